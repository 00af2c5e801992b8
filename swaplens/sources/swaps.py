"""Swap records: parsing service pages, time and block filters, paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swaplens.functions.numbers import to_integer
from swaplens.plans.ordered import orderable
from swaplens.schemas import PAGE_DDL


def _text(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def checked_pages(raw: DataFrame, column: str = "value") -> DataFrame:
    """All swaps and rejects of JSON response pages, one page per row, in one pass: the swaps' columns, reason and raw.

    A page with errors or without a swap list is one reject, with its own text. A swap without a whole-number timestamp, without a
    whole-number block or without both tokens is a reject of its own; the rest of its page goes on. Good swaps have neither reason nor raw.
    """
    # As generator output the page is parsed once, however many of its fields are tested below.
    page = raw.select(F.col(column).alias("page"), F.inline(F.array(F.from_json(column, PAGE_DDL))))
    messages = F.array_join(F.transform("errors", lambda e: e["message"]), "; ")
    page_reason = F.when(F.col("errors").isNotNull(), F.concat(F.lit("errors: "), F.coalesce(messages, F.lit("")))).when(
        F.col("data.swaps").isNull(), "no swap list"
    )
    bad_page = F.col("page_reason").isNotNull()
    rows = page.select("page", "data", page_reason.alias("page_reason")).select(
        F.when(bad_page, F.col("page")).alias("page"),
        "page_reason",
        F.explode(F.when(bad_page, F.array(F.lit(None))).otherwise(F.col("data.swaps"))).alias("s"),
    )
    return (
        rows.select(
            "s",
            "page",
            "page_reason",
            F.coalesce(_text(F.col("s.transaction.id")), F.col("s.id"), F.lit("")).alias("txHash"),
            to_integer(_text(F.col("s.blockNumber"))).alias("blockNumber"),
            to_integer(F.col("s.timestamp")).alias("timestamp"),
            F.coalesce("s.token0.id", F.lit("")).alias("token0"),
            F.coalesce("s.token1.id", F.lit("")).alias("token1"),
            F.col("s.amount0").alias("amount0"),
            F.col("s.amount1").alias("amount1"),
            F.coalesce("s.sqrtPriceX96", F.lit("0")).alias("sqrtPriceX96"),
        )
        .withColumn(
            "reason",
            F.when(F.col("page_reason").isNotNull(), F.col("page_reason"))
            .when(F.col("timestamp").isNull(), "bad timestamp")
            .when(F.col("blockNumber").isNull(), "bad blockNumber")
            .when(F.col("s.token0").isNull() | F.col("s.token1").isNull(), "bad token"),
        )
        .withColumn("raw", F.when(F.col("reason").isNotNull(), F.coalesce("page", F.to_json("s"))))
        .drop("s", "page", "page_reason")
    )


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(swaps, rejects) of checked pages; a reject is reason and raw."""
    swaps = checked.where(F.col("reason").isNull()).drop("reason", "raw")
    return swaps, checked.where(F.col("reason").isNotNull()).select("reason", "raw")


def parse_swap_pages(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(swaps, rejects) from one JSON response page per row; see ``checked_pages``. To use both, write the checked pages once and split what was written."""
    return split_rejects(checked_pages(raw, column))


def within(df: DataFrame, minutes: int, now: int) -> DataFrame:
    """Rows of the last ``minutes`` before ``now`` (epoch seconds)."""
    return df.where(F.col("timestamp") >= now - minutes * 60)


def recent(df: DataFrame, minutes: int, now: int) -> DataFrame:
    """Rows of the last ``minutes`` before ``now`` (epoch seconds), the oldest first.

    Equal timestamps are ordered by the other columns, so that a crowded second can be cut between tasks.
    """
    rest = [name for name in orderable(df) if name != "timestamp"]
    return within(df, minutes, now).orderBy("timestamp", *rest)


def page(df: DataFrame, order: Sequence[str], first: int, skip: int = 0) -> DataFrame:
    """One page of the ordered rows. For pages far down use ``page_after``, which skips nothing."""
    return df.orderBy(*order).offset(skip).limit(first)


def page_after(df: DataFrame, order: Sequence[str], first: int, last: Sequence | None = None) -> DataFrame:
    """The page that follows the row with order values ``last``: a pushed-down filter and a top-n. NULLs come first, as in ``page``.

    Rows with equal order values are one place: give an order that is total, or those after the last one of a page are passed over.
    """
    if last is not None:
        beyond = F.lit(False)
        equal = F.lit(True)
        for name, value in zip(order, last, strict=True):
            col = F.col(name)
            beyond = beyond | (equal & (col.isNotNull() if value is None else F.coalesce(col > F.lit(value), F.lit(False))))
            equal = equal & (col.isNull() if value is None else col.eqNullSafe(F.lit(value)))
        if last[0] is not None:
            df = df.where(F.col(order[0]) >= F.lit(last[0]))
        df = df.where(beyond)
    return df.orderBy(*order).limit(first)


def cap(df: DataFrame, max_results: int | None) -> DataFrame:
    """At most ``max_results`` rows; all of them for None."""
    return df if max_results is None else df.limit(max_results)


def after_block(df: DataFrame, last_block: int) -> DataFrame:
    """Rows of later blocks only; everything if there is no block column."""
    return df.where(F.col("blockNumber") > last_block) if "blockNumber" in df.columns else df


def block_range(df: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows from block ``start`` to ``end``, both included; open-ended without ``end``."""
    block = F.col("blockNumber")
    return df.where(block >= start) if end is None else df.where(block.between(start, end))
