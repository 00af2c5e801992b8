"""Normalising, validating and de-duplicating swap records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.functions.numbers import no_nan, to_number, to_whole
from swaplens.plans.names import fresh
from swaplens.plans.once import with_once
from swaplens.plans.ordered import orderable

# Pool-side column names and the trade-side names that stand for them.
ALIASES = [
    ("amount0", "amountIn"),
    ("amount1", "amountOut"),
    ("token0", "tokenIn"),
    ("token1", "tokenOut"),
    ("txHash", "transaction"),
]
NUMERIC = ["amount0", "amount1", "amountIn", "amountOut", "amountInUSD", "amountOutUSD"]
REQUIRED = ["id", "transaction", "tokenIn", "tokenOut", "blockNumber"]
NOT_NEGATIVE = ["amountIn", "amountOut", "amountInUSD", "amountOutUSD"]


def normalize_swaps(df: DataFrame) -> DataFrame:
    """Trade-side names, numeric amounts, timestamp and date; only columns that are there are touched.

    Text that is no number becomes NULL. ``timestamp`` holds epoch seconds.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    numeric = [name for name in NUMERIC if name in df.columns]
    parsed = {name: to_number(F.col(name)) for name in [*numeric, "timestamp"] if name in text}
    if "blockNumber" in text:
        parsed["blockNumber"] = to_whole(F.col("blockNumber"))
    if parsed:
        df = with_once(df, parsed)
    df = df.withColumns({name: no_nan(F.col(name).cast("double")) for name in numeric if name not in text})
    have = set(df.columns)
    df = df.withColumns({new: F.col(old) for old, new in ALIASES if old in have and new not in have})
    if "timestamp" not in have:
        return df
    micros = (F.col("timestamp") * 1000000).try_cast("bigint")
    return df.withColumn("timestamp", F.timestamp_micros(micros)).withColumn("date", F.to_date("timestamp"))


def validate(df: DataFrame, allow_negative: Sequence[str] = ()) -> DataFrame:
    """Rows with every required field and no negative amount; a NULL amount fails too.

    A swap usually has one negative side: name it in ``allow_negative`` to keep such rows.
    """
    have = set(df.columns)
    df = df.dropna(subset=[name for name in REQUIRED if name in have])
    for name in NOT_NEGATIVE:
        if name in have and name not in allow_negative:
            df = df.where(F.col(name) >= 0)
    return df


def dedupe(df: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """One row per key (NULL is a key like any other), the least by ``order``, else by all columns.

    The rank filter is also applied before the shuffle, so each task sends one row per key and a key that
    fills a third of the table does not meet in one task.
    """
    if key not in df.columns:
        return df
    by = list(order) or orderable(df)
    first = Window.partitionBy(key).orderBy(*by)
    (rank,) = fresh(df, "_rank")
    return df.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
