"""Summaries per pair, per day and token, per trader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.functions.rounding import round_scaled

# The daily aggregates by column.
DAILY = [
    ("amountIn", ["sum", "mean", "count"]),
    ("amountInUSD", ["sum", "mean"]),
    ("amountOut", ["sum", "mean"]),
    ("amountOutUSD", ["sum", "mean"]),
]

# Parts in which a pair's traders are ranked first.
SHARES = 64


def _mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def summarize(enriched: DataFrame, top_n: int | None = None) -> DataFrame:
    """Per pair: count, totalUSD, avgUSD (two places), by total descending, then pair.

    Sums run in the type of ``usdVolume``: cast it to a decimal for totals that do not depend on row order.
    """
    return top_pairs(_pair_totals(enriched, "pair"), top_n)


def summarize_windows(enriched: DataFrame, ts: str = "ts", size: str = "60 minutes") -> DataFrame:
    """The pair summary per tumbling window; the batch form of the streaming summary."""
    totals = _pair_totals(enriched.withColumn("window", F.window(ts, size)), "window", "pair")
    return totals.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *totals.columns[1:]
    )


def window_sums(enriched: DataFrame, ts: str = "ts", size: str = "60 minutes") -> DataFrame:
    """What ``summarize_windows`` is made from: per tumbling window and pair the count and, in the type of a sum of ``usdVolume``, the total; rows of several tables can be merged."""
    sums = enriched.groupBy(F.window(ts, size).alias("window"), "pair").agg(F.count("usdVolume").alias("count"), F.sum("usdVolume").alias("total"))
    return sums.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "pair", "count", "total")


def merged_window_sums(sums: DataFrame, *kept: Column) -> DataFrame:
    """The windows of ``summarize_windows`` over all rows that went into the ``window_sums``, and aggregates to keep beside them."""
    by = ["window_start", "window_end", "pair"]
    merged = sums.groupBy(*by).agg(F.sum("count").alias("count"), F.coalesce(F.sum("total").cast("double"), F.lit(0.0)).alias("_total"), *kept)
    return _rounded(merged, *by, kept=merged.columns[5:])


def _pair_totals(enriched: DataFrame, *by: str) -> DataFrame:
    sums = enriched.groupBy(*by).agg(
        F.count("usdVolume").alias("count"),
        F.coalesce(F.sum("usdVolume").cast("double"), F.lit(0.0)).alias("_total"),
    )
    return _rounded(sums, *by)


def _rounded(sums: DataFrame, *by: str, kept: Sequence[str] = ()) -> DataFrame:
    return sums.select(
        *by,
        "count",
        round_scaled(F.col("_total"), 2).alias("totalUSD"),
        round_scaled(F.try_divide(F.col("_total"), F.col("count")), 2).alias("avgUSD"),
        *kept,
    )


def top_pairs(summary: DataFrame, n: int | None) -> DataFrame:
    """The first n pairs by total descending, then pair; all of them for None or n <= 0."""
    ordered = summary.orderBy(F.col("totalUSD").desc(), F.col("pair").asc())
    return ordered.limit(n) if n is not None and n > 0 else ordered


def daily_token_agg(df: DataFrame) -> DataFrame:
    """Per (date, tokenIn): sums, means and the count of the amount columns there are.

    Rows without date or token are dropped, a sum over no value is 0, a mean over none NULL.
    """
    have = set(df.columns)
    made = {
        "sum": lambda c: F.coalesce(F.sum(c).cast("double"), F.lit(0.0)),
        "mean": lambda c: _mean(F.sum(c), F.count(c)),
        "count": lambda c: F.count(c),
    }
    aggs = [made[kind](name).alias(f"{name}_{kind}") for name, kinds in DAILY if name in have for kind in kinds]
    return df.dropna(subset=["date", "tokenIn"]).groupBy("date", "tokenIn").agg(*aggs)


def top_traders(enriched: DataFrame, n: int, trader: str = "trader") -> DataFrame:
    """Per pair the n trader addresses with most volume, best first, as the array tradersTopN.

    Volumes are summed per (pair, trader) first. Then traders are ranked in ``SHARES`` shares of their pair, and the best n of each share in the pair,
    so no task ranks all traders of a crowded pair, whatever n is.
    """
    volume = enriched.groupBy("pair", F.col(trader).alias("trader")).agg(F.sum("usdVolume").alias("_volume"))
    order = [F.col("_volume").desc(), F.col("trader").asc()]
    best = volume.withColumn("_share", F.pmod(F.xxhash64("trader"), F.lit(SHARES)))
    for keys in (["pair", "_share"], ["pair"]):
        best = best.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n)
    listed = F.sort_array(F.collect_list(F.struct("_rank", "trader")))
    return best.groupBy("pair").agg(F.transform(listed, lambda row: row["trader"]).alias("tradersTopN"))


def mean_std(df: DataFrame, column: str) -> DataFrame:
    """One row: mean and sample standard deviation."""
    return df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def moments(df: DataFrame, column: str) -> DataFrame:
    """One row that can be kept and merged: n, mean, and m2, the sum of squared deviations. A run keeps that of its own rows."""
    return df.agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * F.count(column)).alias("m2")
    ).select("n", F.coalesce("mean", F.lit(0.0)).cast("double").alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))


def merged_mean_std(kept: DataFrame) -> DataFrame:
    """``mean_std`` over the rows of all runs, from their ``moments`` alone.

    The squared deviations of a run around the common mean are its own and n times the square of the distance of the means, so nothing large is subtracted.
    """
    total = kept.agg(F.struct(F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean")).alias("t"))
    common = total.select("t").scalar()
    spread = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("t.mean")) ** 2)
    merged = kept.withColumn("t", common).agg(F.first("t").alias("t"), spread.alias("m2"))
    return merged.select(F.col("t.mean").alias("mean"), F.when(F.col("t.n") > 1, F.sqrt(F.col("m2") / (F.col("t.n") - 1))).alias("std"))
