"""Time-ordered operators: rolling sums, outliers, tick direction, quotes, sign flips, rates, feed gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.operators.aggregate import mean_std
from swaplens.plans.names import fresh
from swaplens.plans.ordered import previous_row, running_max, trailing_sums
from swaplens.plans.scale import small_side, stored

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 3600 * SECOND

# Half of the estimated spread on either side of the price.
BID_FACTOR = 0.9995
ASK_FACTOR = 1.0005


def _cells(width: int) -> list[int]:
    """Cell sizes for a trailing span: seconds, then minutes or hours when the span is long."""
    if width % SECOND or width <= SECOND:
        raise ValueError("the span must be whole seconds, two at least")
    if width <= 2 * MINUTE:
        return [SECOND]
    for coarse in (HOUR, MINUTE):
        if width % coarse == 0 and width >= 2 * coarse:
            return [SECOND, coarse]
    return [SECOND]


def rolling_volume(
    df: DataFrame,
    hours: int = 24,
    keys: Sequence[str] = (),
    value: str = "amountInUSD",
    ts: str = "timestamp",
) -> DataFrame:
    """Add rolling_volume_usd: the sum of ``value`` over (t - hours, t], per key if any.

    Rows at the same instant see the same sum. It is NULL where the span holds no value.
    """
    (micros,) = fresh(df, "_micros")
    at = df.withColumn(micros, F.unix_micros(ts))
    done = trailing_sums(at, keys, micros, hours * HOUR, {"rolling_volume_usd": F.col(value)}, _cells(hours * HOUR))
    return done.drop(micros)


def sliding_rate(
    events: DataFrame, key: str | None, seconds: int, limit: int, ts: str = "ts"
) -> DataFrame:
    """Requests in the trailing window [t - seconds, t] of each request, what remains, and whether it is over.

    The window is closed on both sides: an entry expires only when it is older than the window.
    """
    keys = [key] if key else []
    (micros,) = fresh(events, "_micros")
    at = events.withColumn(micros, F.unix_micros(ts))
    counted = trailing_sums(
        at, keys, micros, seconds * SECOND, {"requests_in_window": F.lit(1)}, _cells(seconds * SECOND), True
    )
    used = F.col("requests_in_window")
    return counted.withColumns(
        {"remaining": F.greatest(F.lit(limit) - used, F.lit(0)), "over_limit": used > limit}
    ).drop(micros)


def flag_outliers(df: DataFrame, column: str = "amountInUSD", threshold: float = 3.0) -> DataFrame:
    """Add z_score and is_outlier (|z| > threshold) against the mean and deviation of the whole column.

    One row of statistics, read as a scalar subquery; with no deviation nothing is flagged and z_score is NULL.
    """
    if column not in df.columns:
        return df
    stats = mean_std(df, column).select(F.struct("mean", "std")).scalar()
    (held,) = fresh(df, "_stats")
    z = F.when(F.col(held)["std"] > 0, (F.col(column) - F.col(held)["mean"]) / F.col(held)["std"])
    return (
        df.withColumn(held, stats)
        .withColumn("z_score", z)
        .withColumn("is_outlier", F.coalesce(F.abs("z_score") > threshold, F.lit(False)))
        .drop(held)
    )


def direction(price: Column, previous: Column) -> Column:
    return F.when(price > previous, "up").when(price < previous, "down").otherwise("neutral")


def tick_direction(ticks: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Add priceDirection: up, down or neutral against the symbol's previous tick."""
    (previous,) = fresh(ticks, "_previous")
    with_previous = previous_row(ticks, ["symbol"], order, F.col("price"), previous)
    return with_previous.withColumn("priceDirection", direction(F.col("price"), F.col(previous))).drop(previous)


def _given(df: DataFrame, name: str) -> Column:
    """A quote the tick brings itself; 0 counts as absent."""
    return F.nullif(F.col(name), F.lit(0.0)) if name in df.columns else F.lit(None).cast("double")


def estimated_quotes(
    ticks: DataFrame, mode: str = "per_tick", order: Sequence[str] = ("ts", "event_id")
) -> DataFrame:
    """Add bid and ask, estimated from the price where the tick has none; volume24h and change24h default to 0.

    per_tick: from the tick's own price. sticky: from the symbol's first price that gave a quote, which then stays.
    """
    if mode not in ("per_tick", "sticky"):
        raise ValueError(f"Unsupported mode: {mode}")
    base: Column = F.col("price")
    symbol, since, given = fresh(ticks, "_symbol", "_since", "_first")
    if mode == "sticky":
        # One row per symbol, combined map-side.
        first = (
            ticks.where(F.col("price") != 0)
            .groupBy(F.col("symbol").alias(symbol))
            .agg(F.min(F.struct(*order)).alias(since), F.min_by("price", F.struct(*order)).alias(given))
        )
        ticks = ticks.join(small_side(first, derived=True), F.col("symbol") == F.col(symbol), "left")
        base = F.when(F.struct(*order) >= F.col(since), F.col(given)).otherwise(base)
    quoted = ticks.withColumns(
        {
            "bid": F.coalesce(_given(ticks, "bid"), base * BID_FACTOR),
            "ask": F.coalesce(_given(ticks, "ask"), base * ASK_FACTOR),
            "volume24h": F.coalesce(_given(ticks, "volume24h"), F.lit(0.0)),
            "change24h": F.coalesce(_given(ticks, "change24h"), F.lit(0.0)),
        }
    )
    return quoted.drop(symbol, since, given)


def pnl_sign_flips(
    ticks: DataFrame, value: str = "pnl", key: str = "id", order: Sequence[str] = ("ts", "event_id")
) -> DataFrame:
    """The ticks at which a position's P&L turned from gain to loss or back; a zero in between resets.

    Adds previousSign and sign.
    """
    signed = ticks.withColumn("sign", F.signum(value).cast("int"))
    with_previous = previous_row(signed, [key], order, F.col("sign"), "previousSign")
    return with_previous.where(F.col("sign") * F.col("previousSign") == -1)


def _feed_cells(ticks: DataFrame, seconds: int, ts: str) -> DataFrame:
    """Per symbol and cell of ``seconds``: first and last tick, count.

    Two ticks in one cell are less than ``seconds`` apart, so no gap is inside a cell: the history of a
    symbol shrinks to at most one row per ``seconds``, combined before the shuffle.
    """
    micros = F.unix_micros(ts)
    return ticks.groupBy("symbol", (micros - F.pmod(micros, F.lit(seconds * SECOND))).alias("_cell")).agg(
        F.min(ts).alias("_from"), F.max(ts).alias("_to"), F.count("*").alias("_ticks")
    )


def feed_gaps(ticks: DataFrame, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Spans of more than ``seconds`` without a tick: symbol, gap_start, gap_end, gap_seconds."""
    gaps = (
        previous_row(_feed_cells(ticks, seconds, ts), ["symbol"], ["_cell"], F.col("_to"), "gap_start")
        .withColumn("_gap", F.unix_micros("_from") - F.unix_micros("gap_start"))
        .where(F.col("_gap") > seconds * SECOND)
    )
    return gaps.select(
        "symbol", "gap_start", F.col("_from").alias("gap_end"), (F.col("_gap") / SECOND).alias("gap_seconds")
    )


def feed_sessions(ticks: DataFrame, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Spans in which ticks follow each other within less than ``seconds``: symbol, start, end, ticks.

    The session ends ``seconds`` after its last tick, as ``session_window`` has it. A cell belongs to the last one before it, or itself, that
    opens a session: within a chunk of cells by a window, before the chunk by the running maximum over the chunks, one row each.
    """
    cells = previous_row(_feed_cells(ticks, seconds, ts), ["symbol"], ["_cell"], F.col("_to"), "_earlier", "_part")
    opens = F.coalesce(F.unix_micros("_from") - F.unix_micros("_earlier") >= seconds * SECOND, F.lit(True))
    # Written once, so that both uses see the same chunks.
    chunked = stored(cells.withColumn("_opened", F.when(opens, F.col("_cell"))), "sessions")
    upto = Window.partitionBy("symbol", "_part").orderBy("_cell")
    earlier = Window.partitionBy("symbol").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    last = chunked.groupBy("symbol", "_part").agg(F.max("_opened").alias("_last"))
    carried = last.select(F.col("symbol").alias("_symbol"), F.col("_part").alias("_of"), F.max("_last").over(earlier).alias("_carried"))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_part") == F.col("_of"))
    numbered = chunked.withColumn("_mine", F.max("_opened").over(upto)).join(carried, same).withColumn("_session", F.coalesce("_mine", "_carried"))
    return (
        numbered.groupBy("symbol", "_session")
        .agg(
            F.min("_from").alias("session_start"),
            (F.max("_to") + F.expr(f"INTERVAL {int(seconds)} SECONDS")).alias("session_end"),
            F.sum("_ticks").alias("ticks"),
        )
        .drop("_session")
    )


def merged_sessions(parts: DataFrame) -> DataFrame:
    """The ``feed_sessions`` of all ticks from those of any tables the ticks were dealt into: sessions that overlap are one.

    A session ends ``seconds`` after its last tick, so one that starts before another's end has a tick within ``seconds`` of it. It belongs to the last start
    that no earlier session reaches. Starts are range-cut, so no task holds a symbol's history.
    """
    rows = parts.groupBy("symbol", "session_start").agg(F.max("session_end").alias("session_end"), F.sum("ticks").alias("ticks"))
    # Written once, so that all uses see the same chunks.
    chunked = stored(rows.repartitionByRange("symbol", "session_start").withColumn("_part", F.spark_partition_id()), "parts")
    reached = running_max(chunked, ["symbol"], "_part", ["session_start"], F.col("session_end"), "_reach", before=True)
    opens = F.coalesce(F.col("session_start") >= F.col("_reach"), F.lit(True))
    opened = F.when(opens, F.col("session_start"))
    numbered = running_max(reached, ["symbol"], "_part", ["session_start"], opened, "_session")
    return (
        numbered.groupBy("symbol", "_session")
        .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("ticks").alias("ticks"))
        .drop("_session")
    )
