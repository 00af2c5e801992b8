"""Ordered operators over ticks, and positions with their profit and loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.checks import sql as S
from swaplens.checks.registry import query
from swaplens.functions import money
from swaplens.functions.rounding import round_scaled
from swaplens.operators import market, ordered
from swaplens.plans.scale import run_dir
from swaplens.sources import adapters as A
from swaplens.sources import feed, files


def _micros(df: DataFrame, *names: str) -> DataFrame:
    """Instants as epoch microseconds, which compare without time zones."""
    return df.withColumns({name: F.unix_micros(name) for name in names})


# Ordered operators

TRAILING_DAY = "RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW"


def _exact_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price", F.col("price").cast("decimal(18,2)"))


def _rolling(df: DataFrame) -> DataFrame:
    return _micros(df, "ts").withColumns(
        {"price": F.col("price").cast("double"), "rolling_volume_usd": F.col("rolling_volume_usd").cast("double")}
    )


@query(
    "rolling_volume",
    f"""WITH {S.TICKS} SELECT event_id, symbol, price, epoch_us(ts) AS ts,
    CAST(sum(CAST(price AS DECIMAL(18,2))) OVER (ORDER BY ts {TRAILING_DAY}) AS DOUBLE) AS rolling_volume_usd
    FROM ticks""",
)
def rolling_volume(spark, d):
    return _rolling(ordered.rolling_volume(_exact_price(A.ticks(spark, d)), 24, value="price", ts="ts"))


@query(
    "rolling_volume_by_symbol",
    f"""WITH {S.TICKS} SELECT event_id, symbol, price, epoch_us(ts) AS ts,
    CAST(sum(CAST(price AS DECIMAL(18,2))) OVER (PARTITION BY symbol ORDER BY ts {TRAILING_DAY}) AS DOUBLE)
      AS rolling_volume_usd FROM ticks""",
)
def rolling_volume_by_symbol(spark, d):
    ticks = _exact_price(A.ticks(spark, d))
    return _rolling(ordered.rolling_volume(ticks, 24, ["symbol"], value="price", ts="ts"))


@query(
    "rolling_swap_volume",
    """WITH daily AS (
      SELECT l_shipdate, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
      FROM lineitem GROUP BY l_shipdate),
    rolled AS (
      SELECT l_shipdate, sum(total) OVER (ORDER BY l_shipdate RANGE BETWEEN INTERVAL '6 days' PRECEDING AND CURRENT ROW)
        AS rolled FROM daily)
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price, epoch_us(l_shipdate) AS ts,
           CAST(rolled AS DOUBLE) AS rolling_volume_usd
    FROM lineitem JOIN rolled USING (l_shipdate)""",
)
def rolling_swap_volume(spark, d):
    rows = A.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    return _rolling(ordered.rolling_volume(rows, 7 * 24, value="price", ts="ts"))


@query(
    "flagged_outliers",
    f"""WITH stats AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    SELECT event_id, value, {S.scaled('(value - m) / s', 6)} AS z_score, abs((value - m) / s) > 3 AS is_outlier
    FROM events, stats""",
)
def flagged_outliers(spark, d):
    flagged = ordered.flag_outliers(A.table(spark, d, "events").select("event_id", "value"), "value")
    return flagged.withColumn("z_score", round_scaled(F.col("z_score"), 6))


DIRECTION_SQL = """CASE WHEN price > before THEN 'up' WHEN price < before THEN 'down' ELSE 'neutral' END"""


@query(
    "tick_direction",
    f"""WITH {S.TICKS}, lagged AS (
      SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS before FROM ticks)
    SELECT event_id, symbol, price, epoch_us(ts) AS ts, {DIRECTION_SQL} AS priceDirection FROM lagged""",
)
def tick_direction(spark, d):
    return _micros(ordered.tick_direction(A.ticks(spark, d)), "ts")


@query(
    "estimated_quotes",
    f"""WITH {S.TICKS} SELECT event_id, symbol, price, epoch_us(ts) AS ts, price * 0.9995::DOUBLE AS bid,
    price * 1.0005::DOUBLE AS ask, 0::DOUBLE AS volume24h, 0::DOUBLE AS change24h FROM ticks""",
)
def estimated_quotes(spark, d):
    return _micros(ordered.estimated_quotes(A.ticks(spark, d)), "ts")


@query(
    "estimated_quotes_sticky",
    f"""WITH {S.TICKS}, held AS (
      SELECT *, first_value(price) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS first FROM ticks)
    SELECT event_id, symbol, price, epoch_us(ts) AS ts, first * 0.9995::DOUBLE AS bid, first * 1.0005::DOUBLE AS ask,
           0::DOUBLE AS volume24h, 0::DOUBLE AS change24h FROM held""",
)
def estimated_quotes_sticky(spark, d):
    return _micros(ordered.estimated_quotes(A.ticks(spark, d), mode="sticky"), "ts")


FLIPS_SQL = f"""WITH {S.POSITION_TICKS}, {S.pnl('position_ticks')}, signs AS (
      SELECT id, event_id, epoch_us(ts) AS ts, absolute AS pnl, CAST(sign(absolute) AS INTEGER) AS sign,
             lag(CAST(sign(absolute) AS INTEGER)) OVER (PARTITION BY id ORDER BY ts, event_id) AS previousSign
      FROM pnl)
    SELECT * FROM signs WHERE sign * previousSign = -1"""


@query("pnl_sign_flips", FLIPS_SQL)
def pnl_sign_flips(spark, d):
    valued = market.with_pnl(A.position_ticks(spark, d))
    flips = ordered.pnl_sign_flips(valued.select("id", "event_id", "ts", F.col("pnl.absolute").alias("pnl")))
    return _micros(flips, "ts")


@query(
    "sliding_rate",
    """WITH counted AS (
      SELECT event_id, user_id, epoch_us(ts) AS ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL '12 hours' PRECEDING AND CURRENT ROW) AS requests_in_window FROM events)
    SELECT *, greatest(2 - requests_in_window, 0) AS remaining, requests_in_window > 2 AS over_limit FROM counted""",
)
def sliding_rate(spark, d):
    events = A.table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return _micros(ordered.sliding_rate(events, "user_id", 12 * 3600, 2), "ts")


@query(
    "sliding_rate_all",
    """WITH counted AS (
      SELECT event_id, epoch_us(ts) AS ts, count(*) OVER (ORDER BY ts
        RANGE BETWEEN INTERVAL '60 seconds' PRECEDING AND CURRENT ROW) AS requests_in_window FROM events)
    SELECT *, greatest(50 - requests_in_window, 0) AS remaining, requests_in_window > 50 AS over_limit FROM counted""",
)
def sliding_rate_all(spark, d):
    events = A.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return _micros(ordered.sliding_rate(events, None, 60, 50), "ts")


@query(
    "feed_gaps",
    f"""WITH {S.TICKS}, lagged AS (
      SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS before FROM ticks)
    SELECT symbol, epoch_us(before) AS gap_start, epoch_us(ts) AS gap_end,
           (epoch_us(ts) - epoch_us(before)) / 1000000.0::DOUBLE AS gap_seconds
    FROM lagged WHERE epoch_us(ts) - epoch_us(before) > 60000000""",
)
def feed_gaps(spark, d):
    return _micros(ordered.feed_gaps(A.ticks(spark, d)), "gap_start", "gap_end")


SESSIONS_SQL = f"""{S.TICKS}, lagged AS (
  SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS before FROM ticks),
numbered AS (
  SELECT *, sum(CASE WHEN before IS NULL OR us - before >= GAP THEN 1 ELSE 0 END)
    OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM lagged),
sessions AS (
  SELECT symbol, min(us) AS session_start, max(us) + GAP AS session_end, count(*) AS ticks
  FROM numbered GROUP BY symbol, session)"""


@query(
    "feed_sessions",
    f"WITH {SESSIONS_SQL.replace('GAP', '3600000000')} SELECT * FROM sessions",
)
def feed_sessions(spark, d):
    return _micros(ordered.feed_sessions(A.ticks(spark, d), 3600), "session_start", "session_end")


# Feed messages


def _coin(symbol: str):
    return F.when(F.col(symbol) == "view", "BTC").when(F.col(symbol) == "click", "ETH").when(
        F.col(symbol) == "error", "DOGE"
    ).otherwise(F.col(symbol))


COIN_SQL = "CASE event_type WHEN 'view' THEN 'BTC' WHEN 'click' THEN 'ETH' WHEN 'error' THEN 'DOGE' ELSE event_type END"
MARKET_SQL = "CASE event_type WHEN 'view' THEN 'BTC-USD' WHEN 'click' THEN 'ETH-USD' WHEN 'error' THEN 'DOGE' ELSE event_type END"


@query("normalized_symbols", f"SELECT event_id, {MARKET_SQL} AS symbol FROM events")
def normalized_symbols(spark, d):
    return A.ticks(spark, d).select("event_id", money.normalize_symbol(_coin("symbol")).alias("symbol"))


@query(
    "parsed_mids",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'BTC-USD' ELSE 'ETH-USD' END AS symbol, value AS price
       FROM events WHERE event_type IN ('view', 'click')
       UNION ALL SELECT event_id, 'SOL-USD', value + 1 FROM events WHERE user_id % 2 = 0""",
)
def parsed_mids(spark, d):
    """One message per event: its own coin, and a second price that is no number for odd users."""
    second = F.when(F.col("user_id") % 2 == 0, (F.col("value") + 1).cast("string")).otherwise("n/a")
    data = F.create_map(_coin("event_type"), F.col("value").cast("string"), F.lit("SOL"), second)
    raw = A.table(spark, d, "events").select(
        "event_id", F.to_json(F.struct(F.lit("allMids").alias("channel"), data.alias("data"))).alias("value")
    )
    return feed.parse_mids(raw)


@query(
    "parsed_trades",
    f"""SELECT event_id, {MARKET_SQL} AS symbol, value AS price FROM events WHERE event_type <> 'purchase'""",
)
def parsed_trades(spark, d):
    """One message per event, of an older trade and the event's; purchases come on another channel."""
    trade = lambda price: F.struct(
        _coin("event_type").alias("coin"), F.lit("B").alias("side"), price.cast("string").alias("px"), F.lit("1").alias("sz")
    )
    channel = F.when(F.col("event_type") == "purchase", "orders").otherwise("trades")
    data = F.array(trade(F.col("value") - 5), trade(F.col("value")))
    raw = A.table(spark, d, "events").select(
        "event_id", F.to_json(F.struct(channel.alias("channel"), data.alias("data"))).alias("value")
    )
    return feed.parse_trades(raw)


# Positions


@query("latest_tick", f"WITH {S.TICKS}, {S.LATEST} SELECT event_id, symbol, price, epoch_us(ts) AS ts FROM latest")
def latest_tick(spark, d):
    return _micros(market.latest_tick(A.ticks(spark, d)), "ts")


@query(
    "spread",
    f"""WITH {S.TICKS}, quotes AS (
      SELECT event_id, price, price * 0.9995::DOUBLE AS bid, price * 1.0005::DOUBLE AS ask FROM ticks)
    SELECT event_id, price, bid, ask, ask - bid AS spread,
           CASE WHEN price <> 0 THEN (ask - bid) / price * 100 END AS spreadPercent FROM quotes""",
)
def spread(spark, d):
    quotes = ordered.estimated_quotes(A.ticks(spark, d).select("event_id", "symbol", "price", "ts"))
    return market.with_spread(quotes.select("event_id", "price", "bid", "ask"))


PNL_COLUMNS = "absolute, percentage, entryValue, currentValue"


def _flat(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "pnl.*")


@query(
    "pnl",
    f"""WITH {S.POSITION_TICKS}, {S.pnl('position_ticks')}
    SELECT event_id, id, side, {PNL_COLUMNS} FROM pnl""",
)
def pnl(spark, d):
    return _flat(market.with_pnl(A.position_ticks(spark, d)), "event_id", "id", "side")


@query(
    "pnl_simple",
    f"""WITH {S.POSITION_TICKS}, raw AS (
      SELECT event_id, (price - entryPrice) / entryPrice * size * leverage * 100 AS v FROM position_ticks)
    SELECT event_id, {S.fixed('v')} AS pnl FROM raw""",
)
def pnl_simple(spark, d):
    return market.with_pnl_simple(A.position_ticks(spark, d)).select("event_id", "pnl")


@query(
    "pct_change",
    f"""WITH raw AS (
      SELECT o_orderkey, o_custkey % 4 AS old, o_totalprice AS new, CASE WHEN o_custkey % 4 = 0 THEN 0.0::DOUBLE
        ELSE (o_totalprice - o_custkey % 4) / (o_custkey % 4)::DOUBLE * 100 END AS v FROM orders)
    SELECT o_orderkey, {S.fixed('v')} AS pct_change FROM raw""",
)
def pct_change(spark, d):
    rows = A.table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 4).cast("double").alias("old"), F.col("o_totalprice").alias("new")
    )
    return market.with_pct_change(rows, "old", "new").select("o_orderkey", "pct_change")


@query(
    "formatted_money",
    """SELECT c_custkey,
              CASE WHEN c_acctbal < 0 THEN '-$' ELSE '$' END || format('{:,.2f}', abs(c_acctbal)) AS balance,
              format('{:,.2f}', c_acctbal) AS plain
       FROM customer""",
)
def formatted_money(spark, d):
    return A.table(spark, d, "customer").select(
        "c_custkey",
        money.format_currency(F.col("c_acctbal")).alias("balance"),
        money.format_number(F.col("c_acctbal")).alias("plain"),
    )


@query(
    "valued_positions",
    f"""WITH {S.TICKS}, {S.LATEST}, {S.POSITIONS}, marked AS (
      SELECT p.*, price FROM positions p LEFT JOIN latest l ON p.symbol = l.symbol), {S.pnl('marked')}
    SELECT id, symbol, side, price, {PNL_COLUMNS} FROM pnl""",
)
def valued_positions(spark, d):
    latest = market.latest_tick(A.ticks(spark, d))
    return _flat(market.value_positions(A.positions(spark, d), latest), "id", "symbol", "side", "price")


UPDATES_SQL = "updates AS (SELECT c_custkey AS id, -c_acctbal AS balance FROM customer WHERE c_acctbal < 1000)"


@query(
    "upsert",
    """WITH base AS (SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier),
    updates AS (SELECT c_custkey AS id, -c_acctbal AS balance FROM customer WHERE c_acctbal < 1000)
    SELECT id, balance FROM base WHERE id NOT IN (SELECT id FROM updates) UNION ALL SELECT * FROM updates""",
)
def upsert(spark, d):
    base = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    updates = (
        A.table(spark, d, "customer")
        .where(F.col("c_acctbal") < 1000)
        .select(F.col("c_custkey").alias("id"), (-F.col("c_acctbal")).alias("balance"))
    )
    return market.upsert(base, updates, "id")


@query(
    "updated_pnl",
    f"""WITH {S.POSITIONS}, updates AS (SELECT c_custkey AS id, c_acctbal AS pnl FROM customer)
    SELECT p.id, p.symbol, coalesce(u.pnl, 0) AS pnl FROM positions p LEFT JOIN updates u ON p.id = u.id""",
)
def updated_pnl(spark, d):
    rows = A.positions(spark, d).select("id", "symbol", F.lit(0.0).alias("pnl"))
    updates = A.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("pnl"))
    return market.update_pnl(rows, updates)


@query(
    "pair_summary_by_window",
    f"""WITH totals AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS w, event_type AS pair, count(*) AS count,
             CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)
    SELECT epoch_us(w) AS window_start, epoch_us(w) + 3600000000 AS window_end, pair, count,
           {S.scaled('total', 2)} AS totalUSD, {S.scaled('total / count', 2)} AS avgUSD FROM totals""",
)
def pair_summary_by_window(spark, d):
    from swaplens.operators.aggregate import summarize_windows

    return _micros(summarize_windows(as_volumes(A.ticks(spark, d))), "window_start", "window_end")


def as_volumes(ticks: DataFrame) -> DataFrame:
    """Ticks as enriched swaps: the symbol is the pair, the price its exact volume."""
    return ticks.select("event_id", "ts", F.col("symbol").alias("pair"), F.col("price").cast("decimal(18,2)").alias("usdVolume"))


def write_tick_files(spark, d, slices: int = 6, backwards: bool = False) -> str:
    """events as files in time order, or the latest first, each an equal part of the time they span, for streams that take one file per batch.

    One pass deals the events out by slice; each slice is then written in its turn, as streams take files by age.
    """
    folder = run_dir(spark, "tick-files")
    events = A.table(spark, d, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    width = max(1, -(-((last or 0) - (first or 0) + 1) // slices))
    dealt = f"{folder}-dealt"
    events.withColumn("slice", F.floor((at - F.lit(first or 0)) / F.lit(width)).cast("int")).repartition("slice").write.partitionBy("slice").parquet(dealt)
    parts = spark.read.schema(f"{events.schema.toDDL()}, slice INT").parquet(dealt)
    for n in range(slices)[:: -1 if backwards else 1]:
        files.write(parts.where(F.col("slice") == n).drop("slice").repartition(1), f"{folder}/slice={n}", "parquet")
    return folder
