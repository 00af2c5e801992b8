"""Shared parts of the oracle SQL (DuckDB)."""

from __future__ import annotations


def fixed(x: str) -> str:
    """Two places by exact binary value, ties (odd eighths) away from zero; no negative zero."""
    return (
        f"(CASE WHEN (abs({x}) * 8) % 2 = 1 THEN sign({x}) * (floor(abs({x}) * 100) + 1) / 100 "
        f"ELSE CAST(printf('%.2f', {x}) AS DOUBLE) END + 0.0)"
    )


def scaled(x: str, places: int) -> str:
    """Scale, round half to even, scale back."""
    scale = f"{10**places}.0"
    return f"(round_even(CAST({x} AS DOUBLE) * {scale}, 0) / {scale})"


SWAP_ROWS = """swap_rows AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS id,
         concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS txHash,
         l_orderkey AS blockNumber, CAST(epoch(l_shipdate) AS BIGINT) AS timestamp,
         l_partkey, l_suppkey, l_linenumber AS line,
         CAST(CAST(l_quantity AS BIGINT) * 1000000 AS VARCHAR) AS amount0,
         CAST(CAST(-100 * CAST(l_extendedprice AS DECIMAL(18,2)) AS BIGINT) AS VARCHAR) AS amount1,
         '0' AS sqrtPriceX96, concat('trader-', CAST(l_suppkey AS VARCHAR)) AS trader
  FROM lineitem)"""

SWAPS = (
    SWAP_ROWS
    + """, swaps AS (
  SELECT r.*, CASE WHEN line % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS token0, n_name AS token1
  FROM swap_rows r JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
)

PRICES = """prices AS (
  SELECT p_brand AS token, CAST(min(p_retailprice) AS DOUBLE) AS price_usd
  FROM part WHERE p_brand <> 'Brand#7' GROUP BY p_brand
  UNION ALL
  SELECT n_name, CASE WHEN n_nationkey < 3 THEN CAST(1 AS DOUBLE) ELSE CAST(n_nationkey + 2 AS DOUBLE) END
  FROM nation)"""

DIMS = (
    PRICES
    + """, stables AS (
  SELECT 'brand#1' AS token UNION ALL SELECT lower(n_name) FROM nation WHERE n_nationkey < 3),
decimals AS (
  SELECT lower(p_brand) AS token, 6 AS decimals FROM part WHERE p_brand <> 'Brand#2' GROUP BY lower(p_brand)
  UNION ALL SELECT lower(n_name), 2 FROM nation)"""
)

# Swaps with both prices and quantities; a missing price or unreadable amount stays NULL here.
LOOKED_UP = """looked_up AS (
  SELECT s.*, p0.price_usd AS price0, p1.price_usd AS price1,
         TRY_CAST(s.amount0 AS DOUBLE) / pow(10.0, coalesce(d0.decimals, 18)) AS quantity0,
         TRY_CAST(s.amount1 AS DOUBLE) / pow(10.0, coalesce(d1.decimals, 18)) AS quantity1,
         lower(s.token0) IN (SELECT token FROM stables) AS stable0,
         lower(s.token1) IN (SELECT token FROM stables) AS stable1
  FROM swaps s
  LEFT JOIN prices p0 ON lower(s.token0) = lower(p0.token)
  LEFT JOIN prices p1 ON lower(s.token1) = lower(p1.token)
  LEFT JOIN decimals d0 ON lower(s.token0) = d0.token
  LEFT JOIN decimals d1 ON lower(s.token1) = d1.token)"""

VOLUME = (
    "CASE WHEN stable0 THEN abs(quantity0 * price0) WHEN stable1 THEN abs(quantity1 * price1) "
    "ELSE abs(quantity0 * price0) + abs(quantity1 * price1) END"
)

ENRICHED = f"""{SWAPS}, {DIMS}, {LOOKED_UP}, enriched AS (
  SELECT id, txHash, blockNumber, timestamp, amount0, amount1, sqrtPriceX96, trader, line, token0, token1,
         CAST(printf('%.6f', price0) AS DOUBLE) AS priceUSD0,
         CAST(printf('%.6f', price1) AS DOUBLE) AS priceUSD1,
         CAST(printf('%.6f', {VOLUME}) AS DOUBLE) AS usdVolume,
         concat(lower(token0), '-', lower(token1)) AS pair
  FROM looked_up WHERE price0 IS NOT NULL AND price1 IS NOT NULL
    AND quantity0 IS NOT NULL AND quantity1 IS NOT NULL)"""

TICKS = "ticks AS (SELECT event_id, event_type AS symbol, value AS price, ts FROM events)"

POSITIONS = """positions AS (
  SELECT o_orderkey AS id,
         CASE o_orderkey % 5 WHEN 0 THEN 'view' WHEN 1 THEN 'signup' WHEN 2 THEN 'purchase'
                             WHEN 3 THEN 'error' ELSE 'click' END AS symbol,
         CAST(o_orderkey % 7 AS DOUBLE) AS size, CAST(10 + o_orderkey % 90 AS DOUBLE) AS entryPrice,
         CAST(o_orderkey % 4 AS DOUBLE) AS leverage,
         CASE WHEN o_orderstatus = 'F' THEN 'short' ELSE 'long' END AS side
  FROM orders)"""

POSITION_TICKS = """position_ticks AS (
  SELECT user_id AS id, event_id, ts, value AS price, CAST(user_id % 20 + 5 AS DOUBLE) AS entryPrice,
         (user_id % 7) / 2.0 AS size, CAST(user_id % 4 AS DOUBLE) AS leverage,
         CASE WHEN user_id % 3 = 0 THEN 'short' ELSE 'long' END AS side
  FROM events)"""

LATEST = """latest AS (
  SELECT symbol, event_id, price, ts FROM ticks
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) = 1)"""

USABLE = "(entryPrice > 0 AND price > 0 AND leverage > 0 AND size <> 0)"


def pnl(source: str) -> str:
    """The P&L columns over ``source``, which has entryPrice, price, size, side, leverage."""
    gain = "(CASE WHEN side = 'long' THEN price - entryPrice ELSE entryPrice - price END) * abs(size) * leverage"
    return f"""pnl AS (
  SELECT *, CASE WHEN {USABLE} THEN {fixed('gain')} ELSE 0 END AS absolute,
         CASE WHEN {USABLE} THEN {fixed('gain / (entryPrice * abs(size)) * 100')} ELSE 0 END AS percentage,
         CASE WHEN {USABLE} THEN {fixed('entryPrice * abs(size)')} ELSE 0 END AS entryValue,
         CASE WHEN {USABLE} THEN {fixed('price * abs(size)')} ELSE 0 END AS currentValue
  FROM (SELECT *, {gain} AS gain FROM {source}))"""
