"""Explicit schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# 256-bit integers stay decimal text until an operator needs a double.
SWAP_SCHEMA = T.StructType(
    [
        T.StructField("txHash", T.StringType()),
        T.StructField("blockNumber", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("token0", T.StringType()),
        T.StructField("token1", T.StringType()),
        T.StructField("amount0", T.StringType()),
        T.StructField("amount1", T.StringType()),
        T.StructField("sqrtPriceX96", T.StringType()),
    ]
)

ENRICHED_SCHEMA = T.StructType(
    SWAP_SCHEMA.fields
    + [
        T.StructField("priceUSD0", T.DoubleType()),
        T.StructField("priceUSD1", T.DoubleType()),
        T.StructField("usdVolume", T.DoubleType()),
        T.StructField("pair", T.StringType()),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("pair", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("totalUSD", T.DoubleType()),
        T.StructField("avgUSD", T.DoubleType()),
    ]
)

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("price_usd", T.DoubleType()),
    ]
)

TICK_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

POSITION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("entryPrice", T.DoubleType()),
        T.StructField("leverage", T.DoubleType()),
        T.StructField("side", T.StringType()),
    ]
)

_TOKEN = "STRUCT<symbol: STRING, id: STRING>"

# One response page of the swap service. Leaves are text: casting happens per record, so that one bad
# value rejects one swap and not its page.
PAGE_DDL = (
    "errors ARRAY<STRUCT<message: STRING>>, "
    "data STRUCT<swaps: ARRAY<STRUCT<id: STRING, transaction: STRUCT<id: STRING>, timestamp: STRING, "
    f"blockNumber: STRING, token0: {_TOKEN}, token1: {_TOKEN}, amount0: STRING, amount1: STRING, "
    "sqrtPriceX96: STRING>>>"
)

# Market feed envelopes.
MIDS_DDL = "channel STRING, data MAP<STRING, STRING>"
TRADES_DDL = (
    "channel STRING, data ARRAY<STRUCT<coin: STRING, side: STRING, px: STRING, sz: STRING, "
    "time: BIGINT, hash: STRING, tid: BIGINT>>"
)
