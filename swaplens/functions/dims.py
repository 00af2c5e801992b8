"""Fixed token tables as small DataFrames; every operator also takes the caller's own."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

DEFAULT_DECIMALS = 18

# Public Ethereum mainnet token contracts, their decimals and their price-service ids.
STABLECOINS = [
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48",  # USDC
    "0xdac17f958d2ee523a2206206994597c13d831ec7",  # USDT
    "0x6b175474e89094c44da98b954eedeac495271d0f",  # DAI
    "0x0000000000085d4780b73119b644ae5ecd22b376",  # TUSD
    "0x8e870d67f660d95d5be530380d0ec0bd388289e1",  # USDP
]

TOKENS = [
    # address, decimals, price id
    ("0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2", 18, "weth"),
    ("0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48", 6, "usd-coin"),
    ("0xdac17f958d2ee523a2206206994597c13d831ec7", 6, "tether"),
    ("0x2260fac5e5542a773aa44fbcfedf7c193bc2c599", 8, "wrapped-bitcoin"),
    ("0x6b175474e89094c44da98b954eedeac495271d0f", 18, "dai"),
    ("0x1f9840a85d5af5bf1d1762f925bdaddc4201f984", 18, "uniswap"),
    ("0x514910771af9ca656af840dff83e8264ecf986ca", 18, "chainlink"),
    ("0x7fc66500c84a76ad7e9c93437bfc5ac33e2ddae9", 18, "aave"),
    ("0xd533a949740bb3306d119cc777fa900ba034cd52", 18, "curve-dao-token"),
    ("0x9f8f72aa9304c8b593d555f12ef6589cc3a579a2", 18, "maker"),
]

SYMBOL_IDS = [
    ("eth", "ethereum"),
    ("weth", "weth"),
    ("btc", "bitcoin"),
    ("wbtc", "wrapped-bitcoin"),
    ("usdc", "usd-coin"),
    ("usdt", "tether"),
    ("dai", "dai"),
    ("uni", "uniswap"),
    ("link", "chainlink"),
    ("aave", "aave"),
    ("crv", "curve-dao-token"),
    ("mkr", "maker"),
]


def _local(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    # From Arrow it is a local relation of known size, not a job of Python tasks.
    return spark.createDataFrame(pa.Table.from_pylist(rows), schema)


def stablecoins(spark: SparkSession) -> DataFrame:
    return _local(spark, [{"token": token} for token in STABLECOINS], "token STRING")


def decimals(spark: SparkSession) -> DataFrame:
    rows = [{"token": token, "decimals": places} for token, places, _ in TOKENS]
    return _local(spark, rows, "token STRING, decimals INT")


def address_ids(spark: SparkSession) -> DataFrame:
    rows = [{"key": token, "token_id": name} for token, _, name in TOKENS]
    return _local(spark, rows, "key STRING, token_id STRING")


def symbol_ids(spark: SparkSession) -> DataFrame:
    rows = [{"key": symbol, "token_id": name} for symbol, name in SYMBOL_IDS]
    return _local(spark, rows, "key STRING, token_id STRING")
