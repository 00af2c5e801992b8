"""Token identity and prices: resolving names, loading, filling and looking up prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.functions import dims
from swaplens.plans.scale import small_side


def unique_tokens(df: DataFrame) -> DataFrame:
    """The distinct non-empty tokens on either side, spelled as they are."""
    return (
        df.select(F.explode(F.array("token0", "token1")).alias("token")).where(F.col("token") != "").distinct()
    )


def resolve_token(
    df: DataFrame,
    column: str,
    addresses: DataFrame | None = None,
    symbols: DataFrame | None = None,
    name: str = "token_id",
) -> DataFrame:
    """Add the price id of a token address (0x...) or symbol; text found in neither table is its own id.

    The tables have columns (key, token_id), keys in lower case and unique.
    """
    spark = df.sparkSession
    addresses = dims.address_ids(spark) if addresses is None else addresses
    symbols = dims.symbol_ids(spark) if symbols is None else symbols
    known = (
        addresses.where(F.col("key").startswith("0x"))
        .unionByName(symbols.where(~F.col("key").startswith("0x")))
        .select(F.col("key").alias("_key"), F.col("token_id").alias("_id"))
    )
    joined = df.join(small_side(known), F.trim(F.lower(column)) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_id", F.col(column))).drop("_key", "_id")


def load_prices(raw: DataFrame, column: str = "value", vs: str = "usd") -> DataFrame:
    """(token_id, price_usd) from price responses ``{id: {currency: price}}``, one JSON object per row."""
    entries = raw.select(F.explode(F.from_json(column, "MAP<STRING, MAP<STRING, DOUBLE>>")).alias("token_id", "quotes"))
    return entries.select(
        "token_id", F.coalesce(F.try_element_at("quotes", F.lit(vs)), F.lit(0.0)).alias("price_usd")
    )


def prices_by_token(
    tokens: DataFrame,
    by_id: DataFrame,
    addresses: DataFrame | None = None,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """(token, price_usd): each token's price through its price id, 0 where unknown."""
    resolved = resolve_token(tokens.select("token"), "token", addresses, symbols)
    return fill_missing_prices(resolved, by_id, key="token_id").select("token", "price_usd")


def fill_missing_prices(tokens: DataFrame, prices: DataFrame, default: float = 0.0, key: str = "token") -> DataFrame:
    """Every token with its price, ``default`` where there is none."""
    side = small_side(prices.select(F.col(key).alias("_key"), F.col("price_usd").alias("_price")), derived=True)
    joined = tokens.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumn("price_usd", F.coalesce("_price", F.lit(default))).drop("_key", "_price")


def price_on_date(df: DataFrame, daily_prices: DataFrame, vs: str = "usd") -> DataFrame:
    """Add price_on_date: the price of (token_id, date) in ``daily_prices`` (token_id, date, usd, ...), else NULL."""
    side = small_side(
        daily_prices.select(
            F.col("token_id").alias("_id"), F.col("date").alias("_date"), F.col(vs).alias("price_on_date")
        ),
        derived=True,
    )
    match = (F.col("token_id") == F.col("_id")) & (F.col("date") == F.col("_date"))
    return df.join(side, match, "left").drop("_id", "_date")


def search_tokens(tokens: DataFrame, query: str) -> DataFrame:
    """Tokens whose name or symbol contains the text, in any case."""
    text = query.strip().lower()
    return tokens.where(F.lower("name").contains(text) | F.lower("symbol").contains(text))


def token_info(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add the attributes of each row's token_id; NULL where it is unknown."""
    return df.join(small_side(tokens), "token_id", "left")
