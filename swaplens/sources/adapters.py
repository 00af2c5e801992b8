"""The driver's star-schema tables seen as swaps, prices, ticks and positions (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYMBOLS = ("view", "signup", "purchase", "error", "click")


# Columns the views below use; stating them saves reading file footers first.
TABLES = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def _swap_rows(lineitem: DataFrame) -> DataFrame:
    cents = F.col("l_extendedprice").cast("decimal(18,2)") * -100
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("txHash"),
        F.col("l_orderkey").alias("blockNumber"),
        _epoch_seconds(F.col("l_shipdate")).alias("timestamp"),
        "l_partkey",
        "l_suppkey",
        F.col("l_linenumber").alias("line"),
        (F.col("l_quantity").cast("bigint") * 1000000).cast("string").alias("amount0"),
        cents.cast("bigint").cast("string").alias("amount1"),
        F.lit("0").alias("sqrtPriceX96"),
        F.concat(F.lit("trader-"), F.col("l_suppkey")).alias("trader"),
    )


def _with_tokens(rows: DataFrame, sf_dir: str) -> DataFrame:
    spark = rows.sparkSession
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    brand = F.when(F.col("line") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))
    return (
        rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns({"token0": brand, "token1": F.col("n_name")})
        .drop("l_partkey", "l_suppkey", "p_partkey", "p_brand", "s_suppkey", "s_nationkey", "n_nationkey", "n_name")
    )


def swap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as swaps whose tokens are still part and supplier keys; no join."""
    return _swap_rows(table(spark, sf_dir, "lineitem"))


def swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """swap_rows with token0 the brand (upper case on even lines) and token1 the supplier's nation.

    Plain joins: Spark broadcasts a side whose size it knows to be small, and shuffles otherwise.
    """
    return _with_tokens(swap_rows(spark, sf_dir), sf_dir)


def swap_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same swaps, lineitem read as a stream of files."""
    files = spark.readStream.schema(TABLES["lineitem"]).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    return _with_tokens(_swap_rows(files), sf_dir)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per brand but Brand#7, and per nation."""
    brands = (
        table(spark, sf_dir, "part")
        .where(F.col("p_brand") != "Brand#7")
        .groupBy(F.col("p_brand").alias("token"))
        .agg(F.min("p_retailprice").cast("double").alias("price_usd"))
    )
    key = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("token"),
        F.when(key < 3, F.lit(1.0)).otherwise((key + 2).cast("double")).alias("price_usd"),
    )
    return brands.unionByName(nations)


def stables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One brand and three nations, so that all four volume rules occur."""
    nations = table(spark, sf_dir, "nation").where(F.col("n_nationkey") < 3).select(F.lower("n_name").alias("token"))
    return nations.unionByName(spark.range(1).select(F.lit("brand#1").alias("token")))


def decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six places for brands (Brand#2 is left to the default), two for nations."""
    brands = (
        table(spark, sf_dir, "part")
        .where(F.col("p_brand") != "Brand#2")
        .select(F.lower("p_brand").alias("token"), F.lit(6).alias("decimals"))
        .distinct()
    )
    nations = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("token"), F.lit(2).alias("decimals"))
    return brands.unionByName(nations)


def id_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(token_id, usd, usd_24h_change) per brand."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("token_id"))
        .agg(
            F.min("p_retailprice").alias("usd"),
            (F.max("p_size").cast("double") - 25).alias("usd_24h_change"),
        )
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ticks of five symbols."""
    return table(spark, sf_dir, "events").select(*_tick_columns())


def _tick_columns() -> list[Column]:
    return [
        F.col("event_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("ts"),
    ]


def tick_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of event files as a stream of ticks."""
    return _event_stream(spark, folder, files_per_trigger).select(*_tick_columns())


def _event_stream(spark: SparkSession, folder: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as leveraged positions; size 0 and leverage 0 occur."""
    key = F.col("o_orderkey")
    symbol = F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (key % 5 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        symbol.alias("symbol"),
        (key % 7).cast("double").alias("size"),
        (key % 90 + 10).cast("double").alias("entryPrice"),
        (key % 4).cast("double").alias("leverage"),
        F.when(F.col("o_orderstatus") == "F", "short").otherwise("long").alias("side"),
    )


def market_ticks(events: DataFrame) -> DataFrame:
    """events as ticks of some 250 markets."""
    symbol = F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string"))
    return events.select("event_id", symbol.alias("symbol"), F.col("value").alias("price"), F.col("ts").cast("timestamp").alias("ts"))


def market_tick_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    return market_ticks(_event_stream(spark, folder, files_per_trigger))


def market_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as positions in those markets; half cents of size, so that small gains round to 0."""
    return positions(spark, sf_dir).select(
        "id", F.concat_ws("-", "symbol", (F.floor(F.col("id") / 5) % 50).cast("string")).alias("symbol"), (F.col("size") / 200).alias("size"), "entryPrice", "leverage", "side"
    )


def position_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as observations of one position per user: half sizes, so that exact cents ties occur."""
    return table(spark, sf_dir, "events").select(*_position_columns())


def position_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of event files as a stream of observations."""
    return _event_stream(spark, folder, files_per_trigger).select(*_position_columns())


def _position_columns() -> list[Column]:
    user = F.col("user_id")
    return [
        user.alias("id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        (user % 20 + 5).cast("double").alias("entryPrice"),
        ((user % 7) / 2).alias("size"),
        (user % 4).cast("double").alias("leverage"),
        F.when(user % 3 == 0, "short").otherwise("long").alias("side"),
    ]
