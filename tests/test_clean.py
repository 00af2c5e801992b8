from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from swaplens.operators.aggregate import daily_token_agg, mean_std
from swaplens.operators.clean import dedupe, normalize_swaps, validate


def test_normalize_types_and_date(typed_swaps):
    got = normalize_swaps(typed_swaps).orderBy("id").first()
    assert (got.blockNumber, got.amountIn, got.amountInUSD) == (1000, 1000000.0, 1000.0)
    assert got.timestamp == datetime(2021, 12, 20, 11, 33, 20)
    assert got.date == date(2021, 12, 20)


def test_normalize_adds_missing_aliases_only(swaps):
    got = normalize_swaps(swaps.withColumn("tokenIn", F.lit("kept")))
    row = got.orderBy("blockNumber").first()
    assert row.tokenIn == "kept" and row.tokenOut == row.token1 and row.transaction == row.txHash
    assert row.amountOut == -2e9 and row.amount1 == -2e9


def test_normalize_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("x", "nan"), ("5d", "7")], "amountIn STRING, blockNumber STRING")
    assert {tuple(r) for r in normalize_swaps(df).collect()} == {(None, None), (None, 7)}


def test_normalize_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),)], "amountIn DOUBLE")
    assert validate(normalize_swaps(df)).count() == 0


def test_validate_drops_negative_null_and_incomplete(typed_swaps):
    good = normalize_swaps(typed_swaps)
    negative = good.limit(1).withColumn("amountIn", F.lit(-1000.0))
    unknown = good.limit(1).withColumn("amountOut", F.lit(None).cast("double"))
    nameless = good.limit(1).withColumn("tokenIn", F.lit(None).cast("string"))
    everything = good.unionByName(negative).unionByName(unknown).unionByName(nameless)
    assert validate(everything).count() == 2
    assert validate(everything, allow_negative=["amountIn"]).count() == 3


def test_validate_ignores_absent_columns(spark):
    assert validate(spark.createDataFrame([("a",)], "id STRING")).count() == 1


def test_dedupe_keeps_the_least_and_one_null_key(spark):
    rows = [("a", 2), ("a", 1), ("b", 3), (None, 5), (None, 4)]
    df = spark.createDataFrame(rows, "id STRING, n INT")
    assert {tuple(r) for r in dedupe(df).collect()} == {("a", 1), ("b", 3), (None, 4)}
    assert dedupe(df.drop("id")).count() == 5


def test_dedupe_with_map_column(spark):
    df = spark.createDataFrame([("a", {"k": 1}), ("a", {"k": 1})], "id STRING, m MAP<STRING, INT>")
    assert dedupe(df).count() == 1


def test_dedupe_ranks_before_the_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("id"), F.col("id").alias("n"))
    plan = dedupe(df)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert [tuple(r) for r in dedupe(df).collect()] == [("hot0", 0)]


def test_daily_aggregate(typed_swaps):
    (row,) = daily_token_agg(normalize_swaps(typed_swaps)).collect()
    assert (row.date, row.tokenIn) == (date(2021, 12, 20), "0xt1")
    assert (row.amountIn_sum, row.amountIn_mean, row.amountIn_count) == (1500000, 750000, 2)
    assert (row.amountInUSD_sum, row.amountInUSD_mean) == (1500, 750)
    assert (row.amountOut_sum, row.amountOut_mean) == (3500000, 1750000)
    assert (row.amountOutUSD_sum, row.amountOutUSD_mean) == (3500, 1750)


def test_daily_aggregate_of_nothing(spark):
    ddl = "date DATE, tokenIn STRING, amountIn DOUBLE"
    df = spark.createDataFrame([(date(2024, 1, 1), "a", None), (None, "a", 1.0), (date(2024, 1, 1), None, 1.0)], ddl)
    (row,) = daily_token_agg(df).collect()
    assert (row.amountIn_sum, row.amountIn_mean, row.amountIn_count) == (0.0, None, 0)


def test_mean_std(spark):
    df = spark.createDataFrame([(1000.0,), (500.0,)], "v DOUBLE")
    assert tuple(mean_std(df, "v").first()) == pytest.approx((750.0, 353.5533905932738))
    assert mean_std(df.limit(1), "v").first().std is None
