"""Layouts that let reads touch few files, and moments kept per run."""

import random

import pytest
from pyspark.sql import functions as F

from swaplens.operators.aggregate import mean_std, merged_mean_std, moments
from swaplens.sources.layout import page_ranked, read_by_block, write_by_block, write_ranked
from swaplens.sources.swaps import page


def _files(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_block_ranges_are_read_and_replaced_alone(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS blockNumber", "concat('x', id) AS block_part").unionByName(spark.createDataFrame([(None, "none")], "blockNumber long, block_part string"))
    path = str(tmp_path / "blocks")
    write_by_block(rows, path, 100)
    got = read_by_block(spark, path, rows.schema, 150, 320, 100)
    assert sorted(r.blockNumber for r in got.collect()) == list(range(150, 321)) and got.columns == rows.columns
    assert all(any(f"block_part={k}/" in f for k in (1, 2, 3)) for f in _files(got))
    assert "PartitionFilters: [isnotnull" in got._jdf.queryExecution().executedPlan().toString()
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "blocks").iterdir() if p.is_dir()}
    write_by_block(rows.where("blockNumber BETWEEN 200 AND 299").withColumn("block_part", F.lit("new")), path, 100)
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "blocks").iterdir() if p.is_dir()}
    assert {k for k in before if before[k] != after[k]} == {"_block_part=2"}
    everything = read_by_block(spark, path, rows.schema, -100, None, 100)
    assert everything.count() == 1000 and everything.where("block_part = 'new'").count() == 100  # no block, no range that is asked for


@pytest.mark.parametrize("skip", [0, 1, 499, 500, 777, 1190, 1200, 5000])
def test_deep_pages_are_those_of_a_sort(spark, tmp_path, skip):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]), k) for k in range(1200)]
    df = spark.createDataFrame(rows, "a int, b string, rank_part int").repartition(3)
    order, path = ["a", "b", "rank_part"], str(tmp_path / "ranked")
    write_ranked(df, order, path, 16)
    got = page_ranked(spark, path, df.schema, order, 25, skip)
    assert got.collect() == page(df, order, 25, skip).collect()
    assert len(_files(got)) <= 3


def test_a_ranked_table_without_rows(spark, tmp_path):
    df = spark.createDataFrame([], "a int")
    write_ranked(df, ["a"], str(tmp_path / "r"))
    assert page_ranked(spark, str(tmp_path / "r"), df.schema, ["a"], 10).collect() == []


def test_moments_of_runs_give_the_whole(spark, tmp_path):
    rng = random.Random(7)
    runs = [[1e9 + rng.gauss(k, 3) for _ in range(n)] + [None] for k, n in enumerate([1, 400, 0, 2, 77])]
    path = str(tmp_path / "m")
    for run in runs:
        moments(spark.createDataFrame([(x,) for x in run], "x double"), "x").write.mode("append").parquet(path)
    everything = spark.createDataFrame([(x,) for run in runs for x in run], "x double")
    got, expected = merged_mean_std(spark.read.parquet(path)).first(), mean_std(everything, "x").first()
    assert got["mean"] == pytest.approx(expected["mean"], rel=1e-12) and got["std"] == pytest.approx(expected["std"], rel=1e-6)
    none = merged_mean_std(moments(everything.limit(0), "x")).first()
    assert tuple(none) == (None, None)
    one = merged_mean_std(moments(spark.createDataFrame([(5.0,)], "x double"), "x")).first()
    assert tuple(one) == (5.0, None)
