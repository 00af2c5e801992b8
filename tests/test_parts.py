"""Partial rewrites and the letter index."""

import random
import re

import pytest
from pyspark.sql import functions as F

from swaplens.sources.parts import read_parts, write_changed_parts
from swaplens.sources.prices import search_tokens
from swaplens.sources.search import search_index, write_token_index


def _table(spark):
    rows = [(k, None if k % 9 == 8 else f"2024-01-0{k % 9}" if k % 9 else "", k / 2, "x" if k % 2 else None) for k in range(90)]
    return spark.createDataFrame(rows, "k long, day string, v double, slot string")


def _same(got, expected):
    return got.columns == expected.columns and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_only_changed_parts_are_written(spark, tmp_path):
    df, path = _table(spark), str(tmp_path / "t")
    assert read_parts(spark, path, df.schema, "day").collect() == []
    assert write_changed_parts(df, path, "day") == {"written": 9, "kept": 0, "gone": 0}
    before = sorted((tmp_path / "t" / "rows").rglob("*.parquet"))
    assert write_changed_parts(df.repartition(5).select("v", "slot", "k", "day"), path, "day") == {"written": 0, "kept": 9, "gone": 0}
    assert sorted((tmp_path / "t" / "rows").rglob("*.parquet")) == before
    one = df.withColumn("v", F.when((F.col("day") == "2024-01-03") & (F.col("k") == 3), -1.0).otherwise(F.col("v")))
    assert write_changed_parts(one, path, "day") == {"written": 1, "kept": 8, "gone": 0}
    new = set((tmp_path / "t" / "rows").rglob("*.parquet")) - set(before)
    assert len({f.parent for f in new}) == 1 and _same(read_parts(spark, path, df.schema, "day"), one)
    # A part that went, one that came, NULL and the empty text apart.
    other = one.where("day IS NULL OR day <> '2024-01-05'").unionByName(one.limit(1).withColumn("day", F.lit("new")))
    assert write_changed_parts(other, path, "day") == {"written": 1, "kept": 8, "gone": 1}
    assert _same(read_parts(spark, path, df.schema, "day"), other)
    for values in (["2024-01-03"], [None], ["", "new"], ["2024-01-05"], [None, "2024-01-01"], []):
        got = read_parts(spark, path, df.schema, "day", values)
        some = [v for v in values if v is not None]
        expected = other.where((F.col("day").isin(some) if some else F.lit(False)) | (F.col("day").isNull() & F.lit(None in values)))
        assert _same(got, expected) and len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) == len([v for v in values if v != "2024-01-05"])
    typed = other.withColumn("v", F.col("v").cast("string"))
    assert write_changed_parts(typed, path, "day") == {"written": 9, "kept": 0, "gone": 0}
    assert write_changed_parts(typed.limit(0), path, "day")["gone"] == 9 and read_parts(spark, path, typed.schema, "day").count() == 0


def test_a_rewrite_that_dies_leaves_what_stood(spark, tmp_path, monkeypatch):
    from swaplens.sources import parts

    df, path = _table(spark), str(tmp_path / "t")
    write_changed_parts(df, path, "day")

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(parts, "save_state", dies)
        with pytest.raises(RuntimeError):
            write_changed_parts(df.withColumn("v", F.lit(0.0)), path, "day")
    assert _same(read_parts(spark, path, df.schema, "day"), df)
    assert write_changed_parts(df.withColumn("v", F.lit(0.0)), path, "day")["written"] == 9


def test_repeated_rows_count(spark, tmp_path):
    df, path = _table(spark), str(tmp_path / "t")
    write_changed_parts(df, path, "day")
    twice = df.unionByName(df.where("k = 1").withColumn("k", F.lit(1).cast("long")))
    assert write_changed_parts(twice, path, "day") == {"written": 1, "kept": 8, "gone": 0}
    assert _same(read_parts(spark, path, df.schema, "day"), twice)


def _tokens(spark, n=400):
    rng = random.Random(11)
    words = ["wrapped", "Ether", "USD", "coin", "Éclair", "Σίγμα", "100%", "a_b", "ring", "aa", "aaa", "💧 drop", "İzmir"]
    rows = [(k, None if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randrange(0, 4))), rng.choice([None, "", "WETH", "ab", "Aaa", "x"])) for k in range(n)]
    return spark.createDataFrame(rows, "row long, name string, symbol string").withColumn("part", F.lit("mine"))


def test_the_index_finds_what_a_scan_finds(spark, tmp_path):
    tokens, path = _tokens(spark).repartition(6), str(tmp_path / "index")
    write_token_index(tokens, path)
    for text in (" RING ", "a", "aa", "aaa", "aaaa", "d e", "coin ether", "éclair", "ΣΊΓ", "0%", "%", "_", "💧", "💧 d", "", "  ", "nothing here", "wethx", "i̇z"):
        assert _same(search_index(spark, path, tokens.schema, text), search_tokens(tokens, text)), text
    empty = tokens.limit(0)
    write_token_index(empty, str(tmp_path / "none"))
    assert search_index(spark, str(tmp_path / "none"), empty.schema, "ring").collect() == []


def test_a_search_reads_postings_and_few_rows(spark, tmp_path):
    tokens, path = _tokens(spark), str(tmp_path / "index")
    rare = spark.createDataFrame([(9999, "Zyxquartz", None, "mine")], tokens.schema)
    write_token_index(tokens.repartition(7).unionByName(rare.coalesce(1)), path)
    got = search_index(spark, path, tokens.schema, "xqua")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [r.row for r in got.collect()] == [9999]
    assert "PushedFilters: [In(gram" in plan and re.search(r"PartitionFilters: \[[^\]]*(IN \(\d+\)|= \d+)", plan)  # one folder
