"""Nothing is lost: rejects of all runs, rows at NULLs, callers' columns."""

import json

import pytest
from pyspark.sql import functions as F

from swaplens.__main__ import main
from swaplens.operators.clean import dedupe
from swaplens.operators.market import latest_tick, update_pnl, value_positions, with_pnl
from swaplens.operators.ordered import estimated_quotes, flag_outliers, pnl_sign_flips, rolling_volume, sliding_rate, tick_direction
from swaplens.plans.names import fresh
from swaplens.plans.scale import stored
from swaplens.sources.swaps import page, page_after


def test_runs_of_rejects_alone_keep_each_others(spark, tmp_path, capsys):
    (tmp_path / "prices").mkdir()
    (tmp_path / "prices" / "1.json").write_text(json.dumps({"weth": {"usd": 2000.0}}))
    for run in ("one", "two"):
        (tmp_path / run).mkdir()
        (tmp_path / run / "1.json").write_text(json.dumps({"errors": [{"message": run}]}))
        places = [f"--pages={tmp_path / run}", *[f"--{name}={tmp_path / name}" for name in ("prices", "out", "state")]]
        assert main(places) == 0
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["swaps_rejected"] == 1
    assert sorted(r.reason for r in spark.read.json(f"{tmp_path}/out/rejects").collect()) == ["errors: one", "errors: two"]


@pytest.mark.parametrize("first", [1, 2, 5])
def test_pages_go_through_nulls(spark, first):
    rows = [(a, b, k) for a in (None, 1, 2) for b in (None, "x", "y") for k in (1, 2)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, k int")
    order, last, got = ["a", "b", "k"], None, []
    while part := page_after(df, order, first, last).collect():
        got += part
        last = tuple(part[-1])
    assert got == page(df, order, 100).collect() and len(got) == len(rows)


HELPERS = ["_chunk", "_value", "_before", "_first", "_last", "_across", "_rank", "_micros", "_stats", "_previous", "_symbol", "_since", "_newest", "_tick",
           "_usable", "_gain", "_entry", "_absolute", "_key", "_pnl", "_hit", "_id"]


def test_callers_columns_stay(spark):
    ticks = spark.createDataFrame(
        [("A", k, k, float(k % 3 - 1), float(10 + k % 4)) for k in range(12)], "symbol string, event_id long, second long, pnl double, price double"
    ).withColumn("ts", F.timestamp_seconds("second")).withColumn("id", F.col("symbol"))
    mine = ticks.withColumns({name: F.concat(F.lit(name), F.col("event_id").cast("string")) for name in HELPERS})
    positions = mine.withColumns({"entryPrice": F.lit(11.0), "size": F.lit(2.0), "leverage": F.lit(3.0), "side": F.lit("long")})
    for made in (
        lambda d: tick_direction(d),
        lambda d: pnl_sign_flips(d),
        lambda d: dedupe(d, "event_id"),
        lambda d: rolling_volume(d, 1, ["symbol"], "price", "ts"),
        lambda d: sliding_rate(d, "symbol", 4, 2),
        lambda d: flag_outliers(d, "price"),
        lambda d: estimated_quotes(d, "sticky"),
        lambda d: latest_tick(d),
    ):
        plain, out = made(ticks), made(mine)
        assert set(out.columns) == set(plain.columns) | set(HELPERS)
        assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
        assert out.where(" OR ".join(f"`{n}` IS NULL OR `{n}` <> concat('{n}', event_id)" for n in HELPERS)).count() == 0
    assert set(HELPERS) <= set(with_pnl(positions).columns)
    valued = value_positions(positions.drop("price"), latest_tick(ticks))
    assert set(HELPERS) <= set(valued.columns) and valued.count() == 12
    updated = update_pnl(positions, spark.createDataFrame([("A", 7.0)], "id string, pnl double"))
    assert set(HELPERS) <= set(updated.columns) and {r.pnl for r in updated.collect()} == {7.0}


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x int, _X int, `a b` int")
    assert fresh(df, "x", "y", "y") == ["__x", "y", "_y"]


def test_stored_rows_come_back(spark):
    df = spark.createDataFrame([(1, None, [1]), (2, "b", None)], "x int, y string, z array<int>")
    assert sorted(map(tuple, stored(df).collect())) == [(1, None, [1]), (2, "b", None)]
    assert stored(df.limit(0)).collect() == [] and stored(df.limit(0)).dtypes == df.dtypes
