import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from swaplens.operators.clean import normalize_swaps
from swaplens.operators.ordered import (
    feed_gaps,
    feed_sessions,
    flag_outliers,
    pnl_sign_flips,
    rolling_volume,
    sliding_rate,
    tick_direction,
)
from swaplens.plans.ordered import previous_row, trailing_sums

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _ticks(spark, rows):
    """(event_id, symbol, price, seconds after start)"""
    data = [(i, s, p, START + timedelta(seconds=t)) for i, s, p, t in rows]
    return spark.createDataFrame(data, "event_id BIGINT, symbol STRING, price DOUBLE, ts TIMESTAMP")


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the rows on one symbol at one instant, another third on that symbol, the rest spread out."""
    random.seed(3)
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            rows.append((i, "HOT", float(random.randint(1, 9)), 5000.0))
        elif i % 3 == 1:
            rows.append((i, "HOT", float(random.randint(1, 9)), random.randint(0, 200000)))
        else:
            rows.append((i, f"S{i % 50}", float(random.randint(1, 9)), random.randint(0, 200000) + 0.25))
    return _ticks(spark, rows).repartition(8).cache()


def test_rolling_golden(typed_swaps):
    got = rolling_volume(normalize_swaps(typed_swaps)).orderBy("timestamp").collect()
    assert [r.rolling_volume_usd for r in got] == [1000.0, 1500.0]


def test_rolling_span_is_open_on_the_left(spark):
    day = 24 * 3600
    ticks = _ticks(spark, [(1, "A", 1.0, 0), (2, "A", 2.0, day - 0.000001), (3, "A", 4.0, day), (4, "A", 8.0, day)])
    got = {r.event_id: r.rolling_volume_usd for r in rolling_volume(ticks, 24, value="price", ts="ts").collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 14.0, 4: 14.0}


def test_rolling_nulls(spark):
    ticks = _ticks(spark, [(1, "A", None, 0), (2, "A", 2.0, 10), (3, None, 3.0, 20)])
    undated = ticks.where("event_id = 2").withColumns({"ts": F.lit(None).cast("timestamp"), "event_id": F.lit(9)})
    df = ticks.unionByName(undated)
    got = {r.event_id: r.rolling_volume_usd for r in rolling_volume(df, 1, ["symbol"], "price", "ts").collect()}
    assert got == {1: None, 2: 2.0, 3: 3.0, 9: None}


@pytest.mark.parametrize("hours,keys", [(24, []), (24, ["symbol"]), (1, ["symbol"]), (2, [])])
def test_rolling_equals_a_plain_window(crowded, hours, keys):
    micros = crowded.withColumn("us", F.unix_micros("ts"))
    plain = Window.partitionBy(*keys).orderBy("us").rangeBetween(-hours * 3600 * 1000000 + 1, 0)
    want = {r.event_id: r.s for r in micros.withColumn("s", F.sum("price").over(plain)).collect()}
    got = {r.event_id: r.rolling_volume_usd for r in rolling_volume(crowded, hours, keys, "price", "ts").collect()}
    assert got == want


@pytest.mark.parametrize("key,seconds", [("symbol", 60), (None, 60), ("symbol", 7200), ("symbol", 90)])
def test_rate_equals_a_plain_window(crowded, key, seconds):
    micros = crowded.withColumn("us", F.unix_micros("ts"))
    plain = Window.partitionBy(*([key] if key else [])).orderBy("us").rangeBetween(-seconds * 1000000, 0)
    want = {r.event_id: r.n for r in micros.withColumn("n", F.count("*").over(plain)).collect()}
    rows = sliding_rate(crowded, key, seconds, 10).collect()
    assert {r.event_id: r.requests_in_window for r in rows} == want
    assert all(r.remaining == max(0, 10 - r.requests_in_window) for r in rows)
    assert all(r.over_limit == (r.requests_in_window > 10) for r in rows)


def test_cells_must_divide(spark):
    with pytest.raises(ValueError):
        trailing_sums(spark.range(3), [], "id", 10, {"n": F.lit(1)}, [3])
    with pytest.raises(ValueError):
        trailing_sums(spark.range(3), [], "id", 10, {"n": F.lit(1)}, [10])


def test_trailing_sums_in_small_units(spark):
    got = trailing_sums(spark.range(100), [], "id", 12, {"s": F.col("id")}, [2, 6])
    assert {r.id: r.s for r in got.collect()} == {i: sum(range(max(0, i - 11), i + 1)) for i in range(100)}


def test_previous_row_equals_lag(crowded):
    by = Window.partitionBy("symbol").orderBy("ts", "event_id")
    want = {r.event_id: r.p for r in crowded.withColumn("p", F.lag("price").over(by)).collect()}
    got = {r.event_id: r.p for r in previous_row(crowded, ["symbol"], ["ts", "event_id"], F.col("price"), "p").collect()}
    assert got == want


def test_previous_row_cuts_a_hot_symbol(spark, crowded):
    """With chunks kept apart, the hot symbol (and its one crowded instant) lies in more than one of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunked = crowded.repartitionByRange("symbol", "ts", "event_id").withColumn("c", F.spark_partition_id())
        sizes = [r["count"] for r in chunked.groupBy("c").count().collect()]
        instant = chunked.where((F.col("symbol") == "HOT") & (F.unix_seconds("ts") == int(START.timestamp()) + 5000))
        assert len(sizes) == 4 and max(sizes) < 2400
        assert instant.select("c").distinct().count() > 1
        by = Window.partitionBy("symbol").orderBy("ts", "event_id")
        want = {r.event_id: r.p for r in crowded.withColumn("p", F.lag("price").over(by)).collect()}
        got = previous_row(crowded, ["symbol"], ["ts", "event_id"], F.col("price"), "p")
        assert {r.event_id: r.p for r in got.collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_direction(spark):
    ticks = _ticks(spark, [(1, "A", 5.0, 0), (2, "A", 6.0, 1), (3, "A", 6.0, 2), (4, "A", 1.0, 3), (5, "B", 9.0, 9)])
    got = {r.event_id: r.priceDirection for r in tick_direction(ticks).collect()}
    assert got == {1: "neutral", 2: "up", 3: "neutral", 4: "down", 5: "neutral"}


def test_sign_flips_need_two_opposite_signs(spark):
    rows = [(1, 1, 5.0), (1, 2, -1.0), (1, 3, 0.0), (1, 4, 2.0), (1, 5, -2.0), (2, 6, -1.0)]
    df = spark.createDataFrame(rows, "id INT, event_id INT, pnl DOUBLE").withColumn("ts", F.timestamp_seconds("event_id"))
    got = {(r.event_id, r.previousSign, r.sign) for r in pnl_sign_flips(df).collect()}
    assert got == {(2, 1, -1), (5, 1, -1)}


def test_gaps_and_sessions(spark):
    rows = [(1, "A", 1.0, 0), (2, "A", 1.0, 60), (3, "A", 1.0, 120.5), (4, "A", 1.0, 121), (5, "B", 1.0, 500)]
    ticks = _ticks(spark, rows)
    (gap,) = feed_gaps(ticks).collect()
    assert (gap.symbol, gap.gap_seconds) == ("A", 60.5)
    got = sorted((r.symbol, r.ticks, (r.session_end - r.session_start).total_seconds()) for r in feed_sessions(ticks).collect())
    assert got == [("A", 1, 60.0), ("A", 1, 60.0), ("A", 2, 60.5), ("B", 1, 60.0)]


def test_gaps_equal_lag(crowded):
    by = Window.partitionBy("symbol").orderBy("ts", "event_id")
    lagged = crowded.withColumn("before", F.lag("ts").over(by))
    wide = F.unix_micros("ts") - F.unix_micros("before") > 60000000
    want = sorted((r.symbol, r.before, r.ts) for r in lagged.where(wide).collect())
    got = sorted((r.symbol, r.gap_start, r.gap_end) for r in feed_gaps(crowded).collect())
    assert got == want and got


def test_sessions_equal_session_window(crowded):
    window = F.session_window("ts", "300 seconds")
    want = crowded.groupBy("symbol", window.alias("w")).count().select("symbol", "w.start", "w.end", "count")
    got = feed_sessions(crowded, 300).select("symbol", "session_start", "session_end", "ticks")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_outliers(spark):
    two = spark.createDataFrame([(1000.0,), (500.0,)], "amountInUSD DOUBLE")
    got = sorted((r.z_score, r.is_outlier) for r in flag_outliers(two).collect())
    assert got == [(pytest.approx(-0.7071, abs=1e-4), False), (pytest.approx(0.7071, abs=1e-4), False)]
    same = spark.createDataFrame([(5.0,), (5.0,)], "v DOUBLE")
    assert [(r.z_score, r.is_outlier) for r in flag_outliers(same, "v").collect()] == [(None, False)] * 2
    many = spark.range(100).select(F.when(F.col("id") == 7, 1000.0).otherwise(1.0).alias("v"))
    assert flag_outliers(many, "v").where("is_outlier").count() == 1
    assert flag_outliers(two, "absent").columns == ["amountInUSD"]
