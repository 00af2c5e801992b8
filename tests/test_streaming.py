from datetime import datetime, timedelta, timezone
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from swaplens.operators.aggregate import summarize
from swaplens.operators.ordered import pnl_sign_flips, tick_direction
from swaplens.schemas import SWAP_SCHEMA, TICK_SCHEMA
from swaplens.operators.positions import position_flips
from swaplens.streaming.market import live_position_flips, live_sign_flips, live_ticks, newest_state, stream_feed_sessions
from swaplens.streaming.seen import SeenIds
from swaplens.streaming.swaps import dedupe_stream, ingest_swaps, windowed_summary, write_available

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _ticks(spark, rows):
    data = [(i, s, p, START + timedelta(seconds=t)) for i, s, p, t in rows]
    return spark.createDataFrame(data, TICK_SCHEMA)


def _add(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "state", "checkpoint")}


def test_ingest_reads_only_new_files(spark, swaps, prices, places):
    def run():
        stream = spark.readStream.schema(SWAP_SCHEMA).parquet(places["in"])
        ingest_swaps(stream, prices, places["out"], places["checkpoint"]).awaitTermination()
        return spark.read.parquet(places["out"])

    _add(swaps.where("blockNumber < 1002"), places["in"])
    assert run().count() == 2
    assert run().count() == 2
    _add(swaps.where("blockNumber = 1002"), places["in"])
    got = run()
    assert [r.totalUSD for r in summarize(got).collect()] == [20000.0, 6000.0]
    assert got.select("batch").distinct().count() == 2


def test_a_swap_is_written_once(spark, swaps, prices, places, tmp_path):
    """Delivered twice in a batch, again in a later batch, again to a run of its own; a swap without a price waits for one."""
    swaps = swaps.withColumn("id", F.col("txHash"))
    stray = swaps.limit(1).withColumns({"id": F.lit("0x09"), "token0": F.lit("0xnone"), "blockNumber": F.lit(250_000).cast(swaps.schema["blockNumber"].dataType)})
    seen = str(tmp_path / "seen")

    def run(checkpoint, quotes):
        stream = spark.readStream.schema(swaps.schema).option("maxFilesPerTrigger", 1).parquet(places["in"])
        ingest_swaps(stream, quotes, f"{places['out']}/run={checkpoint}", str(tmp_path / checkpoint), seen_dir=seen).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(places["out"]).collect())

    _add(swaps.where("blockNumber < 1002").unionByName(swaps.where("blockNumber < 1002")), places["in"])
    _add(swaps.unionByName(stray), places["in"])
    assert run("one", prices) == ["0x01", "0x02", "0x03"]
    more = prices.unionByName(spark.createDataFrame([("0xnone", 3.0)], prices.schema))
    assert run("two", more) == ["0x01", "0x02", "0x03", "0x09"]
    assert run("three", more) == ["0x01", "0x02", "0x03", "0x09"]


def test_a_repeated_batch_writes_what_it_wrote(spark, swaps, tmp_path):
    swaps = swaps.withColumn("id", F.col("txHash"))
    seen = SeenIds(spark, str(tmp_path / "seen"), "run")
    assert seen.new_only(swaps, 0).count() == 3
    seen.add(swaps, 0)
    assert seen.new_only(swaps, 0).count() == 3 and seen.new_only(swaps, 1).count() == 0
    assert SeenIds(spark, str(tmp_path / "seen"), "other").new_only(swaps, 0).count() == 0


def test_ids_are_looked_up_in_their_own_folders(spark, tmp_path):
    rows = spark.range(4000).selectExpr("concat('0x', id) AS id", "id * 1000 AS blockNumber")
    seen = SeenIds(spark, str(tmp_path / "seen"), "run")
    seen.add(rows, 0)
    batch = rows.where("blockNumber IN (5000, 2105000)").unionByName(rows.limit(1).selectExpr("CAST(NULL AS STRING) AS id", "blockNumber"))
    files = seen.known(batch, 1).inputFiles()
    assert 1 <= len(files) <= 4 and all("/range=0/" in f or "/range=21/" in f for f in files)
    assert [r.id for r in seen.new_only(batch, 1).collect()] == [None]


def _tick_stream(spark, places):
    return spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", 1).parquet(places["in"])


FEED = [
    [(1, "A", 5.0, 0), (2, "A", 6.0, 1), (3, "B", 9.0, 1)],
    [(4, "A", 6.0, 2), (5, "A", 2.0, 3)],
    [(6, "B", 9.5, 5), (7, "C", 1.0, 5), (8, "A", 3.0, 5)],
]


def test_live_ticks_equal_batch(spark, places):
    for rows in FEED:
        _add(_ticks(spark, rows), places["in"])
    live_ticks(_tick_stream(spark, places), places["out"], places["state"], places["checkpoint"]).awaitTermination()
    got = {r.event_id: r.priceDirection for r in spark.read.parquet(places["out"]).collect()}
    everything = _ticks(spark, [row for rows in FEED for row in rows])
    assert got == {r.event_id: r.priceDirection for r in tick_direction(everything).collect()}
    latest = newest_state(spark, places["state"])
    assert {(r.symbol, r.price, r.priceDirection) for r in latest.collect()} == {
        ("A", 3.0, "up"),
        ("B", 9.5, "up"),
        ("C", 1.0, "neutral"),
    }


def test_late_ticks_are_set_aside_and_a_restart_goes_on(spark, places):
    def run():
        live_ticks(_tick_stream(spark, places), places["out"], places["state"], places["checkpoint"]).awaitTermination()

    _add(_ticks(spark, [(1, "A", 5.0, 10)]), places["in"])
    run()
    _add(_ticks(spark, [(2, "A", 7.0, 5), (3, "A", 4.0, 20)]), places["in"])
    run()
    got = {r.event_id: r.priceDirection for r in spark.read.parquet(places["out"]).collect()}
    assert got == {1: "neutral", 3: "down"}
    assert [r.event_id for r in spark.read.parquet(places["out"] + "-late").collect()] == [2]


OBSERVED = "id BIGINT, event_id BIGINT, ts TIMESTAMP, pnl DOUBLE"
PNLS = [[1.0, 0.0], [-1.0, 2.0, None, -3.0], [3.0, 5.0], [0.0], [-2.0, 4.0], [4.0, -4.0, 4.0], [-1.0], [6.0]]


def _observations(spark):
    files, n = [], 0
    for values in PNLS:
        rows = []
        for value in values:
            for key in (1, 2, 1000 + n):
                rows.append((key, n, START + timedelta(seconds=n // 2), value if key != 2 or value is None else -value))
                n += 1
        files.append(spark.createDataFrame(rows, OBSERVED))
    return files


@pytest.mark.parametrize("files", [1, 2, 100])
def test_live_flips_equal_batch_however_cut(spark, places, files):
    observed = _observations(spark)
    for part in observed:
        _add(part, places["in"])
    stream = spark.readStream.schema(OBSERVED).option("maxFilesPerTrigger", files).parquet(places["in"])
    live_sign_flips(stream, places["out"], places["state"], places["checkpoint"]).awaitTermination()
    got = sorted((r.id, r.event_id, r.previousSign, r.sign) for r in spark.read.parquet(places["out"]).collect())
    everything = reduce(lambda a, b: a.union(b), observed)
    assert got == sorted((r.id, r.event_id, r.previousSign, r.sign) for r in pnl_sign_flips(everything).collect())
    assert len(got) > 8
    assert newest_state(spark, places["state"], "id").count() == everything.select("id").distinct().count()


def test_untouched_state_is_not_rewritten(spark, places):
    def run(rows):
        _add(spark.createDataFrame(rows, OBSERVED), places["in"])
        stream = spark.readStream.schema(OBSERVED).parquet(places["in"])
        live_sign_flips(stream, places["out"], places["state"], places["checkpoint"]).awaitTermination()

    run([(k, k, START, 1.0) for k in range(200)])
    for n in range(1, 5):
        run([(7, 1000 + n, START + timedelta(seconds=n), (-1.0) ** n), (7, -n, START - timedelta(seconds=n), 9.0)])
    written = {r["batch"]: r["count"] for r in spark.read.parquet(f"{places['state']}/own").groupBy("batch").count().collect()}
    assert written == {0: 200, 1: 1, 2: 1, 3: 1, 4: 1}
    assert newest_state(spark, places["state"], "id").count() == 200
    assert sorted(r.event_id for r in spark.read.parquet(places["out"]).collect()) == [1001, 1002, 1003, 1004]
    assert sorted(r.event_id for r in spark.read.parquet(places["out"] + "-late").collect()) == [-4, -3, -2, -1]


def test_window_summary_emits_closed_windows(spark, places):
    rows = [(1, "p", 1.5, 0), (2, "p", 2.0, 3599), (3, "q", 1.0, 10), (4, "p", 8.0, 3600), (5, "p", 1.0, 8000)]
    _add(_ticks(spark, rows), places["in"])
    stream = _tick_stream(spark, places).select("ts", F.col("symbol").alias("pair"), F.col("price").alias("usdVolume"))
    write_available(windowed_summary(stream), places["out"], places["checkpoint"]).awaitTermination()
    got = {(r.window_start.hour, r.pair, r["count"], r.totalUSD, r.avgUSD) for r in spark.read.parquet(places["out"]).collect()}
    assert got == {(0, "p", 2, 3.5, 1.75), (0, "q", 1, 1.0, 1.0), (1, "p", 1, 8.0, 8.0)}


def test_dedupe_across_files(spark, places):
    _add(_ticks(spark, [(1, "A", 1.0, 0), (1, "A", 1.0, 0), (2, "A", 1.0, 1)]), places["in"])
    _add(_ticks(spark, [(2, "A", 1.0, 1), (3, "A", 1.0, 2)]), places["in"])
    stream = dedupe_stream(_tick_stream(spark, places), "event_id")
    write_available(stream, places["out"], places["checkpoint"]).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(places["out"]).collect()) == [1, 2, 3]


def test_sessions(spark, places):
    _add(_ticks(spark, [(1, "A", 1.0, 0), (2, "A", 1.0, 59), (3, "A", 1.0, 200), (4, "A", 1.0, 1000)]), places["in"])
    write_available(
        stream_feed_sessions(_tick_stream(spark, places)), places["out"], places["checkpoint"]
    ).awaitTermination()
    got = sorted((r.session_end - r.session_start).total_seconds() for r in spark.read.parquet(places["out"]).collect())
    assert got == [60.0, 119.0]


def test_tick_files_span_months(spark, tmp_path):
    from swaplens.checks.market_queries import write_tick_files

    days = [START + timedelta(days=9 * k) for k in range(9)]
    ddl = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    rows = [(k, d.replace(tzinfo=None), 1, "A", float(k), "{}") for k, d in enumerate(days)]
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "events.parquet"))
    folder = write_tick_files(spark, str(tmp_path))
    slices = [sorted(r.event_id for r in spark.read.parquet(f"{folder}/slice={n}").collect()) for n in range(6)]
    assert [i for part in slices for i in part] == list(range(9))


def _market(spark, seed=3):
    import random

    rng = random.Random(seed)
    ticks = [(k, rng.choice("AB"), rng.choice([0.0, 9.99, 10.0, 10.004, 11.0, 12.5, 50.0, -1.0, float("nan")]), k // 2) for k in range(150)]
    held = [(k, rng.choice(["A", "A", "B", "C", None]), rng.choice([10.0, 10.0, 10.002, 12.0, 40.0, None, float("nan")]), rng.choice([0.0, 0.5, -2.0, 100.0]), rng.choice([0.0, 1.0, 5.0]), rng.choice(["long", "short", None])) for k in range(300)]
    return _ticks(spark, ticks), spark.createDataFrame(held, "id long, symbol string, entryPrice double, size double, leverage double, side string")


def _every_pair(ticks, positions):
    """Flips by valuing every position at every tick of its symbol."""
    from swaplens.operators.market import with_pnl

    pairs = ticks.join(positions, "symbol")
    valued = with_pnl(pairs).withColumn("pair", F.concat_ws("-", "id", "symbol")).withColumn("gain", F.col("pnl.absolute"))
    return sorted((r.id, r.event_id, r.previousSign, r.sign) for r in pnl_sign_flips(valued, "gain", "pair").collect())


@pytest.mark.parametrize("buckets", [2, 256])
def test_steps_flip_the_positions_they_cross(spark, monkeypatch, buckets):
    from swaplens.operators import positions as operator

    monkeypatch.setattr(operator, "BUCKETS", buckets)
    ticks, positions = _market(spark)
    got = position_flips(ticks, positions)
    expected = _every_pair(ticks, positions)
    assert sorted((r.id, r.event_id, r.previousSign, r.sign) for r in got.collect()) == expected and len(expected) > 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("block, cell", [(1, 1), (2, 8), (4096, 50)])
def test_steps_flip_the_same_positions_however_ranges_are_cut(spark, monkeypatch, block, cell):
    from swaplens.operators import positions as operator

    monkeypatch.setattr(operator, "BLOCK", block)
    monkeypatch.setattr(operator, "CELL", cell)
    monkeypatch.setattr(operator, "PAIRS", 1000)
    ticks, positions = _market(spark, 5)
    positions = positions.unionByName(positions.limit(40)).unionByName(positions.limit(40).withColumn("id", F.lit(None).cast("long")))
    got = position_flips(ticks, positions).collect()
    # A window over ids would mix copies, so each row is valued on its own and copies are told apart by a number.
    numbered = positions.withColumn("copy", F.monotonically_increasing_id()).localCheckpoint()
    by_copy = {r.copy: r.id for r in numbered.collect()}
    expected = sorted((str(by_copy[i]), e, a, b) for i, e, a, b in _every_pair(ticks, numbered.withColumn("id", F.col("copy"))))
    assert sorted((str(r.id), r.event_id, r.previousSign, r.sign) for r in got) == expected and len(expected) > 100


def test_a_hot_price_is_dealt_to_many_tasks(spark):
    ticks = spark.range(2500).select(F.col("id").alias("event_id"), F.concat(F.lit("A"), F.col("id") % 1).alias("symbol"), (9.0 + F.col("id") % 2 * 2).alias("price"), F.timestamp_seconds("id").alias("ts"))
    positions = spark.range(5000).selectExpr("id", "concat('A', id % 1) AS symbol", "10D + id % 1 AS entryPrice", "1D AS size", "1D AS leverage", "'long' AS side")
    tasks = position_flips(ticks, positions).groupBy(F.spark_partition_id()).count().collect()
    # 12.5 million flips, of one price.
    assert sum(r["count"] for r in tasks) == 2499 * 5000 and max(r["count"] for r in tasks) < 2499 * 5000 * 0.8


def test_amounts_next_to_half_a_cent(spark):
    from swaplens.operators.market import with_pnl

    sizes = [0.005, 0.00499999999999999, 0.0050000000000000010408, 0.00500000000000000001, 0.0049999999999999992, float("inf"), float("nan"), 1e308, 5e-324]
    positions = spark.createDataFrame([(k, "A", 10.0, s, lever, side) for k, (s, lever, side) in enumerate((s, lever, side) for s in sizes for lever in (1.0, 1e300, float("inf"), float("nan")) for side in ("long", None))], "id long, symbol string, entryPrice double, size double, leverage double, side string")
    ticks = spark.createDataFrame([(0, "A", 9.0, 0), (1, "A", 11.0, 1), (2, "A", 9.0, 2)], "event_id long, symbol string, price double, ts long").withColumn("ts", F.timestamp_seconds("ts"))
    valued = {(r.id, r.price): r.gain for r in with_pnl(ticks.join(positions, "symbol")).select("id", "price", F.signum("pnl.absolute").cast("int").alias("gain")).collect()}
    expected = sorted((i, e, valued[i, a], valued[i, b]) for i in range(positions.count()) for e, a, b in ((1, 9.0, 11.0), (2, 11.0, 9.0)) if valued[i, a] * valued[i, b] == -1)
    assert sorted((r.id, r.event_id, r.previousSign, r.sign) for r in position_flips(ticks, positions).collect()) == expected and len(expected) > 10


@pytest.mark.parametrize("files", [1, 4, 20])
def test_live_positions_however_the_stream_is_cut(spark, places, files):
    ticks, positions = _market(spark)
    for n in range(files):
        _add(ticks.where((F.col("event_id") >= 150 * n // files) & (F.col("event_id") < 150 * (n + 1) // files)), places["in"])
    # Half of it, then the rest after a restart with another number of files per trigger.
    for each in (1, 3):
        stream = spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", each).parquet(places["in"])
        live_position_flips(stream, positions, places["out"], places["state"], places["checkpoint"]).awaitTermination()
    got = sorted((r.id, r.event_id, r.previousSign, r.sign) for r in spark.read.parquet(places["out"]).collect())
    assert got == _every_pair(ticks, positions)
    assert sorted(r.symbol for r in newest_state(spark, places["state"]).collect()) == ["A", "B"]


def test_live_positions_are_written_packed(spark, places):
    import pyarrow.parquet as pq

    ticks, positions = _market(spark)
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    _add(ticks, places["in"])
    live_position_flips(spark.readStream.schema(TICK_SCHEMA).parquet(places["in"]), positions, places["out"], places["state"], places["checkpoint"]).awaitTermination()
    files = [pq.ParquetFile(p) for p in Path(places["out"]).rglob("*.parquet")]
    columns = [f.metadata.row_group(0).column(k) for f in files if f.metadata.num_rows for k in range(f.metadata.num_columns)]
    assert {c.compression for c in columns} == {"LZ4"} and "INT96" not in {c.physical_type for c in columns}
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    assert sorted(spark.read.parquet(places["out"]).select("event_id", "ts").distinct().join(ticks, ["event_id", "ts"], "left_anti").collect()) == []


def test_row_groups_of_flips_are_cut_by_rows(spark, places, monkeypatch):
    import pyarrow.parquet as pq

    from swaplens.streaming import market

    monkeypatch.setattr(market, "GROUP_ROWS", 64)
    ticks, positions = _market(spark)
    _add(ticks, places["in"])
    live_position_flips(spark.readStream.schema(TICK_SCHEMA).parquet(places["in"]), positions, places["out"], places["state"], places["checkpoint"]).awaitTermination()
    found = [pq.ParquetFile(p).metadata for p in Path(places["out"]).rglob("*.parquet")]
    groups = [m.row_group(k) for m in found for k in range(m.num_row_groups)]
    assert max(g.num_rows for g in groups) == 64 and len(groups) > len(found)
    assert not any("DICTIONARY" in e for g in groups for k in range(g.num_columns) if g.column(k).path_in_schema == "id" for e in g.column(k).encodings)
    assert sum(g.num_rows for g in groups) == len(_every_pair(ticks, positions))


def test_state_is_whole_again_every_so_often(spark, tmp_path, monkeypatch):
    from pyspark.sql import types as T

    from swaplens.streaming import state

    monkeypatch.setattr(state, "EVERY", 3)
    log = state.StateLog(spark, str(tmp_path), "k", T._parse_datatype_string("k string, v long, _batch string"))
    expected = {}
    for n in range(8):
        assert {r.k: r.v for r in log.before(n).collect()} == expected
        own = {None if n == 4 else f"k{n % 3}": n, "hot": 10 * n}
        log.put(spark.createDataFrame([(k, v, "x") for k, v in own.items()], "k string, v long, _batch string"), n)
        expected |= own
    assert sorted(p.name for p in (tmp_path / "whole").iterdir()) == ["batch=2", "batch=5"]
    assert {r.k: r.v for r in state.newest_rows(spark, str(tmp_path), "k").collect()} == expected
