import json
from datetime import date

import pytest
from conftest import USDC, WETH
from pyspark.sql import functions as F

from swaplens.plans.scale import shared_dir, small_side
from swaplens.schemas import SWAP_SCHEMA
from swaplens.sources import files, prices, state, swaps
from swaplens.sources.feed import parse_mids, parse_trades


def _swap(n, **changes):
    record = {
        "id": f"0x{n}#1",
        "transaction": {"id": f"0x{n}"},
        "timestamp": "1640000000",
        "token0": {"symbol": "WETH", "id": WETH},
        "token1": {"symbol": "USDC", "id": USDC},
        "amount0": "1",
        "amount1": "-2",
        "sqrtPriceX96": "3",
    }
    record.update(changes)
    return {k: v for k, v in record.items() if v != "absent"}


def _pages(spark, *pages):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in pages]
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_pages_to_swaps(spark):
    page = {
        "data": {
            "swaps": [
                _swap(1, blockNumber="3"),
                _swap(2, transaction="absent", blockNumber="77"),
                _swap(3, blockNumber="5", sqrtPriceX96="absent", token0={"symbol": "X"}),
                _swap(4, blockNumber=""),
                _swap(5),
            ]
        }
    }
    good, bad = swaps.parse_swap_pages(_pages(spark, page))
    assert good.schema.names == SWAP_SCHEMA.names
    got = {r.txHash: r for r in good.collect()}
    assert set(got) == {"0x1", "0x2#1", "0x3"}
    assert (got["0x1"].blockNumber, got["0x2#1"].blockNumber, got["0x3"].blockNumber) == (3, 77, 5)
    assert (got["0x3"].token0, got["0x3"].sqrtPriceX96, got["0x1"].timestamp) == ("", "0", 1640000000)
    assert [r.reason for r in bad.collect()] == ["bad blockNumber"] * 2


def test_bad_records_leave_the_rest(spark):
    page = {
        "data": {
            "swaps": [
                _swap(1, blockNumber="3"),
                _swap(2, timestamp="soon"),
                _swap(3, timestamp=None),
                _swap(4, blockNumber="12.5"),
                _swap(5, token1=None, blockNumber="3"),
            ]
        }
    }
    errors = {"errors": [{"message": "a"}, {"message": "b"}]}
    good, bad = swaps.parse_swap_pages(_pages(spark, page, errors, {"data": {}}, "no json", {"data": {"swaps": []}}))
    assert [r.txHash for r in good.collect()] == ["0x1"]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad blockNumber", "bad timestamp", "bad timestamp", "bad token", "errors: a; b"] + ["no swap list"] * 2


def test_pages_are_parsed_once(spark):
    good, _ = swaps.parse_swap_pages(_pages(spark, {"data": {"swaps": [_swap(1)]}}))
    assert good._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_block_filters(swaps_frame):
    df = swaps_frame
    assert [swaps.after_block(df, b).count() for b in (0, 1000, 1001, 1002)] == [3, 2, 1, 0]
    assert swaps.after_block(df.drop("blockNumber"), 9999).count() == 3
    assert swaps.block_range(df, 1001).count() == 2 and swaps.block_range(df, 1000, 1001).count() == 2
    assert state.latest_block(df).first()[0] == 1002
    assert state.latest_block(df.limit(0)).first()[0] == 0


@pytest.fixture
def swaps_frame(request):
    return request.getfixturevalue("swaps")


def test_recent(swaps_frame):
    got = swaps.recent(swaps_frame, 1, 1640000160).collect()
    assert [r.timestamp for r in got] == [1640000100, 1640000200]


def test_pages_of_rows(spark):
    df = spark.createDataFrame([(i // 2, i) for i in range(10)], "t INT, i INT")
    whole = [r.i for r in swaps.page(df, ["t", "i"], 10).collect()]
    assert [r.i for r in swaps.page(df, ["t", "i"], 4, 3).collect()] == whole[3:7]
    read, last = [], None
    while rows := swaps.page_after(df, ["t", "i"], 3, last).collect():
        read += [r.i for r in rows]
        last = (rows[-1].t, rows[-1].i)
    assert read == whole
    assert swaps.cap(df, 4).count() == 4 and swaps.cap(df, None).count() == 10


def test_filters_reach_the_scan(spark, swaps_frame, tmp_path):
    path = files.write(swaps_frame, str(tmp_path / "s"), "parquet")
    df = files.read(spark, path, "parquet", SWAP_SCHEMA)
    plan = swaps.within(swaps.after_block(df, 1000), 1, 1640000160).select("txHash")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(blockNumber,1000)" in text and "GreaterThanOrEqual(" in text.split("PushedFilters")[1]
    assert "ReadSchema: struct<txHash:string,blockNumber:bigint,timestamp:bigint>" in text


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_files_round_trip(spark, tmp_path, fmt):
    rows = [("a,b", 1, 0.1, date(2024, 1, 1)), ('quo"te', None, 2.5, None), ("line\\n", 3, None, date(2024, 2, 3))]
    df = spark.createDataFrame(rows, "s STRING, n INT, x DOUBLE, d DATE")
    path = files.write(df, str(tmp_path / "t"), fmt)
    assert sorted(map(repr, files.read(spark, path, fmt, df.schema).collect())) == sorted(map(repr, df.collect()))


def test_json_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}], indent=2))
    assert files.read(spark, str(tmp_path / "a.json"), "json", "id INT", multi_line=True).count() == 2


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write(spark.range(1), str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        files.read(spark, str(tmp_path / "x"), "xml", "id INT")


def test_fingerprint_ignores_order_only(spark):
    def print_of(rows):
        return tuple(files.fingerprint(spark.createDataFrame(rows, "a STRING, b STRING")).first())

    base = print_of([("1", None), ("2", "x")])
    assert base == print_of([("2", "x"), ("1", None)])
    for other in ([("1", None)], [(None, "1"), ("2", "x")], [("1", None), ("2", "y")], [("1", None), ("2", "x"), ("2", "x")]):
        assert base != print_of(other)


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_write_if_changed(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 4), (2, 5)], "a INT, b INT")
    assert files.write_if_changed(df, path, fmt)
    assert not files.write_if_changed(df.orderBy(F.desc("a")), path, fmt)
    assert files.write_if_changed(df.withColumn("b", F.col("b") + 1), path, fmt)
    assert {tuple(r) for r in files.read(spark, path, fmt, df.schema).collect()} == {(1, 5), (2, 6)}
    changed = df.withColumn("b", F.col("b") + 1)
    assert not files.write_if_changed(changed.select("b", "a"), path, fmt)
    assert files.write_if_changed(changed.withColumnRenamed("b", "c"), path, fmt)
    assert files.write_if_changed(changed.withColumn("b", F.col("b").cast("string")), path, fmt)
    other = "json" if fmt != "json" else "parquet"
    assert files.write_if_changed(changed.withColumn("b", F.col("b").cast("string")), path, other)


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.load_state(spark, path) == {"last_processed_block": 0}
    state.save_state(spark, path, block=1000, note="x")
    saved = state.save_state(spark, path, other=2)
    assert state.load_state(spark, path) == saved
    assert (saved["last_processed_block"], saved["note"], saved["other"]) == (1000, "x", 2) and saved["last_updated"]
    state.replace_state(spark, path, {"only": 1})
    assert state.load_state(spark, path) == {"last_processed_block": 0, "only": 1}


def test_corrupt_state_starts_over(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "part.json").write_text("{not json")
    assert state.load_state(spark, str(tmp_path / "state")) == {"last_processed_block": 0}
    state.save_state(spark, str(tmp_path / "state"), block=5)
    assert state.load_state(spark, str(tmp_path / "state"))["last_processed_block"] == 5


def test_tokens_and_prices(spark):
    tokens = spark.createDataFrame(
        [(WETH.upper().replace("0X", "0x"),), (" ETH ",), ("some-price-id",), ("0xnone",), ("wbtc",), ("0xeth",)], "token STRING"
    )
    ids = {r.token: r.token_id for r in prices.resolve_token(tokens, "token").collect()}
    assert list(ids.values()) == ["weth", "ethereum", "some-price-id", "0xnone", "wrapped-bitcoin", "0xeth"]
    raw = spark.createDataFrame([('{"weth": {"usd": 2500.5}, "ethereum": {"eur": 1}}',), ("oops",)], "value STRING")
    by_id = prices.load_prices(raw)
    assert {tuple(r) for r in by_id.collect()} == {("weth", 2500.5), ("ethereum", 0.0)}
    got = {r.token: r.price_usd for r in prices.prices_by_token(tokens, by_id).collect()}
    assert sorted(got.values()) == [0.0, 0.0, 0.0, 0.0, 0.0, 2500.5]


def test_unique_tokens(spark):
    df = spark.createDataFrame([("A", "b"), ("a", ""), (None, "b")], "token0 STRING, token1 STRING")
    assert sorted(r.token for r in prices.unique_tokens(df).collect()) == ["A", "a", "b"]


def test_price_on_date_and_lookups(spark):
    daily = spark.createDataFrame([("weth", date(2024, 1, 1), 9.0)], "token_id STRING, date DATE, usd DOUBLE")
    rows = spark.createDataFrame([("weth", date(2024, 1, 1)), ("weth", date(2024, 1, 2))], "token_id STRING, date DATE")
    assert [r.price_on_date for r in prices.price_on_date(rows, daily).orderBy("date").collect()] == [9.0, None]
    tokens = spark.createDataFrame([("weth", "Wrapped Ether", "WETH"), ("dai", "Dai", "DAI")], "token_id STRING, name STRING, symbol STRING")
    assert [r.token_id for r in prices.search_tokens(tokens, "ETHER").collect()] == ["weth"]
    assert {r.name for r in prices.token_info(rows, tokens).collect()} == {"Wrapped Ether"}


def test_feed_messages(spark):
    mids = [
        '{"channel": "allMids", "data": {"BTC": "45000.5", "ETH": "bad", "DOGE": "0.1"}}',
        '{"channel": "other", "data": {"BTC": "1"}}',
        "junk",
    ]
    got = parse_mids(spark.createDataFrame([(i, m) for i, m in enumerate(mids)], "n INT, value STRING")).collect()
    assert [tuple(r) for r in got] == [(0, "BTC-USD", 45000.5)]
    trades = [
        '{"channel": "trades", "data": [{"coin": "SOL", "px": "1", "sz": "9"}, {"coin": "SOL", "px": "2.5", "sz": "1"}]}',
        '{"channel": "trades", "data": []}',
        '{"channel": "trades", "data": [{"coin": "XRP", "px": "x"}]}',
    ]
    got = parse_trades(spark.createDataFrame([(t,) for t in trades], "value STRING")).collect()
    assert [tuple(r) for r in got] == [("SOL-USD", 2.5)]


def test_small_side_checks_the_size(spark):
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hint(small_side(spark.range(10), limit=160)) and not hint(small_side(spark.range(11), limit=160))
    text = spark.range(1).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit(1)).alias("a"))
    assert hint(small_side(text, limit=1100)) and not hint(small_side(text, limit=1000))
    assert hint(small_side(spark.range(10).groupBy("id").count(), derived=True))


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
