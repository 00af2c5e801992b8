import pytest
from conftest import USDC, USDT, WBTC, WETH
from pyspark.sql import functions as F

from swaplens.operators.aggregate import summarize, top_pairs, top_traders
from swaplens.operators.enrich import (
    enrich_swaps,
    enrich_with_prices,
    price_join,
    run_stats,
    skipped,
    with_amounts,
)
from swaplens.schemas import ENRICHED_SCHEMA, SWAP_SCHEMA


@pytest.fixture
def more_swaps(spark):
    rows = [
        ("0xa1", 1, 10, WETH, USDC, "1000000000000000000", "-2500000000", "1"),
        ("0xa2", 2, 20, WETH.upper().replace("0X", "0x"), USDC, "2000000000000000000", "-5000000000", "1"),
        ("0xb1", 3, 30, WBTC, USDC, "50000000", "-22500000000", "1"),
        ("0xc1", 4, 40, USDC, USDT, "1000000000", "-1000000000", "1"),
        ("0xa3", 5, 50, WETH, USDC, "500000000000000000", "-1250000000", "1"),
        ("0xd1", 6, 60, "0xunknown", USDC, "1", "-1", "1"),
    ]
    return spark.createDataFrame(rows, SWAP_SCHEMA)


@pytest.fixture
def more_prices(spark):
    rows = [(WETH, 2500.0), (USDC, 1.0), (WBTC, 45000.0), (USDT, 1.0)]
    return spark.createDataFrame(rows, "token STRING, price_usd DOUBLE")


def test_stable_side_gives_the_volume(swaps, prices):
    got = enrich_swaps(swaps, prices).orderBy("blockNumber").collect()
    assert [r.usdVolume for r in got] == [2000.0, 4000.0, 20000.0]
    assert (got[0].priceUSD0, got[0].priceUSD1, got[2].priceUSD0) == (2000.0, 1.0, 40000.0)
    assert got[0].pair == f"{WETH}-{USDC}"


def test_enriched_columns(swaps, prices):
    got = enrich_swaps(swaps, prices)
    assert set(got.columns) == set(ENRICHED_SCHEMA.names)
    extra = enrich_swaps(swaps.withColumn("pool", F.lit("p")), prices)
    assert set(extra.columns) == set(ENRICHED_SCHEMA.names) | {"pool"}


def test_summary(swaps, prices):
    got = [tuple(r) for r in summarize(enrich_swaps(swaps, prices)).collect()]
    assert got == [(f"{WBTC}-{USDC}", 1, 20000.0, 20000.0), (f"{WETH}-{USDC}", 2, 6000.0, 3000.0)]


def test_summary_with_stable_pair_and_unknown_token(more_swaps, more_prices):
    enriched = enrich_swaps(more_swaps, more_prices)
    got = [tuple(r) for r in summarize(enriched).collect()]
    assert got == [
        (f"{WBTC}-{USDC}", 1, 22500.0, 22500.0),
        (f"{WETH}-{USDC}", 3, 8750.0, 2916.67),
        (f"{USDC}-{USDT}", 1, 1000.0, 1000.0),
    ]
    assert enriched.where("token0 like '0xC02%'").count() == 1
    assert [tuple(r) for r in summarize(enriched, 1).collect()] == got[:1]
    assert top_pairs(summarize(enriched), 0).count() == 3
    (left_out,) = skipped(more_swaps, more_prices).collect()
    assert (left_out.txHash, left_out.reason) == ("0xd1", "missing_price")


def test_both_sides_without_a_stable(spark, more_prices):
    row = [("0x1", 1, 1, WETH, WBTC, "1000000000000000000", "-10000000", "1")]
    (got,) = enrich_swaps(spark.createDataFrame(row, SWAP_SCHEMA), more_prices).collect()
    assert got.usdVolume == 2500.0 + 4500.0


def test_missing_prices_skip_or_zero(swaps, prices):
    only_weth = prices.where(F.col("token") == WETH)
    assert enrich_swaps(swaps, only_weth).count() == 0
    assert price_join(swaps, only_weth).count() == 0
    zero = enrich_swaps(swaps, only_weth, missing="zero").collect()
    assert [r.usdVolume for r in zero] == [0.0, 0.0, 0.0]
    assert {r.price0 for r in price_join(swaps, only_weth, missing="zero").collect()} == {2000.0, 0.0}
    with pytest.raises(ValueError):
        enrich_swaps(swaps, prices, missing="guess")


def test_bad_amounts_are_skipped(swaps, prices):
    bad = swaps.withColumn("amount0", F.when(F.col("blockNumber") == 1000, "n/a").otherwise(F.col("amount0")))
    assert enrich_swaps(bad, prices).count() == 2
    assert [r.reason for r in skipped(bad, prices).collect()] == ["invalid_amount"]


def test_large_integers_and_scaled_amounts(spark, prices):
    wide = str(2**160 - 1)
    row = [("0x1", 1, 1, WETH, WBTC, wide, "-1", "1")]
    (got,) = enrich_swaps(spark.createDataFrame(row, SWAP_SCHEMA), prices).collect()
    assert got.usdVolume == pytest.approx((2**160 - 1) / 1e18 * 2000, rel=1e-12)
    scaled = spark.createDataFrame([("0x1", 1, 1, WETH, WBTC, "1.5", "-0.5", "1")], SWAP_SCHEMA)
    (got,) = enrich_swaps(scaled, prices, amounts_are_raw=False).collect()
    assert got.usdVolume == 3000.0 + 20000.0


def test_default_decimals(spark):
    df = spark.createDataFrame([("0xnew", USDC, "2" + "0" * 18, "1500000")], "token0 STRING, token1 STRING, amount0 STRING, amount1 STRING")
    got = with_amounts(df).first()
    assert (got.quantity0, got.quantity1) == (2.0, 1.5)


def test_price_spellings_count_once(spark, swaps):
    rows = [(WETH, 2000.0), (WETH.upper(), 1.0), (USDC, 1.0), (WBTC, 1.0)]
    prices = spark.createDataFrame(rows, "token STRING, price_usd DOUBLE")
    assert enrich_swaps(swaps, prices).count() == 3


def test_current_prices_match_exactly(spark):
    df = spark.createDataFrame([("bitcoin",), ("Bitcoin",)], "tokenIn STRING")
    prices = spark.createDataFrame([("bitcoin", 50000.0, 2.5)], "token_id STRING, usd DOUBLE, usd_24h_change DOUBLE")
    got = {tuple(r) for r in enrich_with_prices(df, prices).collect()}
    assert got == {("bitcoin", 50000.0, 2.5), ("Bitcoin", None, None)}


def test_run_stats(more_swaps, more_prices):
    got = run_stats(more_swaps, more_prices, 2).first()
    assert (got.swaps_fetched, got.swaps_filtered, got.swaps_new) == (6, 2, 4)
    assert (got.swaps_enriched, got.swaps_skipped, got.pairs_summarized) == (3, 1, 3)
    assert (got.unique_tokens, got.prices_fetched, got.prices_missing, got.latest_block) == (5, 4, 1, 6)
    assert run_stats(more_swaps.limit(0), more_prices, 0).first().swaps_fetched == 0


def test_top_traders(spark):
    rows = [("p", "a", 5.0), ("p", "b", 7.0), ("p", "a", 3.0), ("p", "c", 1.0), ("q", "a", 1.0)]
    df = spark.createDataFrame(rows, "pair STRING, trader STRING, usdVolume DOUBLE")
    got = {r.pair: r.tradersTopN for r in top_traders(df, 2).collect()}
    assert got == {"p": ["a", "b"], "q": ["a"]}


def test_empty_summary_has_its_columns(swaps, prices):
    empty = summarize(enrich_swaps(swaps, prices).limit(0))
    assert empty.columns == ["pair", "count", "totalUSD", "avgUSD"] and empty.count() == 0


def test_lookup_is_broadcast_and_swaps_are_not_shuffled(swaps, prices):
    plan = enrich_swaps(swaps, prices)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_lookup_beyond_the_limit_still_joins(monkeypatch, swaps, prices):
    from swaplens.operators import enrich
    from swaplens.plans.scale import small_side

    monkeypatch.setattr(enrich, "small_side", lambda df, derived=False: small_side(df, derived, limit=1))
    got = enrich_swaps(swaps, prices)
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()
    assert got.count() == 3
