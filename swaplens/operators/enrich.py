"""Prices and USD volumes for swaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swaplens.functions import dims
from swaplens.functions.money import usd_volume
from swaplens.functions.numbers import to_number
from swaplens.functions.rounding import with_rounded
from swaplens.plans.once import with_once
from swaplens.plans.scale import settle, small_side


def price_dim(prices: DataFrame) -> DataFrame:
    """(token, price_usd) with one row per lower-cased token; of several spellings the last in text order counts."""
    return prices.groupBy(F.lower("token").alias("token")).agg(F.max_by("price_usd", "token").alias("price_usd"))


def token_dim(
    prices: DataFrame, decimals: DataFrame | None = None, stables: DataFrame | None = None
) -> DataFrame:
    """One lookup row per token: price, price at six places, raw units per token, stable flag.

    Joining these small tables first leaves two joins on the swaps instead of six, and rounds per token, not per swap.
    """
    spark = prices.sparkSession
    decimals = dims.decimals(spark) if decimals is None else decimals
    stables = dims.stablecoins(spark) if stables is None else stables
    facts = (
        price_dim(prices)
        .unionByName(decimals.select(F.lower("token").alias("token"), "decimals"), allowMissingColumns=True)
        .unionByName(
            stables.select(F.lower("token").alias("token"), F.lit(True).alias("stable")), allowMissingColumns=True
        )
    )
    places = F.coalesce(F.max("decimals"), F.lit(dims.DEFAULT_DECIMALS))
    tokens = facts.groupBy("token").agg(
        F.max("price_usd").alias("price"),
        F.pow(F.lit(10.0), places).alias("units"),
        F.coalesce(F.bool_or("stable"), F.lit(False)).alias("stable"),
    )
    return with_rounded(tokens, {"rounded": F.col("price")}, 6)


def _with_side(df: DataFrame, dim: DataFrame, token: str, suffix: str, columns: list[str], how: str) -> DataFrame:
    side = dim.select(
        F.col("token").alias(f"_token{suffix}"), *[F.col(c).alias(f"_{c}{suffix}") for c in columns]
    )
    return df.join(side, F.lower(token) == F.col(f"_token{suffix}"), how).drop(f"_token{suffix}")


def price_join(df: DataFrame, prices: DataFrame, missing: str = "skip") -> DataFrame:
    """Add price0 and price1 by case-insensitive token; swaps lacking one are skipped, or priced zero."""
    _check_missing(missing)
    dim = small_side(price_dim(prices), derived=True)
    how = "inner" if missing == "skip" else "left"
    for suffix in "01":
        df = _with_side(df, dim, f"token{suffix}", suffix, ["price_usd"], how).withColumnRenamed(
            f"_price_usd{suffix}", f"price{suffix}"
        )
    if missing == "skip":
        return df.where(F.col("price0").isNotNull() & F.col("price1").isNotNull())
    return df.withColumns({p: F.coalesce(F.col(p), F.lit(0.0)) for p in ("price0", "price1")})


def normalize_amount(amount: Column, decimals: Column) -> Column:
    """Raw integer text to whole tokens; text that is no number gives NULL."""
    return to_number(amount) / F.pow(F.lit(10.0), F.coalesce(decimals, F.lit(dims.DEFAULT_DECIMALS)))


def with_amounts(df: DataFrame, decimals: DataFrame | None = None) -> DataFrame:
    """Add quantity0 and quantity1, the amounts in whole tokens."""
    decimals = dims.decimals(df.sparkSession) if decimals is None else decimals
    places = decimals.groupBy(F.lower("token").alias("token")).agg(F.max("decimals").alias("decimals"))
    dim = small_side(places, derived=True)
    for suffix in "01":
        df = (
            _with_side(df, dim, f"token{suffix}", suffix, ["decimals"], "left")
            .withColumn(f"quantity{suffix}", normalize_amount(F.col(f"amount{suffix}"), F.col(f"_decimals{suffix}")))
            .drop(f"_decimals{suffix}")
        )
    return df


LOOKUPS = ["price", "rounded", "units", "stable"]


def _looked_up(
    swaps: DataFrame,
    prices: DataFrame,
    decimals: DataFrame | None,
    stables: DataFrame | None,
    how: str = "left",
    amounts_are_raw: bool = True,
) -> DataFrame:
    """The swaps with both tokens' lookups and quantities, in columns that begin with an underscore.

    An inner join keeps the swaps whose tokens both have a price.
    """
    tokens = token_dim(prices, decimals, stables)
    dim = small_side(tokens.where(F.col("price").isNotNull()) if how == "inner" else tokens, derived=True)
    df = with_once(swaps, {f"_number{s}": to_number(F.col(f"amount{s}")) for s in "01"})
    for suffix in "01":
        df = _with_side(df, dim, f"token{suffix}", suffix, LOOKUPS, how)
    for s in "01":
        units = F.coalesce(f"_units{s}", F.lit(10.0**dims.DEFAULT_DECIMALS)) if amounts_are_raw else F.lit(1.0)
        df = df.withColumn(f"_quantity{s}", F.col(f"_number{s}") / units).drop(f"_number{s}")
    return df


def _without_lookups(df: DataFrame) -> DataFrame:
    return df.drop(*[f"_{name}{s}" for name in [*LOOKUPS, "quantity"] for s in "01"])


def _reason(missing: str) -> Column:
    """Why a looked-up swap is left out; NULL for a swap that is kept."""
    no_price = F.col("_price0").isNull() | F.col("_price1").isNull()
    bad_amount = F.col("_quantity0").isNull() | F.col("_quantity1").isNull()
    reason = F.when(bad_amount, "invalid_amount")
    return F.when(no_price, "missing_price").otherwise(reason) if missing == "skip" else reason


def enrich_swaps(
    swaps: DataFrame,
    prices: DataFrame,
    decimals: DataFrame | None = None,
    stables: DataFrame | None = None,
    missing: str = "skip",
    amounts_are_raw: bool = True,
) -> DataFrame:
    """Add priceUSD0, priceUSD1, usdVolume (six places) and the lower-cased pair.

    Swaps with a missing price or an unreadable amount are left out (``skipped`` lists them); with
    ``missing="zero"`` a missing price counts as 0. With a lookup table of checked size this is one stage
    without a shuffle of the swaps.
    """
    _check_missing(missing)
    how = "inner" if missing == "skip" else "left"
    df = _looked_up(swaps, prices, decimals, stables, how, amounts_are_raw)
    df = df.where(F.col("_quantity0").isNotNull() & F.col("_quantity1").isNotNull())
    zero = F.lit(0.0)
    price0, price1, rounded0, rounded1 = (
        F.coalesce(f"_{name}{s}", zero) for name in ("price", "rounded") for s in "01"
    )
    stable0, stable1 = (F.coalesce(f"_stable{s}", F.lit(False)) for s in "01")
    volume = usd_volume(F.col("_quantity0"), price0, stable0, F.col("_quantity1"), price1, stable1)
    df = with_rounded(df, {"usdVolume": volume}, 6)
    pair = F.concat_ws("-", F.lower("token0"), F.lower("token1"))
    return _without_lookups(df.withColumns({"priceUSD0": rounded0, "priceUSD1": rounded1, "pair": pair}))


def skipped(
    swaps: DataFrame,
    prices: DataFrame,
    decimals: DataFrame | None = None,
    missing: str = "skip",
) -> DataFrame:
    """The swaps ``enrich_swaps`` leaves out, each with its reason."""
    _check_missing(missing)
    df = _looked_up(swaps, prices, decimals, None)
    return _without_lookups(df.withColumn("reason", _reason(missing)).where(F.col("reason").isNotNull()))


def enrich_with_prices(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Add current_price_usd and price_change_24h where tokenIn equals the price id exactly, else NULL.

    ``prices``: (token_id, usd, usd_24h_change), one row per id.
    """
    dim = small_side(
        prices.select(
            F.col("token_id").alias("_token_id"),
            F.col("usd").alias("current_price_usd"),
            F.col("usd_24h_change").alias("price_change_24h"),
        ),
        derived=True,
    )
    return df.join(dim, F.col("tokenIn") == F.col("_token_id"), "left").drop("_token_id")


def run_stats(
    swaps: DataFrame,
    prices: DataFrame,
    last_block: int,
    decimals: DataFrame | None = None,
) -> DataFrame:
    """One row of counts for a run: fetched, old, new, enriched, skipped, pairs, tokens, prices; and the latest block."""
    df = _looked_up(swaps, prices, decimals, None)
    new = F.coalesce(F.col("blockNumber") > last_block, F.lit(False))
    # One pass over the swaps: everything else is counted from one row per pair of token spellings.
    groups = settle(
        df.groupBy(
            "token0",
            "token1",
            F.col("_price0").isNotNull().alias("priced0"),
            F.col("_price1").isNotNull().alias("priced1"),
        ).agg(
            F.count("*").alias("fetched"),
            F.count_if(new).alias("new"),
            F.count_if(new & _reason("skip").isNull()).alias("enriched"),
            F.max("blockNumber").alias("block"),
        )
    )
    pairs = groups.where(F.col("enriched") > 0).select(F.lower("token0"), F.lower("token1")).distinct()
    tokens = (
        groups.where(F.col("new") > 0)
        .select(F.explode(F.array(*[F.struct(F.col(f"token{s}").alias("token"), F.col(f"priced{s}").alias("priced")) for s in "01"])).alias("t"))
        .select("t.*")
        .where(F.col("token") != "")
        .distinct()
    )
    names = tokens.agg(
        F.count("*").alias("unique_tokens"),
        F.count_if("priced").alias("prices_fetched"),
        F.count_if(~F.col("priced")).alias("prices_missing"),
    )
    counted = groups.agg(
        F.coalesce(F.sum("fetched"), F.lit(0)).alias("swaps_fetched"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("swaps_new"),
        F.coalesce(F.sum("enriched"), F.lit(0)).alias("swaps_enriched"),
        F.coalesce(F.max("block"), F.lit(0)).alias("latest_block"),
    ).withColumns(
        {
            "swaps_filtered": F.col("swaps_fetched") - F.col("swaps_new"),
            "swaps_skipped": F.col("swaps_new") - F.col("swaps_enriched"),
            "pairs_summarized": pairs.agg(F.count("*")).scalar(),
            "_names": names.select(F.struct(*names.columns)).scalar(),
        }
    )
    return counted.select("*", "_names.*").drop("_names")


def _check_missing(missing: str) -> None:
    if missing not in ("skip", "zero"):
        raise ValueError(f"Unsupported missing: {missing}")
