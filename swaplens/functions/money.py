"""Column expressions for volumes, spreads and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usd_volume(
    amount0: Column, price0: Column, stable0: Column, amount1: Column, price1: Column, stable1: Column
) -> Column:
    """USD volume of a swap: the stable side where there is one (token0 first), else both sides."""
    side0, side1 = F.abs(amount0 * price0), F.abs(amount1 * price1)
    return F.when(stable0, side0).when(stable1, side1).otherwise(side0 + side1)


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def spread_percent(bid: Column, ask: Column, price: Column) -> Column:
    return F.try_divide(ask - bid, price) * 100


def normalize_symbol(symbol: Column) -> Column:
    """Feed coin to market symbol: the three majors carry their quote currency."""
    return F.when(symbol.isin("BTC", "ETH", "SOL"), F.concat(symbol, F.lit("-USD"))).otherwise(symbol)


def format_number(value: Column, decimals: int = 2) -> Column:
    """Thousands separators and a fixed number of decimals, halves away from zero."""
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, _digits(value, decimals))


def format_currency(value: Column, decimals: int = 2) -> Column:
    """US dollars: ``-$1,234.56``."""
    sign = F.when(value < 0, "-$").otherwise("$")
    return F.concat(sign, _digits(value, decimals))


def _digits(value: Column, decimals: int) -> Column:
    size = F.abs(value.cast("double"))
    return (
        F.when(F.isnan(size), "NaN")
        .when(size == float("inf"), "∞")
        .otherwise(F.format_number(F.round(size, decimals), decimals))
    )
