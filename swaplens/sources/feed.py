"""Market feed messages to price ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.functions.money import normalize_symbol
from swaplens.functions.numbers import to_number
from swaplens.schemas import MIDS_DDL, TRADES_DDL

# The coins the feed subscribes to.
SUBSCRIBED = ("BTC", "ETH", "SOL")


def _parsed(raw: DataFrame, rest: list[str], column: str, ddl: str) -> DataFrame:
    # As generator output the message is parsed once, not again for the filter on its channel.
    return raw.select(*rest, F.explode(F.array(F.from_json(column, ddl))).alias("_m"))


def parse_mids(raw: DataFrame, column: str = "value", symbols: Sequence[str] = SUBSCRIBED) -> DataFrame:
    """One tick per subscribed coin and allMids message; unreadable prices are left out.

    Columns of ``raw`` other than the message are kept.
    """
    rest = [name for name in raw.columns if name != column]
    message = _parsed(raw, rest, column, MIDS_DDL).where(F.col("_m.channel") == "allMids")
    mids = message.select(*rest, F.explode("_m.data").alias("_coin", "_text")).where(F.col("_coin").isin(*symbols))
    return mids.select(
        *rest, normalize_symbol(F.col("_coin")).alias("symbol"), to_number(F.col("_text")).alias("price")
    ).where(F.col("price").isNotNull())


def parse_trades(raw: DataFrame, column: str = "value") -> DataFrame:
    """One tick per trades message, from its last trade; sizes are ignored.

    Columns of ``raw`` other than the message are kept.
    """
    rest = [name for name in raw.columns if name != column]
    message = _parsed(raw, rest, column, TRADES_DDL).where(F.col("_m.channel") == "trades")
    last = message.select(*rest, F.try_element_at("_m.data", F.lit(-1)).alias("_t"))
    return last.select(
        *rest, normalize_symbol(F.col("_t.coin")).alias("symbol"), to_number(F.col("_t.px")).alias("price")
    ).where(F.col("price").isNotNull())
