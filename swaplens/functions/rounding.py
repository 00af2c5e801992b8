"""Decimal rounding of doubles, the three ways the results need it."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swaplens.plans.once import with_once

# 2**27 + 1 cuts a double into two halves whose products with 10**6 are exact.
_SPLIT = 134217729.0


def round_scaled(x: Column, places: int) -> Column:
    """Scale, round to the nearest integer (half to even), scale back: how array libraries round."""
    scale = float(10**places)
    return F.rint(x * scale) / scale


def with_rounded(
    df: DataFrame, columns: Mapping[str, Column], places: int, ties: str = "even"
) -> DataFrame:
    """Add columns rounded by the exact binary value of each double.

    2.675 is stored as 2.67499..., so it becomes 2.67, where scaling first gives 2.68. Only true ties
    (eighths, at two places) depend on ``ties``: "even" or "up" (away from zero).

    The product with 10**places is kept with its rounding error, in plain double arithmetic, so the
    stage stays in generated code. The steps are separate projections: each input is computed once.
    """
    if ties not in ("even", "up"):
        raise ValueError(f"Unsupported ties: {ties}")
    scale = float(10**places)
    # From here on neighbouring doubles are further apart than the rounding step.
    coarse = 2.0 ** math.floor(53 - math.log2(scale))
    names = list(columns)
    raw = df.withColumns({f"_raw_{n}": columns[n].cast("double") for n in names})
    cut = raw.selectExpr("*", *[e for n in names for e in (_scaled(n, scale), _high_half(n))])
    parts = cut.selectExpr("*", *[f"cast(floor(`_scaled_{n}`) AS DOUBLE) AS `_whole_{n}`" for n in names])
    parts = parts.selectExpr("*", *[_beyond_half(n, scale) for n in names])
    # A filter on a result would otherwise carry some fifteen copies of each input below the projections.
    done = with_once(parts, {n: F.expr(_rounded(n, scale, coarse, ties)) for n in names})
    kinds = ("raw", "scaled", "high", "whole", "beyond")
    return done.drop(*[f"_{kind}_{n}" for kind in kinds for n in names])


def _scaled(n: str, scale: float) -> str:
    return f"abs(`_raw_{n}`) * {scale}D AS `_scaled_{n}`"


def _high_half(n: str) -> str:
    a = f"abs(`_raw_{n}`)"
    return f"{a} * {_SPLIT}D - ({a} * {_SPLIT}D - {a}) AS `_high_{n}`"


def _beyond_half(n: str, scale: float) -> str:
    """How far the exact product lies above the middle between two steps; the sign is exact."""
    raw, scaled, high = f"abs(`_raw_{n}`)", f"`_scaled_{n}`", f"`_high_{n}`"
    error = f"({high} * {scale}D - {scaled}) + ({raw} - {high}) * {scale}D"
    return f"({scaled} - `_whole_{n}` - 0.5D) + ({error}) AS `_beyond_{n}`"


def _rounded(n: str, scale: float, coarse: float, ties: str) -> str:
    raw, whole, beyond = f"`_raw_{n}`", f"`_whole_{n}`", f"`_beyond_{n}`"
    up = f"{beyond} >= 0" if ties == "up" else f"{beyond} > 0 OR ({beyond} = 0 AND {whole} % 2 = 1)"
    near = f"signum({raw}) * CASE WHEN {up} THEN {whole} + 1 ELSE {whole} END / {scale}D"
    # NaN compares above every number in Spark, so NaN and infinity pass through unchanged here.
    return f"CASE WHEN abs({raw}) >= {coarse}D THEN {raw} ELSE {near} + 0.0D END"
