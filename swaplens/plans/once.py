"""Evaluating costly columns once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns whose expressions are evaluated once per row.

    A filter on a projected column is pushed below the projection and takes a copy of the expression along, for
    parsing or rounding several times its price. Generator output it only sees from above. Other columns'
    filters still pass through.
    """
    kept = [name for name in df.columns if name not in columns]
    made = F.inline(F.array(F.struct(*[expr.alias(name) for name, expr in columns.items()])))
    added = df.select(*[F.col(f"`{name}`") for name in kept], made)
    return added.select(*[F.col(f"`{name}`") for name in dict.fromkeys([*df.columns, *columns])])
