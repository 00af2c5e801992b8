"""Names for helper columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str, also: Sequence[str] = ()) -> list[str]:
    """Names like the given ones that no column of ``df`` has, whatever its case, and that are not in ``also``, so that no caller's column is lost."""
    taken = {c.lower() for c in [*df.columns, *also]}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
