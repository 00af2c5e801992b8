"""Ordered computations whose tasks stay bounded however the keys, times or instants are distributed.

A window partitioned by a market symbol puts a symbol's whole history into one task. The two helpers here
give the same values without that:

* ``previous_row``: lag over range-partitioned chunks, the seams between chunks closed by a second, tiny window;
* ``trailing_sums``: sums over a trailing span from partial sums per instant, cell and coarser cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.plans.names import fresh


def orderable(df: DataFrame) -> list[str]:
    """The columns rows can be sorted by: all but maps and variants."""
    kinds = (T.MapType, T.VariantType)
    return [f.name for f in df.schema if not isinstance(f.dataType, kinds)]


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk_name: str | None = None) -> DataFrame:
    """Add ``name``: ``value`` of the preceding row of the same key, NULL on the first; and ``chunk_name``, the row's chunk, if asked for.

    ``order`` must be total within a key. Range partitioning on (keys, order) samples the data and cuts a hot key
    or a hot moment into as many chunks as it needs. Only the first and last row of each chunk meet again in
    the second window: two rows per chunk and key. The plan is one chain, so chunk numbers are taken once.
    """
    chunk, held, before, first, last, across = fresh(df, "_chunk", "_value", "_before", "_first", "_last", "_across", also=[name])
    chunked = df.repartitionByRange(*keys, *order).withColumn(chunk, F.spark_partition_id())
    inside = Window.partitionBy(*keys, chunk).orderBy(*order)
    marked = chunked.withColumn(held, value).withColumns(
        {
            before: F.lag(held).over(inside),
            first: F.row_number().over(inside) == 1,
            last: F.lead(F.lit(False), 1, True).over(inside),
        }
    )
    on_seam = F.col(first) | F.col(last)
    seams = Window.partitionBy(*keys, F.when(on_seam, F.lit(-1)).otherwise(F.col(chunk))).orderBy(*order)
    closed = marked.withColumn(across, F.lag(held).over(seams))
    return closed.withColumn(name, F.when(F.col(first), F.col(across)).otherwise(F.col(before))).drop(
        held, before, first, last, across, *([] if chunk_name else [chunk])
    ).withColumnsRenamed({chunk: chunk_name} if chunk_name else {})


def running_max(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], value: Column, name: str, before: bool = False) -> DataFrame:
    """Add ``name``: the greatest ``value`` of the same key up to the row, or only of the rows ``before`` it, for a table that is written in chunks of (keys, order).

    Within a chunk by a window, before the chunk by the running maximum over the chunks, one row per chunk and key.
    """
    held, upto, top, carried, of = fresh(df, "_value", "_upto", "_top", "_carried", "_of", also=[name])
    own = [f"{of}{n}" for n in range(len(keys))]
    valued = df.withColumn(held, value)
    chunks = valued.groupBy(*keys, chunk).agg(F.max(held).alias(top))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sides = chunks.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.col(chunk).alias(of), F.max(top).over(earlier).alias(carried))
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    same = F.col(chunk) == F.col(of)
    for k, o in zip(keys, own):
        same = same & F.col(k).eqNullSafe(F.col(o))
    joined = valued.withColumn(upto, F.max(held).over(inside)).join(sides, same)
    return joined.withColumn(name, F.greatest(upto, carried)).drop(held, upto, carried, of, *own)


def trailing_sums(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    width: int,
    sums: dict[str, Column],
    cells: Sequence[int],
    closed_left: bool = False,
) -> DataFrame:
    """Sums of each row's trailing span (at - width, at], or [at - width, at] with ``closed_left``.

    ``at`` is a bigint column; ``cells`` are cell sizes in its unit, ascending, each dividing the next and
    the last dividing ``width``. Rows sharing (keys, at) collapse to one in the first, map-side combined
    aggregation, so a window never holds more rows than a cell has distinct instants. Values are only ever added,
    never subtracted, so doubles do not cancel. Rows with a NULL ``at`` get NULL sums.
    """
    _check_cells(cells, width)
    names = list(sums)
    instants = (
        df.where(F.col(at).isNotNull())
        .groupBy(*keys, F.col(at).alias("_at"))
        .agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    )
    done = _span(instants, list(keys), names, width, list(cells), True, closed_left)
    left, right = df.alias("l"), done.alias("r")
    match = F.col(f"l.{at}") == F.col("r._at")
    for key in keys:
        match = match & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, match, "left").select("l.*", *[f"r.{name}" for name in names])


def _check_cells(cells: Sequence[int], width: int) -> None:
    sizes = [*cells, width]
    if not cells or any(small >= big or big % small for small, big in zip(sizes, sizes[1:])):
        raise ValueError(f"cells {list(cells)} must ascend, divide each other and divide {width}")


def _span(
    rows: DataFrame, keys: list[str], names: list[str], width: int, cells: list[int], with_own: bool, closed_left: bool
) -> DataFrame:
    """One row per (keys, _at) in; the same rows with their trailing sums out.

    With cell size c, the span of an instant is: its own cell up to it, the whole cells between, and
    the tail of the cell that starts ``width`` earlier. The tail comes from copying every row one width
    later ("leaving"), into the cell whose rows need it.
    """
    cell = cells[0]
    near = _near(rows, keys, names, width, cell, with_own, closed_left)
    start = F.col("_at") - F.pmod(F.col("_at"), F.lit(cell))
    totals = rows.groupBy(*keys, start.alias("_at")).agg(*[F.sum(n).alias(n) for n in names])
    if len(cells) > 1:
        between = _span(totals, keys, names, width, cells[1:], False, False)
    else:
        # The whole cells between, by the same two running sums, in blocks of one width.
        between = _near(totals, keys, names, width, width, False, False).drop("_cell")
    n_, b_ = near.alias("n"), between.alias("b")
    match = F.col("n._cell") == F.col("b._at")
    for key in keys:
        match = match & F.col(f"n.{key}").eqNullSafe(F.col(f"b.{key}"))
    return n_.join(b_, match, "left").select(
        *[f"n.{k}" for k in keys], "n._at", *[_add(f"n.{n}", f"b.{n}").alias(n) for n in names]
    )


def _near(
    rows: DataFrame, keys: list[str], names: list[str], width: int, cell: int, with_own: bool, closed_left: bool
) -> DataFrame:
    """(keys, _at, _cell) and the sums of the own cell up to the row and of the cell one width before from it on.

    Both are running sums, so the work is linear in the rows however many a cell has.
    """
    start = F.col("_at") - F.pmod(F.col("_at"), F.lit(cell))
    both = rows.withColumn("_leaving", F.explode(F.array(F.lit(False), F.lit(True)))).withColumns(
        {"_pos": F.pmod(F.col("_at"), F.lit(cell)), "_cell": start + F.when(F.col("_leaving"), width).otherwise(0)}
    )
    place = Window.partitionBy(*keys, "_cell")
    upto = place.orderBy("_pos").rangeBetween(Window.unboundedPreceding, 0 if with_own else -1)
    after = place.orderBy(F.col("_pos").desc()).rangeBetween(Window.unboundedPreceding, 0 if closed_left else -1)
    own = {name: F.when(~F.col("_leaving"), F.col(name)) for name in names}
    leaving = {name: F.when(F.col("_leaving"), F.col(name)) for name in names}
    return (
        both.withColumns({f"_upto_{n}": F.sum(own[n]).over(upto) for n in names})
        .withColumns({f"_after_{n}": F.sum(leaving[n]).over(after) for n in names})
        .where(~F.col("_leaving"))
        .select(*keys, "_at", "_cell", *[_add(f"_upto_{n}", f"_after_{n}").alias(n) for n in names])
    )


def _add(a: str, b: str) -> Column:
    """Sum that skips NULL, and is NULL only if both are."""
    x, y = F.col(a), F.col(b)
    return F.coalesce(x + y, x, y)
