"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of block b go to shard s is drawn first: the row of a block is a multivariate hypergeometric draw from what the shards
still have room for. Rows are ranked in their block by a random key (the local permutation) and cut at the matrix' running sums, go
to their shards, and are ranked there by a second key. Every assignment of rows to slots is equally likely, as far as the keys are
random, and sizes are exact. Ranks are taken within blocks and within cells of a shard, so no task holds a whole shard.

Documents are numbered and written once, and cross the network once: blocks are ranked on the keys alone, and the keys at the
cuts tell every document its shard where it lies. It goes there with all its columns, is ranked, and is written to its shard's folder.

Main path: DataFrame functions only. The matrix is drawn on the driver; it has a row per ``block_rows`` documents, and ``MOST_BLOCKS`` rows at most.

Null texts stay null and have the keys, size and checksum of empty ones. Null ids and repeated rows are rows like others: the row's number within the
read is part of its keys. An empty table gives no rows. Other columns go along as they are.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.llm.common import as_they_are, chunks_for, fresh, text_or_empty
from swaplens.plans.scale import run_dir, small_side, stored

BLOCK_ROWS, MOST_BLOCKS = 8192, 4096  # from 33 million rows on, blocks get longer, not more


def communication_matrix(block_counts: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows by block, columns by shard; row and column sums are exact, and the draw is that of a uniform permutation."""
    rng, room, matrix = np.random.default_rng(seed), np.array(shard_sizes, "i8"), []
    for count in block_counts:
        row = rng.multivariate_hypergeometric(room, count, method="marginals")
        room -= row
        matrix.append([int(x) for x in row])
    return matrix


def _cell(key: Column, n: int) -> Column:
    """Cell 0 to n - 1 by a key's leading 31 bits; keys ascend with cells."""
    return F.shiftright(F.shiftrightunsigned(key, 33) * n, 31).cast("int")


def _stored(df: DataFrame, folder: str, *by: str) -> DataFrame:
    """What is read from the folder after writing to it, under the same schema whether or not there are rows."""
    df.write.option("compression", "zstd").partitionBy(*by).parquet(folder)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return df.sparkSession.read.schema(nullable).parquet(folder).select(*as_they_are(df))


def _digests() -> list[Column]:
    text = text_or_empty()
    return [(F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def write_shards(docs: DataFrame, folder: str, shards: int = 24, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write the documents to a folder per shard and read them again: all columns as they are, then shard and slot.

    Slots are gapless from 0 in each shard; shards differ by one row at most. Where the documents have a column shard or slot, the new one
    gets underscores before its name.
    """
    shard, slot, row, k0, k1, k2, block, cell, rank, cut, edges, c_block, c_rank, o_shard, o_cell, o_before = fresh(
        docs, "shard", "slot", "row", "k0", "k1", "k2", "block", "cell", "rank", "cut", "edges", "c_block", "c_rank", "o_shard", "o_cell", "o_before"
    )
    columns, (_, crc) = as_they_are(docs), _digests()
    held = _stored(docs.withColumn(row, F.monotonically_increasing_id()), run_dir(docs.sparkSession, "rows"))
    keyed = held.withColumns({k: F.xxhash64(F.lit(f"{name}-{seed}"), "doc_id", crc, row) for name, k in (("k0", k0), ("k1", k1), ("k2", k2))})
    base = stored(keyed.select(k0, k1, k2, row), "keys")
    n = base.count()
    blocks, cells = min(chunks_for(n, block_rows), MOST_BLOCKS), chunks_for(n, block_rows * shards)
    placed = {block: _cell(F.col(k0), blocks), cell: _cell(F.col(k2), cells)}
    base = base.withColumns(placed)
    counts = dict(base.groupBy(block).count().collect())
    sizes = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], sizes, seed)
    cuts = docs.sparkSession.sql(
        "SELECT c_block, explode(cuts) AS c_rank FROM (SELECT posexplode(from_json(:m, 'array<array<bigint>>')) AS (c_block, cuts))",
        args={"m": json.dumps(np.cumsum(matrix, axis=1).tolist())},
    ).toDF(c_block, c_rank)
    # The last keys that go to each shard, per block; shards before the first row have none.
    local = base.withColumn(rank, F.row_number().over(Window.partitionBy(block).orderBy(k1, row)))
    last = cuts.join(local, (F.col(c_block) == F.col(block)) & (F.col(c_rank) == F.col(rank)), "left")
    edge = F.when(F.col(row).isNotNull(), F.struct(k1, row))
    at = stored(last.groupBy(c_block).agg(F.collect_list(edge).alias(edges), F.count(F.when(F.col(c_rank) == 0, 1)).alias(cut)), "cuts")

    def dealt(df: DataFrame) -> DataFrame:
        before = F.filter(edges, lambda e: e < F.struct(k1, row))
        # A row per block, with an edge per shard.
        return df.join(F.broadcast(at), F.col(block) == F.col(c_block)).withColumn(shard, (F.col(cut) + F.size(before)).cast("int"))

    in_cell = dealt(base).groupBy(shard, cell).count()
    before = F.sum("count").over(Window.partitionBy(shard).orderBy(cell)) - F.col("count")
    offsets = small_side(stored(in_cell.select(F.col(shard).alias(o_shard), F.col(cell).alias(o_cell), before.alias(o_before)), "offsets"))
    sent = dealt(keyed.withColumns(placed)).select(*columns, row, k2, shard, cell)
    ranked = sent.withColumn(rank, F.row_number().over(Window.partitionBy(shard, cell).orderBy(k2, row)))
    slotted = ranked.join(offsets, (F.col(shard) == F.col(o_shard)) & (F.col(cell) == F.col(o_cell)))
    out = slotted.select(*columns, F.col(shard), (F.col(o_before) + F.col(rank) - 1).cast("bigint").alias(slot))
    return _stored(out, folder, shard)


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 7, block_rows: int = BLOCK_ROWS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of the documents that arrived in the shards."""
    arrived = write_shards(docs, folder or run_dir(docs.sparkSession, "shards"), shards, seed, block_rows)
    shard, slot = arrived.columns[-2:]
    return arrived.select("doc_id", *_digests(), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
