"""Tables laid out so that a read touches few files: by block range, and in ranked ranges for deep pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.plans.names import fresh
from swaplens.sources.swaps import block_range, page

BLOCKS = 100_000
COUNTS = "part INT, count BIGINT"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def write_by_block(df: DataFrame, path: str, blocks: int = BLOCKS, block: str = "blockNumber") -> None:
    """Write a folder per ``blocks`` blocks, replacing the folders that ``df`` has rows for and no others; rows without block are in range -1.

    Rows are dealt by range, and adaptive execution cuts a crowded one.
    """
    (part,) = fresh(df, "block_part")
    span = F.coalesce(F.floor(F.col(block) / blocks), F.lit(-1)).cast("bigint")
    rows = df.withColumn(part, span).hint("rebalance", F.col(part))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def read_by_block(
    spark: SparkSession, path: str, schema: T.StructType, start: int = 0, end: int | None = None, blocks: int = BLOCKS, block: str = "blockNumber"
) -> DataFrame:
    """The rows from block ``start`` to ``end``, both included, of what ``write_by_block`` wrote; only the folders of their ranges are read."""
    empty = spark.createDataFrame([], schema)
    (part,) = fresh(empty, "block_part")
    rows = spark.read.schema(_nullable(schema).add(part, T.LongType())).parquet(path).where(F.col(part) >= start // blocks)
    if end is not None:
        rows = rows.where(F.col(part) <= end // blocks)
    own = rows.drop(part)
    return block_range(own.withColumnRenamed(block, "blockNumber"), start, end).withColumnRenamed("blockNumber", block).select(*[f"`{f.name}`" for f in schema])


def write_ranked(df: DataFrame, order: Sequence[str], path: str, parts: int | None = None) -> None:
    """Write the rows in ranges of ``order``, a folder each, and how many rows each has: an index of ranks with a row per range."""
    (part,) = fresh(df, "rank_part")
    cut = df.repartitionByRange(*([parts] if parts else []), *order).withColumn(part, F.spark_partition_id())
    cut.write.mode("overwrite").partitionBy(part).parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(_nullable(df.schema).add(part, T.IntegerType())).parquet(f"{path}/rows")
    written.groupBy(F.col(part).alias("part")).count().coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")


def page_ranked(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str], first: int, skip: int = 0) -> DataFrame:
    """The page that ``page`` gives, for an order without ties, from the ranges that it lies in: files read do not grow with ``skip``."""
    (part,) = fresh(spark.createDataFrame([], schema), "rank_part")
    counts = spark.read.schema(COUNTS).parquet(f"{path}/counts").orderBy("part").collect()  # a row per range
    before, at, wanted = 0, 0, []
    for r in counts:
        if before < skip + first and before + r["count"] > skip:
            at = at if wanted else before
            wanted.append(r["part"])
        before += r["count"]
    rows = spark.read.schema(_nullable(schema).add(part, T.IntegerType())).parquet(f"{path}/rows").where(F.col(part).isin(wanted)).drop(part)
    return page(rows, order, first, skip - at if wanted else 0)
