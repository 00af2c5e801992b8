"""Plan helpers for sizes no single task or executor can hold."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side of at most this size is sent to every executor.
BROADCAST_BYTES = 64 * 2**20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from spark.checkpoint.dir; a temporary one only in local mode."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors see")
        path = tempfile.mkdtemp(prefix="swaplens-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run within leave no shuffle files behind; otherwise these stay until the driver happens to collect its garbage.

    For writes whose rows are read back from what was written. The session's own setting comes back afterwards.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def settle(df: DataFrame) -> DataFrame:
    """Write a small intermediate to the shared folder, so later uses neither recompute nor lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored", compression: str = "snappy") -> DataFrame:
    """Write an intermediate of any size as Parquet below the shared folder and read it back.

    Unlike a checkpointed RDD it packs into few partitions, has a known size, and reads only the columns asked for. All its columns can be null.
    """
    path = run_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: a word or two per column, and the text and nested values themselves."""
    size = F.lit(16 * len(df.columns))
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return size.cast("bigint")


def small_side(df: DataFrame, derived: bool = False, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a lookup table for broadcast if measuring it shows that it is small.

    Otherwise it is returned as it is: the join shuffles both sides and adaptive execution splits hot keys.
    A ``derived`` table (joined or aggregated) is settled first, so that measuring and joining compute it once.
    """
    if derived:
        df = settle(df)
    size = df.agg(F.sum(_row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df
