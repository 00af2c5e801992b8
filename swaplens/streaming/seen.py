"""The ids that have been written, over micro-batches and runs."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swaplens.operators.clean import dedupe
from swaplens.plans.names import fresh


class SeenIds:
    """A set of ids below ``path``, in folders by block range and hash of the id; a batch consults the folders of its own rows only.

    ``run`` names who writes (a checkpoint): what a repeated batch wrote before it died does not count against it. A row is known by its id and the range of its block; rows without id are all new.
    """

    def __init__(self, spark: SparkSession, path: str, run: str, key: str = "id", block: str = "blockNumber", blocks: int = 100_000, buckets: int = 16):
        self.spark, self.path, self.key, self.block = spark, path.rstrip("/"), key, block
        self.run, self.blocks, self.buckets = hashlib.sha256(run.encode()).hexdigest()[:16], blocks, buckets

    def _places(self, df: DataFrame, part: str, bucket: str) -> DataFrame:
        span = F.coalesce(F.floor(F.col(self.block) / self.blocks), F.lit(-1)).cast("bigint")
        return df.withColumns({part: span, bucket: F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")})

    def known(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """The ids in the folders that the batch's rows fall in, but for this batch's own; None if there are no such folders."""
        part, bucket = fresh(batch, "range", "bucket")
        touched = self._places(batch.where(F.col(self.key).isNotNull()), part, bucket).select(part, bucket).distinct().collect()  # ranges x buckets at most
        if not touched:
            return None
        spans, buckets = (",".join(sorted({str(r[k]) for r in touched})) for k in (0, 1))
        kind = batch.schema[self.key].dataType.simpleString()
        reader = self.spark.read.schema(f"`{self.key}` {kind}, range BIGINT, bucket INT, run STRING, batch BIGINT").option("basePath", self.path)
        try:
            ids = reader.parquet(f"{self.path}/range={{{spans}}}/bucket={{{buckets}}}")
        except AnalysisException:
            return None
        return ids.where((F.col("run") != self.run) | (F.col("batch") < batch_id)).select(self.key)

    def new_only(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """One row per id of the batch, of the ids that have not been written."""
        named = dedupe(batch.where(F.col(self.key).isNotNull()), self.key)
        known = self.known(batch, batch_id)
        if known is not None:
            (key,) = fresh(batch, "_seen")
            named = named.join(known.withColumnRenamed(self.key, key), F.col(self.key) == F.col(key), "left_anti")
        return named.unionByName(batch.where(F.col(self.key).isNull()))

    def add(self, written: DataFrame, batch_id: int) -> None:
        """What a batch has written."""
        ids = self._places(written.where(F.col(self.key).isNotNull()).select(self.key, self.block), "range", "bucket").drop(self.block)
        ids = ids.withColumns({"run": F.lit(self.run), "batch": F.lit(batch_id).cast("bigint")})
        ids.repartition("range", "bucket").write.mode("append").partitionBy("range", "bucket", "run", "batch").parquet(self.path)
