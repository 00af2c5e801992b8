"""Tables of which a new state is written by the parts that changed.

The parts of a column's values have a fingerprint each, the leaves of a tree of hashes, and the fingerprint of the leaves is its root. Equal roots: nothing
is written. Otherwise only the parts whose leaves differ are, to a folder of this write, and a manifest, a row per part, tells the folder in which each part stands. The root and the name of the
manifest move last, as a row in a log, so readers see the old state or the new one, and a write that dies leaves the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.plans.names import fresh
from swaplens.plans.scale import settle, small_side
from swaplens.sources.files import combined, fingerprint, kinds, row_hash
from swaplens.sources.state import load_state, save_state

LEAVES = "slot BIGINT, rows BIGINT, hash_sum STRING, hash_xor BIGINT, version STRING"


def _manifest(spark: SparkSession, path: str) -> tuple[dict[str, Any], DataFrame]:
    """What the log says, and the leaves of the state that stands."""
    state = load_state(spark, f"{path}/state")
    if "version" not in state:
        return state, spark.createDataFrame([], LEAVES)
    return state, spark.read.schema(LEAVES).parquet(f"{path}/manifest/version={state['version']}")


def write_changed_parts(df: DataFrame, path: str, by: str) -> dict[str, int]:
    """Make ``df`` what stands at ``path``, writing the parts (by value of ``by``, NULL is one) whose content changed; the numbers of parts written, kept and gone.

    Order of rows and columns does not count, names and types do: other ones rewrite everything. ``df`` is read twice, so give a written table. Folders that no manifest names any
    more are left; clear them by hand.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    state, old = _manifest(spark, path)
    slot, h, version = fresh(df, "slot", "_hash", "version")
    slotted = df.withColumn(slot, F.xxhash64(by))
    leaves = settle(slotted.select(F.col(slot).alias("slot"), row_hash(df).alias(h)).groupBy("slot").agg(*combined(h)))
    root = [*map(str, fingerprint(leaves).first()), kinds(df), by]
    if root == state.get("root"):
        return {"written": 0, "kept": leaves.count(), "gone": 0}
    if state.get("root", [])[-2:] != root[-2:]:
        old = old.limit(0)
    stands = old.select(F.struct("slot", "rows", "hash_sum", "hash_xor").alias("leaf"), F.col("version").alias("stands"))
    told = settle(leaves.join(stands, F.struct(*leaves.columns) == F.col("leaf"), "left").drop("leaf"))
    counts = told.agg(F.count_if(F.col("stands").isNull()).alias("written"), F.count("stands").alias("kept")).first().asDict()
    gone = old.join(leaves, "slot", "left_anti").count()
    run = uuid.uuid4().hex
    if counts["written"]:
        changed = small_side(told.where("stands IS NULL").select(F.col("slot").alias(h)))
        rows = slotted.join(changed, F.col(slot) == F.col(h), "left_semi").hint("rebalance", F.col(slot))
        rows.write.mode("overwrite").partitionBy(slot).parquet(f"{path}/rows/version={run}")
    made = told.select(*leaves.columns, F.coalesce("stands", F.lit(run)).alias("version"))
    made.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={run}")
    save_state(spark, f"{path}/state", version=run, root=root)
    return counts | {"gone": gone}


def read_parts(spark: SparkSession, path: str, schema: T.StructType, by: str, values: Sequence[Any] | None = None) -> DataFrame:
    """What stands at ``path``, or of it the rows with the ``values`` of ``by`` (None is NULL); only the folders of their parts are read."""
    path = path.rstrip("/")
    _, leaves = _manifest(spark, path)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    empty = spark.createDataFrame([], nullable)
    (slot,) = fresh(empty, "slot")
    if values is not None:
        wanted = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", nullable[by].dataType)]))
        leaves = leaves.join(F.broadcast(wanted.select(F.xxhash64("v").alias("slot")).distinct()), "slot", "left_semi")  # as many as the caller names
    places = [f"{path}/rows/version={r.version}/{slot}={r.slot}" for r in leaves.select("version", "slot").collect()]  # a row per folder
    if not places:
        return empty
    rows = spark.read.schema(nullable).parquet(*places)
    if values is None:
        return rows
    some = [v for v in values if v is not None]
    match = F.col(f"`{by}`").isin(some) if some else F.lit(False)
    return rows.where(match | F.col(f"`{by}`").isNull() if len(some) < len(values) else match)
