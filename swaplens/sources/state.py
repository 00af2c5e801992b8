"""Run state: the last processed block and what else a run wants to remember."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_DDL = "version BIGINT, state STRING"


def _newest(spark: SparkSession, path: str) -> tuple[int, dict[str, Any]]:
    try:
        log = spark.read.schema(STATE_DDL).json(path)
        row = log.agg(F.max("version").alias("version"), F.max_by("state", "version").alias("state")).first()
    except AnalysisException:
        return 0, {}
    if row is None or row["version"] is None:
        return 0, {}
    try:
        state = json.loads(row["state"])
    except (TypeError, ValueError):
        return row["version"], {}
    return row["version"], state if isinstance(state, dict) else {}


def load_state(spark: SparkSession, path: str) -> dict[str, Any]:
    """The newest state; a missing or unreadable one means nothing was processed (block 0)."""
    _, state = _newest(spark, path)
    return {"last_processed_block": 0} | state


def save_state(spark: SparkSession, path: str, block: int | None = None, **values: Any) -> dict[str, Any]:
    """Merge into the stored state; ``block`` also sets last_processed_block and last_updated."""
    version, state = _newest(spark, path)
    if block is not None:
        state["last_processed_block"] = block
        state["last_updated"] = datetime.now(timezone.utc).isoformat()
    return _append(spark, path, version, state | values)


def replace_state(spark: SparkSession, path: str, state: dict[str, Any]) -> dict[str, Any]:
    """Set the whole state, forgetting keys that are not in it."""
    version, _ = _newest(spark, path)
    return _append(spark, path, version, state)


def _append(spark: SparkSession, path: str, version: int, state: dict[str, Any]) -> dict[str, Any]:
    # One small row per run is appended; overwriting in place could lose the state with a dying driver.
    text = json.dumps(state, sort_keys=True, default=str)
    row = spark.range(1).select(F.lit(version + 1).cast("bigint").alias("version"), F.lit(text).alias("state"))
    row.coalesce(1).write.mode("append").json(path)
    return state


def latest_block(swaps: DataFrame) -> DataFrame:
    """One row: the highest block, 0 when there is none."""
    return swaps.agg(F.coalesce(F.max("blockNumber"), F.lit(0)).alias("latest_block"))
