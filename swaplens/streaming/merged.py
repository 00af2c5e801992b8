"""Windows and sessions that late rows still reach.

A micro-batch keeps partial aggregates of its own rows, and what stands is merged from all of them, so no watermark decides what is dropped: a row counts however late
it comes. Rows without a time belong nowhere; they go to a folder of their own. The partial aggregates of batch N lie in folders that a repeated batch
overwrites. A state folder belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from swaplens.operators.aggregate import merged_window_sums, window_sums
from swaplens.operators.ordered import feed_sessions, merged_sessions

DAY = 86_400


def _each_batch(rows: DataFrame, step: Callable[[DataFrame, int], None], ts: str, untimed_dir: str, checkpoint: str) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        batch.where(F.col(ts).isNull()).write.mode("overwrite").parquet(f"{untimed_dir}/batch={batch_id}")
        step(batch.where(F.col(ts).isNotNull()), batch_id)
        batch.unpersist()

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def live_windowed_summary(
    enriched: DataFrame, out_dir: str, state_dir: str, checkpoint: str, ts: str = "ts", size: str = "60 minutes", span: int = DAY, untimed_dir: str | None = None
) -> StreamingQuery:
    """The pair summary of every tumbling window that a micro-batch has rows for, as it stands after the batch, to ``out_dir/batch=N``.

    ``corrected`` tells a window and pair that an earlier batch has given already. Partial sums lie in folders by window start, ``span`` seconds each, and a batch reads
    those of its own windows only. Rows without ``ts`` go to ``untimed_dir`` (``out_dir`` with ``-untimed`` if not given). Totals do not depend on the
    batches if ``usdVolume`` is a decimal.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = window_sums(batch, ts, size)
        own = own.withColumns({"span": F.floor(F.unix_seconds("window_start") / span).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")})
        schema = _nullable(own.schema)
        own = own.hint("rebalance", "span").persist()
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("span", "batch").parquet(state_dir)
        touched = [r.span for r in own.select("span").distinct().collect()]  # a row per span of time
        own.unpersist()
        paths = [f"{state_dir.rstrip('/')}/span={n}" for n in touched]
        parts = spark.read.schema(schema).option("basePath", state_dir).parquet(*paths) if paths else spark.createDataFrame([], schema)
        parts = parts.where(F.col("batch") <= batch_id)
        merged = merged_window_sums(parts, F.max("batch").alias("_last"), (F.min("batch") < batch_id).alias("corrected"))
        merged.where(F.col("_last") == batch_id).drop("_last").write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return _each_batch(enriched, step, ts, untimed_dir or f"{out_dir}-untimed", checkpoint)


def newest_windows(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every window and pair as ``live_windowed_summary`` gave it last: ``summarize_windows`` over all rows so far."""
    rows = spark.read.parquet(out_dir)
    columns = [c for c in rows.columns if c not in ("batch", "corrected")]
    newest = rows.groupBy("window_start", "pair").agg(F.max_by(F.struct(*columns), "batch").alias("_newest"))
    return newest.select("_newest.*")


def live_feed_sessions(
    ticks: DataFrame, state_dir: str, checkpoint: str, seconds: int = 60, ts: str = "ts", untimed_dir: str | None = None
) -> StreamingQuery:
    """Keep each micro-batch's own sessions, a row per session and batch, for ``sessions_so_far``; rows without ``ts`` go to ``untimed_dir`` (``state_dir`` with ``-untimed``)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        feed_sessions(batch, seconds, ts).write.mode("overwrite").parquet(f"{state_dir}/batch={batch_id}")

    return _each_batch(ticks, step, ts, untimed_dir or f"{state_dir}-untimed", checkpoint)


def sessions_so_far(spark: SparkSession, state_dir: str) -> DataFrame:
    """``feed_sessions`` over all ticks that ``live_feed_sessions`` has seen: a late tick lengthens a session, or makes one of two."""
    return merged_sessions(spark.read.parquet(state_dir).drop("batch"))
