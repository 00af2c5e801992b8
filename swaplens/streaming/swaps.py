"""Swap streams: incremental enrichment, windowed summary, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from swaplens.operators.aggregate import summarize_windows
from swaplens.operators.enrich import enrich_swaps
from swaplens.streaming.seen import SeenIds


def write_available(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append", fmt: str = "parquet"
) -> StreamingQuery:
    """Process what has arrived, then stop; the file sink and its checkpoint give each row once."""
    return (
        stream.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def ingest_swaps(
    swaps: DataFrame,
    prices: DataFrame,
    out_dir: str,
    checkpoint: str,
    decimals: DataFrame | None = None,
    stables: DataFrame | None = None,
    missing: str = "skip",
    seen_dir: str | None = None,
    key: str = "id",
) -> StreamingQuery:
    """Enrich newly arrived swaps; files seen before are not read again.

    Prices are looked up afresh for every micro-batch. A batch writes its own folder ``batch=N`` and a
    repeated batch overwrites it. With ``seen_dir``, a set of written ids that batches and runs share, a swap (by ``key``) is written once, however often it is
    delivered; one that was skipped for want of a price gets its chance when it is delivered again.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{out_dir}/batch={batch_id}"
        seen = None if seen_dir is None else SeenIds(spark, seen_dir, checkpoint, key)
        new = batch if seen is None else seen.new_only(batch, batch_id)
        enriched = enrich_swaps(new, prices, decimals, stables, missing)
        enriched.write.mode("overwrite").parquet(place)
        if seen is not None:
            seen.add(spark.read.schema(enriched.schema).parquet(place), batch_id)

    return (
        swaps.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_summary(
    enriched: DataFrame, ts: str = "ts", size: str = "60 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Pair summary per tumbling window, emitted once the watermark has passed the window's end."""
    return summarize_windows(enriched.withWatermark(ts, delay), ts, size)


def dedupe_stream(df: DataFrame, key: str = "id", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """The first row per key among those arriving within ``delay`` of each other."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
