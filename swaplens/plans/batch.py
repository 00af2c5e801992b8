"""The incremental batch job: new swaps in, enriched swaps and pair summary out, state advanced."""

from __future__ import annotations

import time
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from swaplens.operators.aggregate import summarize
from swaplens.operators.enrich import enrich_swaps, run_stats
from swaplens.sources.files import read, write
from swaplens.sources.state import load_state, save_state
from swaplens.sources.swaps import after_block, within


def run_batch(
    spark: SparkSession,
    swaps: DataFrame,
    prices: DataFrame,
    out_dir: str,
    state_path: str,
    window_minutes: int | None = None,
    now: int | None = None,
    decimals: DataFrame | None = None,
    stables: DataFrame | None = None,
    top_n: int | None = None,
    swaps_format: str = "json",
    summary_format: str = "csv",
    missing: str = "skip",
    rejects: DataFrame | None = None,
) -> dict[str, Any]:
    """Process the swaps after the last processed block; returns the run's counts.

    Each run writes its own folders, named by its last block: ``swaps/run=B`` and ``summary/run=B``. State moves
    after the outputs, so a run that dies is repeated and overwrites the same folders. ``swaps`` and ``prices`` are read for the counts
    and again for the rows, so give tables that are written, not a parse; the summary reads the written rows. ``rejects`` (reason, raw) are
    counted and written to a folder of their own, ``rejects/run=B-<id>``: a run may hold nothing but rejects, or end at a block that an earlier one ended at, and
    must not replace the other's. There is no window unless ``window_minutes`` is given.
    """
    began = time.monotonic()
    last = load_state(spark, state_path)["last_processed_block"]
    if window_minutes is not None:
        if now is None:
            raise ValueError("window_minutes needs now (epoch seconds)")
        swaps = within(swaps, window_minutes, now)
    stats = run_stats(swaps, prices, last, decimals).first().asDict()
    stats["swaps_rejected"] = 0 if rejects is None else rejects.count()
    stats["seconds"] = round(time.monotonic() - began, 3)
    if stats["swaps_rejected"]:
        stats["output_rejects"] = write(rejects, f"{out_dir}/rejects/run={stats['latest_block']}-{uuid.uuid4().hex}", "json")
    if stats["swaps_new"] == 0:
        return stats
    enriched = enrich_swaps(after_block(swaps, last), prices, decimals, stables, missing)
    block = stats["latest_block"]
    written = write(enriched, f"{out_dir}/swaps/run={block}", swaps_format)
    summary = summarize(read(spark, written, swaps_format, enriched.schema), top_n)
    stats["output_swaps"] = written
    stats["output_summary"] = write(summary, f"{out_dir}/summary/run={block}", summary_format)
    if block > 0:
        save_state(spark, state_path, block=block)
    stats["seconds"] = round(time.monotonic() - began, 3)
    return stats
