"""Command line: process response pages and prices that a fetcher left as JSON files."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession

from swaplens.plans.batch import run_batch
from swaplens.plans.scale import run_dir, settle
from swaplens.sources.files import FORMATS, read
from swaplens.sources.prices import load_prices, prices_by_token, unique_tokens
from swaplens.sources.swaps import checked_pages, split_rejects


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("swaplens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    # The pages are parsed once; everything else reads what was written.
    parsed = run_dir(spark, "parsed")
    checked_pages(spark.read.text(args.pages, wholetext=not args.json_lines)).write.parquet(parsed)
    swaps, rejects = split_rejects(spark.read.parquet(parsed))
    by_id = load_prices(spark.read.text(args.prices, wholetext=not args.json_lines))
    stats = run_batch(
        spark,
        swaps,
        settle(prices_by_token(unique_tokens(swaps), by_id)),
        args.out,
        args.state,
        window_minutes=args.window_minutes,
        now=int(time.time()) if args.now is None else args.now,
        decimals=_table(spark, args.decimals, "token STRING, decimals INT"),
        stables=_table(spark, args.stables, "token STRING"),
        top_n=args.top_n,
        swaps_format=args.swaps_format,
        summary_format=args.summary_format,
        missing=args.missing,
        rejects=rejects,
    )
    print(json.dumps(stats, sort_keys=True))
    return 0


def _table(spark: SparkSession, path: str | None, schema: str) -> DataFrame | None:
    return read(spark, path, "csv", schema) if path else None


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="swaplens", description=__doc__)
    parser.add_argument("--pages", required=True, help="folder of swap response pages, one JSON object per file")
    parser.add_argument("--prices", required=True, help="folder of price responses, one JSON object per file")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--state", required=True, help="state folder")
    parser.add_argument("--window-minutes", type=int, help="only swaps of the last so many minutes; all of them if not given")
    parser.add_argument("--now", type=int, help="epoch seconds; the current time if not given")
    parser.add_argument("--top-n", type=int)
    parser.add_argument("--json-lines", action="store_true", help="pages and prices hold one JSON object per line, which splits large files")
    parser.add_argument("--decimals", help="CSV file of token, decimals")
    parser.add_argument("--stables", help="CSV file of token")
    parser.add_argument("--missing", choices=["skip", "zero"], default="skip", help="swaps without a price: skip, or count as 0")
    parser.add_argument("--swaps-format", choices=FORMATS, default="json")
    parser.add_argument("--summary-format", choices=FORMATS, default="csv")
    return parser


if __name__ == "__main__":
    raise SystemExit(main())
