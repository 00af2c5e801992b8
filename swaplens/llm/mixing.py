"""Mixing sources to target weights by thresholds on a hash.

Every document has a 60-bit hash of its id and text. A source takes whole rounds of its documents and, for what is left of its
target, the documents below a threshold. Histograms of words by source and the hash's leading bits find the threshold: the bucket in which
the running sum meets the budget is cut by the next bits, the others are done. Nothing is sorted but bucket numbers, and thresholds
are nested: a larger target keeps what a smaller one took.

Null texts have size 0. Null sources are one source, the last. Rows with the same id, text and source share a hash and so their fate. An
empty table gives no rows; where all sizes are 0, targets are 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.llm.common import as_they_are, fresh, n_words, text_or_empty
from swaplens.plans.scale import run_dir, settle, small_side

HASH_BITS, STEP_BITS = 60, 12


def mix_hash() -> Column:
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty().cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source: source_size and target.

    Targets are min(most * size, weight * level), with the level at which they sum to ``share`` of all: where resharing the excess by
    weight ends. One row per source goes through the windows.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    capped = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "weight"
    ).over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    levels = capped.withColumn("level", level)
    meets = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level"))))
    return levels.withColumn("level", meets.over(everything)["level"]).select(
        "source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target")
    )


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: rounds, and the hash below which (or up to which, ``whole``) documents are taken once more.

    A document goes in if the words before it and half its own are within the budget, which ends nearest to it.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    bounds = wanted.withColumn("rounds", rounds.cast("bigint")).select(
        F.col("source").alias("b_source"),
        "source_size",
        "target",
        "rounds",
        (F.col("target") - F.col("rounds") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("bigint").alias("prefix"),
        F.lit(0).cast("bigint").alias("before"),
        F.lit(0).cast("bigint").alias("inside"),
    )
    keep = ["b_source", "source_size", "target", "rounds", "budget"]
    for done in range(0, HASH_BITS, STEP_BITS):
        left = HASH_BITS - done - STEP_BITS
        here = F.shiftright("hash", left + STEP_BITS) == F.col("prefix")
        hist = (
            sized.join(bounds.select("b_source", "prefix"), F.col("source").eqNullSafe(F.col("b_source")) & here)
            .groupBy("source", F.shiftright("hash", left).alias("bucket"))
            .agg(F.sum("size").alias("inside_now"))
        )
        upto = F.sum("inside_now").over(Window.partitionBy("source").orderBy("bucket"))
        sums = hist.withColumn("upto", upto).withColumnRenamed("source", "h_source")
        # The first bucket at whose end the budget is met; past the last one all documents are in.
        met = (
            bounds.join(sums, F.col("b_source").eqNullSafe(F.col("h_source")), "left")
            .groupBy(*keep, "before")
            .agg(
                F.min(F.when(F.col("before") + F.col("upto") >= F.col("budget"), F.struct("bucket", "upto", "inside_now"))).alias("edge"),
                F.max(F.struct("bucket", "upto", "inside_now")).alias("last"),
            )
        )
        edge = F.coalesce(F.col("edge"), F.col("last"))
        bounds = met.select(
            *keep,
            F.coalesce(edge["bucket"], F.lit(0).cast("bigint")).alias("prefix"),
            (F.col("before") + F.coalesce(edge["upto"] - edge["inside_now"], F.lit(0).cast("bigint"))).alias("before"),
            F.coalesce(edge["inside_now"], F.lit(0).cast("bigint")).alias("inside"),
        )
        bounds = settle(bounds)
    whole = F.col("before") + F.col("inside") / 2 <= F.col("budget")
    return bounds.select(*keep, F.col("prefix").alias("threshold"), whole.alias("whole"))


LIMITS = ("b_source", "source_size", "target", "rounds", "budget", "threshold", "whole")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(text_or_empty()).alias("size"), mix_hash().alias("hash"))


def _limits(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source what decides on its documents, under names that no table has."""
    limits = thresholds(sized, targets(sized, weights, share, most))
    return small_side(limits.select(*[F.col(c).alias(f"{c} of the mix") for c in LIMITS]))


def _taken(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """The documents as often as the limits say."""
    hashed, number = fresh(docs, "hash", "copies")
    limit = {c: F.col(f"`{c} of the mix`") for c in LIMITS}
    more = (F.col(hashed) < limit["threshold"]) | ((F.col(hashed) == limit["threshold"]) & limit["whole"])
    copies = limit["rounds"] + F.when(more & (limit["budget"] > 0), 1).otherwise(0)
    return (
        docs.withColumn(hashed, mix_hash())
        .join(limits, F.col("source").eqNullSafe(limit["b_source"]))
        .withColumn(number, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
        .select(*as_they_are(docs))
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, folder: str | None = None
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document, copies and taken words as counted in the mix that was written.

    ``weights`` repeat over the sources by code point; ``share`` of all words is dealt out; no source gets over ``most`` times its own.
    """
    folder = folder or run_dir(docs.sparkSession, "mix")
    sized = settle(_sized(docs))
    limits = _limits(sized, weights, share, most)
    _taken(docs, limits).write.option("compression", "zstd").parquet(folder)
    written = _sized(docs.sparkSession.read.schema(docs.schema).parquet(folder))
    # Rows of one id, text and source share a fate, so each has its share of what was written of them.
    key = ["doc_id", "source", "hash"]
    rows = sized.groupBy(*key).agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("words"))
    found = written.groupBy(*key).agg(F.lit(0).cast("bigint").alias("rows"), F.count("*").alias("n"), F.sum("size").alias("words"))
    counted = rows.union(found).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("rows", "n", "words")])
    counted = counted.select(*[F.col(c).alias(f"c_{c}") for c in key], (F.col("n") / F.col("rows")).cast("bigint").alias("copies"), (F.col("words") / F.col("rows")).cast("bigint").alias("taken"))
    same = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & F.col("source").eqNullSafe(F.col("c_source")) & (F.col("hash") == F.col("c_hash"))
    return (
        sized.join(counted, same)
        .join(limits, F.col("source").eqNullSafe(F.col("`b_source of the mix`")))
        .select("doc_id", "source", "size", *[F.col(f"`{c} of the mix`").alias(c) for c in ("source_size", "target")], "copies", "taken")
    )


def apply_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents of the mix, as often as it takes them, all columns as they are."""
    return _taken(docs, _limits(settle(_sized(docs)), weights, share, most))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15)) AS BIGINT) AS hash
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight,
  2.0::DOUBLE * source_size AS cap FROM per),
levels AS (SELECT *, (1.5::DOUBLE * (SELECT CAST(sum(source_size) AS DOUBLE) FROM per)
  - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
level AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
target AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM level)) AS target FROM weighed),
placed AS (SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds,
  sum(size) OVER (PARTITION BY s.source ORDER BY hash) - sum(size) OVER (PARTITION BY s.source, hash) AS before,
  sum(size) OVER (PARTITION BY s.source, hash) AS inside
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  rounds + CASE WHEN target - rounds * source_size > 0 AND before + inside / 2 <= target - rounds * source_size THEN 1 ELSE 0 END AS copies,
  CAST(size * (rounds + CASE WHEN target - rounds * source_size > 0 AND before + inside / 2 <= target - rounds * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""
