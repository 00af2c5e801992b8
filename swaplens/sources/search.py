"""Text search by an index of letter groups: the rows of ``search_tokens`` without reading the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swaplens.plans.names import fresh
from swaplens.sources.prices import search_tokens

GRAM = 3
FIELDS = ("name", "symbol")
POSTINGS = "gram STRING, field STRING, part INT, row BIGINT"


def _grams(text: Column) -> Column:
    """The distinct groups of one to ``GRAM`` letters."""
    size = F.length(text)

    def of(width: int) -> Column:
        starts = F.when(size >= width, F.sequence(F.lit(1), size - (width - 1)))
        return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, F.lit(width))), F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(width) for width in range(1, GRAM + 1)]))


def write_token_index(tokens: DataFrame, path: str) -> None:
    """Write the tokens in numbered rows, and for each group of up to three letters of a lower-case name or symbol the rows that have it.

    Groups are range-partitioned with their rows and sorted, so a frequent group is cut over several files, and a search reads the row groups of its own.
    """
    spark = tokens.sparkSession
    part, row = fresh(tokens, "part", "row")
    numbered = tokens.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    numbered.write.mode("overwrite").partitionBy(part).parquet(f"{path}/rows")
    written = _rows(spark, path, tokens.schema)
    fields = [F.struct(F.lit(f).alias("field"), _grams(F.lower(f)).alias("grams")) for f in FIELDS]
    texts = written.select(F.col(part).alias("part"), F.col(row).alias("row"), F.inline(F.array(*fields)))
    postings = texts.select(F.explode("grams").alias("gram"), "field", "part", "row")
    postings.repartitionByRange("gram", "row").sortWithinPartitions("gram", "row").write.mode("overwrite").parquet(f"{path}/postings")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    part, row = fresh(empty, "part", "row")
    stored = T.StructType([T.StructField(f.name, f.dataType) for f in schema]).add(row, T.LongType()).add(part, T.IntegerType())
    return spark.read.schema(stored).parquet(f"{path}/rows")


def search_index(spark: SparkSession, path: str, schema: T.StructType, query: str) -> DataFrame:
    """The tokens whose name or symbol contains the text, in any case, as ``search_tokens`` finds them; ``schema`` is that of the tokens.

    Rows that have all letter groups of the text in one field are looked at themselves; other folders of rows are not read. A text without letters matches all
    tokens with name or symbol.
    """
    text = query.strip().lower()
    rows = _rows(spark, path, schema)
    part, row = rows.columns[-1], rows.columns[-2]
    if not text:
        return search_tokens(rows, query).drop(part, row)
    width = min(GRAM, len(text))
    grams = sorted({text[i : i + width] for i in range(len(text) - width + 1)})
    hits = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("gram").isin(grams))
    if len(grams) > 1:
        hits = hits.groupBy("field", "part", "row").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
    found, at = fresh(rows, "_part", "_row")
    hits = hits.select(F.col("part").alias(found), F.col("row").alias(at)).distinct()
    parts = [r[0] for r in hits.select(found).distinct().collect()]  # folders of rows at most
    joined = rows.where(F.col(part).isin(parts)).join(hits, (F.col(part) == F.col(found)) & (F.col(row) == F.col(at)), "left_semi")
    return search_tokens(joined, query).drop(part, row)
