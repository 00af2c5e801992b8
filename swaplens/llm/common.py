"""What the operators share: tables, tokens, hashing and packed blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = "[ \\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of runs of other characters than space and 9 to 13."""
    return F.size(F.filter(F.split(text, WHITE), lambda w: w != "")).cast("bigint")


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased: bytes.lower and bytes.split know ASCII only, as the contract asks."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def held_out(modulus: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 0; a row without id counts as the empty text, which leaves 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == 0


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def chunks_for(size: int, target: int) -> int:
    return max(1, math.ceil(size / target))


def chunked(docs: DataFrame, columns: list[str], n: int, *keys: Column) -> DataFrame:
    """The columns and ``chunk``, one of n by the hash of the keys: a function of the row, so that every pass and every
    repeated task deals the rows alike."""
    return docs.select(*columns, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias("chunk"))


def slices(texts: list, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters together, one text at least: bounds what is split at once."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) if text else 0
        if held >= limit:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def as_they_are(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]
