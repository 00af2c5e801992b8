"""Jaccard join of documents on word shingles, by groups of equal prefixes.

Documents with the same shingle set are one class; classes are joined. A class' shingles are ordered by the number of classes that have them
(rare ones first, ties by hash). Two sets can only reach the threshold if they share a shingle of their prefixes, the
first n - ceil(t n) + 1. Classes with equal size and prefix form a group; groups meet by shared prefix shingles, are filtered by
size and position, and only then expanded to members, whose whole sets are compared.

Components need a spanning set of links, not all of them, so groups of copies are not expanded into pairs: two rounds compare each class with one
leader of the groups it meets, and the exact round that follows compares all remaining candidates whose components still differ. There components meet first, once per
token, so what is one component already is never paired, however common its shingles.

Shingle counts travel packed: a chunk of documents sends one sorted block per hash range and gets one byte per shingle back. Sets
stay where their documents are until a candidate needs them. A hot group sends one entry per class and shingle, whatever its copies.

Words are runs of other characters than space and 9 to 13, A-Z lower-cased; documents with fewer than ``q`` words have one shingle of them all;
null, empty and blank texts have none and link with nothing. Rows with equal id and text are one document. Rows without id take part, and their
component is the least id that is known, or null. Other columns are not read; an empty table gives no rows. Shingles are 64-bit hashes, whole sets are compared by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.common import as_they_are, chunks_for, fresh, text_bytes, words
from swaplens.llm.components import components
from swaplens.plans.scale import stored

CHUNK_BYTES, BUCKET_BYTES = 8 * 2**20, 32 * 2**20  # of text, whose shingles a task sends and a task counts
LEADER_ROUNDS = 2


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values. A plain sort takes an eighth of np.unique's time for 64-bit numbers."""
    out = np.sort(values)
    first = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=first[1:])
    return out[first]


def shingle_set(text: str | None, q: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text. Words are hashed each time: in a table of a corpus' words a look-up takes longer, and every worker holds one."""
    tokens = words(text)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(q, len(h))
    if not width:
        return h
    out = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return distinct(out)


def prefix_length(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1


def _texts(batch: pd.DataFrame) -> list:
    return [t if isinstance(t, str) else None for t in batch["text"]]


def signatures(rows: DataFrame, q: int) -> DataFrame:
    """doc_id, rowkey, chunk, n_shingles and the 128-bit key of the set (null for an empty one) of every row."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns="text")
            sets = (shingle_set(t, q) for t in _texts(batch))
            made = [(len(s), xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None) for s in sets]
            out["n_shingles"] = [n for n, _ in made]
            out["key"] = [k for _, k in made]
            yield out

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(sign, f"doc_id {kind}, rowkey bigint, chunk int, n_shingles bigint, key string", )


def _class_sets(docs: pd.DataFrame, side: pd.DataFrame, q: int) -> dict[str, np.ndarray]:
    """The sets of the classes that a row of this chunk stands for."""
    wanted = set()
    for keys in side.loc[side["bucket"] < 0, "rows"]:
        wanted.update(keys)
    out = {}
    for rowkey, text in zip(docs["rowkey"], _texts(docs)):
        if rowkey in wanted:
            s = shingle_set(text, q)
            out.setdefault(xxhash.xxh3_128_hexdigest(s.tobytes()), s)
    return out


def _packed(sets: list[np.ndarray], buckets: int) -> np.ndarray:
    """Bucket and low half of each shingle hash, in one number that sorts by both."""
    h = np.concatenate([np.empty(0, np.uint64), *sets])
    return ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def shared_shingles(rows: DataFrame, stand_ins: DataFrame, q: int, buckets: int) -> DataFrame:
    """Per chunk and bucket one byte for each distinct shingle: 0 if no other class has it, else by the logarithm of how many do."""

    def send(docs: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        packed = np.sort(_packed(list(_class_sets(docs, side, q).values()), buckets))
        cuts = np.searchsorted(packed, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        blocks = [(b, packed[i:j].astype("<u4").tobytes()) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        chunk = docs["chunk"].iloc[0] if len(docs) else 0
        return pd.DataFrame({"chunk": chunk, "bucket": [b for b, _ in blocks], "block": [x for _, x in blocks]})

    def count(part: pd.DataFrame) -> pd.DataFrame:
        blocks = [np.frombuffer(x, "<u4") for x in part["block"]]
        values, counts = np.unique(np.concatenate(blocks), return_counts=True)
        level = np.where(counts > 1, np.minimum(255, 1 + 8 * np.log2(counts)), 0).astype("u1")
        out = part[["chunk", "bucket"]].copy()
        out["block"] = [level[np.searchsorted(values, distinct(x))].tobytes() for x in blocks]
        return out

    schema = "chunk int, bucket int, block binary"
    sent = rows.groupBy("chunk").cogroup(stand_ins.groupBy("chunk")).applyInPandas(send, schema)
    return sent.groupBy("bucket").applyInPandas(count, schema)


MEMBER = "key string, n int, alone int, gkey string, tokens array<bigint>, shingles binary"


def candidates(rows: DataFrame, side: DataFrame, q: int, percent: int, buckets: int) -> DataFrame:
    """The classes with a shared shingle in their prefix: key, size, number of unshared shingles, group, the shared prefix shingles, the set."""

    def select(docs: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        classes = _class_sets(docs, side, q)
        sets = list(classes.values())
        answers = side[side["bucket"] >= 0].sort_values("bucket")["block"]
        level = np.frombuffer(b"".join(answers), "u1")
        _, where = np.unique(_packed(sets, buckets), return_inverse=True)
        out, at = [], 0
        for key, s in classes.items():
            lv = level[where[at : at + len(s)]]
            at += len(s)
            alone = int((lv == 0).sum())
            p = prefix_length(len(s), percent)
            if alone < p:
                prefix = s[np.argsort(lv, kind="stable")[:p]]  # ties by hash: the set is sorted
                group = xxhash.xxh3_128_hexdigest(np.append(prefix, np.uint64(len(s))).tobytes())
                out.append((key, len(s), alone, group, prefix[alone:].astype("i8"), s.tobytes()))
        return pd.DataFrame(out, columns=["key", "n", "alone", "gkey", "tokens", "shingles"])

    return rows.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInPandas(select, MEMBER)


def verify(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The components (a, b) of the pairs (x, y) of class keys whose whole sets reach the threshold."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x_set"], batch["y_set"]):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.loc[keep, ["a", "b"]]

    sets = members.select("key", "shingles")
    left = sets.select(F.col("key").alias("x"), F.col("shingles").alias("x_set"))
    right = sets.select(F.col("key").alias("y"), F.col("shingles").alias("y_set"))
    found = pairs.join(right, "y").join(left, "x").select("a", "b", "x_set", "y_set").mapInPandas(check, "a string, b string")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _close(percent: int):
    """The size filter on n and m."""
    return (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)


def led_pairs(placed: DataFrame, entries: DataFrame, percent: int, salt: int) -> DataFrame:
    """Each class with one leader of the groups that its own meets, and with the stand-in of its group: (x, y) of keys, (a, b) of their components."""
    by_group = placed.groupBy("gkey").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    here = entries.join(by_group, "gkey")
    order = F.struct(F.xxhash64(F.lit(salt), "gkey"), "n", "gkey", "stand", "low") if salt else F.struct("alone", "n", "gkey", "stand", "low")
    open_tokens = (
        here.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.min(order).alias("lead")).where("least <> most")
    )
    led = here.join(open_tokens.select("token", "lead"), "token").select(
        "gkey", "n", F.col("lead.gkey").alias("lead_gkey"), F.col("lead.n").alias("m"), F.col("lead.stand").alias("lead"), F.col("lead.low").alias("lead_low")
    )
    votes = led.where((F.col("gkey") != F.col("lead_gkey")) & _close(percent)).groupBy("gkey", "lead", "lead_low").count()
    chosen = votes.groupBy("gkey").agg(F.max(F.struct("count", "lead", "lead_low")).alias("best")).select("gkey", "best.lead", "best.lead_low")
    across = placed.join(chosen, "gkey").select(F.col("key").alias("x"), F.col("lead").alias("y"), F.col("component").alias("a"), F.col("lead_low").alias("b"))
    # A group's stand-in is its least key; its component comes with it.
    first = placed.groupBy("gkey").agg(F.min(F.struct("key", "component")).alias("stand"))
    inside = placed.join(first, "gkey").select(F.col("key").alias("x"), F.col("stand.key").alias("y"), F.col("component").alias("a"), F.col("stand.component").alias("b"))
    return across.union(inside).where("a <> b")


def open_pairs(placed: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """All candidates (x, y) whose components (a, b) still differ: components meet by token or group first, and only those that differ are expanded to groups and members."""
    spread = placed.select("gkey", "component").distinct()
    here = entries.join(spread, "gkey").select("token", "component", "gkey", "n", "at")
    # What a component can reach at best by a token: its sizes, and how many shingles follow.
    of_token = here.groupBy("token", "component").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("at")).alias("room"), F.count("*").alias("many")
    )
    a = of_token.withColumnRenamed("component", "a")
    b = of_token.select("token", *[F.col(c).alias(f"{c}_b") for c in ("lo", "hi", "room", "many")], F.col("component").alias("b"))
    near = (F.col("hi") * 100 >= F.col("lo_b") * percent) & (F.col("hi_b") * 100 >= F.col("lo") * percent)
    enough = F.least("room", "room_b") >= F.ceil((F.col("lo") + F.col("lo_b")) * F.lit(percent) / F.lit(100 + percent))
    met = a.alias("l").join(b.alias("r"), (F.col("l.token") == F.col("r.token")) & (F.col("a") < F.col("b")) & near & enough)
    # The component with fewer groups is expanded first, the other under the filters.
    few = F.col("many") <= F.col("many_b")
    met = met.select("l.token", F.when(few, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(few, F.col("b")).otherwise(F.col("a")).alias("b"))
    mine = here.select("token", F.col("component").alias("a"), "gkey", "n", "at")
    other = here.select(F.col("token").alias("t"), F.col("component").alias("c"), F.col("gkey").alias("hkey"), F.col("n").alias("m"), F.col("at").alias("bt"))
    need = F.ceil((F.col("n") + F.col("m")) * F.lit(percent) / F.lit(100 + percent))
    reach = 1 + F.least(F.col("n") - F.col("at") - 1, F.col("m") - F.col("bt") - 1)
    fits = (F.col("gkey") != F.col("hkey")) & _close(percent) & (reach >= need)
    groups = met.join(mine, ["token", "a"]).join(other, (F.col("token") == F.col("t")) & (F.col("b") == F.col("c")) & fits).select("gkey", "a", "hkey", "b")
    g, h = spread.select("gkey", F.col("component").alias("a")), spread.select(F.col("gkey").alias("hkey"), F.col("component").alias("b"))
    same = g.join(h, F.col("gkey") == F.col("hkey")).where("a < b")
    x = placed.select("gkey", F.col("component").alias("a"), F.col("key").alias("x"))
    y = placed.select(F.col("gkey").alias("hkey"), F.col("component").alias("b"), F.col("key").alias("y"))
    return groups.union(same.select("gkey", "a", "hkey", "b")).distinct().join(x, ["gkey", "a"]).join(y, ["hkey", "b"]).select("x", "y", "a", "b")


def connect(members: DataFrame, percent: int) -> DataFrame:
    """node (a class key) and component of every member, as all links connect them."""
    groups = members.groupBy("gkey").agg(
        F.first("n").alias("n"), F.min("alone").alias("alone"), F.min("key").alias("stand"), F.first("tokens").alias("tokens")
    )
    entries = stored(
        groups.select("gkey", "n", "alone", "stand", F.posexplode("tokens").alias("at", "token")).withColumn("at", F.col("at") + F.col("alone")), "entries"
    )
    placed = members.select("key", "gkey", F.col("key").alias("component"))
    for salt in [*range(LEADER_ROUNDS), None]:
        pairs = open_pairs(placed, entries, percent) if salt is None else led_pairs(placed, entries, percent, salt)
        new = stored(verify(pairs, members, percent).distinct(), "links")
        if new.isEmpty():
            continue
        joined = components(new).select(F.col("node").alias("old"), F.col("component").alias("joined"))
        placed = placed.join(joined, F.col("component") == F.col("old"), "left")
        placed = stored(placed.select("key", "gkey", F.coalesce("joined", "component").alias("component")), "placed")
    return placed.select(F.col("key").alias("node"), "component")


def near_duplicates(docs: DataFrame, q: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, rowkey, n_shingles, group (null for an empty set) and component_id (the least doc_id that links reach) of every document.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``q``-word shingles.
    """
    size = text_bytes(docs)
    n, buckets = chunks_for(size, CHUNK_BYTES), chunks_for(size, BUCKET_BYTES)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rowkey")).withColumn("chunk", F.pmod("rowkey", F.lit(n)).cast("int"))
    # Signatures are a small part of what was read: packed, they take few files, not one per task of the scan.
    signed = stored(signatures(rows, q).hint("rebalance"), "signatures")
    first = signed.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "rowkey", "chunk")).alias("row")).select("row.*")
    stand_ins = stored(
        first.groupBy("chunk").agg(F.collect_list("rowkey").alias("rows")).select(
            "chunk", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("block"), "rows"
        ),
        "stand-ins",
    )
    answers = shared_shingles(rows, stand_ins, q, buckets).withColumn("rows", F.lit(None).cast("array<bigint>"))
    members = stored(candidates(rows, answers.union(stand_ins), q, percent, buckets), "members")
    found = connect(members, percent)
    least = (
        found.join(signed.groupBy("key").agg(F.min("doc_id").alias("id")), F.col("node") == F.col("key"))
        .groupBy("component")
        .agg(F.min("id").alias("component_id"))
    )
    by_key = found.join(least, "component").select(F.col("node").alias("n_key"), "component", "component_id")
    alone = signed.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("class_id"))
    of_class = alone.join(by_key, F.col("key") == F.col("n_key"), "left").select(
        F.col("key").alias("c_key"), F.coalesce("component", "key").alias("group"), F.coalesce("component_id", "class_id").alias("component_id")
    )
    return signed.join(of_class, F.col("key") == F.col("c_key"), "left").select(
        "doc_id", "rowkey", "n_shingles", "group", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, q: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of linked ones, that of the least id, all columns as they are; documents without words all stay."""
    rowkey, own_id, s_id, s_key, count = fresh(docs, "rowkey", "own_id", "s_id", "s_key", "count")
    found = stored(near_duplicates(docs, q, percent), "near")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rowkey")
    grouped = found.where("group IS NOT NULL")
    stay = grouped.groupBy("group").agg(F.min(order).alias("row")).select(F.col("row.doc_id").alias(s_id), F.col("row.rowkey").alias(s_key))
    stay = stay.union(found.where("group IS NULL").select("doc_id", "rowkey").distinct())
    repeated = grouped.groupBy(F.col("doc_id").alias(s_id), F.col("rowkey").alias(s_key)).agg(F.count("*").alias(count)).where(F.col(count) > 1)
    repeated = stored(repeated.drop(count), "repeated")
    keyed = docs.withColumn(rowkey, F.xxhash64("doc_id", "text")).withColumn(own_id, F.col("doc_id"))
    same = (F.col(rowkey) == F.col(s_key)) & F.col(own_id).eqNullSafe(F.col(s_id))
    kept = keyed.join(stay, same, "left_semi")
    if not repeated.isEmpty():
        kept = kept.join(repeated, same, "left_anti").union(kept.join(repeated, same, "left_semi").dropDuplicates([own_id, rowkey]))
    return kept.select(*as_they_are(docs))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' '))) END AS s FROM w),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
linked AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes r ON r.doc_id = b WHERE 100 * shared >= 85 * (p.n + r.n - shared)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""
