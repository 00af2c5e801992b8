"""Near-duplicate vectors by cross-polytope hashing.

Three rounds of random signs and a fast Hadamard transform rotate a vector; the largest coordinate and its sign are its hash. ``functions``
hashes make a bucket number, and each table has its own. A vector lies in its own bucket of each table and also probes the buckets
it nearly fell in. Candidates are verified by cosine in double precision on the vectors themselves.

Equal vectors of a label are one class, so copies are hashed and compared once. A bucket's vectors are compared in blocks, and blocks of a full bucket are
dealt to several tasks: no task takes a whole hot bucket, and pairs are not written out. A pair that meets in several buckets is counted in the first one alone, which
both vectors' bucket numbers tell. What leaves a block are counts per class and the links of a spanning forest.

Vectors are compared only with equal labels and dimensions. Those that are null, empty, zero, or hold null or non-finite components,
and those without label, link with nothing: n_links 0, their own component. Rows repeat as they are; equal rows link like other copies. Null ids link,
and a component's id is the least known one. Other columns are not read. An empty table gives no rows.

Chance to miss a pair at cosine 0.98: below 0.1 per table in 64 dimensions, so below 1e-6 with six tables.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.components import components
from swaplens.plans.scale import settle

PROBES, BLOCK = 4, 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width, h = len(x), x.shape[1], 1
    while h < width:
        pairs = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


def polytope_codes(x: np.ndarray, tables: int, functions: int, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """Bucket numbers of the rows of x, (rows, tables, probes): the own bucket first, then the nearest others."""
    n, dim = x.shape
    width = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    rng = np.random.default_rng([seed, width])
    near = min(3, width)
    choices = list(itertools.product(range(near), repeat=functions))
    out = np.empty((n, tables, min(probes, len(choices))), "i8")
    for t in range(tables):
        codes, gaps = [], []
        for _ in range(functions):
            y = padded
            for signs in rng.choice([-1.0, 1.0], (3, width)):
                y = hadamard(y * signs)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(y, top, 1)
            codes.append(top * 2 + (value > 0))
            gaps.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
        loss = np.stack([sum(gaps[j][:, c[j]] for j in range(functions)) for c in choices], 1)
        bucket = np.stack([sum(codes[j][:, c[j]] * (2 * width) ** j for j in range(functions)) for c in choices], 1)
        best = np.argsort(loss, axis=1, kind="stable")[:, : out.shape[2]]
        out[:, t] = np.take_along_axis(bucket, best, 1)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _hash(classes: DataFrame, tables: int, functions: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.stack(part["embedding"].to_numpy()).astype("f8").reshape(len(part), dim)
                codes = polytope_codes(_unit(x), tables, functions)
                out = part.drop(columns="embedding")
                out["vector"] = [v.tobytes() for v in x]
                out["codes"] = [c.tobytes() for c in codes]
                out["probes"] = [c.tolist() for c in codes]
                yield out

    schema = "label bigint, dim int, key string, copies bigint, vector binary, codes binary, probes array<array<bigint>>"
    return classes.select("label", "dim", "key", "copies", "embedding").mapInPandas(run, schema)


def _first_meeting(a: np.ndarray, b: np.ndarray, table: int, a_is_less: np.ndarray) -> np.ndarray:
    """Whether pairs (rows of a and b, whose row of a probes b's bucket in ``table``) have not met before: in an earlier table, or in this one by the lesser's probe."""
    forth = (a[:, : table + 1] == b[:, : table + 1, :1]).any(2)
    back = (b[:, : table + 1] == a[:, : table + 1, :1]).any(2)
    earlier = (forth[:, :table] | back[:, :table]).any(1)
    return ~earlier & (a_is_less | ~back[:, table])


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest."""
    parent, out = list(range(n)), []
    for i, j in zip(left.tolist(), right.tolist()):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[i] = j
            out.append((i, j))
    return out


def _compare(group: pd.DataFrame, tables: int, least: float) -> list[tuple]:
    """(a, b, links) rows of a block: a null b with a class' weighted links, or a link of the forest."""
    probing = np.flatnonzero(~group["home"].to_numpy())
    homes = np.flatnonzero(group["home"].to_numpy())
    if not len(probing) or not len(homes):
        return []
    keys, copies, table = group["key"].to_numpy(), group["copies"].to_numpy(), int(group["table"].iloc[0])
    x = _unit(np.stack([np.frombuffer(v, "f8") for v in group["vector"]]))
    codes = np.stack([np.frombuffer(c, "i8").reshape(tables, -1) for c in group["codes"]])
    number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    names = list(number)
    ids = np.array([number[k] for k in keys])
    weight = np.zeros(len(names), "i8")
    links: list[tuple[int, int]] = []
    for begin in range(0, len(probing), BLOCK):
        a = probing[begin : begin + BLOCK]
        i, j = np.nonzero(x[a] @ x[homes].T >= least)
        i, j = a[i], homes[j]
        other = ids[i] != ids[j]
        i, j = i[other], j[other]
        new = np.concatenate([_first_meeting(codes[i[s : s + 65536]], codes[j[s : s + 65536]], table, keys[i[s : s + 65536]] < keys[j[s : s + 65536]]) for s in range(0, max(1, len(i)), 65536)])
        i, j = i[new], j[new]
        weight += np.bincount(ids[i], copies[j], len(names)).astype("i8") + np.bincount(ids[j], copies[i], len(names)).astype("i8")
        links += _roots(len(names), ids[i], ids[j])
    forest = _roots(len(names), *np.array(links).T) if links else []
    return [(names[k], None, int(w)) for k, w in enumerate(weight) if w] + [(names[p], names[q], 0) for p, q in forest]


def class_links(classes: DataFrame, least: float, tables: int, functions: int) -> DataFrame:
    """Rows (a, b, links): per class and block the copies it links with (b null), and links that connect what all links connect."""
    hashed = settle(_hash(classes, tables, functions))
    each = hashed.select("label", "dim", "key", F.posexplode("probes").alias("table", "buckets"))
    entries = each.select("label", "dim", "key", "table", F.posexplode("buckets").alias("probe", "bucket")).withColumn("home", F.col("probe") == 0)
    place = ["label", "dim", "table", "bucket"]
    sizes = entries.groupBy(*place).agg(F.count(F.lit(1)).alias("all"), F.count_if("home").alias("homes")).where("homes > 0 AND all > 1")
    parts = sizes.select(*place, F.ceil(F.col("all") / BLOCK).cast("int").alias("sa"), F.ceil(F.col("homes") / BLOCK).cast("int").alias("sb"))
    # Every entry probes; a home is also probed. Each meets all blocks of the other side.
    sides = entries.join(parts, place).withColumn("side", F.explode(F.when(F.col("home"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    own = F.pmod(F.xxhash64("key"), F.when(F.col("side"), F.col("sb")).otherwise(F.col("sa"))).cast("int")
    others = F.when(F.col("side"), F.col("sa")).otherwise(F.col("sb"))
    dealt = sides.select(*place, "key", F.col("side").alias("home"), own.alias("own"), F.explode(F.sequence(F.lit(0), others - 1)).alias("met")).select(
        *place,
        "key",
        "home",
        F.when(F.col("home"), F.col("met")).otherwise(F.col("own")).alias("ia"),
        F.when(F.col("home"), F.col("own")).otherwise(F.col("met")).alias("ib"),
    )
    block = [*place, "ia", "ib"]
    rows = dealt.join(hashed.select("label", "dim", "key", "copies", "vector", "codes"), ["label", "dim", "key"])
    ordered = rows.withColumn("block", F.xxhash64(*block)).repartition("block").sortWithinPartitions("block", *block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not len(batch):
                continue
            whole = batch if held is None else held if batch is None else pd.concat([held, batch], ignore_index=True)
            if whole is None:
                return
            change = (whole[block].to_numpy()[1:] != whole[block].to_numpy()[:-1]).any(1)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(whole)]
            out = []
            for i, j in zip(cuts, cuts[1:] if batch is None else cuts[1:-1]):
                if j - i > 1:
                    out += _compare(whole.iloc[i:j], tables, least)
            held = whole.iloc[cuts[-2] :]
            yield pd.DataFrame(out, columns=["a", "b", "links"])

    return ordered.select(*block, "key", "home", "copies", "vector", "codes").mapInPandas(run, "a string, b string, links bigint")


def deduplicate(vectors: DataFrame, least: float = 0.98, tables: int | None = None, functions: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector; ``functions`` and ``tables`` grow with the largest label if not given."""
    e = F.col("embedding")
    sound = e.isNotNull() & F.col("label").isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.coalesce(sound & F.exists(e, lambda v: v != 0), F.lit(False))
    key = F.concat(*[F.hex(F.xxhash64(F.lit(s), "label", "embedding")) for s in (1, 2)])
    rows = settle(
        vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
        .withColumn("key", F.when(sound, key))
        .withColumn("dim", F.size("embedding"))
    )
    classes = settle(
        rows.where("key IS NOT NULL").groupBy("label", "dim", "key").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"), F.first("embedding").alias("embedding"))
    )
    if functions is None:
        most, dim = classes.groupBy("label", "dim").count().agg(F.max("count"), F.max("dim")).first()
        functions = max(2, math.ceil(math.log(max(1, (most or 1) / 64)) / math.log(2 * max(2, dim or 2))))
    found = settle(class_links(classes, least, tables or 6 + 3 * (functions - 2), functions))
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("linked"))
    comp = components(found.where("b IS NOT NULL"))
    named = classes.join(comp, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "key"))
    least_id = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    done = (
        named.join(least_id, "component")
        .join(counts, F.col("key") == F.col("a"), "left")
        .select(F.col("key").alias("c_key"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    )
    alone = F.col("key").isNull()
    out = rows.join(done, F.col("key") == F.col("c_key"), "left").select(
        "vec_id",
        F.when(alone, F.lit(0).cast("bigint")).otherwise(F.col("links")).alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).cast("bigint").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, e.b FROM reach r JOIN linked e ON e.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least
"""
