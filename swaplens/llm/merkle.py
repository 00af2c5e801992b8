"""A Merkle manifest of a table: a hash tree per source, a tree over their roots, and a proof for every row.

Leaves are numbered by their place in the source, subroots by their source. A level is a table of nodes (tree, idx, digest, n: the tree's nodes on this level). Every
node computes the indices of its run's members (its own with the last bit flipped for two, slot offsets that wrap round in the run for more), an
equijoin fetches their digests, and the rows of slot zero emit the parents. A tree leaves the loop when it has one node. Levels are
written once, and shrink by the fan-out.

Paths are put together downwards: a node's path is what stands left and right of it in its run, then its parent's path. Rows meet the path of
their parent, so what crosses the network is one path per run, not one per row. Joins are on (tree, idx), which no source makes hot; places come from range
partitions with counts, so no task numbers a whole source.

A digest is the SHA-256 of the texts put together, and goes into the next one as lower-case hex. A leaf covers its columns: ``-`` for null, else byte count, colon
and value. Rows with equal id are ordered by leaf; repeated rows are leaves like others, so rows with null ids are, which come first. Null sources are a tree of their own,
the first. Other columns are not read; an empty table gives no rows and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.llm.common import LOWER, UPPER
from swaplens.plans.scale import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _hexes(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def tree_of(source: Column) -> Column:
    """A key that orders as sources do, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add idx, the place from 0 in the row's tree by ``order``, and n, the tree's rows.

    Range partitions cut a big tree, ties included, into chunks; places within a chunk are moved by the counts of the chunks before it.
    """
    row = "_row"
    chunked = stored(
        df.withColumn(row, F.monotonically_increasing_id())
        .repartitionByRange("tree", *order, row)
        .withColumn("_chunk", F.spark_partition_id()),
        "numbered",
    )
    counts = chunked.groupBy("_chunk", "tree").agg(F.count("*").alias("_count"))
    whole = Window.partitionBy("tree")
    before = counts.select(
        F.col("_chunk").alias("_at"),
        F.col("tree").alias("_tree"),
        (F.sum("_count").over(whole.orderBy("_chunk")) - F.col("_count")).alias("_before"),
        F.sum("_count").over(whole).alias("n"),
    )
    inside = Window.partitionBy("_chunk", "tree").orderBy(*order, row)
    placed = chunked.withColumn("_place", F.row_number().over(inside))
    return placed.join(before, (F.col("_chunk") == F.col("_at")) & (F.col("tree") == F.col("_tree"))).select(
        *df.columns, (F.col("_before") + F.col("_place") - 1).alias("idx"), "n"
    )


def run_indices(idx: Column, fanout: int) -> Column:
    """The indices of a node's run, its own first: by XOR for two, by slot offsets otherwise."""
    if fanout == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1)))
    slot = F.pmod(idx, F.lit(fanout))
    return F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda k: idx - slot + F.pmod(slot + k, F.lit(fanout)))


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """tree, idx, n and run, the digests of all members of the node's run in their order, for nodes of trees that go on."""
    going = nodes.where("n > 1")
    asked = going.select("tree", "idx", "n", F.explode(run_indices(F.col("idx"), fanout)).alias("sibling")).where("sibling < n")
    theirs = going.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), "digest")
    found = asked.join(theirs, (F.col("tree") == F.col("_tree")) & (F.col("sibling") == F.col("_idx")))
    members = F.sort_array(F.collect_list(F.struct("sibling", "digest")))
    return found.groupBy("tree", "idx").agg(F.first("n").alias("n"), members["digest"].alias("run"))


def parents(runs: DataFrame, fanout: int) -> DataFrame:
    """The next level's nodes, from the rows of slot zero."""
    return runs.where(F.pmod("idx", F.lit(fanout)) == 0).select(
        "tree",
        F.floor(F.col("idx") / fanout).cast("bigint").alias("idx"),
        F.unhex(F.sha2(_hexes(F.col("run")), 256)).alias("digest"),
        F.ceil(F.col("n") / fanout).cast("bigint").alias("n"),
    )


def levels(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(nodes, runs) by level; the last level holds nodes of one-node trees alone, and has no runs."""
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    most = nodes.agg(F.max("n")).first()[0] or 0
    all_nodes, all_runs = [nodes], []
    while most > 1:
        all_runs.append(stored(with_siblings(all_nodes[-1], fanout), "runs"))
        all_nodes.append(stored(parents(all_runs[-1], fanout).hint("rebalance"), "nodes"))
        most = -(-most // fanout)
    return all_nodes, all_runs


def _step(fanout: int) -> Column:
    """What stands left and right of a node in its run."""
    slot = F.pmod("idx", F.lit(fanout)).cast("int")
    return F.struct(
        _hexes(F.slice("run", F.lit(1), slot)).alias("before"), _hexes(F.slice("run", slot + 2, F.lit(fanout))).alias("behind")
    )


def _above(runs: DataFrame, paths: DataFrame, fanout: int, *more: str) -> DataFrame:
    """The rows with ``step``, their own, and the parent's path."""
    up = paths.select(F.col("tree").alias("_tree"), F.col("idx").alias("_up"), "path", *more)
    rows = runs.withColumn("step", _step(fanout)).drop("run").withColumn("_parent", F.floor(F.col("idx") / fanout).cast("bigint"))
    return rows.join(up, (F.col("tree") == F.col("_tree")) & (F.col("_parent") == F.col("_up"))).drop("_tree", "_up", "_parent")


def _one_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class Manifest:
    """``leaves`` (tree, idx, n, digest and the rows' own columns), ``root`` as hex (None without rows), and paths upwards."""

    def __init__(self, leaves: DataFrame, fanout: int = FANOUT):
        """``leaves``: tree, idx, n, digest and what else the rows should keep."""
        self.fanout, self.leaves = fanout, leaves
        nodes, self.runs = levels(leaves.select("tree", "idx", "digest", "n"), fanout)
        self.subroots = [level.where("n = 1").select("tree", "idx", "digest") for level in nodes]
        tops = _one_of(self.subroots).select(F.lit("").alias("tree"), "digest", F.col("tree").alias("of"))
        self.tops = stored(numbered(tops, ["of"]), "subroots")
        top_nodes, self.top_runs = levels(self.tops.select("tree", "idx", "digest", "n"), fanout)
        last = top_nodes[-1].first()
        self.root = None if last is None else bytes(last["digest"]).hex()

    def subroot_paths(self) -> DataFrame:
        """of (a tree), subroot and path from the subroot to the root."""
        steps = "array<struct<before:string,behind:string>>"
        paths = None
        for runs in reversed(self.top_runs):
            if paths is None:
                paths = runs.withColumn("step", _step(self.fanout)).select("tree", "idx", F.array("step").cast(steps).alias("path"))
            else:
                paths = _above(runs, paths, self.fanout).select("tree", "idx", F.concat(F.array("step"), "path").alias("path"))
        tops = self.tops.select(F.col("idx").alias("top"), F.col("of"), F.col("digest").alias("subroot"))
        if paths is None:
            return tops.select("of", "subroot", F.array().cast(steps).alias("path"))
        return tops.join(paths.select("idx", "path"), F.col("top") == F.col("idx")).select("of", "subroot", "path")

    def proofs(self) -> DataFrame:
        """The leaves with subroot (a digest) and path: per level from the leaf to the root, the hex digests before and behind it in its run."""
        ends = stored(self.subroot_paths(), "paths")

        def ended(level: int) -> DataFrame:
            """The paths of the trees that end on a level."""
            done = self.subroots[level].select("tree", "idx")
            return done.join(ends, F.col("tree") == F.col("of")).select("tree", "idx", "subroot", "path")

        paths = ended(len(self.runs))
        for level in range(len(self.runs) - 1, 0, -1):
            here = _above(self.runs[level], paths, self.fanout, "subroot").select(
                "tree", "idx", "subroot", F.concat(F.array("step"), "path").alias("path")
            )
            paths = stored(here.unionByName(ended(level)), "paths")
        kept = [c for c in self.leaves.columns if c not in ("tree", "idx", "n")]
        alone = self.leaves.where("n = 1").join(ends, F.col("tree") == F.col("of")).select(*kept, "subroot", "path")
        if not self.runs:
            return alone
        own = self.runs[0].drop("n").join(self.leaves.where("n > 1"), ["tree", "idx"])
        climbed = _above(own, paths, self.fanout, "subroot").select(*kept, "subroot", F.concat(F.array("step"), "path").alias("path"))
        return climbed.unionByName(alone)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give, as hex."""
    return F.aggregate(path, _hex(digest), lambda d, step: F.sha2(F.concat(step["before"], d, step["behind"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["behind"])), ""), 256)


def build_manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, source: str = "source", order: str = "doc_id", claims: dict[str, Column] | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of a table: leaves over ``fields``, a tree per ``source`` ordered by ``order``.

    ``claims`` are further digests by name, taken from each row in the same pass, such as those of a suspect copy's row.
    """
    claims = claims or {}
    read = rows.select(
        tree_of(F.col(source)).alias("tree"), F.col(order), leaf_digest([F.col(c) for c in fields]).alias("digest"), *[c.alias(name) for name, c in claims.items()]
    )
    # Digests are a small part of what was read: packed, they take few files, not one per task of the scan.
    return Manifest(stored(numbered(stored(read.hint("rebalance"), "leaves"), [order, "digest"]), "leaves"), fanout)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def verify_documents(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    Where 5 divides the crc32 of the id (a null id counts as the empty text) the row that is checked has its text's A-Z lower-cased; the others are checked as they are.
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    changed = [lowered(F.col("text")) if c == "text" else F.col(c) for c in FIELDS]
    manifest = build_manifest(docs, claims={"claim": F.when(crc % 5 == 0, leaf_digest(changed))}, fanout=fanout)
    folded = manifest.proofs().select(
        "doc_id",
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("claim", "digest"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
rows AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS id_text, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS tree,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
fields AS (SELECT doc_id, tree, id_text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS low_body FROM rows),
leaves AS (SELECT doc_id, tree, sha256(head || body) AS h,
    CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id_text, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, x: xor(c >> 8, t[1 + ((xor(c, x)) & 255)])), 4294967295) % 5 = 0 THEN sha256(head || low_body) ELSE sha256(head || body) END AS claim
    FROM fields, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(tree, level, idx, h, n) AS (SELECT tree, 0, idx, h, n FROM placed UNION ALL
    SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM nodes WHERE n > 1 GROUP BY tree, level, n, idx // 16),
runs AS (SELECT tree, level, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
subroots AS (SELECT tree AS of, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, idx, h, n) AS (SELECT 0, idx, h, n FROM subroots UNION ALL
    SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM tops WHERE n > 1 GROUP BY level, n, idx // 16),
top_runs AS (SELECT level, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
climb(doc_id, leaf, tree, level, idx, folded, siblings) AS (SELECT doc_id, h, tree, 0, idx, claim, '' FROM placed UNION ALL
    SELECT c.doc_id, c.leaf, c.tree, c.level + 1, c.idx // 16,
        sha256(array_to_string(list_concat(hs[:c.idx % 16], [c.folded], hs[c.idx % 16 + 2:]), '')),
        c.siblings || array_to_string(list_concat(hs[:c.idx % 16], hs[c.idx % 16 + 2:]), '')
    FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 16),
at_top AS (SELECT c.doc_id, c.leaf, s.h AS subroot, s.idx, c.folded, c.siblings FROM climb c
    JOIN nodes e ON e.tree = c.tree AND e.level = c.level AND e.n = 1 JOIN subroots s ON s.of = c.tree),
over(doc_id, leaf, subroot, level, idx, folded, siblings) AS (SELECT doc_id, leaf, subroot, 0, idx, folded, siblings FROM at_top UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.idx // 16,
        sha256(array_to_string(list_concat(hs[:c.idx % 16], [c.folded], hs[c.idx % 16 + 2:]), '')),
        c.siblings || array_to_string(list_concat(hs[:c.idx % 16], hs[c.idx % 16 + 2:]), '')
    FROM over c JOIN top_runs r ON r.level = c.level AND r.run = c.idx // 16)
SELECT o.doc_id, o.leaf, o.subroot, t.h AS root, sha256(o.siblings) AS proof_sha256, o.folded AS folded_root, o.folded = t.h AS verified
FROM over o JOIN tops t ON t.n = 1 AND t.level = o.level
"""
