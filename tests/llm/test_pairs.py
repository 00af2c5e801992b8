"""Operators on pairs: components, n-gram join, embeddings, suffix arrays; each against brute force."""

import hashlib
import math
import random
import string
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from swaplens.llm import embedding_dedup, ngram_join, suffix_dedup
from swaplens.llm.common import words
from swaplens.llm.components import components

CLASHING = ["key", "chunk", "rowkey", "hash", "size", "component", "row", "bucket", "n"]


def documents(spark, rows, clash=True):
    """(doc_id, text) rows as documents with other columns, some of them named like the operators' own."""
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)], ddl)
    return df.withColumns({c: F.lit(-7) for c in CLASHING}) if clash else df


def classes_of(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("last_edges", [0, 40, 10**6])
def test_components(spark, last_edges):
    rng = random.Random(3)
    edges = [(f"{rng.randrange(300):03}", f"{rng.randrange(300):03}") for _ in range(220)]
    edges += [(f"c{k:03}", f"c{k + 1:03}") for k in range(60)] + [("hub", f"h{k}") for k in range(100)] + [("z", "z")]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string"), last_edges).collect()}
    assert got == classes_of({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_prefix_filter_is_lossless():
    for n in range(1, 200):
        p = ngram_join.prefix_length(n, 85)
        assert 1 <= p <= n and n - p < math.ceil(0.85 * n)


def shingles(text, q):
    w = words(text)
    return {tuple(w[k : k + q]) for k in range(max(1, len(w) - q + 1))} if w else set()


def near_rows(rng, groups=12, copies=14):
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=25))
    rows = [(None, "one two three four five"), (5000, None), (5001, ""), (5002, " \t\n"), (5003, "One"), (5004, "one"), (5005, "a b c"), (5006, "A b\x0bc")]
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randrange(30, 160)) + (passage.split() if g % 3 == 0 else [])
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((1000 + 50 * g + c, " ".join(w)))
        rows += [(2000 + g, " ".join(base)), (2100 + g, "  ".join(base).upper())]
    return rows + [(1000, "repeated id, other text"), rows[20], rows[20]]


@pytest.mark.parametrize("q,percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, monkeypatch, q, percent):
    monkeypatch.setattr(ngram_join, "CHUNK_BYTES", 8192)
    rows = near_rows(random.Random(q))
    found = ngram_join.near_duplicates(documents(spark, rows), q, percent)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    sets = [shingles(t, q) for _, t in rows]
    linked = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    comp = classes_of(range(len(rows)), linked)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[k]] = min(i, least.get(comp[k], i))
    expected = sorted(((i, len(sets[k]), least.get(comp[k])) for k, (i, _) in enumerate(rows)), key=repr)
    assert got == expected
    kept = ngram_join.keep_one(documents(spark, rows), q, percent)
    assert kept.columns == documents(spark, rows).columns
    full = {(comp[k]) for k in range(len(rows)) if sets[k]}
    texts = [r for r in kept.select("doc_id", "text").collect() if words(r.text)]
    assert len(texts) == len(full) and kept.count() == len(full) + sum(not s for s in sets)


def test_keep_one_with_columns_named_like_its_own(spark):
    text = " ".join(f"w{k}" for k in range(40))
    names = ["rowkey", "own_id", "s_id", "s_key", "r_id", "r_key", "count", "group", "key", "chunk", "unknown", "_rowkey"]
    rows = [(k, text if k < 4 else f"{text} {k}", *["x"] * len(names)) for k in (3, 1, 1, 2, 9)] + [(None, None, *["y"] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.s_key) for r in kept.collect()), key=str) == [(1, "x"), (None, "y")]


def test_ngram_join_takes_few_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sc, tracker, keep = spark.sparkContext, spark.sparkContext.statusTracker(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    sc.setJobGroup("few", "few")
    try:
        assert ngram_join.near_duplicates(docs).count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = tracker.getJobIdsForGroup("few")
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    assert len(jobs) < 80 and sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i) < 200


def test_signatures_of_many_parts_take_few_files(spark, monkeypatch):
    """A file costs an executor processes of its own, and signatures are small: none per task of the scan."""
    files, plain = [], ngram_join.stored

    def noted(df, name):
        files.append((name, len((out := plain(df, name)).inputFiles())))
        return out

    monkeypatch.setattr(ngram_join, "stored", noted)
    rows = [(i, " ".join(f"w{i % 60}x{k}" for k in range(9))) for i in range(100)]
    found = ngram_join.near_duplicates(documents(spark, rows).repartition(40))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(i, i % 60) for i in range(100)]
    assert files[0][0] == "signatures" and max(n for _, n in files) < 10


def test_a_common_shingle_does_not_pair_what_is_one_component(spark):
    """A thousand near copies and one stranger that shares their rarest shingles: pairs stay far below all pairs."""
    placed = spark.createDataFrame([(f"k{k}", f"g{k}", "c0" if k else "c1") for k in range(1000)], "key string, gkey string, component string")
    entries = spark.createDataFrame([(f"g{k}", 20, 0, f"k{k}", 0, 7) for k in range(1000)], "gkey string, n int, alone int, stand string, at int, token bigint")
    pairs = ngram_join.open_pairs(placed, entries, 80)
    assert pairs.count() == 999


def test_ngram_join_of_nothing(spark):
    empty = documents(spark, [])
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def cosine(a, b):
    return float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))


@pytest.mark.parametrize("block", [8, 1024])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(15):
        base = rng.normal(size=24)
        for c in range(12):
            v = base + rng.normal(size=24) * rng.choice([0.0, 0.02, 0.1, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in v], g % 4))
    hot = rng.normal(size=24)
    rows += [(len(rows) + k, (hot + rng.normal(size=24) * 0.03).tolist(), 9) for k in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [nan] * 24, [inf] + [0.0] * 23, [None] + [1.0] * 23, [1.0, 0.0], [1.0, 0.001], [2.0] * 24, [2.0] * 24]
    rows += [(900 + k, v, 1) for k, v in enumerate(odd)] + [(950, hot.tolist(), None), (951, hot.tolist(), None), rows[3], (None, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("key", "dim", "copies", "codes")})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.deduplicate(df).collect()), key=repr)
    vectors = [None if v is None or not v or None in v else np.array(v, "f4").astype("f8") for _, v, _ in rows]
    sound = [v is not None and np.isfinite(v).all() and v.any() and rows[k][2] is not None for k, v in enumerate(vectors)]
    linked = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sound[a] and sound[b] and rows[a][2] == rows[b][2] and len(vectors[a]) == len(vectors[b]) and cosine(vectors[a], vectors[b]) >= 0.98
    ]
    comp = classes_of(range(len(rows)), linked)
    expected = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if comp[m] == comp[k] and rows[m][0] is not None]
        least = min(ids) if sound[k] and ids else i
        expected.append((i, sum(k in e for e in linked), least, i == least))
    assert got == sorted(expected, key=repr)


def test_embeddings_of_nothing(spark):
    assert embedding_dedup.deduplicate(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)), x)


def removed(rows):
    """(n_bytes, n_removed, n_spans, sha256) in the order of rows."""
    seen, out = set(), []
    for text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("chunk_bytes", [3000, 10**6])
def test_suffix_dedup(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk_bytes)
    rng = random.Random(chunk_bytes)
    passages = ["".join(rng.choices("abcdé ", k=rng.choice([99, 100, 101, 150, 400]))) for _ in range(8)]
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "ab" * 300), (6, passages[3] + passages[3])]
    for k in range(10, 70):
        parts = [rng.choice([*passages, "".join(rng.choices("abcdé ", k=rng.randrange(0, 200)))]) for _ in range(rng.randrange(1, 5))]
        rows.append((k, "".join(parts)))
    for k in range(70, 90):
        t = list(rows[20][1] + rows[21][1])
        for _ in range(3):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        rows.append((k, "".join(t)))
    rows += [(200 + k, rows[25][1]) for k in range(5)]
    shuffled = rng.sample(rows, len(rows))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(documents(spark, shuffled)).collect()}
    expected = dict(zip([i for i, _ in rows], removed([t for _, t in rows])))
    assert got == expected


@pytest.mark.parametrize("chunk_bytes,hot", [(3000, 0), (3000, 20), (10**6, 0), (10**6, 20)])
def test_hot_anchors_meet_by_window(spark, monkeypatch, tmp_path, chunk_bytes, hot):
    """A passage in most documents, each time with other text around it: the same rows, and no bucket holds more than ``hot`` contexts of an anchor."""
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk_bytes)
    rng = random.Random(5)
    passage, other = ("".join(rng.choices("abcdé ", k=n)) for n in (260, 140))
    noise = lambda n: "".join(rng.choices("abcdé ", k=rng.randrange(n)))
    rows = [(k, noise(150) + passage[rng.choice([0, 0, 30]) : rng.choice([260, 260, 200])] + noise(150)) for k in range(80)]
    rows += [(100 + k, noise(90) + passage + noise(40) + other + noise(90) + passage) for k in range(10)] + [(200, rows[7][1]), (201, "ab" * 300), (202, None)]
    docs = documents(spark, rng.sample(rows, len(rows)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, hot=hot).collect()}
    assert got == dict(zip([i for i, _ in rows], removed([t for _, t in rows])))
    cut = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS rowkey", "CAST(pmod(doc_id, 3) AS INT) AS chunk")
    suffix_dedup.whole_repeats(cut, suffix_dedup.repeated_contexts(cut, 3, hot), 3).write.parquet(str(tmp_path / "made"))
    made, grams = spark.read.parquet(str(tmp_path / "made")), {}
    for r in made.where("kind = 'border'").collect():
        place = np.frombuffer(r.places, "i8").reshape(-1, 4)
        ends = np.cumsum(np.frombuffer(r.contexts[: 2 * len(place)], "<u2").astype("i8")) + 2 * len(place)
        for end, size, left in zip(ends, np.diff(ends, prepend=2 * len(place)), place[:, 3]):
            gram = r.contexts[end - size + left : end - size + left + suffix_dedup.GRAM]
            grams[gram] = grams.get(gram, 0) + 1
    assert max(grams.values(), default=0) <= hot and made.where("kind = 'windows'").count() > 0


def test_suffix_dedup_of_odd_rows(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    got = suffix_dedup.remove_repeats(documents(spark, [(None, text), (7, text), (7, text), (8, "short")])).collect()
    assert sorted((r.doc_id or 99, r.n_removed) for r in got) == [(7, 0), (7, 300), (8, 0), (99, 300)]


def shuffle_bytes(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*"))


def test_suffix_dedup_leaves_no_shuffle_of_its_first_pass(spark):
    rng = random.Random(21)
    shared = "".join(rng.choices(string.ascii_letters, k=150))
    rows = [(k, "".join(rng.choices(string.ascii_letters, k=20_000)) + shared * (k % 3)) for k in range(100)]
    docs = documents(spark, rows).localCheckpoint()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_before = shuffle_bytes(spark), spark.conf.get(key)
    made = suffix_dedup.remove_repeats(docs)
    assert shuffle_bytes(spark) < before + 500_000 and spark.conf.get(key) == set_before
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in made.collect()}
    assert got == dict(enumerate(removed([t for _, t in rows])))


def test_waiting_texts_are_packed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 20_000)
    rng = random.Random(22)
    passage, vocabulary = "".join(rng.choices("abcdé ", k=300)), ["".join(rng.choices("abcdefgh", k=7)) for _ in range(50)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=200)) + passage + " ".join(rng.choices(vocabulary, k=200))) for k in range(30)]
    rows += [(None, rows[3][1] + "x"), (50, "")]
    cut = documents(spark, rows).selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS rowkey", "CAST(pmod(coalesce(doc_id, 0), 2) AS INT) AS chunk")
    suffix_dedup.whole_repeats(cut, suffix_dedup.repeated_contexts(cut, 2), 2).write.parquet(str(tmp_path / "made"))
    waits = spark.read.parquet(str(tmp_path / "made")).where("kind = 'waits'").collect()
    texts = {doc_id: text.decode() for r in waits for _, doc_id, text, _ in suffix_dedup._unpacked(r.text, r.places, r.contexts)}
    assert len(waits) > 2 and texts.items() <= dict(rows).items() and len(texts) > 20
    assert 2 * sum(len(r.text) for r in waits) < sum(map(len, texts.values()))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(documents(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    assert got == dict(zip([i for i, _ in order], removed([t for _, t in order])))


def test_maximal_repeats():
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab", k=60)).encode() for _ in range(40)]
    anchor = b"X" * suffix_dedup.GRAM
    lefts, rights = [t[:30][::-1] for t in texts], [anchor + t[30:] for t in texts]
    need = suffix_dedup.GRAM + 8
    found = {}
    for left, right, members in suffix_dedup.maximal_repeats(lefts, rights, need):
        for a in members:
            for b in members:
                if a < b:
                    assert lefts[a][:left] == lefts[b][:left] and rights[a][:right] == rights[b][:right] and left + right >= need
                    found.setdefault((a, b), set()).add((left, right))
    common = lambda s, t: next((k for k, (x, y) in enumerate(zip(s, t)) if x != y), min(len(s), len(t)))
    for a in range(40):
        for b in range(a + 1, 40):
            best = (common(lefts[a], lefts[b]), common(rights[a], rights[b]))
            assert (best in found.get((a, b), set())) == (sum(best) >= need)


def test_losses_alike_by_scan_and_by_levels(monkeypatch):
    rng = random.Random(11)
    lefts, rights = [], []
    anchor = "".join(rng.choices("abc", k=suffix_dedup.GRAM))
    for k in range(120):
        base = random.Random(k % 3)
        left, right = base.choices("xyz", k=68), base.choices("xyz", k=68)
        for side in (left, right):
            if rng.random() < 0.7:
                side[rng.randrange(68)] = "!"
        lefts.append("".join(left[: rng.choice([68, 68, 30])]).encode())
        rights.append((anchor + "".join(right[: rng.choice([68, 68, 50])])).encode())
    order = np.array(rng.sample(range(120), 120))
    found = []
    for wide in (2, 10**6):
        monkeypatch.setattr(suffix_dedup, "WIDE", wide)
        found.append([x.tolist() for x in suffix_dedup.losses(lefts, rights, order)])
    assert found[0] == found[1] and len(found[0][0]) > 50


def test_shingles_hold_no_words_back():
    import tracemalloc

    text = " ".join(f"w{k}" for k in range(100_000))
    tracemalloc.start()
    try:
        n = len(ngram_join.shingle_set(text, 4))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert n == 99_997 and held < 2**20
    for values in ([], [5], [2, 2, 2], [2**64 - 1, 0, 7, 0, 2**64 - 1]):
        assert ngram_join.distinct(np.array(values, np.uint64)).tolist() == sorted(set(values))
