"""Mixing, sharding, the pipeline, and the queries against their SQL."""

import random
import zlib

import pytest
from compare import differences, oracle
from pyspark.sql import functions as F
from test_pairs import documents

import __spark_entry__ as contract
import corpus_pipeline
from swaplens.llm import mixing, sharding
from swaplens.llm.common import table, words
from swaplens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    free, done, left = set(names), {}, share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return done | {s: left * weight[s] / total for s in free}
        done |= {s: most * sizes[s] for s in over}
        left -= sum(done[s] for s in over)
        free -= over
    return done


def mixed_rows():
    rng = random.Random(9)
    rows = [(k, " ".join(["w"] * rng.randrange(0, 60)), rng.choices(["a", "B", "é", "hot", None], [1, 2, 3, 20, 2])[0]) for k in range(1500)]
    return rows + [(None, "no id", "a"), (2000, None, "none"), (2001, "", "none"), (7, "same", "a"), (7, "same", "a"), (2002, "w " * 5000, "hot")]


def test_mix(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({c: F.lit(3) for c in ("hash", "size", "target", "copies", "bucket", "prefix")})
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = reshared(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= max([len(words(t)) for _, t, x in rows if x == s] + [0]) / 2 + 1e-6
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(df.repartition(5)).collect()), key=repr)
    out = mixing.apply_mix(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)
    assert out.groupBy().agg(F.sum(F.size(F.filter(F.split("text", " "), lambda w: w != "")))).first()[0] == sum(taken.values())


def test_mix_is_counted_from_its_documents(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(mixed_rows(), "doc_id bigint, text string, source string")
    got = mixing.mix(df, folder=str(tmp_path / "mix")).collect()
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert written.columns == df.columns
    assert sorted(map(tuple, written.collect()), key=repr) == sorted(map(tuple, mixing.apply_mix(df).collect()), key=repr)
    assert written.count() == sum(r.copies for r in got) and sum(len(words(r.text)) for r in written.collect()) == sum(r.taken for r in got)
    whole = mixing._taken
    monkeypatch.setattr(mixing, "_taken", lambda docs, limits: whole(docs, limits).where("doc_id % 2 = 0"))  # a mix that loses documents shows it
    assert all(r.copies == r.taken == 0 for r in mixing.mix(df).collect() if r.doc_id is None or r.doc_id % 2)


def test_mix_of_nothing(spark):
    empty = documents(spark, [])
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    blank = mixing.mix(documents(spark, [(1, None), (2, " ")])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0), (0.0, 0)]


def test_communication_matrix():
    counts, sizes = [5, 0, 17, 30, 8], [20, 20, 10, 10]
    matrix = sharding.communication_matrix(counts, sizes, 3)
    assert [sum(r) for r in matrix] == counts and [sum(c) for c in zip(*matrix)] == sizes
    mean = sum(sharding.communication_matrix(counts, sizes, seed)[3][0] for seed in range(400)) / 400
    assert abs(mean - 30 * 20 / 60) < 0.6


@pytest.mark.parametrize("n", [0, 1, 23, 1000])
def test_shards(spark, n):
    rows = [(k % 400 if k % 7 else None, "same" if k % 3 == 0 else f"téxt {k}" if k % 11 else None) for k in range(n)]
    df = documents(spark, rows).withColumns({c: F.lit(1) for c in ("shard", "cell", "block", "rank")})
    got = sharding.shard_rows(df, block_rows=64).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=repr
    )
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(len(slots.get(s, [])) for s in range(24)) == sorted(n // 24 + (s < n % 24) for s in range(24))
    again = sharding.shard_rows(df, block_rows=64).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_shards_hold_the_documents(spark, tmp_path):
    rows = [(k % 50 if k % 7 else None, None if k % 11 == 0 else f"téxt {k % 90}", "de" if k % 2 else None, k, f"old {k}") for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint, Shard string")
    got = sharding.write_shards(df, str(tmp_path / "out"), shards=5, block_rows=64)
    assert got.columns == [*df.columns, "_shard", "slot"]
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == sorted(rows, key=repr)
    for s in range(5):  # each folder holds its own documents, in full
        own = spark.read.parquet(str(tmp_path / "out" / f"_shard={s}"))
        assert sorted(r.slot for r in own.collect()) == list(range(140)) and own.columns == [*df.columns, "slot"]
    assert sharding.write_shards(df.limit(0), str(tmp_path / "none")).count() == 0
    digests = sharding.shard_rows(df, shards=5, block_rows=64).collect()
    expected = [(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()), r["_shard"], r.slot) for r in got.collect()]
    assert sorted(map(tuple, digests), key=repr) == sorted(expected, key=repr)


def test_shards_beside_columns_named_like_its_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "MOST_BLOCKS", 3)
    names = ["row", "k0", "k1", "k2", "block", "cell", "rank", "cut", "edges", "c_block", "c_rank", "o_shard", "o_cell", "o_before", "count", "slot", "_slot"]
    df = documents(spark, [(k, f"t{k}") for k in range(500)], clash=False).withColumns({c: F.lit(c) for c in names})
    got = sharding.write_shards(df, str(tmp_path / "out"), shards=5, block_rows=16)
    assert got.columns == [*df.columns, "shard", "__slot"] and got.schema["__slot"].dataType.simpleString() == "bigint"
    assert sorted((r.shard, r["__slot"]) for r in got.collect()) == [(s, k) for s in range(5) for k in range(100)]
    assert got.where(" OR ".join(f"`{c}` <> '{c}'" for c in names)).count() == 0 and got.select("doc_id", "text").distinct().count() == 500


CONTRACT = {
    "op1": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op2": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4": "page_id bigint, url string, text string, n_chars bigint",
    "op5": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op11": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op13": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
}


@pytest.mark.parametrize("op", list(CONTRACT))
def test_contract_columns(spark, op):
    (name,) = [q for q in QUERIES if q.startswith(f"{op}_")]
    got = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF).schema}
    assert {c.split()[0]: c.split()[1] for c in CONTRACT[op].split(", ")}.items() <= got.items()


def test_shards_are_uniform(spark):
    got = sharding.shard_rows(documents(spark, [(k, str(k)) for k in range(4800)]), shards=4, block_rows=256).collect()
    for part in range(4):  # a quarter of the ids is spread over all shards and slots
        own = [r for r in got if part * 1200 <= r.doc_id < (part + 1) * 1200]
        for shard in range(4):
            assert 240 < sum(r.shard == shard for r in own) < 360
        assert 500 < sum(r.slot for r in own) / len(own) < 700


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), oracle(SF), ORACLES[name]) == []


def test_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_pipeline(spark):
    docs = table(spark, SF, "documents").withColumn("key", F.lit("extra"))
    expected = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, expected, SF)
        if name != "token_output":
            assert out.schema == docs.schema
            assert 0 < out.count() <= 2 * expected.count()
        else:
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == expected.count()
        expected = out
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_rows_are_those_of_brute_force(spark):
    """Every stage on what its predecessor kept: all pairs for the join, SQL for the leaks, resharing for the mix, the library for the ids."""
    import duckdb
    import numpy as np
    from test_pairs import classes_of, shingles

    from swaplens.llm import decontamination, token_output, toxicity
    from swaplens.llm.common import tokenizer_path

    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)

    def kept(stage, before):
        out = stages[stage](spark, before, sf)
        out.write.parquet(path := corpus_pipeline.run_dir(spark, f"test-{stage}"))
        out = spark.read.parquet(path)
        return out, sorted(map(tuple, out.collect()), key=str)

    toxic = {r.doc_id for r in toxicity.tag_documents(docs, toxicity.learn(docs, table(spark, sf, "labels"))).collect() if r.score >= 0.5}
    clean, rows = kept("toxicity", docs)
    assert toxic and rows == sorted((tuple(r) for r in docs.collect() if r.doc_id not in toxic), key=str)

    sets = {r[0]: shingles(r[1], 5) for r in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = classes_of(sets, linked)
    expected = [r for r in rows if comp[r[0]] == r[0]]
    single, rows = kept("ngram_join", clean)
    assert linked and rows == expected

    con = duckdb.connect()
    con.register("documents", single.toArrow())
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{sf}/benchmark.parquet'")
    leaks = {r[0] for r in con.sql(f"SELECT DISTINCT doc_id FROM ({decontamination.ORACLE})").fetchall()}
    expected = [r for r in rows if r[0] not in leaks]
    apart, rows = kept("decontamination", single)
    assert leaks and rows == expected

    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    target, longest = reshared(sizes), {s: max(len(words(r[1])) for r in rows if r[3] == s) for s in sizes}
    before, (mixed, rows) = {r[0]: r for r in rows}, kept("mixing", apart)
    copies = {i: [r for r in rows if r[0] == i] for i in before}
    assert all(len(same) <= 2 and all(r == before[i] for r in same) for i, same in copies.items()) and sum(map(len, copies.values())) == len(rows)
    for source in sizes:
        assert abs(sum(len(words(r[1])) for r in rows if r[3] == source) - target[source]) <= longest[source] / 2 + 1e-6

    library = token_output.WordEncoder(tokenizer_path()).tokenizer
    at, expected = 0, []
    for r in sorted(rows, key=lambda r: r[0]):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        expected.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert kept("token_output", mixed)[1] == sorted(expected, key=str)
