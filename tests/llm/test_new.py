"""Collocations, language identification and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from swaplens.llm import collocation, language_id, merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, idx string"


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns that clash with the operators' own."""
    full = [(i, t, lang, source, None if t is None else len(t), "x", "y") for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOCS)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


# Collocations


def brute_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    out = {}
    for (lang, phrase), a in candidates.items():
        if any(
            x == lang and len(p) > len(phrase) and 100 * b >= 100 * a and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))
            for (x, p), b in candidates.items()
        ):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, r = f[lang, phrase[:k]], f[lang, phrase[k:]]
            cuts.append((1000 * a * n[lang] // (left * r), k, left, r))
        score, _, left, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, r))
    return sorted(
        (
            (lang, i + 1, phrase.decode(), -a, left, r, n[lang], -score)
            for lang, found in out.items()
            for i, (score, a, phrase, left, r) in enumerate(sorted(found)[:top])
        ),
        key=str,
    )


def phrase_rows(seed, docs=120):
    rng = random.Random(seed)
    vocabulary = ["Red", "é", "fox", "Ox", "a\xa0b", "|", "é,ox", "fox\r\nred", "ox.", "im  x"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))), rng.choice(["en", "de", None, "und"]), "s") for i in range(docs)]
    rows += [(500 + i, "one two three four five six", "en", "s") for i in range(7)]  # equal counts: only the longest stay
    rows += [(600, "solo bird " * 30, "fr", "s"), (601, None, "en", "s"), (602, "", "en", "s"), (None, "Red fox", "en", "s"), (603, " \t ", "it", "s")]
    return rows + rows[:5]


@pytest.mark.parametrize("sample", [1, 4, 64])
def test_collocations_are_those_of_brute_force_whatever_the_sample_holds(spark, sample):
    rows = phrase_rows(sample)
    got = collocation.collocations(documents(spark, rows), least=6, top=40, sample=sample)
    assert tuples(got) == brute_collocations(rows, 6, 40)


def test_an_empty_sample_is_made_good_by_further_passes(spark, monkeypatch):
    rows = phrase_rows(3)
    docs = documents(spark, rows)
    monkeypatch.setattr(collocation, "block_sample", lambda texts, of: texts.select("lang", "text").limit(0))
    phrases, totals, passes = collocation.frequent_phrases(docs, 6)
    assert passes > 1
    assert tuples(collocation.best_collocations(phrases, totals, 40)) == brute_collocations(rows, 6, 40)


def test_a_full_filter_counts_more_and_finds_the_same(spark, monkeypatch):
    rows = phrase_rows(4)
    monkeypatch.setattr(collocation, "with_keys", lambda before, failures: np.full_like(before, 0xFF))
    assert tuples(collocation.collocations(documents(spark, rows), least=6, top=40)) == brute_collocations(rows, 6, 40)


def test_a_half_full_filter_finds_the_same(spark, monkeypatch):
    rows, real = phrase_rows(5), collocation.with_keys

    def noisy(before, failures):
        return real(before, failures) | np.random.default_rng(len(rows)).integers(0, 256, len(before), "u1")

    monkeypatch.setattr(collocation, "with_keys", noisy)
    assert tuples(collocation.collocations(documents(spark, rows), least=6, top=40)) == brute_collocations(rows, 6, 40)


def test_two_phrases_of_one_hash_are_counted_apart(spark, monkeypatch):
    texts = [b"a b c. a b. b a"]
    monkeypatch.setattr(collocation, "_longer", lambda h, word: np.zeros(len(h), "u8"))
    everything = collocation.Bloom(np.full(collocation.MIN_BITS // 8, 0xFF, "u1"))
    found = [(p, int(a)) for _, _, phrases, counts, _ in collocation.Counter("en", None, everything).count(texts) for p, a in zip(phrases.to_pylist(), counts)]
    assert sorted(found) == [("a", 3), ("a b", 2), ("a b c", 1), ("b", 3), ("b a", 1), ("b c", 1), ("c", 1)]


def test_equal_hashes_of_all_phrases_do_no_harm(spark, monkeypatch):
    rows = phrase_rows(8)
    monkeypatch.setattr(collocation, "_mixed", lambda h: h * np.uint64(0) + np.uint64(1 << 40))
    assert tuples(collocation.collocations(documents(spark, rows), least=6, top=40)) == brute_collocations(rows, 6, 40)


def test_long_texts_are_cut_where_pieces_end(spark, monkeypatch):
    text = b"red fox ran, " * 50 + b"red fox " * 40 + b"; ox"
    parts = list(collocation.in_parts(text, 64))
    assert b"".join(parts) == text.translate(collocation._MARKS) and max(map(len, parts)) < 360
    rows = phrase_rows(6, 20) + [(700, text.decode(), "en", "s")]
    monkeypatch.setattr(collocation, "SLICE_BYTES", 64)
    assert tuples(collocation.collocations(documents(spark, rows), least=6, top=40)) == brute_collocations(rows, 6, 40)


def test_scores_pass_64_bits(spark):
    big = 4 * 10**12
    phrases = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7)], "lang string, words int, phrase string, a bigint")
    totals = spark.createDataFrame([("en", 9 * 10**14 + 3)], "lang string, n bigint")
    (row,) = collocation.best_collocations(phrases, totals).collect()
    assert row["score"] == 1000 * (big - 7) * (9 * 10**14 + 3) // (big * (big + 1))


def test_no_documents_no_collocations(spark):
    assert collocation.collocations(documents(spark, [])).collect() == []


# Language identification

SYLLABLES = {"aa": ["ka", "to", "mi", "ne"], "bb": ["sch", "ung", "ver", "ß"], "cc": ["é", "oi", "eau", "ç"]}


def spoken(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(words))


def labelled(n=240, seed=5):
    rng = random.Random(seed)
    langs = rng.choices(list(SYLLABLES), k=n)
    return [(i, spoken(rng, lang, rng.randint(5, 80)), lang, "s") for i, lang in enumerate(langs)]


def test_languages_are_recognised_in_rows_that_were_not_learned(spark):
    rng = random.Random(9)
    rows = labelled()
    odd = [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 + 3 = 15!", "bb", "s"), (1003, spoken(rng, "bb", 20000), None, "s"), (None, "eau oi", None, "s"), (1004, "ß", None, "s")]
    got = {r["doc_id"]: r for r in language_id.identify(documents(spark, rows + odd)).collect()}
    for i, _, lang, _ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i]["score"] <= 1
    held = [(lang, got[i]["lang_pred"]) for i, _, lang, _ in rows if got[i]["held_out"]]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003]["lang_pred"] == "bb" and got[1004]["lang_pred"] in SYLLABLES and got[None]["lang_pred"] in SYLLABLES


def test_what_a_prediction_reads_and_learns_from(spark):
    rows = labelled(160)
    told = {tuple(r) for r in language_id.identify(documents(spark, rows)).collect()}
    # Labels of held-out rows change nothing, sources neither.
    other = [(i, t, "aa" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other") for i, t, lang, _ in rows]
    assert {tuple(r) for r in language_id.identify(documents(spark, other)).collect()} == told


def test_without_labels_or_rows(spark):
    assert [r["lang_pred"] for r in language_id.identify(documents(spark, [(1, "some text", None, "s")])).collect()] == ["und"]
    assert language_id.identify(documents(spark, [])).collect() == []


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 10)
    monkeypatch.setattr(language_id, "MAX_LANGS", 2)
    counts = Counter(r["lang"] for r in language_id.sample(documents(spark, labelled(400))).collect())
    assert len(counts) == 2 and max(counts.values()) <= 10 and min(counts.values()) >= 5


def test_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    net = language_id.Network.fresh(["a", "b", "c"], rng)
    net.w = {k: v.astype("f8") for k, v in net.w.items()}
    net.w["bias"] += 0.05
    x = language_id.as_matrix(rng.integers(97, 123, 4 * language_id.WINDOW).astype("u1").tobytes())
    y = np.array([0, 1, 2, 1])

    def loss():
        return -net.head(net.answers(x).max(1))[1][np.arange(4), y].mean()

    for name, gradient in net.gradients(x, y).items():
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in net.w[name].shape)
            if name == "bank" and not net.mask()[at]:
                assert gradient[at] == 0
                continue
            keep = net.w[name][at]
            net.w[name][at] = keep + 1e-6
            up = loss()
            net.w[name][at] = keep - 1e-6
            down = loss()
            net.w[name][at] = keep
            assert abs((up - down) / 2e-6 - gradient[at]) < 1e-5


def test_windows_are_judged_alike_in_any_batch():
    net = language_id.fit([spoken(random.Random(i), lang, 30) for i in range(20) for lang in SYLLABLES], [lang for _ in range(20) for lang in SYLLABLES])
    again = language_id.Network.unpacked(net.langs, net.packed())
    texts = [spoken(random.Random(i), lang, 900 * (i + 1)).encode() for i, lang in enumerate(SYLLABLES)]
    together = language_id.judge(again, texts)
    assert [x for x, _ in together] == list(SYLLABLES)
    for text, (lang, score) in zip(texts, together):
        ((one, alone),) = language_id.judge(again, [text])
        assert one == lang and abs(alone - score) < 1e-5


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    i, _, lang, source = row
    values = [i, source, lang, None if row[1] is None else len(row[1]), text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(hashes, fanout):
    """Levels of a tree, from the leaves to the one node."""
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def brute_proof(tree, i, fanout):
    path = []
    for level in tree[:-1]:
        run = i // fanout * fanout
        path.append((level[run:i], level[i + 1 : run + fanout]))
        i //= fanout
    return path


def brute_verify(rows, fanout):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = [(r, brute_leaf(r, r[1])) for r in rows if r[3] == s]
        mine.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = (mine, brute_tree([h for _, h in mine], fanout))
    top = brute_tree([trees[s][1][-1][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        mine, tree = trees[s]
        for i, (row, leaf) in enumerate(mine):
            path = brute_proof(tree, i, fanout) + brute_proof(top, k, fanout)
            text = row[1]
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0 and text:
                text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
            folded = brute_leaf(row, text)
            for before, behind in path:
                folded = sha(*before, folded, *behind)
            out.append((row[0], leaf, tree[-1][0], top[-1][0], sha(*[h for a, b in path for h in a + b]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest_is_that_of_a_plain_tree(spark, fanout):
    rng = random.Random(fanout)
    names = ["hot"] * 20 + [f"s{i}" for i in range(20)] + [None, "", "é", "Z", "\U0001f600", "￮"]
    rows = [(i, rng.choice([f"Text {i} É", "low", "", None, "CAPS ÀÉ"]), rng.choice(["en", None]), rng.choice(names)) for i in range(400)]
    rows += [(7, "Twice", "en", "hot")] * 3 + [(None, "No id", "en", "hot"), (None, None, None, "hot"), (7, "Other", "en", "hot")]
    got = merkle.verify_documents(documents(spark, rows), fanout)
    assert tuples(got) == brute_verify(rows, fanout)
    assert 0 < sum(not r[-1] for r in tuples(got)) < len(rows) / 4


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_small_trees(spark, n):
    rows = [(i, f"Text {i}", "en", "s") for i in range(n)]
    assert tuples(merkle.verify_documents(documents(spark, rows))) == brute_verify(rows, 16)


def test_digests_of_many_parts_take_few_files(spark, monkeypatch):
    """A file costs an executor processes of its own, and digests are small: none per task of the scan."""
    files, plain = [], merkle.stored

    def noted(df, name):
        files.append((name, len((out := plain(df, name)).inputFiles())))
        return out

    monkeypatch.setattr(merkle, "stored", noted)
    rows = [(i, f"Text {i}", "en", "s") for i in range(100)]
    assert tuples(merkle.verify_documents(documents(spark, rows).repartition(40))) == brute_verify(rows, 16)
    assert files[0][0] == "leaves" and max(n for _, n in files) < 10


def test_no_rows_no_root(spark):
    assert merkle.verify_documents(documents(spark, [])).collect() == []
    assert merkle.build_manifest(documents(spark, [])).root is None


def test_a_run_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        merkle.build_manifest(documents(spark, [(1, "x", "en", "s")]), fanout=1)


def test_binary_siblings_are_found_by_xor(spark):
    from pyspark.sql import functions as F

    got = spark.range(6).select(merkle.run_indices(F.col("id"), 2).alias("x")).collect()
    assert [tuple(r["x"]) for r in got] == [(i, i ^ 1) for i in range(6)]
