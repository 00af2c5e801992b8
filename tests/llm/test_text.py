"""Operators on single texts: tokens, pages, toxicity, benchmark, language model."""

import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from test_pairs import documents

from swaplens.llm import decontamination, hmm_scoring, html_text, token_output, toxicity
from swaplens.llm.common import table, tokenizer_path, words

SF = "/root/testdata/sf0.01"
ODD = ["don't I'LL Ünï İstanbul ΣΑΣ. 3.14 a,b .,. <|endoftext|> x<|ENDOFTEXT|>y z q é Ét́ ﬁ ..,, ,a ½ 漢字かな한국 naïve, ÀÉ.", "", None, " \n\t", "word " * 30_000]


def sample_texts(n=150):
    return [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY hash(doc_id) LIMIT {n}").fetchall()]


# Token output


def test_word_encoder_equals_library():
    encoder = token_output.WordEncoder(tokenizer_path())
    texts = sample_texts() + ODD
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts, 2)):
            assert list(ids) == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        encoder.words, encoder.older = {}, encoder.words


def test_letters_that_become_marks_before_punctuation():
    encoder = token_output.WordEncoder(tokenizer_path())
    letters = ["EVİ", "İ", "Aİ", "éİ", *map(chr, range(0x958, 0x960)), "क\u0958", "\u09dc", "\ufb1d", "ΣΑΣ", "é"]
    for text in [x + tail for x in letters for tail in (".", ",", ".,", "..", "")]:
        for _ in range(2):
            assert list(encoder.encode([text], 2)[0]) == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2], text


def test_marks_that_close_words():
    encoder = token_output.WordEncoder(tokenizer_path())
    rng = random.Random(8)
    parts = ["a", "Word", "don't", "3a", "it's", "x<y", "<|endoftext|>", "<|EndOfText|>", "é", "e\u0301", "E\u0301", "ﬁ", "a\u0303", ".", ",", "..", ".,", "!", "\n", " ", " ", " ", "\u00a0", "\u2028", "-", "_", "1"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        assert list(encoder.encode([text], 2)[0]) == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2], text


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "FILE_TEXT_BYTES", 100_000)
    texts = sample_texts(60) + ODD
    rows = [(3 * k - 20, t) for k, t in enumerate(texts)] + [(None, "no id"), (5, "same id"), (5, "same id"), (5, "other text")]
    random.Random(2).shuffle(rows)
    folder = str(tmp_path / "out")
    files = token_output.write_token_files(documents(spark, rows), folder, tokenizer_path(), frame_bytes=4096)
    assert files.count() > 1
    got = token_output.read_token_files(files, with_ids=True).orderBy("start").collect()
    library = token_output.WordEncoder(tokenizer_path()).tokenizer
    expected = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in expected]
    assert sorted((r.doc_id or -99, list(r.ids)) for r in got) == sorted((i or -99, ids) for i, ids in expected)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_reader_opens_wanted_frames_only(spark, tmp_path):
    rows = [(k, f"text number {k} " * 200) for k in range(40)]
    files = token_output.write_token_files(documents(spark, rows), str(tmp_path / "t"), tokenizer_path(), frame_bytes=2048).collect()
    path = files[0].file
    reader = token_output.FrameReader(token_output.FileSource(path))
    reader.ids(17)
    assert reader.decompressed == 1 and len(reader.sizes) > 10
    assert set(token_output.read_documents(path, [3, 4, 99])) == {3, 4}
    raw = bytearray(open(path, "rb").read())
    raw[int(reader.at[int(reader.frame[17])]) + 12] ^= 1
    (tmp_path / "damaged").write_bytes(raw)
    with pytest.raises(Exception):
        token_output.FrameReader(token_output.FileSource(str(tmp_path / "damaged"))).ids(17)


def test_tokens_of_nothing(spark, tmp_path):
    assert token_output.token_documents(documents(spark, []), tokenizer_path(), str(tmp_path / "none")).count() == 0


# Pages


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>One<p>two <b>bo</b>ld<br>three", "One two bold three"),
        ("<div id=x>a &lt;b&gt;</div><script>if (a<b) '<p>no</p>'</script><style>p{}</style>", "a <b>"),
        ("<header>Site</header><nav><a href=/>Home</a></nav><article><header><h1>Title</h1></header><p>Short.</p><p>A longer paragraph of text, here.</p></article><footer>f</footer>", "Title Short. A longer paragraph of text, here."),
        ("<body><div class='cookie-notice'>We use cookies on this page, as all do.</div><main><p>Text of the page stands here.</p></main><aside>More</aside><section id=comments><p>I like it very much indeed.</p></section></body>", "Text of the page stands here."),
        ("<article><p>x</p><form action=/s><input value=q>Mail<button>Send</button></form><p>y</p></article>", "x y"),
        ("<article><p title='a > b'>in</p><!-- <p>out</p> --><p>end &copy; &#x41;&#66;</p>", "in end \xa9 AB"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two a b c"),
        ("<nav><a href=1>only</a> menus</nav>", ""),
        ("<p unclosed='quote>text</p><p>more", "text more"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


STORY = "<p>The story begins here, with some words.</p><p>It goes on for a while, and ends.</p>"
TOLD = "The story begins here, with some words. It goes on for a while, and ends."
THREAD = "<div id='comments'><article class='comment'><p>I like it.</p></article></div>"


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<div class='layout with-sidebar'><article>{STORY}</article></div>", TOLD),
        (f"<div id='no-comments'><main>{STORY}</main></div>", TOLD),
        (f"<section class='content widget'><article>{STORY}</article></section><aside>More</aside>", TOLD),
        (f"<main><section class='content widget'><article>{STORY}</article></section></main>", TOLD),
        (f"<div role='form'><article>{STORY}</article></div>", TOLD),
        (f"<div class='with-sidebar'><h1>Title</h1>{STORY}</div><div class='cookie-notice'><p>We use cookies.</p></div>", f"Title {TOLD}"),
        (f"<div class='page social'><div>{STORY}</div></div><div class='newsletter'><p>Write to us.</p></div>", TOLD),
        # what stays out
        (f"<div class='with-sidebar'><article>{STORY}</article>{THREAD}</div>", TOLD),
        (f"<article>{STORY}</article>{THREAD}", TOLD),
        (f"<main>{STORY}{THREAD}</main>", TOLD),
        (f"<article>{STORY}</article><div id='comments'>{STORY * 5}</div>", TOLD),
        (f"<div class='with-sidebar' hidden><article>{STORY}</article></div><p>Other text.</p>", "Other text."),
    ],
)
def test_wrappers_named_like_notices(page, text):
    assert html_text.main_text(f"<body>{page}</body>") == text


def test_density_prefers_text_to_links():
    links = "".join(f"<li><a href={k}>link number {k}</a></li>" for k in range(30))
    paragraphs = [f"Paragraph {k} of the story, with some words in it and a few more." for k in range(6)]
    page = f"<body><div><ul>{links}</ul></div><div><div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div></div></body>"
    assert html_text.main_text(page) == " ".join(paragraphs)


def test_long_and_deep_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    text = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert html_text.main_text(text) == " ".join(["word word"] * 20_000)


def test_pages_table(spark):
    rows = [(1, "u", "<p>a</p>", 1), (1, "u", "<p>a</p>", 1), (None, None, None, 2)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "a"), (1, "a")]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# Toxicity


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    rng = np.random.default_rng(1)
    lengths, step = np.array([5, 0, 1, 7, 3]), np.array([[0.9, 0.3], [0.5, 2.0]])
    emission = rng.random(lengths.sum())
    gamma, pairs = toxicity.forward_backward(emission, lengths, step, True)
    at = 0
    for n in lengths:
        total, marginal, steps = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product([0, 1], repeat=int(n)) if n else ():
            p = step[:, states[0]].sum() * np.prod([emission[at + t] if y else 1 - emission[at + t] for t, y in enumerate(states)])
            p *= np.prod([step[x, y] for x, y in zip(states, states[1:])])
            total, marginal = total + p, marginal + p * np.array(states)
            for x, y in zip(states, states[1:]):
                steps[x, y] += p
        if n:
            assert np.allclose(marginal / total, gamma[at : at + n])
            pairs = pairs - steps / total
        at += n
    assert np.abs(pairs).max() < 1e-9


@pytest.fixture(scope="module")
def field():
    rng = random.Random(8)
    good = [f"{a}{b}" for a in ("ta", "mi", "ro", "lu") for b in ("sen", "dor", "vak", "pil", "non")]
    bad = ["vilescum", "grubtrash", "vilesnout"]
    texts, labels = [], []
    for k in range(900):
        w = rng.choices(good, k=rng.randrange(5, 60))
        if k % 4 == 0:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        labels.append(int(k % 4 == 0))
    return toxicity.fit(texts[:600], np.array(labels[:600])), texts[600:], labels[600:]


def test_held_out_accuracy_and_offsets(field):
    model, texts, labels = field
    tagger = toxicity.Tagger(model)
    score, gamma = tagger.marginals(texts)
    assert ((score >= 0.5) == np.array(labels)).mean() > 0.99 and (0 <= score).all() and (score <= 1).all()
    for text, g, label in zip(texts, gamma, labels):
        for span in tagger.spans(text, g):
            assert all(w in ("vilescum", "grubtrash", "vilesnout") for w in text[span["start"] : span["end"]].split())


def test_toxicity_tables(spark, field):
    model, texts, labels = field
    rows = [*enumerate(texts), (None, texts[0]), (7, None), (8, ""), (9, " \n"), (10, "ta " * 40_000)]
    got = toxicity.tag_documents(documents(spark, rows), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id in (9, 10)}
    assert by[9].score == 0 and by[9].spans == [] and by[10].score < 0.5
    kept = toxicity.drop_toxic(documents(spark, rows), model)
    assert kept.columns == documents(spark, rows).columns and kept.count() == labels.count(0) + 5 - labels[0]
    assert toxicity.drop_toxic(documents(spark, []), model).count() == 0


def test_toxicity_learns_from_tables(spark, field):
    _, texts, labels = field
    docs = documents(spark, [*enumerate(texts), (None, "x"), (1, texts[1])])
    tags = spark.createDataFrame([*zip(range(len(labels)), labels), (None, 1), (5, None), (99999, 1)], "doc_id bigint, toxic int")
    assert toxicity.learn(docs, tags)["weights"] is not None
    nothing = toxicity.learn(docs, tags.limit(0))
    assert {r.score for r in toxicity.tag_documents(docs, nothing).collect()} == {0.0}


# Benchmark


def leak_fixture():
    rng = random.Random(6)
    vocabulary = [f"v{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([12, 20, 40, 59, 150])))) for k in range(60)] + [(60, None), (61, ""), (62, "one two"), (3, "repeated id of an item with words")]
    rows = []
    for k in range(200):
        w = rng.choices(vocabulary, k=rng.randrange(0, 900))
        if k % 4 == 0:
            item = words(rng.choice(items[:60])[1])
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.decode() for x in item]
        rows.append((k, " ".join(w).title()))
    return items, rows


def brute_leaks(items, text):
    w, out = words(text), []
    for item, t in items:
        own = words(t)
        half = (len(own) + 1) // 2
        hits = []
        for part in (own[:half], own[half:]):
            q = min(5, len(part))
            grams = {tuple(part[k : k + q]) for k in range(len(part) - q + 1)} if part else set()
            have = {tuple(w[k : k + q]) for k in range(len(w) - q + 1)} if part else set()
            hits.append((len(grams & have), len(grams)))
        if own and w and all(h >= 0.8 * n for h, n in hits):
            out.append(item)
    return sorted(out)


def test_wand_retrieves_all_above_threshold():
    items, rows = leak_fixture()
    index = decontamination.Index(items, block=3)
    for _, text in rows[:80]:
        terms = {index.term[w] for w in words(text)[:128] if w in index.term}
        scores = np.zeros(len(index.owner))
        for t in terms:
            scores[index.items[t]] += index.impacts[t]
        expected = np.flatnonzero(scores >= index.threshold - 1e-9).tolist()
        assert sorted(i for i, _ in index.retrieve(list(terms))) == expected


def test_windows_pass_over_nothing_above_threshold():
    items, rows = leak_fixture()
    index = decontamination.Index(items)
    none, get = len(index.items), index.term.get
    for _, text in rows:
        terms = np.array([get(w, none) for w in words(text)], "i4")
        if not len(terms):
            continue
        kept = index.windows(terms)
        for start in range(0, max(1, len(terms) - 64), 64):
            own = set(terms[start : start + 128].tolist()) - {none}
            if index.retrieve(list(own)):
                assert start in kept


@pytest.mark.parametrize("block_bytes", [2000, 1 << 22])
def test_leaks(spark, block_bytes):
    items, rows = leak_fixture()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {}
    for r in decontamination.find_leaks(documents(spark, [*rows, (None, None)]), benchmark, block_bytes).collect():
        got.setdefault(r.doc_id, []).append(r.item_id)
    expected = {i: brute_leaks(items, t) for i, t in rows}
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in expected.items() if x}
    clean = decontamination.drop_contaminated(documents(spark, rows), benchmark, block_bytes)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, _ in rows if not expected[i]]


def test_leaks_whose_parts_stand_apart(spark):
    rng = random.Random(16)
    vocabulary = [f"v{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([2, 7, 12, 15, 20, 33, 40, 59, 64, 150, 400] * 4)]
    rows = []
    for k, t in items:
        own = words(t)
        half = (len(own) + 1) // 2
        parts = [[x.decode() for x in own[:half]], [x.decode() for x in own[half:]]]
        for kind in range(4):
            rng.shuffle(parts)  # the answer may come first
            pieces = parts
            if kind == 1:  # four of five shingles at most
                pieces = [p[: max(min(5, len(p)), len(p) - (len(p) - 4) // 5)] for p in parts]
            if kind == 2:  # every shingle in a place of its own
                pieces = [p[i : i + 5] for p in parts for i in range(max(1, len(p) - 4))]
            if kind == 3:  # the question alone, or the answer
                pieces = parts[:1]
            text = rng.choices(vocabulary, k=rng.randrange(50))
            for p in pieces:
                text += [*p, *(f"other{rng.randrange(10**6)}" for _ in range(200 if kind != 2 else 20))]
            rows.append((4 * k + kind, " ".join(text)))
    rows.append((10_000, " filler ".join(t for _, t in items)))
    got = {}
    for r in decontamination.find_leaks(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect():
        got.setdefault(r.doc_id, []).append(r.item_id)
        assert 0 < r.score < 1 + 1e-9
    expected = {i: brute_leaks(items, t) for i, t in rows}
    assert all(k in expected[4 * k] and k in expected[4 * k + 2] for k, _ in items)
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in expected.items() if x}


def test_leaks_of_nothing(spark):
    items, rows = leak_fixture()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontamination.find_leaks(documents(spark, []), benchmark).count() == 0
    assert decontamination.drop_contaminated(documents(spark, rows), benchmark.limit(0)).count() == len(rows)


# Language model


def small_model(states=3):
    rng = np.random.default_rng(2)
    emit = rng.random((hmm_scoring.CLASSES + 1, states)) * (rng.random((hmm_scoring.CLASSES + 1, 1)) < 0.5) + 1e-6
    step, start = rng.random((states, states)), rng.random(states)
    return hmm_scoring.Model(step / step.sum(1, keepdims=True), start / start.sum(), emit / emit.sum(0))


def test_forward_and_counts_equal_enumeration():
    model = small_model()
    docs = [np.array(d, "i4") for d in ([5, 9, 5, 3], [7], [1, 2], [hmm_scoring.CLASSES])]
    likelihood, total = model.log_likelihood(docs), [np.zeros((3, 3)), np.zeros(3), np.zeros_like(model.emit)]
    for d, got in zip(docs, likelihood):
        paths = {}
        for s in itertools.product(range(3), repeat=len(d)):
            p = model.start[s[0]] * np.prod([model.emit[c, x] for c, x in zip(d, s)]) * np.prod([model.step[x, y] for x, y in zip(s, s[1:])])
            paths[s] = p
        z = sum(paths.values())
        assert math.isclose(math.log10(z), got, rel_tol=1e-9)
        for s, p in paths.items():
            total[1][s[0]] += p / z
            for x, y in zip(s, s[1:]):
                total[0][x, y] += p / z
            for c, x in zip(d, s):
                total[2][c, x] += p / z
    for got, expected in zip(model.expected(docs), total):
        assert np.allclose(got, expected, atol=1e-4)


def test_baum_welch_raises_the_likelihood():
    docs = [hmm_scoring.class_ids(t) for t in sample_texts(80)]
    model, last = hmm_scoring.Model.of_frequencies(hmm_scoring.class_counts(docs), 4), -math.inf
    for _ in range(6):
        *counts, value = model.expected(docs)
        assert value >= last - 1e-3 * abs(value)
        model, last = hmm_scoring.Model.of_counts(*counts), value
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.step.sum(1), 1)


def in_runs(rng, n):
    """Words of two kinds in runs of 30, each drawn at random."""
    return " ".join(rng.choice(("ta", "mi", "ro", "lu") if k // 30 % 2 else ("sen", "dor", "vak", "pil")) for k in range(n))


def test_only_long_texts(spark):
    """All over 16 KB: the states part all the same, and the chain beats the unigram by what the runs tell."""
    rng = random.Random(3)
    rows = [(k, in_runs(rng, 6000)) for k in range(40)]
    assert min(len(t) for _, t in rows) > 16384
    got = hmm_scoring.score_documents(documents(spark, rows), states=2).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.score - r.base_score > 0.2 * r.n_tokens for r in held)  # log10(2) a token at best


def test_counts_of_whole_documents():
    """Counts of steps and the likelihood run through a long document, also beside shorter ones."""
    model, rng = small_model(), np.random.default_rng(4)
    docs = [rng.integers(0, hmm_scoring.CLASSES, n).astype("i4") for n in (1500, 3, 700, 1, 256, 257)]
    steps, starts, emits, value = model.expected(docs)
    assert math.isclose(steps.sum(), sum(len(d) - 1 for d in docs), rel_tol=1e-4) and math.isclose(starts.sum(), len(docs), rel_tol=1e-4)
    assert math.isclose(value, model.log_likelihood(docs).sum() * math.log(10), rel_tol=1e-6)
    assert np.allclose(emits.sum(1), np.bincount(np.concatenate(docs), minlength=hmm_scoring.CLASSES + 1), atol=1e-3)


def test_a_long_document_is_counted_in_blocks(monkeypatch):
    model, rng = small_model(), np.random.default_rng(4)
    docs = [rng.integers(0, hmm_scoring.CLASSES, n).astype("i4") for n in (1500, 3, 700, 512, 513)]
    whole = model.expected(docs)
    monkeypatch.setattr(hmm_scoring, "LONG", 500)
    monkeypatch.setattr(hmm_scoring, "LEVEL", 16)
    for got, expected in zip(model.expected(docs), whole):
        assert np.allclose(got, expected, atol=2e-3)


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(hmm_scoring, "CHUNK_BYTES", 200_000)
    monkeypatch.setattr(hmm_scoring, "BUCKET_BYTES", 150_000)
    texts = sample_texts(300)
    rows = [*enumerate(texts), (None, "no id here"), (500, None), (501, ""), (502, " \n "), (3, texts[3])]
    got = hmm_scoring.score_documents(documents(spark, rows), states=4, passes=8).collect()
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    counts = {}
    for i, t in rows:
        for w in [*words(t), None] if not held(i) else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (i, held(i), len(words(t)) + 1, sum(w in counts for w in [*words(t), None]), n, round(sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), None]), 6))
            for i, t in rows
        ),
        key=repr,
    )
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == expected
    unseen = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score > r.base_score for r in unseen) > 0.8 * len(unseen) and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_words_of_a_state_sum_to_one(spark):
    """Shares within the classes, unknown ones included, times the classes' shares."""
    docs = documents(spark, [(k, t) for k, t in enumerate(sample_texts(40))], clash=False).selectExpr("doc_id", "text", "false AS held_out", "0 AS chunk")
    sums, known = {}, {}
    read = hmm_scoring.read_chunks(docs, 3).where("bucket IS NOT NULL").select("chunk", "bucket", "words", "counts")
    sent = {r.bucket: bytes(r.words).split(b" ") for r in read.collect()}
    for r in hmm_scoring.word_counts(read, 3).collect():
        weights, count = np.frombuffer(r["weights"], "<f8"), np.frombuffer(r["counts"], "<i8")
        for w, c in zip(sent[r["bucket"]], count, strict=True):
            k = hmm_scoring.word_class(w)
            sums[k] = sums.get(k, 0.0) + (c + 0.1) / weights[k // 3]
            known.setdefault(k, []).append(c)
    for k, cs in known.items():
        assert math.isclose(sums[k] + 0.1 / (sum(cs) + 0.1 * (len(cs) + 1)), 1, rel_tol=1e-9)


def test_scores_of_nothing(spark):
    assert hmm_scoring.score_documents(documents(spark, [])).count() == 0
    only = hmm_scoring.score_documents(documents(spark, [(i, "a b") for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]))
    assert {(r.n_known, r.train_tokens) for r in only.collect()} == {(0, 0)}


def test_hmm_counts_two_million_tokens_at_once(spark):
    rows = [(bytearray(np.zeros(300_000, "<u2").tobytes()),) for _ in range(6)]
    classes = spark.createDataFrame(rows, "classes binary").coalesce(1)
    # Each call of the counting function adds 1: long documents have a step a token, which those counted with them share.
    assert hmm_scoring._summed(classes, 1, lambda documents: np.ones((1, 1)))[0, 0] == 1


def test_encoder_holds_a_bounded_number_of_words(monkeypatch):
    encoder, letters = token_output.WordEncoder(tokenizer_path()), "abcdefghijklmnop"
    word = lambda k: "".join(letters[k >> 4 * i & 15] for i in range(5))
    for k in range(0, 450_000, 10_000):
        encoder.encode([" ".join(map(word, range(k, k + 10_000)))], 2)
    assert len(encoder.words) + len(encoder.older) <= 2 * 160_000
    monkeypatch.setattr(token_output, "CACHED_BYTES", 2**17)
    for k in range(20):
        text = " ".join(word(100 * k + j) * 100 for j in range(100))
        assert list(encoder.encode([text], 2)[0]) == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert sum(map(len, [*encoder.words, *encoder.older])) <= 2 * (2**17 + 51_000) + 320_000 * 8


def test_words_that_end_in_punctuation_go_to_the_library_by_their_letters(monkeypatch):
    encoder, alone = token_output.WordEncoder(tokenizer_path()), []
    one_by_one = encoder._one_by_one
    monkeypatch.setattr(encoder, "_one_by_one", lambda parts: alone.extend(parts) or one_by_one(parts))
    text = "Alpha### beta&&& gamma!! ünï$$$ delta.) é...*** ≠## x≠# don't** 3%%"
    assert list(encoder.encode([text], 2)[0]) == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert {b"###", b"&&&", b"!!", b"$$$", b".)", b"...***"} <= set(alone)
    assert not [x for x in alone if x[:1].isalpha() and x != b"don't**" and x[:1] != b"x"]


def test_encoder_looks_at_distinct_words_only(monkeypatch):
    encoder, asked = token_output.WordEncoder(tokenizer_path()), []
    remember = encoder._remember
    monkeypatch.setattr(encoder, "_remember", lambda new: asked.append(list(new)) or remember(new))
    monkeypatch.setattr(token_output, "SLICE_BYTES", 40)
    texts = ["one two, three\x0b\x0c four.\n" * 9, None, "", "  ", "five" * 30, "six. seven.\tone"]
    for text, ids in zip(texts, encoder.encode(texts, 2)):
        assert list(ids) == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    every = [w for new in asked for w in new]
    assert len(asked) > 5 and sorted(every) == sorted({b"one", b"two", b",", b"three", b"four", b".", b"five" * 30, b"six", b"seven"})
