"""Toxic spans by a linear-chain conditional random field.

Labels are per document, so tokens are labelled first: a word, or the beginning of one, that occurs in so many toxic documents of the
sample and hardly in a clean one that chance cannot explain it marks its tokens in toxic documents. The field then has two states;
a token's features are its word, beginnings and ending, hashed, and neighbours count through the transitions. It is
trained by forward-backward gradients on a bounded sample of labelled documents (``per_label``, of at most ``sample_bytes``
each). All documents are scored whole: token marginals give the offending offsets, and the largest of them is the document's score,
which does not grow with the mere length of a text.

Null and empty texts, and texts of white space, score 0 without spans. Rows repeat as they are. Labels that are null, or whose document is missing, are not
used; without both labels in the sample, all scores are 0. An empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.common import held_out, slices
from swaplens.plans.scale import settle

FEATURE_BITS = 18
SEGMENT, BLOCK = 512, 256
TOKEN = re.compile("[^\x20\x09-\x0d]+")
STRIP = b".,;:!?\"'()[]"


def _tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def _stem(word: bytes) -> bytes:
    return (word.strip(STRIP) or word).lower()


def _shape(word: bytes) -> bytes:
    """Capitals throughout, and how many exclamation marks end the word (two at most)."""
    return b"#" + b"U" * (word.isupper() and len(word) > 2) + b"!" * min(2, len(word) - len(word.rstrip(b"!")))


def _features(word: bytes) -> list[int]:
    stem, mask = _stem(word), (1 << FEATURE_BITS) - 1
    parts = [b"w" + stem, b"3" + stem[:3], b"4" + stem[:4], b"5" + stem[:5], b"6" + stem[:6], b"e" + stem[-4:], _shape(word)]
    return [zlib.crc32(p) & mask for p in parts]


def _cues(word: bytes) -> list[bytes]:
    """What can mark a token as toxic in the sample: the word, its first four or five bytes if there are more, its shape."""
    stem, shape = _stem(word), _shape(word)
    return [stem] + [stem[:n] + b"*" for n in (4, 5) if len(stem) > n] + [shape] * (len(shape) > 1)


def copy_groups(texts: list[str], bands: int = 5, rows: int = 3) -> list[int]:
    """A number per document that its copies share: documents are joined whose least hashes of three-word shingles agree in a band of ``rows``."""
    group = list(range(len(texts)))

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    seen: dict[tuple, int] = {}
    multipliers = np.random.default_rng(3).integers(1, 1 << 62, bands * rows, dtype="u8") * 2 + 1
    for i, text in enumerate(texts):
        h = np.array([zlib.crc32(w) for w in _tokens(text)], "u8")
        h = h[:-2] * np.uint64(961748941) + h[1:-1] * np.uint64(982451653) + h[2:] if len(h) > 2 else h
        if len(h):
            h ^= h >> np.uint64(29)
            least = [int((h * m >> np.uint64(16)).min()) for m in multipliers]
            for k in range(bands):
                j = seen.setdefault((k, *least[k * rows : (k + 1) * rows]), i)
                group[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def toxic_cues(texts: list[str], labels: np.ndarray) -> set[bytes]:
    """Cues whose toxic documents are too many for chance (one false cue in a hundred samples), clean ones at most 2 %. Copies count once.

    Texts are split one group after the other, and clean ones are only searched for the cues that passed, which keeps the driver small.
    """
    members: tuple[dict, dict] = ({}, {})
    for text, label, group in zip(texts, labels, copy_groups(texts)):
        members[label].setdefault(group, []).append(text)
    distinct = lambda some: set().union(*map(_tokens, some))
    toxic, size = Counter(), [1, 1]
    for some in members[1].values():
        found = distinct(some)
        size[1] += len(found)
        toxic.update({c for w in found for c in _cues(w)})
    size[0] += sum(len(distinct(some)) for some in members[0].values())
    chance = size[1] / (size[0] + size[1])
    shapes = sum(c[:1] == b"#" for c in toxic)
    least = [max(3, np.log(max(10, tried) * 100) / -np.log(chance)) for tried in (len(toxic), shapes)]
    passed = {c: n for c, n in toxic.items() if n >= least[c[:1] == b"#"]}
    clean = Counter(c for some in members[0].values() for c in {c for w in distinct(some) for c in _cues(w) if c in passed})
    return {c for c, n in passed.items() if clean[c] <= 0.02 * n}


def forward_backward(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray, with_pairs: bool = False):
    """Marginals of state 1 of each token, and the expected transitions if asked for.

    ``emission`` holds the weight of state 1 of each token (that of state 0 is one less it), sequence after sequence; a free state stands
    before the first token. Sequences are cut in blocks, and all blocks take a step together: first for their transfer matrices, whose products
    give what comes in at either end of each block, then for the recursions themselves. This is exact, and the loop is as
    long as a block, however long a text is.
    """
    (s00, s01), (s10, s11) = step
    lengths = np.asarray(lengths, "i8")
    n_blocks = -(-lengths // BLOCK)
    first = np.cumsum(lengths) - lengths
    if not len(emission):
        return np.empty(0), np.zeros((2, 2))
    doc = np.repeat(np.arange(len(lengths)), n_blocks)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    size = np.minimum(BLOCK, lengths[doc] - number * BLOCK)
    order = np.argsort(-size, kind="stable")
    doc, number, size = doc[order], number[order], size[order]
    longest = int(size[0])
    inside = np.arange(longest)[:, None] < size[None, :]
    place = (first[doc] + number * BLOCK)[None, :] + np.arange(longest)[:, None]
    grid = np.zeros(inside.shape)
    grid[inside] = emission[place[inside]]
    active = inside.sum(1)

    x0, x1, y0, y1 = np.ones(len(doc)), np.zeros(len(doc)), np.zeros(len(doc)), np.ones(len(doc))
    for t in range(longest):
        k = active[t]
        e, f = grid[t, :k], 1 - grid[t, :k]
        x0[:k], x1[:k] = (x0[:k] * s00 + x1[:k] * s10) * f, (x0[:k] * s01 + x1[:k] * s11) * e
        y0[:k], y1[:k] = (y0[:k] * s00 + y1[:k] * s10) * f, (y0[:k] * s01 + y1[:k] * s11) * e
        if t % 8 == 7 or t + 1 == longest:
            c = x0 + x1 + y0 + y1
            x0, x1, y0, y1 = x0 / c, x1 / c, y0 / c, y1 / c

    by_number = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[by_number], np.arange(number.max() + 2))
    layers = [by_number[a:b] for a, b in zip(cuts, cuts[1:])]
    a_in, b_out = np.empty((2, len(doc))), np.empty((2, len(doc)))
    v = np.ones((2, len(lengths)))
    for ids in layers:
        d = doc[ids]
        a_in[:, ids] = v[:, d]
        n0, n1 = v[0, d] * x0[ids] + v[1, d] * y0[ids], v[0, d] * x1[ids] + v[1, d] * y1[ids]
        v[:, d] = n0 / (n0 + n1), n1 / (n0 + n1)
    v = np.ones((2, len(lengths)))
    for ids in reversed(layers):
        d = doc[ids]
        b_out[:, ids] = v[:, d]
        n0, n1 = x0[ids] * v[0, d] + x1[ids] * v[1, d], y0[ids] * v[0, d] + y1[ids] * v[1, d]
        v[:, d] = n0 / (n0 + n1), n1 / (n0 + n1)

    alpha = np.empty((longest + 1, len(doc)))  # of state 1, scaled; row 0 is what comes in
    a0, a1 = a_in / a_in.sum(0)
    alpha[0] = a1
    for t in range(longest):
        k = active[t]
        e = grid[t, :k]
        n0, n1 = (a0[:k] * s00 + a1[:k] * s10) * (1 - e), (a0[:k] * s01 + a1[:k] * s11) * e
        c = n0 + n1
        a0[:k], a1[:k] = n0 / c, n1 / c
        alpha[t + 1, :k] = a1[:k]
    (b0, b1), pairs = b_out, np.zeros((2, 2))
    marginal = np.empty_like(grid)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        e, p = grid[t, :k], alpha[t + 1, :k]
        w1, w0 = p * b1[:k], (1 - p) * b0[:k]
        marginal[t, :k] = w1 / (w0 + w1)
        f0, f1 = (1 - e) * b0[:k], e * b1[:k]
        if with_pairs:
            q = alpha[t, :k]
            w = np.array([(1 - q) * s00 * f0, (1 - q) * s01 * f1, q * s10 * f0, q * s11 * f1])
            w[:, (number[:k] == 0) & (t == 0)] = 0
            pairs += (w / np.maximum(w.sum(0), 1e-300)).sum(1).reshape(2, 2)
        n0, n1 = s00 * f0 + s01 * f1, s10 * f0 + s11 * f1
        b0[:k], b1[:k] = n0 / (n0 + n1), n1 / (n0 + n1)
    gamma = np.empty(len(emission))
    gamma[place[inside]] = marginal[inside]
    return np.clip(gamma, 0, 1), pairs


def fit(texts: list[str], labels: np.ndarray, rounds: int = 40, l2: float = 1e-3, clean: int = 1000) -> dict:
    """The field's weights from labelled texts: cues from all, weights from the toxic ones and the first ``clean`` clean ones."""
    cues = toxic_cues(texts, labels) if 0 < labels.sum() < len(labels) else set()
    if not cues:
        return {"weights": None}
    vocabulary: dict[bytes, int] = {}
    pieces, marks = [], []
    trained = (labels == 1) | (np.cumsum(labels == 0) <= clean)
    for text, label in [(t, y) for t, y, use in zip(texts, labels, trained) if use]:
        tokens = _tokens(text)
        for k in range(0, len(tokens), SEGMENT):
            pieces.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in tokens[k : k + SEGMENT]], "i4"))
            marks.append(np.full(len(pieces[-1]), label, "i1"))
    marked = np.array([any(c in cues for c in _cues(w)) for w in vocabulary])
    feats = np.array([_features(w) for w in vocabulary], "i4")
    lengths = np.array([len(p) for p in pieces])
    token = np.concatenate(pieces)
    truth = (marked[token] & (np.concatenate(marks) == 1)).astype(float)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(token), bool)
    inner[first] = False
    before, after = truth[:-1][inner[1:]], truth[1:][inner[1:]]
    seen_pairs = np.array([[((1 - before) * (1 - after)).sum(), ((1 - before) * after).sum()], [(before * (1 - after)).sum(), (before * after).sum()]])
    weights, bias = np.zeros(1 << FEATURE_BITS), np.log((truth.sum() + 1) / (len(truth) + 2))
    trans = np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((2, 2)), np.zeros((2, 2)), 0.0, 0.0]
    rate, decay = 0.25, (0.8, 0.99)
    for k in range(1, rounds + 1):
        emission = 1 / (1 + np.exp(-np.clip(weights[feats].sum(1) + bias, -30, 30)))[token]
        gamma, pairs = forward_backward(emission, lengths, np.exp(trans), True)
        error = truth - gamma
        by_word = np.bincount(token, error, len(vocabulary))
        grads = [
            np.bincount(feats.ravel(), np.repeat(by_word, feats.shape[1]), len(weights)) - l2 * weights,
            (seen_pairs - pairs) - l2 * trans,
            error.sum(),
        ]
        for g, value in enumerate(grads):
            moments[2 * g] = decay[0] * moments[2 * g] + (1 - decay[0]) * value
            moments[2 * g + 1] = decay[1] * moments[2 * g + 1] + (1 - decay[1]) * value**2
            move = rate * (moments[2 * g] / (1 - decay[0] ** k)) / (np.sqrt(moments[2 * g + 1] / (1 - decay[1] ** k)) + 1e-8)
            if g == 0:
                weights += move
            elif g == 1:
                trans += np.clip(move, -0.1, 0.1)
            else:
                bias += min(0.1, max(-0.1, move))
    return {"weights": weights.astype("f4"), "bias": float(bias), "step": np.exp(trans)}


class Tagger:
    """Scores texts with a fitted field; keeps the weights of words it has seen, within a bound."""

    def __init__(self, model: dict):
        self.model, self.known, self.emission = model, {}, []

    def _look_up(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        for w in set(tokens).difference(known):
            weight = float(self.model["weights"][_features(w)].sum()) + self.model["bias"]
            known[w] = 1 / (1 + np.exp(-min(30.0, max(-30.0, weight))))
        return np.fromiter(map(known.__getitem__, tokens), float, len(tokens))

    def marginals(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Score of each text and the marginals of its tokens."""
        documents = [_tokens(t) for t in texts]
        lengths = np.array([len(d) for d in documents], "i8")
        if self.model["weights"] is None:
            return np.zeros(len(texts)), [np.zeros(n) for n in lengths]
        if len(self.known) > 500_000:
            self.known.clear()
        emission = np.concatenate([np.empty(0), *[self._look_up(d) for d in documents]])
        gamma, _ = forward_backward(emission, lengths, self.model["step"])
        parts = np.split(gamma, np.cumsum(lengths)[:-1]) if len(lengths) else []
        return np.array([g.max(initial=0.0) for g in parts]), parts

    def spans(self, text: str, gamma: np.ndarray, least: float = 0.5) -> list[dict]:
        """Runs of toxic tokens: first and next character, and the largest marginal."""
        hot = np.flatnonzero(gamma >= least)
        if not len(hot):
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        runs = np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1)
        return [{"start": places[r[0]][0], "end": places[r[-1]][1], "marginal": float(gamma[r].max())} for r in runs]


def sample(docs: DataFrame, labels: DataFrame, modulus: int, per_label: tuple[int, int], sample_bytes: int) -> DataFrame:
    """The labelled rows to learn from (rowkey, text, toxic): up to ``per_label`` clean and toxic ones by a hash of the id, none held out.

    Rows are chosen without their texts; the chosen ones, a bounded number, are then looked up.
    """
    keyed = docs.where(F.col("doc_id").isNotNull() & ~held_out(modulus) & (F.octet_length("text") <= sample_bytes)).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("rowkey"), "text"
    )
    tags = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    both = keyed.select("doc_id", "rowkey").distinct().join(tags, "doc_id")
    picks = [both.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "rowkey").limit(most) for label, most in enumerate(per_label)]
    chosen = settle(picks[0].union(picks[1]).select("rowkey", "toxic"))
    return keyed.join(F.broadcast(chosen), "rowkey").groupBy("rowkey").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 5, per_label: tuple[int, int] = (4000, 1000), sample_bytes: int = 16384) -> dict:
    """Fit on at most ``per_label`` clean and toxic documents of at most ``sample_bytes``, in one task; the driver gets the weights alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"rowkey": [], "text": [], "toxic": []}), *batches]).sort_values("rowkey")
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows["text"].tolist(), rows["toxic"].to_numpy(int)))]})

    fitted = sample(docs, labels, modulus, per_label, sample_bytes).repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else {"weights": None}


SPANS = "array<struct<start: int, end: int, marginal: double>>"


def tag_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score and spans of every document."""

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            for begin, end in slices(texts, 4 << 20):
                score, gamma = tagger.marginals(texts[begin:end])
                out = batch.iloc[begin:end].drop(columns="text")
                out["score"] = score
                out["spans"] = [tagger.spans(t or "", g) for t, g in zip(texts[begin:end], gamma)]
                yield out

    return docs.select("doc_id", "text").mapInPandas(tag, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, spans {SPANS}")


def drop_toxic(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The documents with a score below ``least``, all columns as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in slices(texts, 4 << 20):
                score, _ = tagger.marginals(texts[begin:end])
                yield batch.slice(begin, end - begin).filter(pa.array(score < least))

    return docs.mapInArrow(keep, docs.schema)
