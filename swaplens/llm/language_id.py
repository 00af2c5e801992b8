"""Language identification by a convolutional network over bytes, written and trained in numpy.

Bytes have embeddings; filters of several widths run over them, each keeps its largest answer in a window, and a softmax layer on those gives the window's language. A text
is all its windows of ``WINDOW`` bytes, one after the other, the last one padded; its language is the one with the largest mean log probability, by the windows' bytes, and
its score the probability that those means give.

The network learns from a bounded sample: of each language up to ``SAMPLE_DOCS`` documents, chosen by a hash of their ids, and of each up to ``SAMPLE_CHARS`` characters from a place
that hangs on the hash; of languages the ``MAX_LANGS`` with the most documents. It is fitted in one task, and its weights alone reach the driver. Prediction reads every whole text.

Documents to learn from are those with a language whose crc32 of the id as text does not leave 2 modulo 4 (a null id counts as the empty text); source, lang and id are never inputs
of a prediction. Null and empty texts and texts without a letter are ``und`` with score 0, so are all texts if nothing can be learned. Repeated rows repeat; ties go to
the first language in order. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.plans.scale import small_side, stored

SAMPLE_DOCS, SAMPLE_CHARS, MAX_LANGS = 600, 1024, 200
WINDOW, PAD = 128, 0xFF  # PAD is no byte of UTF-8
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4, 5), 12, 8
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED = 5, 400, 64, 0.004, 11  # small samples are read more often
BLOCK = 256  # windows that are judged at once


def windows(text: bytes) -> bytes:
    """The text, padded to whole windows."""
    return text.ljust(-(-len(text) // WINDOW) * WINDOW, bytes([PAD]))


def as_matrix(padded: bytes) -> np.ndarray:
    """A row per window, with room for the widest filter behind it."""
    own = np.frombuffer(padded, "u1").reshape(-1, WINDOW)
    return np.pad(own, ((0, 0), (0, WIDTHS[-1] - 1)), constant_values=PAD)


class Network:
    """Weights by name: embed (256, E), bank (widest * E, filters), bias, out (filters, languages), shift."""

    def __init__(self, langs: list[str], weights: dict[str, np.ndarray]):
        self.langs, self.w = langs, weights

    @classmethod
    def fresh(cls, langs: list[str], rng: np.random.Generator) -> Network:
        n = FILTERS * len(WIDTHS)
        weights = {
            "embed": rng.normal(size=(256, EMBEDDING)) * 0.5,
            "bank": rng.normal(size=(WIDTHS[-1] * EMBEDDING, n)) * 0.25 * cls.mask(),
            "bias": np.zeros(n),
            "out": rng.normal(size=(n, len(langs))) * 0.1,
            "shift": np.zeros(len(langs)),
        }
        return cls(langs, {k: v.astype("f4") for k, v in weights.items()})

    @staticmethod
    def mask() -> np.ndarray:
        """Which rows of the bank a filter uses: those of its width."""
        width = np.repeat(WIDTHS, FILTERS)
        return (np.arange(WIDTHS[-1] * EMBEDDING)[:, None] < width * EMBEDDING).astype("f4")

    def fields(self, x: np.ndarray) -> np.ndarray:
        """(windows, places, what the widest filter sees there)."""
        embedded = self.w["embed"][x].reshape(len(x), -1)
        size = WIDTHS[-1] * EMBEDDING
        return np.lib.stride_tricks.sliding_window_view(embedded, size, axis=1)[:, ::EMBEDDING]

    def answers(self, x: np.ndarray) -> np.ndarray:
        fields = np.ascontiguousarray(self.fields(x)).reshape(-1, WIDTHS[-1] * EMBEDDING)
        return (fields @ self.w["bank"]).reshape(len(x), WINDOW, -1)

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the filters found, and the log probability of each language."""
        found = np.maximum(pooled + self.w["bias"], 0)
        logits = found @ self.w["out"] + self.w["shift"]
        logits -= logits.max(1, keepdims=True)
        return found, logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [self.head(self.answers(x[i : i + BLOCK]).max(1))[1] for i in range(0, len(x), BLOCK)]
        return np.concatenate([*parts, np.zeros((0, len(self.langs)), "f4")])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        answers = self.answers(x)
        where = answers.argmax(1)
        rows = np.arange(len(x))[:, None]
        found, logp = self.head(np.take_along_axis(answers, where[:, None, :], 1)[:, 0])
        d_logits = np.exp(logp)
        d_logits[np.arange(len(x)), y] -= 1
        d_logits /= len(x)
        d_found = (d_logits @ self.w["out"].T) * (found > 0)
        seen = self.fields(x)[rows, where]  # (windows, filters, field): the only places that a gradient reaches
        d_bank = np.einsum("bf,bfe->ef", d_found, seen) * self.mask()
        d_seen = d_found[:, :, None] * self.w["bank"].T[None]
        d_embed = np.zeros_like(self.w["embed"])
        for k in range(WIDTHS[-1]):
            np.add.at(d_embed, x[rows, where + k], d_seen[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
        return {"embed": d_embed, "bank": d_bank, "bias": d_found.sum(0), "out": found.T @ d_logits, "shift": d_logits.sum(0)}

    def packed(self) -> bytes:
        return b"".join(self.w[k].astype("<f4").tobytes() for k in ("embed", "bank", "bias", "out", "shift"))

    @classmethod
    def unpacked(cls, langs: list[str], blob: bytes) -> Network:
        flat, n = np.frombuffer(blob, "<f4"), FILTERS * len(WIDTHS)
        shapes = {"embed": (256, EMBEDDING), "bank": (WIDTHS[-1] * EMBEDDING, n), "bias": (n,), "out": (n, len(langs)), "shift": (len(langs),)}
        weights, at = {}, 0
        for name, shape in shapes.items():
            size = int(np.prod(shape))
            weights[name] = flat[at : at + size].reshape(shape)
            at += size
        return cls(langs, weights)


def fit(texts: list[str], labels: list[str]) -> Network:
    """A network by Adam on the texts' windows. One text in eight is learned in capitals too, one window in four is cut short each time."""
    langs = sorted(set(labels))
    place = {lang: i for i, lang in enumerate(langs)}
    padded, y = [], []
    for i, (text, label) in enumerate(zip(texts, labels)):
        for form in {text, text.upper()} if i % 8 == 0 else {text}:
            made = windows(form.encode("utf-8", "surrogatepass"))
            padded.append(made)
            y += [place[label]] * (len(made) // WINDOW)
    x, y = as_matrix(b"".join(padded)), np.array(y, "i8")
    rng = np.random.default_rng(SEED)
    net = Network.fresh(langs, rng)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step, epochs = 0, max(EPOCHS, -(-LEAST_STEPS * BATCH // len(x)))
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            step += 1
            batch = x[at].copy()
            for i in np.flatnonzero(rng.random(len(batch)) < 0.25):
                batch[i, rng.integers(4, WINDOW) :] = PAD
            rate = RATE * (1 - epoch / epochs)
            for k, g in net.gradients(batch, y[at]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype("f4")
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame) -> DataFrame:
    """lang and an excerpt of the documents to learn from: hashes under a bound by the language's count first, then the least of them."""
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n"))
    counts = stored(counts.orderBy(F.col("n").desc(), "of").limit(MAX_LANGS), "langs")
    under = F.pmod(hashed, F.lit(1_000_000)) * F.col("n") < 2_000_000 * SAMPLE_DOCS
    begin = F.pmod(F.xxhash64(hashed), F.greatest(F.lit(1), F.char_length("text") - SAMPLE_CHARS)) + 1
    excerpts = (
        labelled.join(small_side(counts), F.col("lang") == F.col("of"))
        .where(under)
        .select("lang", hashed.alias("key"), F.col("text").substr(begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("excerpt"))
    )
    least = Window.partitionBy("lang").orderBy("key", "excerpt")
    return excerpts.withColumn("place", F.row_number().over(least)).where(F.col("place") <= SAMPLE_DOCS).select("lang", "excerpt")


def learn(docs: DataFrame) -> Network | None:
    """The network; None if no document can be learned from."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "excerpt"])
        net = fit(list(rows["excerpt"]), list(rows["lang"]))
        return pd.DataFrame({"langs": [net.langs], "weights": [net.packed()]})

    fitted = sample(docs).where(F.col("excerpt") != "").groupBy().applyInPandas(run, "langs array<string>, weights binary").first()
    return None if fitted is None else Network.unpacked(list(fitted["langs"]), bytes(fitted["weights"]))


_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def judge(net: Network, texts: list[bytes]) -> list[tuple[str, float]]:
    """Language and score of texts that have letters."""
    sums = np.zeros((len(texts), len(net.langs)))
    held, owner, weight = [], [], []

    def settle() -> None:
        logp = net.log_probabilities(as_matrix(b"".join(held)))
        np.add.at(sums, np.array(owner), logp * np.array(weight, "f8")[:, None])
        held.clear(), owner.clear(), weight.clear()

    for i, text in enumerate(texts):
        for at in range(0, len(text), WINDOW * BLOCK):
            part = text[at : at + WINDOW * BLOCK]
            held.append(windows(part))
            n = -(-len(part) // WINDOW)
            owner += [i] * n
            weight += [WINDOW] * (n - 1) + [len(part) - WINDOW * (n - 1)]
            if len(owner) >= BLOCK * 8:
                settle()
    if held:
        settle()
    means = sums / np.array([len(t) for t in texts])[:, None]
    p = np.exp(means - means.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return [(net.langs[k], float(p[i, k])) for i, k in enumerate(p.argmax(1))]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    langs, blob = ([], b"") if net is None else (net.langs, net.packed())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.unpacked(langs, blob) if langs else None
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [("und", 0.0)] * len(texts)
            held, size = {}, 0
            for i, text in enumerate(texts):
                text = text.as_py()
                if model and text and has_letter(text):
                    held[i] = text
                    size += len(text)
                if held and (size >= 1 << 20 or i + 1 == len(texts)):
                    for j, answer in zip(held, judge(model, list(held.values()))):
                        found[j] = answer
                    held, size = {}, 0
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """The language of every document, by a network learned from those with a label."""
    return predict(docs, learn(docs))
