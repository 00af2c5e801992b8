"""A hidden Markov language model: trained by Baum-Welch counts, scored by the scaled forward recursion.

A word has a class by its first and last bytes and its length; the end of a text is a class of its own. States emit classes, classes emit words:
P(word | state) = q(class | state) * (c + 0.1) / (N of the class + 0.1 * (V of the class + 1)), with a share for unknown words in each class. The second factor does not depend on
the state, so the chain runs on classes alone, whose parameters have a fixed size however large the vocabulary; word counts stay distributed.

* Reading: a chunk of documents is cut into words once. Its texts go on as numbers of its own vocabulary, the longest first, so that documents counted together are alike.
* Word counts: a chunk sends its distinct words with counts, sorted and packed by class range, and gets their totals back in the same order.
* Training: the states start as the class frequencies of all training documents, each with seeded noise of its own. Then each pass takes the expected counts of
  all training documents in full length, sums them by class across partitions, and makes the next model of them, going ``RELAXED`` times as far as Baum-Welch
  would (as far, after a pass that lost likelihood). It ends when a pass gains less than ``GAIN`` a token, after ``passes`` at most. Passes read the classes, which are written once. A document
  of over ``LONG`` tokens keeps the forward state at every ``LEVEL * LEVEL`` th token alone, and takes the others again on the way back.
* Scoring: the scaled forward recursion over the whole text, exact for any length.

Training documents are those whose crc32 of the id as text leaves no 0 modulo 10; a null id counts as the empty text. Null, empty and blank texts have the end alone. Rows
repeat as they are and count as often. Other columns are not read; an empty table gives no rows. Without training documents all words are unknown and the states equal.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.common import chunks_for, held_out, text_bytes, words
from swaplens.plans.scale import stored

CLASSES = 16384
SEED = 7
RELAXED, GAIN = 1.5, 0.003  # GAIN in log10 a token
LEVEL = 256  # steps after which rounding errors of the backward recursion are taken out
CHUNK_BYTES, BUCKET_BYTES = 16 * 2**20, 64 * 2**20  # of text that a task reads, and whose words a task counts
TOKENS = 2**21  # whose expected counts are taken at once, or one document's
LONG = 2**20


def word_class(word: bytes) -> int:
    return zlib.crc32(word[:3] + b"|" + word[-3:] + bytes([min(len(word), 8)])) % CLASSES


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def class_ids(text: str | None) -> np.ndarray:
    """The classes of a text's tokens, the end last."""
    return np.array([*map(word_class, words(text)), CLASSES], "i4")


class Model:
    """step (from, to), start, and emit (class, state)."""

    def __init__(self, step: np.ndarray, start: np.ndarray, emit: np.ndarray):
        self.step, self.start, self.emit = step, start, emit

    @classmethod
    def of_counts(cls, step: np.ndarray, start: np.ndarray, emit: np.ndarray) -> Model:
        step, start, emit = step + 0.5, start + 0.5, emit + 0.02
        return cls(step / step.sum(1, keepdims=True), start / start.sum(), emit / emit.sum(0))

    @classmethod
    def of_frequencies(cls, counts: np.ndarray, states: int) -> Model:
        """The frequencies of the classes, times seeded noise in each state, which lets the states part."""
        background = (counts + 1.0) / (counts + 1.0).sum()
        noise = np.random.default_rng(SEED).exponential(size=(CLASSES + 1, states)) ** 4 + 0.1
        emit = background[:, None] * noise
        step = np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
        return cls(step / step.sum(1, keepdims=True), np.full(states, 1 / states), emit / emit.sum(0))

    def towards(self, after: Model, step: float) -> Model:
        """``step`` times as far as ``after``, in logarithms."""

        def go(here: np.ndarray, there: np.ndarray, axis: int) -> np.ndarray:
            out = there * (there / here) ** (step - 1)
            return out / out.sum(axis, keepdims=True)

        return Model(go(self.step, after.step, 1), go(self.start, after.start, 0), go(self.emit, after.emit, 0))

    def expected_of_long(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """As ``expected``, of one document, in blocks: memory for a block and a state per block."""
        k, size = len(self.start), LEVEL * LEVEL
        steps, emits, logs = np.zeros((k, k)), np.zeros((CLASSES + 1, k)), 0.0

        def forward(a: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
            """States of a block, from the state before it."""
            part = tokens[begin : begin + size]
            alpha, scale = np.empty((len(part), k)), np.empty(len(part))
            for t, e in enumerate(self.emit[part]):
                a = (a @ self.step if begin + t else self.start) * e
                scale[t] = a.sum()
                alpha[t] = a = a / scale[t]
            return alpha, scale

        befores, a = [], self.start
        for begin in range(0, len(tokens), size):
            befores.append(a)
            alpha, scale = forward(a, begin)
            a, logs = alpha[-1], logs + np.log(scale).sum()
        b, w = np.ones(k), None  # w: what the token behind gives its state
        for begin in range((len(tokens) - 1) // size * size, -1, -size):
            alpha, scale = forward(befores[begin // size], begin)
            part = tokens[begin : begin + size]
            emit = self.emit[part] / scale[:, None]
            for t in range(len(part) - 1, -1, -1):
                if w is not None:
                    steps += np.outer(alpha[t], w) * self.step
                    b = self.step @ w
                    b /= alpha[t] @ b
                w = b * emit[t]
                alpha[t] *= b
            for s in range(k):
                emits[:, s] += np.bincount(part, alpha[:, s], CLASSES + 1)
        return steps, alpha[0], emits, logs

    def expected(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of steps, starts and emissions, and the log-likelihood, of whole documents."""
        k = len(self.start)
        steps, starts, emits = np.zeros((k, k)), np.zeros(k), np.zeros((CLASSES + 1, k))
        documents = sorted((d for d in documents if len(d)), key=len, reverse=True)
        long = sum(len(d) > LONG for d in documents)
        if long:
            each = [self.expected_of_long(d) for d in documents[:long]] + [self.expected(documents[long:])]
            return tuple(sum(x[1:], x[0]) for x in zip(*each))
        if not documents:
            return steps, starts, emits, 0.0
        size = np.array([len(d) for d in documents], "i8")
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # documents that have a token t
        at = np.concatenate([[0], np.cumsum(active)])  # tokens lie by t, then by document
        t_of = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flat = np.empty(len(t_of), "i4")
        flat[at[t_of] + np.repeat(np.arange(len(size)), size)] = np.concatenate(documents)
        del t_of
        step = self.step.astype("f4")
        emit = self.emit.astype("f4")[flat]
        alpha, scale = np.empty((len(flat), k), "f4"), np.empty(len(flat), "f4")
        begins, counts = at.tolist(), active.tolist()
        a, ones = None, np.ones(k, "f4")
        for i, m in zip(begins, counts):
            a = np.multiply(a[:m] @ step if i else self.start.astype("f4"), emit[i : i + m], out=alpha[i : i + m])
            scale[i : i + m] = c = a @ ones
            a /= c[:, None]
        emit /= scale[:, None]
        b = np.ones((counts[-1], k), "f4")
        for t in range(len(counts) - 1, -1, -1):
            i, m = begins[t], counts[t]
            if t + 1 < len(counts):
                j = counts[t + 1]
                w = b * emit[begins[t + 1] : begins[t + 1] + j]
                steps += (alpha[i : i + j].T @ w) * step
                b = w @ step.T
                if j < m:
                    b = np.concatenate([b, np.ones((m - j, k), "f4")])
            here = alpha[i : i + m]
            if t % LEVEL == 0:
                b /= (here * b).sum(1, keepdims=True)
            here *= b
        starts += alpha[: counts[0]].sum(0)
        for s in range(k):
            emits[:, s] = np.bincount(flat, alpha[:, s], CLASSES + 1)
        return steps, starts, emits, float(np.log(scale, dtype="f8").sum())

    def log_likelihood(self, documents: list[np.ndarray]) -> np.ndarray:
        """log10 of each whole sequence of classes."""
        size = np.array([len(d) for d in documents], "i8")
        order = np.argsort(-size, kind="stable")
        size = size[order]
        flat = np.concatenate([documents[i] for i in order]) if len(documents) else np.empty(0, "i4")
        at = np.cumsum(size) - size
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")
        out = np.zeros(len(documents))
        total = np.zeros(len(documents))
        a = np.repeat(self.start[None, :], len(documents), 0)
        for t in range(longest):
            m = active[t]
            if t:
                a = a[:m] @ self.step
            a *= self.emit[flat[at[:m] + t]]
            c = a.sum(1)
            a /= c[:, None]
            total[:m] += np.log10(c)
        out[order] = total
        return out


def class_counts(documents: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(CLASSES + 1)
    for d in documents:
        total += np.bincount(d, minlength=CLASSES + 1)
    return total


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The low bytes of all numbers, then the next ones, which pack well."""
    return np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4)[:, :width].T).tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, 4), "u1")
    out[:, :width] = np.frombuffer(planes, "u1").reshape(width, -1).T
    return out.view("<u4")[:, 0]


def read_chunks(rows: DataFrame, buckets: int) -> DataFrame:
    """Two kinds of rows per chunk: documents (doc_id, held_out, ids of the chunk's words, and for training the classes, the end included), and words by bucket of
    their class (bucket, words, counts in training documents). Ids number the words by bucket, then by word."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def read(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(pc.negate(pc.fill_null(pc.binary_length(table["text"]), 0))))
        held = table["held_out"].to_pylist()
        number = _Numbers()
        texts = []
        for text in table["text"].cast(pa.binary()):
            tokens = (text.as_py() or b"").lower().split()
            texts.append(np.fromiter(map(number.__getitem__, tokens), "i4", len(tokens)))
        vocabulary = list(number)
        classes = np.fromiter(map(word_class, vocabulary), "i4", len(vocabulary))
        order = np.array(sorted(range(len(vocabulary)), key=vocabulary.__getitem__), "i8")
        order = order[np.argsort(classes[order] % buckets, kind="stable")]
        rank = np.empty(len(order), "i8")
        rank[order] = np.arange(len(order))
        counts = np.bincount(np.concatenate([np.empty(0, "i4"), *[t for t, out in zip(texts, held) if not out]]), minlength=len(order))
        cuts = np.searchsorted(classes[order] % buckets, np.arange(buckets + 1))
        some = [(b, order[i:j]) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        n, m = len(texts), len(some)
        columns = {
            "doc_id": pa.chunked_array([*table["doc_id"].chunks, pa.nulls(m, table["doc_id"].type)]),
            "held_out": pa.array(held + [None] * m, pa.bool_()),
            "chunk": pa.array([table["chunk"][0].as_py() if n else 0] * (n + m), pa.int32()),
            "ids": pa.array([_planes(rank[t], 3) for t in texts] + [None] * m, pa.binary()),
            "classes": pa.array([None if out else np.append(classes[t], CLASSES).astype("<u2").tobytes() for t, out in zip(texts, held)] + [None] * m, pa.binary()),
            "bucket": pa.array([None] * n + [b for b, _ in some], pa.int32()),
            "words": pa.array([None] * n + [b" ".join(vocabulary[i] for i in at) for _, at in some], pa.binary()),
            "counts": pa.array([None] * n + [counts[at].astype("<i8").tobytes() for _, at in some], pa.binary()),
        }
        return pa.table(columns)

    schema = f"doc_id {kind}, held_out boolean, chunk int, ids binary, classes binary, bucket int, words binary, counts binary"
    return stored(rows.groupBy("chunk").applyInArrow(read, schema), "chunks", "zstd")


def _summed(classes: DataFrame, width: int, count) -> np.ndarray:
    """The sums over all rows of ``count``'s arrays, which have ``width`` columns. Each partition gives the rows that are not zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: np.ndarray | int = 0
        held, size = [], 0
        for batch in batches:
            for blob in batch["classes"]:
                held.append(np.frombuffer(blob, "<u2"))
                size += len(held[-1])
                if size >= TOKENS:
                    total, held, size = total + count(held), [], 0
        if held:
            total = total + count(held)
        if isinstance(total, np.ndarray):
            some = np.flatnonzero(total.any(1))
            out = pd.DataFrame(total[some].astype("f4"), columns=[f"s{i}" for i in range(width)])
            out.insert(0, "row", some)
            yield out

    schema = "row int, " + ", ".join(f"s{i} float" for i in range(width))
    sums = classes.mapInPandas(run, schema).groupBy("row").agg(*[F.sum(f"s{i}") for i in range(width)]).collect()  # states + 1 + CLASSES + 1 rows at most
    every = np.zeros((width + CLASSES + 3, width))
    for r in sums:
        every[r[0]] = r[1:]
    return every


def baum_welch_pass(classes: DataFrame, model: Model) -> tuple[Model, float]:
    """The next model, from the expected counts of all training rows, and the log10 likelihood of the present one."""
    k = len(model.start)

    def count(documents: list[np.ndarray]) -> np.ndarray:
        steps, starts, emits, logs = model.expected(documents)
        return np.concatenate([steps, starts[None, :], emits, np.full((1, k), logs / np.log(10))])

    every = _summed(classes, k, count)
    return Model.of_counts(every[:k], every[k], every[k + 1 : -1]), every[-1, 0]


def train(classes: DataFrame, states: int, passes: int) -> Model:
    counts = _summed(classes, 1, lambda documents: class_counts(documents)[:, None])[: CLASSES + 1, 0]
    model, likelihood = Model.of_frequencies(counts, states), -np.inf
    for _ in range(passes):
        after, here = baum_welch_pass(classes, model)
        gain = (here - likelihood) / max(1, counts.sum())
        if 0 <= gain < GAIN:
            return after
        model, likelihood = after if gain < 0 else model.towards(after, RELAXED), here
    return model


ANSWER = "chunk int, bucket int, counts binary, classes binary, weights binary, total bigint, distinct bigint"


def word_counts(sent: DataFrame, buckets: int) -> DataFrame:
    """Per chunk and bucket of classes: the counts of the chunk's words over all training rows, and the weight of each of the bucket's classes (N + 0.1 (V + 1)).
    ``total`` and ``distinct`` are the bucket's training tokens and words, on its first row."""

    def total(part: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        ids, sums = [], []
        for blob, counts in zip(part["words"], part["counts"]):
            ids.append(np.array([number.setdefault(w, len(number)) for w in blob.split(b" ")], "i8"))
            sums.append(np.frombuffer(counts, "<i8"))
        c = np.zeros(len(number), "i8")
        np.add.at(c, np.concatenate(ids), np.concatenate(sums))
        classes = np.fromiter(map(word_class, number), "i8", len(number))
        place, size = classes // buckets, -(-CLASSES // buckets)
        weights = np.bincount(place, c, size) + 0.1 * (np.bincount(place, c > 0, size) + 1)
        out = part[["chunk", "bucket"]].copy()
        out["counts"] = [c[i].astype("<i8").tobytes() for i in ids]
        out["classes"] = [classes[i].astype("<u2").tobytes() for i in ids]
        out["weights"] = weights.astype("<f8").tobytes()
        out["total"], out["distinct"] = 0, 0
        out.loc[out.index[0], ["total", "distinct"]] = int(c.sum()), int((c > 0).sum())
        return out

    return sent.groupBy("bucket").applyInPandas(total, ANSWER)


SCORED = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(docs: DataFrame, states: int = 8, passes: int = 14) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigram) and score (log10 of the model's probability) of every document."""
    size = text_bytes(docs)
    n, buckets = chunks_for(size, CHUNK_BYTES), chunks_for(size, BUCKET_BYTES)
    rows = docs.select("doc_id", "text", held_out(10).alias("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("chunk"))
    read = read_chunks(rows, buckets)
    model = train(read.where("classes IS NOT NULL").select("classes"), states, passes)
    sent = read.where("bucket IS NOT NULL").select("chunk", "bucket", "words", "counts")
    answers = stored(word_counts(sent, buckets), "answers", "zstd")
    ends = rows.where("NOT held_out").count()
    sums = answers.agg(F.sum("total"), F.sum("distinct")).first()
    n_all, v_all = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(part: pa.Table, answer: pa.Table) -> pa.Table:
        answer = answer.sort_by("bucket").to_pydict()
        # The end's place is the last. Words come in the order of their numbers.
        counts = np.concatenate([np.empty(0, "i8"), *[np.frombuffer(x, "<i8") for x in answer["counts"]], [ends]]).astype("i8")
        classes = np.concatenate([np.empty(0, "u2"), *[np.frombuffer(x, "<u2") for x in answer["classes"]], [CLASSES]]).astype("i4")
        weights = np.ones(CLASSES + 1)
        for b, x in zip(answer["bucket"], answer["weights"]):
            of_bucket = np.arange(b, CLASSES, buckets)
            weights[of_bucket] = np.frombuffer(x, "<f8")[: len(of_bucket)]
        base = np.log10((counts + 0.1) / (n_all + 0.1 * (v_all + 1)))
        factors = np.log10((counts + 0.1) / weights[classes])
        factors[-1] = 0.0  # the end is the only word of its class
        end = len(counts) - 1
        ids = [np.append(_numbers(x.as_py(), 3), end).astype("i4") for x in part["ids"]]
        likelihood = model.log_likelihood([classes[i] for i in ids])
        return pa.table(
            {
                "doc_id": part["doc_id"],
                "held_out": part["held_out"],
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "n_known": pa.array([int((counts[i] > 0).sum()) for i in ids], pa.int64()),
                "train_tokens": pa.array([n_all] * len(ids), pa.int64()),
                "base_score": pa.array([float(base[i].sum()) for i in ids], pa.float64()),
                "score": pa.array([float(x) + float(factors[i].sum()) for x, i in zip(likelihood, ids)], pa.float64()),
            }
        )

    texts = read.where("ids IS NOT NULL").select("doc_id", "held_out", "ids", "chunk")
    return texts.groupBy("chunk").cogroup(answers.select("chunk", "bucket", "counts", "weights", "classes").groupBy("chunk")).applyInArrow(score, f"doc_id {kind}, {SCORED}")
