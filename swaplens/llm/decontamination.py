"""Benchmark decontamination: every document is a query against a BM25 index of the test items' questions and answers.

Question and answer may stand anywhere in a document, so a query is the whole document: those of its words that stand in a shingle of some item.
A part's score is its BM25 score, divided by the score it has for its own text. A part with 80 % of its shingles reaches the threshold wherever they
stand: it is 0.6, or what is left of the own score without the shingles that may be missing, if that is less; impacts are scaled to have
one threshold for all. Block-max WAND retrieves every part at or above it: a cursor per word walks its postings by part;
the words' maxima give the pivot, the maxima of the blocks that hold the pivot decide whether it is scored. Queries of many words add up their postings instead.

An item whose parts are all retrieved is verified against the document: of the five-word shingles of its question and of its answer, 80 % each must
occur. Items that come as one text have their first half as question and the other as answer; a part of fewer words is one shingle.

The index goes to the executors in blocks of ``block_bytes`` of items, each with
statistics of its own and one pass over the documents, so its size is bounded whatever the benchmark's. Null, empty and blank items and
texts match nothing. Items and documents that repeat give a row for each. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.common import chunks_for, text_bytes, words

STRIDE = 64
BLOCK_BYTES = 4 * 2**20
WIDE = 512  # words of a query from which postings are added up


def _shingles(tokens: list[bytes], q: int) -> set[tuple]:
    if len(tokens) <= q:
        return {tuple(tokens)} if tokens else set()
    return set(zip(*[tokens[k:] for k in range(q)]))


def _hashes(terms: np.ndarray, width: int) -> np.ndarray:
    """A hash of the words at each place and the next ones; equal for equal words."""
    n = max(0, len(terms) - width + 1)
    out = np.zeros(n, "u8")
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + terms[k : k + n].astype("u8") + np.uint64(1)
    return out


class Index:
    """Inverted index of the items' parts with block maxima."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = 0.6, q: int = 5, overlap: float = 0.8, block: int = 16, k1: float = 1.2, b: float = 0.75, common: float = 0.25):
        self.threshold, self.q, self.overlap = threshold, q, overlap
        self.item_ids, self.parts, pieces, of_piece, self.owner = [], [], [], [], []
        for item_id, text in items:
            tokens = words(text)
            if not tokens:
                continue
            half = (len(tokens) + 1) // 2
            self.parts.append((_shingles(tokens[:half], q), _shingles(tokens[half:], q)))
            for part, shingles in zip((tokens[:half], tokens[half:]), self.parts[-1]):
                if part:
                    pieces.append(Counter(part))
                    of_piece.append(shingles)
                    self.owner.append(len(self.item_ids))
            self.item_ids.append(item_id)
        df = Counter(w for p in pieces for w in p)
        mean = sum(map(len, pieces)) / max(1, len(pieces))
        self.own: list[float] = []
        self.least: list[float] = []
        impact: dict[bytes, list[tuple[int, float]]] = {}
        for i, piece in enumerate(pieces):
            size = sum(piece.values())
            score = {
                w: np.log(1 + (len(pieces) - df[w] + 0.5) / (df[w] + 0.5)) * n * (k1 + 1) / (n + k1 * (1 - b + b * size / mean))
                for w, n in piece.items()
            }
            own = sum(score.values())
            # What the shingles that may be missing can take: each word's score is dealt over the shingles that hold it.
            holds = Counter(w for g in of_piece[i] for w in set(g))
            dealt = sorted((sum(score[w] / holds[w] for w in set(g)) for g in of_piece[i]), reverse=True)
            left = sum(dealt[len(dealt) - ceil(overlap * len(dealt)) :])
            self.least.append(max(1e-12, min(threshold, left / own)))
            self.own.append(own)
            for w, x in score.items():
                impact.setdefault(w, []).append((i, x / own * threshold / self.least[-1]))
        self.term: dict[bytes, int] = {w: t for t, w in enumerate(impact)}
        self.items = [[i for i, _ in p] for p in impact.values()]
        self.impacts = [[x for _, x in p] for p in impact.values()]
        self.most = [max(x) for x in self.impacts]
        self.known: dict[int, np.ndarray] = {}
        for width in {len(g) for shingles in of_piece for g in shingles}:
            grams = np.array([[self.term[w] for w in g] for shingles in of_piece for g in shingles if len(g) == width], "i4")
            self.known[width] = np.unique(_hashes(grams.reshape(-1), width)[::width])
        self.block = block
        self.block_most = [[max(x[k : k + block]) for k in range(0, len(x), block)] for x in self.impacts]
        # Common words: those whose impacts together stay below ``common`` in every item, the most frequent first.
        spent = np.zeros(len(pieces))
        groups = max(1, min(64, len(pieces) // 4))
        rare = np.zeros((len(self.items) + 1, groups), "f4")  # the last row is for words that no item has
        for t in sorted(range(len(self.items)), key=lambda t: -len(self.items[t])):
            if all(spent[i] + x < common for i, x in zip(self.items[t], self.impacts[t])):
                spent[self.items[t]] += self.impacts[t]
            else:
                np.maximum.at(rare[t], np.array(self.items[t]) % groups, np.array(self.impacts[t], "f4"))
        self.rare, self.rare_least = rare, threshold - spent.max(initial=0.0) - 1e-4

    def windows(self, terms: np.ndarray) -> list[int]:
        """Starts of the windows of 128 words whose rare words alone might lift a part of some group to the threshold; for callers that
        look for passages, since a document's leaks need not stand in one window."""
        half = np.add.reduceat(self.rare[terms], np.arange(0, len(terms), STRIDE), axis=0)
        both = half[:-1] + half[1:] if len(half) > 1 else half
        return (np.flatnonzero(both.max(axis=1) >= self.rare_least) * STRIDE).tolist()

    def query(self, terms: np.ndarray) -> list[int]:
        """The distinct words that stand in a shingle of some item."""
        own: set[int] = set()
        for width, known in self.known.items():
            have = _hashes(terms, width)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, have), len(known) - 1)] == have)
            own.update(terms[at[:, None] + np.arange(width)].reshape(-1).tolist())
        own.discard(len(self.items))
        return list(own)

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All (piece, score) with a score at or above the threshold for these distinct words."""
        least, found, n = self.threshold - 1e-9, [], self.block
        if len(terms) > WIDE:
            scores = np.zeros(len(self.owner))
            for t in terms:
                scores[self.items[t]] += self.impacts[t]
            return [(i, scores[i]) for i in np.flatnonzero(scores >= least).tolist()]
        cursors = [[self.items[t][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            upto = [c for c in cursors if c[0] <= item]
            if cursors[0][0] == item:
                if sum(self.block_most[c[2]][c[1] // n] for c in upto) >= least:
                    score = sum(self.impacts[c[2]][c[1]] for c in upto)
                    if score >= least:
                        found.append((item, score))
                    target = item + 1
                else:  # no item up to the end of the nearest block, or to the next cursor, can reach it
                    ends = [self.items[c[2]][min(len(self.items[c[2]]), (c[1] // n + 1) * n) - 1] for c in upto]
                    target = max(item + 1, min([e + 1 for e in ends] + [c[0] for c in cursors if c[0] > item][:1]))
            else:
                target = item
                upto = cursors[:pivot]
            for c in upto:
                items = self.items[c[2]]
                c[1] = bisect_left(items, target, c[1])
                c[0] = items[c[1]] if c[1] < len(items) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def leaks(self, text: str | None) -> list[tuple]:
        """(item_id, score, question hits and shingles, answer hits and shingles) of each verified item."""
        tokens = words(text)
        if not tokens or not self.items:
            return []
        none, get = len(self.items), self.term.get
        terms = np.fromiter((get(w, none) for w in tokens), "i4", len(tokens))
        retrieved: dict[int, list[tuple[float, float]]] = {}
        for piece, score in self.retrieve(self.query(terms)):
            own = self.own[piece]
            retrieved.setdefault(self.owner[piece], []).append((score / self.threshold * self.least[piece] * own, own))
        out, sets = [], {}
        for item in sorted(retrieved):
            if len(retrieved[item]) < sum(map(bool, self.parts[item])):
                continue
            score, own = map(sum, zip(*retrieved[item]))
            counts = []
            for part in self.parts[item]:
                width = len(next(iter(part), ()))
                if width and width not in sets:
                    sets[width] = set(zip(*[tokens[k:] for k in range(width)]))
                counts += [len(part & sets[width]) if width else 0, len(part)]
            if counts[0] >= self.overlap * counts[1] and counts[2] >= self.overlap * counts[3]:
                out.append((self.item_ids[item], float(score / own), *counts))
        return out


def indexes(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, **options) -> Iterator[Index]:
    """One index after the other, each of about ``block_bytes`` of items."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    n = chunks_for(text_bytes(items), block_bytes)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield Index([(r["item_id"], r["text"]) for r in rows], **options)


LEAKS = "item_id bigint, score double, question_hits bigint, question_shingles bigint, answer_hits bigint, answer_shingles bigint"


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """One row per document and verified item: doc_id, item_id, the share of the item's own score, hits and shingles of question and answer."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def search(index: Index) -> DataFrame:
        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids = batch["doc_id"]
                found = [(k, *leak) for k, t in enumerate(batch["text"]) for leak in index.leaks(t if isinstance(t, str) else None)]
                out = pd.DataFrame(found, columns=["k", *(c.split()[0] for c in LEAKS.split(", "))])
                out.insert(0, "doc_id", ids.iloc[out.pop("k").astype("i8")].to_numpy())
                yield out

        return docs.select("doc_id", "text").mapInPandas(find, f"doc_id {kind}, {LEAKS}")

    return reduce(DataFrame.union, [search(i) for i in indexes(benchmark, block_bytes, **options)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """The documents without a verified item, all columns as they are."""

    def drop(docs: DataFrame, index: Index) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not index.leaks(t.as_py()) for t in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)

    return reduce(drop, indexes(benchmark, block_bytes, **options), docs)


ORACLE = """
WITH lower AS (SELECT *, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words FROM lower),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[ \\x09-\\x0D]+'), lambda x: x <> '') AS words FROM benchmark),
halves AS (SELECT item_id, words[:(len(words) + 1) // 2] AS question, words[(len(words) + 1) // 2 + 1:] AS answer FROM iw),
parts AS (SELECT item_id, 'q' AS part, question AS words FROM halves UNION ALL SELECT item_id, 'a', answer FROM halves),
wanted AS (SELECT item_id, part, unnest(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')))) AS g FROM parts),
totals AS (SELECT item_id, count(*) FILTER (part = 'q') AS question_shingles, count(*) FILTER (part = 'a') AS answer_shingles FROM wanted GROUP BY item_id),
have AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')))) AS g FROM dw),
hits AS (SELECT doc_id, item_id, count(*) FILTER (part = 'q') AS question_hits, count(*) FILTER (part = 'a') AS answer_hits
  FROM have JOIN wanted USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, question_hits, question_shingles, answer_hits, answer_shingles FROM hits JOIN totals USING (item_id)
WHERE question_hits >= 0.8 * question_shingles AND answer_hits >= 0.8 * answer_shingles
"""
