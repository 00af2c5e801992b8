"""Phrases and collocations by Toivonen's sampling: a sample proposes, one pass counts proposals and their negative border, further passes follow where the border fails.

* Sample: every ``sample``-th block of every document, from a start that hangs on its id. Phrases that reach the scaled-down support there, less some deviations, are proposed,
  level by level.
* Pass: counts, exactly and over all texts, every phrase whose two parts without the last and without the first word are proposed: the proposals and their negative
  border. Words are all counted.
* Closure: a counted phrase with enough occurrences that was not proposed is a border failure. Failures join the proposals, and a further pass counts them, the phrases that have become
  reachable and all that grows from them, and no others, until no pass finds a failure. A phrase with enough occurrences has parts with enough, so none is missed, whatever the
  sample holds.

Proposals are looked up in a Bloom filter of bounded size (``MAX_BITS``). A phrase that it takes for a proposal is treated as one: it is counted exactly all the same, and the
test for failures asks the same filter. Counts are summed in each slice of a task, travel packed by ranges of hashes, and are summed there; proposed phrases travel with
their words, so they are counted as they are, the border by 48-bit hashes alone, and what fails there is counted as it is in the next pass. Phrases and counts stay distributed.

Scores come from joins of candidates with their parts in exact decimals. Words: A-Z lower-cased, pieces end at ``.,;:!?`` and 10 to 13, words are runs of other characters than space and tab. Everything
is per language; a null language is ``und``, and joins an ``und`` of its own. Null, empty and blank texts have no words. Rows repeat as they are and count as often; null ids start where the
empty id does. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swaplens.llm.common import chunks_for, text_bytes
from swaplens.plans.scale import stored

LONGEST = 5  # words of a phrase
SAMPLE, SAMPLE_BLOCK = 8, 128  # one block of so many, in bytes
DEVIATIONS = 2.5  # by which the sample's support lies below the expected one
SLICE_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20  # of text that is counted at once, and whose phrases one task sums
MIN_BITS, MAX_BITS, PROBES, BLOCK = 1 << 20, 1 << 28, 3, 1 << 13

_MARKS = bytes.maketrans(b",;:!?\n\r\x0b\x0c", b"." * 9)


class _Vocabulary(dict):
    """Numbers of words from 1 on, and their hashes; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def tokens_of(text: bytes) -> list[bytes]:
    """Words, and a full stop at each end of a piece."""
    return text.lower().translate(_MARKS).replace(b".", b" . ").split()


def in_parts(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in parts that end where pieces do; a piece longer than the limit stays whole."""
    begin = 0
    if len(text) > limit:
        text = text.translate(_MARKS)
    while len(text) - begin > limit:
        cut = text.rfind(b".", begin, begin + limit)
        cut = text.find(b".", begin + limit) if cut < 0 else cut
        if cut < 0:
            break
        yield text[begin : cut + 1]
        begin = cut + 1
    yield text[begin:]


def sampled(text: bytes, doc_id: object, of: int) -> bytes:
    """Every ``of``-th block of a text, cut at spaces, so that a phrase which one long piece repeats is in the sample as often as others."""
    start = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % of
    out = []
    for at in range(start * SAMPLE_BLOCK, len(text), of * SAMPLE_BLOCK):
        block = text[at : at + SAMPLE_BLOCK]
        begin = block.find(b" ") + 1 if at else 0
        end = block.rfind(b" ") if at + SAMPLE_BLOCK < len(text) else len(block)
        out.append(block[begin:end] if begin or not at else b"")
    return b".".join(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    step = _mixed(keys) | np.uint64(1)
    for k in range(PROBES):
        yield (keys + np.uint64(k) * step) % np.uint64(bits)


class Bloom:
    """A set of phrases by the leading 48 bits of their hashes, and some more."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in _probes(h >> np.uint64(16), 8 * len(self.bits)):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("u1")) & 1 == 1
        return found


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one word more."""
    return _mixed(h * np.uint64(0x9E3779B97F4A7C15) + word)


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


class Counter:
    """Counts the phrases of one language's texts, level by level, in numpy."""

    def __init__(self, lang: str, old: Bloom | None, new: Bloom, ahead: bool = False):
        """``new`` holds the proposals, ``old`` those of the pass before (None: there was none). With ``ahead``, whatever is counted for the first time counts as proposed."""
        self.lang, self.old, self.new, self.ahead = lang, old, new, ahead

    def count(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
        """(words, hashes in their order, phrases, counts, whether proposed) per length."""
        vocabulary = _Vocabulary()
        parts = []
        for text in texts:
            tokens = tokens_of(text)
            parts += [np.fromiter(map(vocabulary.__getitem__, tokens), "i4", len(tokens)), np.zeros(1, "i4")]
        ids = np.concatenate([*parts, np.zeros(LONGEST, "i4")])
        hashes = np.array(vocabulary.hashes, "u8")
        words = pa.array(list(vocabulary), pa.binary())
        at = np.flatnonzero(ids)  # where a phrase of this length begins
        h = _mixed(hashes[ids[at]] + np.uint64(_seed(self.lang)))
        whole = at  # places of all phrases of this length whose parts are proposed
        for size in range(1, LONGEST + 1):
            if size > 1:
                # A phrase of one word more: both its parts have to be there, at this place and the next.
                follows = np.searchsorted(whole, at + 1)
                follows[follows == len(whole)] = 0
                both = whole[follows] == at + 1 if len(whole) else np.zeros(0, bool)
                at, fresh = at[both], (fresh[both] | fresh[follows[both]])
                h = _longer(h[both], hashes[ids[at + size - 1]])
            else:
                fresh = np.full(len(at), self.old is None)
            if not len(at):
                return
            keys, first, place = np.unique(h, return_index=True, return_inverse=True)
            proposed = self.new.has(keys)
            was = np.zeros(len(keys), bool) if self.old is None else self.old.has(keys)
            if self.old is not None:  # what the pass before counted by its hash alone, and found often
                fresh |= (proposed & ~was)[place]
            counts = np.bincount(place[fresh], minlength=len(keys))
            if self.ahead:
                proposed |= counts > 0
            rows = np.column_stack([ids[at + j] for j in range(size)])
            same = (rows == rows[first][place]).all(1)
            some = np.flatnonzero(counts)
            if same.all():
                yield size, keys[some], self._phrases(words, rows[first[some]]), counts[some], proposed[some]
            else:  # two phrases of one hash: each on its own, under the same answer
                tuples, of = np.unique(np.column_stack([place, rows])[fresh], axis=0, return_counts=True)
                yield size, keys[tuples[:, 0]], self._phrases(words, tuples[:, 1:].astype("i4")), of, proposed[tuples[:, 0]]
            on = proposed[place]
            # What grows from a phrase that was not both counted and proposed before has not been counted.
            at, h, fresh = at[on], h[on], (fresh | ~was[place])[on]
            whole = at

    def _phrases(self, words: pa.Array, rows: np.ndarray) -> pa.Array:
        columns = [words.take(pa.array(rows[:, j])) for j in range(rows.shape[1])]
        if len(columns) == 1:
            return columns[0].cast(pa.string())
        return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())).cast(pa.string())


COUNTED = "lang string, words int, phrase string, a bigint, key bigint"
BLOCKS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("words", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("phrases", pa.binary())])
KEY_BYTES = 6
PROPOSED = np.uint32(1 << 31)  # beside a slice's count, which is far below


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The low bytes of all numbers, then the next ones: ascending keys and small counts pack well so."""
    return np.ascontiguousarray(numbers.astype(f"<u{numbers.itemsize}").view("u1").reshape(-1, numbers.itemsize)[:, :width].T).tobytes()


def _numbers(planes: bytes, width: int, size: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, size), "u1")
    out[:, :width] = np.frombuffer(planes, "u1").reshape(width, -1).T
    return out.view(f"<u{size}")[:, 0]


def _blocks(lang: str, counts_by_length, buckets: int) -> Iterator[pa.RecordBatch]:
    """A slice's phrases by range of their hash: hashes and counts as numbers, the proposed phrases as lines. ``words``: all words of the slice, in its first row."""
    for size, keys, phrases, counts, proposed in counts_by_length:
        lines = pc.binary_join_element_wise(phrases.filter(pa.array(proposed)).cast(pa.binary()), pa.scalar(b"", pa.binary()), pa.scalar(b"\n", pa.binary()))
        ends = np.frombuffer(lines.buffers()[1], "i4")[: len(lines) + 1] if len(lines) else np.zeros(1, "i4")
        before = np.concatenate([[0], np.cumsum(proposed)])
        data = lines.buffers()[2]
        flagged = counts.astype("u4") | np.where(proposed, PROPOSED, np.uint32(0))
        of = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # ascends with the keys
        cuts = np.searchsorted(of, np.arange(buckets + 1))
        some = [(b, i, j) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        texts = [(int(ends[before[i]]), int(ends[before[j]])) for _, i, j in some]
        words = [int(counts.sum()) if size == 1 and k == 0 else 0 for k in range(len(some))]
        columns = [
            pa.array([lang] * len(some), pa.string()),
            pa.array([b for b, _, _ in some], pa.int32()),
            pa.array(words, pa.int64()),
            pa.array([_planes(keys[i:j] >> np.uint64(16), KEY_BYTES) for _, i, j in some], pa.binary()),
            pa.array([_planes(flagged[i:j], 4) for _, i, j in some], pa.binary()),
            pa.array([data[x:y].to_pybytes() if y > x else b"" for x, y in texts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=BLOCKS)


def _totals(lang: str, blocks: pd.DataFrame, least: int) -> pd.DataFrame:
    """Of one range of hashes: the proposed phrases that occur ``least`` times, the hashes of the border that do, and the words that its blocks report.

    Hashes choose, the proposed phrases themselves are counted; equal hashes of two phrases are both proposed or both not.
    """
    keys = np.concatenate([_numbers(x, KEY_BYTES, 8) for x in blocks["keys"]])
    flagged = np.concatenate([_numbers(x, 4, 4) for x in blocks["counts"]])
    counts, proposed = flagged & ~PROPOSED, flagged >= PROPOSED
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] ^ np.uint64(1)))
    sums = np.add.reduceat(counts[order].astype("i8"), first)
    known = np.logical_or.reduceat(proposed[order], first)
    failed = (sums >= least) & ~known
    enough = np.empty(len(keys), bool)
    enough[order] = np.repeat((sums >= least) & known, np.diff(np.append(first, len(keys))))
    found: dict[bytes, int] = {}
    at = 0
    for blob, size in zip(blocks["phrases"], blocks["counts"].map(len) // 4):
        mine = np.flatnonzero(proposed[at : at + size])
        here = np.flatnonzero(enough[at + mine])
        if len(here):
            lines = blob.split(b"\n")
            for i, c in zip(here.tolist(), counts[at + mine[here]].tolist()):
                line = lines[i]
                found[line] = found.get(line, 0) + c
        at += size
    rows = [(lang, p.count(b" ") + 1, p.decode(), a, None) for p, a in found.items() if a >= least]
    rows += [(lang, None, None, a, k) for k, a in zip(keys[order[first[failed]]].tolist(), sums[failed].tolist())]
    rows.append((lang, 0, None, int(blocks["words"].sum()), None))
    return pd.DataFrame(rows, columns=["lang", "words", "phrase", "a", "key"]).astype({"words": "Int32", "key": "Int64"})


def counted(texts: DataFrame, old: Broadcast | None, new: Broadcast, least: int, buckets: int, ahead: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a pass over (lang, text) finds ``least`` times: (proposed phrases: lang, words, phrase, a; failures of the border: lang, key; words of each language: lang, n).

    Slices send packed ranges of hashes; no slice sends more blocks than phrases.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        was, now = None if old is None else Bloom(np.frombuffer(old.value, "u1")), Bloom(np.frombuffer(new.value, "u1"))
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def out(lang: str) -> Iterator[pa.RecordBatch]:
            size.pop(lang)
            return _blocks(lang, Counter(lang, was, now, ahead).count(held.pop(lang)), buckets)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                for part in in_parts(text.as_py() or b"", SLICE_BYTES):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part)
                    if sum(size.values()) >= SLICE_BYTES:
                        yield from out(max(size, key=size.get))
        for lang in list(size):
            yield from out(lang)

    def total(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        return _totals(key[0], blocks, least)

    sent = texts.mapInArrow(run, "lang string, bucket int, words bigint, keys binary, counts binary, phrases binary")
    made = stored(sent.groupBy("lang", "bucket").applyInPandas(total, COUNTED), "counted")
    words = made.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    return made.where("words > 0").select("lang", "words", "phrase", "a"), made.where("key IS NOT NULL").select("lang", "key"), words


def block_sample(texts: DataFrame, of: int) -> DataFrame:
    """lang and one block in ``of`` of each text."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            parts = [sampled(t.as_py() or b"", i, of) for i, t in zip(ids, batch.column("text").cast(pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(parts, pa.binary()).cast(pa.string())], ["lang", "text"])

    return texts.mapInArrow(take, "lang string, text string")


def with_keys(before: np.ndarray, failures: DataFrame) -> np.ndarray:
    """The bits of a filter and of further keys. Tasks send the blocks of bits that they set, which are joined by block."""
    bits = 8 * len(before)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(bits // 8, "u1")
        for batch in batches:
            for at in _probes(batch.column("key").to_numpy().astype("u8"), bits):
                np.bitwise_or.at(mine, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype("u1"))
        blocks = mine.reshape(-1, BLOCK)
        for b in np.flatnonzero(blocks.any(1)):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blocks[b].tobytes()], pa.binary())], ["block", "bits"])

    def join(part: pd.DataFrame) -> pd.DataFrame:
        both = np.bitwise_or.reduce([np.frombuffer(x, "u1") for x in part["bits"]])
        return pd.DataFrame({"block": part["block"].iloc[:1], "bits": [both.tobytes()]})

    schema = "block int, bits binary"
    out = before.copy()
    for row in failures.select("key").mapInArrow(mark, schema).groupBy("block").applyInPandas(join, schema).collect():  # MAX_BITS at most
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] |= np.frombuffer(bytes(row["bits"]), "u1")
    return out


def closed(texts: DataFrame, least: int, bits: np.ndarray, buckets: int, ahead: bool) -> tuple[DataFrame, DataFrame, np.ndarray, int]:
    """Passes until the border holds: (phrases that occur ``least`` times, words of each language, the filter with all of them, number of passes).

    With ``ahead``, passes after the first count all that grows from the failures, failures being few: those rarer than ``least`` as well.
    """
    spark = texts.sparkSession
    old, new = None, spark.sparkContext.broadcast(bits.tobytes())
    found, totals, passes = None, None, 0
    while True:
        passes += 1
        phrases, failures, words = counted(texts, old, new, least, buckets, ahead and old is not None)
        totals = words if totals is None else totals
        found = phrases if found is None else found.unionByName(phrases)
        if failures.isEmpty():
            return found, totals, bits, passes
        bits = with_keys(bits, failures)
        old, new = new, spark.sparkContext.broadcast(bits.tobytes())


def frequent_phrases(docs: DataFrame, least: int = 100, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame, int]:
    """(phrases, totals, passes): lang, words, phrase and a of every phrase of one to five words that occurs ``least`` times; lang and n of every language; passes over all texts."""
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = text_bytes(texts)
    bits = np.zeros(int(min(MAX_BITS, max(MIN_BITS, 2 ** math.ceil(math.log2(size / 64 + 1))))) // 8, "u1")
    buckets = chunks_for(size, BUCKET_BYTES)
    expected = least / sample
    support = max(1, math.ceil(expected - DEVIATIONS * math.sqrt(expected)))
    # The sample alone, level by level, from an empty filter; then all texts, from what the sample proposes.
    _, _, bits, _ = closed(stored(block_sample(texts, sample), "sample"), support, bits, chunks_for(size, sample * BUCKET_BYTES), False)
    phrases, totals, _, passes = closed(texts.select("lang", "text"), least, bits, buckets, True)
    return phrases, totals, passes


def _exact(*factors: Column) -> Column:
    out = factors[0].cast("decimal(38,0)")
    for f in factors[1:]:
        out = (out * f.cast("decimal(20,0)")).cast("decimal(38,0)")
    return out


def best_collocations(phrases: DataFrame, totals: DataFrame, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first ``top`` phrases by the score of their worst cut, without those that longer ones account for."""
    words = F.split("phrase", " ")
    candidates = phrases.where("words > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = candidates.withColumn("k", cut).select(
        "lang", "phrase", "words", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first_part"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " ").alias("rest"),
    )
    of_first = phrases.select("lang", F.col("phrase").alias("first_part"), F.col("a").alias("l"))
    of_rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cuts.join(of_first, ["lang", "first_part"]).join(of_rest, ["lang", "rest"]).join(totals, "lang").withColumns(
        {"_over": _exact(F.lit(1000), F.col("a"), F.col("n")), "_under": _exact(F.col("l"), F.col("r"))}
    ).withColumn("score", F.expr("_over div _under"))
    worst = scored.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # What a longer phrase accounts for, one with a word less accounts for too: it is enough to look one word further.
    inner = phrases.where("words > 2").select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.array(
            F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("words")), " ")
        )).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = worst.join(covered, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, sample: int = SAMPLE) -> DataFrame:
    """Each language's ``top`` phrases of two to five words by how far they exceed chance, of those that occur ``least`` times."""
    phrases, totals, _ = frequent_phrases(docs, least, sample)
    return best_collocations(stored(phrases, "frequent"), totals, top)


ORACLE = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cuts AS (SELECT lang, k, phrase, a, c, array_to_string(string_split(phrase, ' ')[:c], ' ') AS x, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS y
    FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (SELECT lang, c.k, c.phrase, c.a, c, x.a AS l, y.a AS r, n, CAST(1000 * c.a::HUGEINT * n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cuts c JOIN f x USING (lang) JOIN f y USING (lang) JOIN totals USING (lang) WHERE x.phrase = c.x AND y.phrase = c.y),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_phrases AS (SELECT lang, a, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
covered AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM worst w LEFT JOIN covered v USING (lang, phrase) WHERE v.longer IS NULL OR 100 * v.longer < 100 * a)
WHERE rank <= 2000
"""
