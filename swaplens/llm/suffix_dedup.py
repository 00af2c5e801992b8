"""Removal of repeated byte strings by enhanced suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it starts earlier as well: in a document of smaller id, or before in the same one.

* Anchors: of the grams of ``GRAM`` bytes in a window of ``LENGTH`` bytes, those with the least hash. Equal windows have equal anchors at equal places, so
  suffixes are only compared where they start at the same anchor, and the suffix array holds one suffix in about 35.
* An anchor's context is all of its document that a window around it can reach. Chunks send keys of their distinct contexts, 32 bits of the anchor's hash and 96 of the context's, packed by anchor; where the same context
  occurs earlier, all of it goes. What is left are contexts that share their anchor with a different one: the borders of repeats.
* Those meet by anchor. Suffixes at the anchors are sorted, and neighbours' common prefixes are scanned with a stack, which gives the interval tree: each interval is
  a right extension with all its occurrences. In each, occurrences are sorted by what stands to their left, and the same scan tells the groups whose
  left extensions part there: the maximal repeats. All but a group's first occurrence lose the repeat.

An anchor with over ``HOT`` contexts would bring them all to one task. Its windows are told apart by their hash instead: for each of the places an anchor can
have in a window, a chunk sends the first of its equal windows, dealt by the hash, and all but the first of all chunks are lost. These are the same spans.

Copies send a context once per chunk, so a hot passage counts by chunks, not by documents, in all but the contexts that cross its borders.

Texts that wait for their border contexts are packed by zstandard, some megabytes together, and the first pass's shuffles go once its output is written, so that the disk
holds either the texts and keys or the borders and packed texts, not both.

Texts are UTF-8 bytes; null is empty. Documents under ``LENGTH`` bytes stay whole. Null ids come last. Rows with one id are ordered by a hash of id and text, and
repeated rows follow each other, so all but the first are removed if long enough. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swaplens.llm.common import chunks_for, text_bytes
from swaplens.plans.scale import run_dir, shuffles_removed

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM  # how far an anchor can stand from its window's start
CHUNK_BYTES, SLICE_BYTES = 8 * 2**20, 2**20
HOT = 4096  # distinct contexts from which an anchor's windows are dealt by their hash
WIDE = 16  # members from which an interval is cut by arrays
UNKNOWN = np.iinfo("i8").max
LOW = np.uint64(0xFFFFFFFF)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x, have = pick(x[:-have], x[have:]), have * 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    h, base, have = data.astype("u8") + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while have < GRAM:
        h, base, have = h[:-have] * np.uint64(base) + h[have:], base * base % 2**64, have * 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.maximum(h, np.uint64(1))


def anchors(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and gram hashes of the anchors of each text."""
    none = (np.empty(0, "i8"), np.empty(0, "u8"))
    out = [none] * len(texts)
    group: list[int] = []
    size = 0
    for k in range(len(texts) + 1):
        if k < len(texts) and len(texts[k]) >= LENGTH:
            group.append(k)
            size += len(texts[k])
        if not group or (k < len(texts) and size < SLICE_BYTES):
            continue
        data = np.frombuffer(b"".join(texts[i] for i in group), "u1")
        ends = np.cumsum([len(texts[i]) for i in group])
        h = gram_hashes(data)
        least = _slide(h, REACH + 1, np.minimum)
        for end in ends[:-1]:
            least[end - LENGTH + 1 : end] = 0  # windows that cross a document's end
        most = _slide(np.concatenate([np.zeros(REACH, "u8"), least, np.zeros(REACH, "u8")]), REACH + 1, np.maximum)
        at = np.flatnonzero(most == h)
        cuts = np.searchsorted(at, ends)
        first = 0
        for i, cut, end in zip(group, cuts, ends):
            here = at[first:cut]
            out[i] = (here - (end - len(texts[i])), h[here])
            first = cut
        group, size = [], 0
    return out


def _new(sorted_keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    return np.concatenate([np.ones(min(1, len(sorted_keys)), bool), (sorted_keys[1:] != sorted_keys[:-1]).any(1)])


class Chunk:
    """The documents of a chunk in order, with their anchors and the first of each distinct context."""

    def __init__(self, docs: pd.DataFrame, buckets: int):
        docs = docs.assign(order=docs["doc_id"].astype("Int64").fillna(UNKNOWN).astype("i8")).sort_values(["order", "rowkey"], kind="stable")
        self.doc_ids, self.order = docs["doc_id"].tolist(), docs["order"].to_numpy()
        self.texts = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in docs["text"]]
        found = anchors(self.texts)
        sizes = [len(p) for p, _ in found]
        self.doc = np.repeat(np.arange(len(found)), sizes)
        self.at = np.concatenate([np.empty(0, "i8"), *[p for p, _ in found]])
        self.gram = np.concatenate([np.empty(0, "u8"), *[h for _, h in found]])
        length = np.array([len(t) for t in self.texts], "i8")[self.doc]
        self.low, self.high = np.maximum(0, self.at - REACH), np.minimum(length, self.at + LENGTH)
        digest, texts = xxhash.xxh3_128_digest, self.texts
        self.context = np.frombuffer(
            b"".join([digest(texts[d][i:j], p - i) for d, p, i, j in zip(self.doc.tolist(), self.at.tolist(), self.low.tolist(), self.high.tolist())]), "<u8"
        ).reshape(-1, 2).copy()
        self.context[:, 1] = self.context[:, 1] & ~LOW | self.gram & LOW  # equal contexts have equal anchors, so the key can hold the anchor's bits as well
        by = np.lexsort((self.context[:, 1], self.context[:, 0]))
        first = by[_new(self.context[by])]
        self.bucket = (self.gram >> np.uint64(32)) % np.uint64(buckets)
        first.sort()
        self.first = first[np.argsort(self.bucket[first], kind="stable")]  # by bucket, then in order

    def blocks(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        cuts = np.searchsorted(self.bucket[self.first], np.arange(buckets + 1, dtype="u8"))
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if j > i:
                yield b, self.first[i:j]


SENT = "chunk int, bucket int, contexts binary, orders binary"


def repeated_contexts(rows: DataFrame, buckets: int, hot: int = HOT) -> DataFrame:
    """Per chunk and bucket a byte for each distinct context: 1 if it occurs earlier elsewhere, 2 if it is one of several contexts of its anchor, 3 if of over ``hot``, else 0."""

    def send(docs: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(docs, buckets)
        out = [
            (b, chunk.context[i].tobytes(), np.diff(chunk.order[chunk.doc[i]], prepend=0).tobytes())
            for b, i in chunk.blocks(buckets)
        ]
        made = pd.DataFrame(out, columns=["bucket", "contexts", "orders"])
        made.insert(0, "chunk", docs["chunk"].iloc[0] if len(docs) else 0)
        return made

    def judge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        context = np.concatenate([np.frombuffer(x, "<u8").reshape(-1, 2) for x in part["contexts"]])
        gram = context[:, 1] & LOW
        orders = [np.cumsum(np.frombuffer(x, "i8")) for x in part["orders"]]
        sizes = [len(x) for x in orders]
        rank = np.lexsort((np.repeat(part["chunk"].to_numpy(), sizes), np.concatenate(orders), context[:, 1], context[:, 0]))
        flag = np.ones(len(context), "u1")
        flag[rank[_new(context[rank])]] = 0
        leaders = np.flatnonzero(flag == 0)
        _, place, count = np.unique(gram[leaders], return_inverse=True, return_counts=True)
        flag[leaders[count[place] > 1]] = 2
        flag[leaders[count[place] > max(1, hot)]] = 3
        out = part[["chunk", "bucket"]].copy()
        out["flags"] = [x.tobytes() for x in np.split(flag, np.cumsum(sizes)[:-1])]
        return out

    return rows.groupBy("chunk").applyInPandas(send, SENT).groupBy("bucket").applyInPandas(judge, "chunk int, bucket int, flags binary")


def _merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint runs, ascending, of (start, end) rows."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.concatenate([new[1:], [True]])]], 1)


def _result(text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
    spans = _merged(spans)
    kept, at = hashlib.sha256(), 0
    for i, j in spans.tolist():
        kept.update(text[at:i])
        at = j
    kept.update(text[at:])
    return len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest()


DONE = "kind string, chunk int, number int, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
WINDOW = np.dtype([("k0", "<u8"), ("k1", "<u8"), ("order", "<i8"), ("doc", "<i4"), ("start", "<i4")])
MADE = f"{DONE}, text binary, bucket int, places binary, contexts binary"
WAITS = np.dtype([("number", "<i8"), ("known", "<i8"), ("doc_id", "<i8"), ("size", "<i8"), ("spans", "<i8")])


def _packed(waits: list[tuple[int, int | None, bytes, np.ndarray]]) -> tuple[bytes, bytes, bytes]:
    """Documents (number, doc_id, text, spans) as text, places and contexts of one row."""
    heads = np.array([(k, i is not None, i or 0, len(text), len(spans)) for k, i, text, spans in waits], WAITS)
    texts = zstandard.ZstdCompressor(level=3).compress(b"".join([text for _, _, text, _ in waits]))
    return texts, heads.tobytes(), b"".join([spans.astype("<i8").tobytes() for _, _, _, spans in waits])


def _unpacked(packed: bytes, places: bytes, spans: bytes) -> Iterator[tuple[int, int | None, bytes, np.ndarray]]:
    heads, spans = np.frombuffer(places, WAITS), np.frombuffer(spans, "<i8").reshape(-1, 2)
    texts, at, span = zstandard.ZstdDecompressor().decompress(packed), 0, 0
    for number, known, doc_id, size, n in heads.tolist():
        yield number, doc_id if known else None, texts[at : at + size], spans[span : span + n]
        at, span = at + size, span + n


def _windows(chunk: Chunk, members: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
    """Of the windows around hot anchors: (document, start) of those that have an equal one before in the chunk, and per bucket the others (``WINDOW``)."""
    digest, seen, keys, kept, lost = xxhash.xxh3_128_digest, set(), [], [], []
    for d, at, low, high in zip(*(x[members].tolist() for x in (chunk.doc, chunk.at, chunk.low, chunk.high))):
        text = chunk.texts[d]
        for back in range(max(0, at + LENGTH - high), min(REACH, at - low) + 1):
            key = digest(text[at - back : at - back + LENGTH], back)
            if key in seen:
                lost.append((d, at - back))
            else:
                seen.add(key)
                keys.append(key)
                kept.append((d, at - back))
    sent = np.empty(len(keys), WINDOW)
    sent["k0"], sent["k1"] = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2).T
    sent["doc"], sent["start"] = np.array(kept, "i4").reshape(-1, 2).T
    sent["order"] = chunk.order[sent["doc"]]
    bucket = sent["k0"] % np.uint64(buckets)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by], prepend=bucket[by][:1])) if len(by) else by
    return np.array(lost, "i8").reshape(-1, 2), [(int(bucket[part[0]]), sent[part].tobytes()) for part in np.split(by, cuts) if len(part)]


def whole_repeats(rows: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """Documents that are done; those that wait for their border contexts, with what has gone; the border contexts, packed by anchor; and hot anchors' windows. Waiting documents share rows (``_packed``)."""

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(docs, buckets)
        flag = np.ones(len(chunk.at), "u1")  # all but the first of a context have one before them
        told = {b: np.frombuffer(x, "u1") for b, x in zip(answers["bucket"], answers["flags"])}
        border, hot = [], [np.empty(0, "i8")]
        for b, i in chunk.blocks(buckets):
            flag[i] = told[b]
            hot.append(i[told[b] == 3])
            i = i[told[b] == 2]
            if len(i):
                places = np.stack([chunk.order[chunk.doc[i]], chunk.doc[i], chunk.at[i], chunk.at[i] - chunk.low[i]], 1).astype("i8")
                texts = [chunk.texts[d][x:y] for d, x, y in zip(chunk.doc[i].tolist(), chunk.low[i].tolist(), chunk.high[i].tolist())]
                lengths = np.array([len(t) for t in texts], "<u2").tobytes()
                border.append((b, places.tobytes(), lengths + b"".join(texts)))
        number = docs["chunk"].iloc[0] if len(docs) else 0
        gone = (flag == 1) & (chunk.high - chunk.low >= LENGTH)
        waits = np.zeros(len(chunk.texts), bool)
        waits[chunk.doc[flag >= 2]] = True
        lost, windows = _windows(chunk, np.concatenate(hot), buckets)
        lost = lost[np.argsort(lost[:, 0], kind="stable")]
        lost_cuts = np.searchsorted(lost[:, 0], np.arange(len(chunk.texts) + 1))
        cuts = np.searchsorted(chunk.doc, np.arange(len(chunk.texts) + 1))
        out, packed, held, size = [], [], [], 0
        for k, text in enumerate(chunk.texts):
            here = slice(cuts[k], cuts[k + 1])
            starts = lost[lost_cuts[k] : lost_cuts[k + 1], 1]
            whole = np.stack([chunk.low[here][gone[here]], chunk.high[here][gone[here]]], 1)
            spans = _merged(np.concatenate([whole, np.stack([starts, starts + LENGTH], 1)]))
            doc_id = None if pd.isna(chunk.doc_ids[k]) else int(chunk.doc_ids[k])
            if not waits[k]:
                out.append(("done", number, k, doc_id, *_result(text, spans), None, None, None, None))
                continue
            held.append((k, doc_id, text, spans))
            size += len(text)
            if size >= SLICE_BYTES:
                packed.append(_packed(held))
                held, size = [], 0
        if held:
            packed.append(_packed(held))
        out += [("waits", number, None, None, None, None, None, None, text, None, places, spans) for text, places, spans in packed]
        out += [("border", number, None, None, None, None, None, None, None, *x) for x in border]
        out += [("windows", number, None, None, None, None, None, None, None, *x, None) for x in windows]
        made = pd.DataFrame(out, columns=[c.split()[0] for c in MADE.split(", ")])
        for c in ("number", "doc_id", "n_bytes", "n_removed", "n_spans", "bucket"):
            made[c] = made[c].astype("Int64")
        return made

    return rows.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInPandas(run, MADE)


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each string with the one before; 0 for the first."""
    out = np.zeros(len(strings), "i8")
    if len(strings) < 2:
        return out
    if len(strings) < 8:
        for k in range(1, len(strings)):
            s, t = strings[k - 1], strings[k]
            n = min(len(s), len(t))
            if s[:n] == t[:n]:
                out[k] = n
            else:
                out[k] = n - ((int.from_bytes(s[:n]) ^ int.from_bytes(t[:n])).bit_length() + 7) // 8
        return out
    width = max(map(len, strings))
    size = np.array([len(s) for s in strings])
    grid = np.frombuffer(b"".join(s.ljust(width + 1, b"\0") for s in strings), "u1").reshape(len(strings), width + 1)
    differ = grid[1:] != grid[:-1]
    differ[:, -1] = True
    out[1:] = np.minimum(differ.argmax(1), np.minimum(size[1:], size[:-1]))
    return out


def intervals(prefixes: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The interval tree of a sorted list by a scan with a stack: (common prefix, first, past the last), inner intervals first."""
    out, stack = [], []
    values = prefixes.tolist()
    for i in range(1, len(values) + 1):
        value = values[i] if i < len(values) else 0
        start = i - 1
        while stack and stack[-1][0] > value:
            length, start = stack.pop()
            out.append((length, start, i))
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, start))
    return out


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, occurrences): groups of suffixes that share ``right`` bytes and, before them, ``left`` bytes, ``least`` together at least.

    ``rights`` are what starts at the anchors, ``lefts`` what stands before, backwards. An interval of the suffix array is a right extension; within it,
    occurrences whose left extensions part at ``left`` make a group.
    """
    suffixes = sorted(range(len(rights)), key=rights.__getitem__)
    prefixes = common_prefixes([rights[k] for k in suffixes])
    for right, i, j in intervals(prefixes, GRAM):
        members = sorted(suffixes[i:j], key=lefts.__getitem__)
        before = common_prefixes([lefts[k] for k in members])
        need = max(0, least - right)
        if need == 0:
            yield 0, right, members
        for left, x, y in intervals(before, max(1, need)):
            yield left, right, members[x:y]


def losses(lefts: list[bytes], rights: list[bytes], order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, left, right): what occurrences lose to a repeat that an earlier one (by ``order``) has as well.

    All windows around an anchor overlap, so a member loses one span: from its longest left extension in any group to its longest right one. A
    wide interval at the root of the tree, with copies that part at every byte, has nearly as many nested groups as members
    times bytes; it is cut level by level instead, for each place of the anchor in the window, which visits the same groups as arrays.
    """
    suffixes = sorted(range(len(rights)), key=rights.__getitem__)
    prefixes = common_prefixes([rights[k] for k in suffixes])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], prefixes >= GRAM, [False]]).astype("i1")))
    left_of, right_of = np.zeros(len(rights), "i8"), np.zeros(len(rights), "i8")
    for i, j in (edges.reshape(-1, 2) - [1, 0]).tolist():
        members = suffixes[i:j]
        if j - i < WIDE:
            for left, right, group in maximal_repeats([lefts[k] for k in members], [rights[k] for k in members]):
                group = [members[k] for k in group]
                first = min(group, key=order.__getitem__)
                for k in group:
                    if k != first:
                        left_of[k], right_of[k] = max(left_of[k], left), max(right_of[k], right)
            continue
        ids = np.array(members)
        by_left = np.array(sorted(range(j - i), key=lambda k: lefts[members[k]]))
        before = common_prefixes([lefts[members[k]] for k in by_left])
        by_order = np.argsort(order[ids], kind="stable")
        parts, left_group = prefixes[i:j].copy(), np.empty(j - i, "i8")
        parts[0] = 0
        for back in range(REACH + 1):
            left_group[by_left] = np.cumsum(before < back)
            group = (np.cumsum(parts < LENGTH - back) * (j - i + 1) + left_group)[by_order]
            _, first = np.unique(group, return_index=True)
            again = np.ones(j - i, bool)
            again[first] = False
            k = ids[by_order[again]]
            left_of[k] = back
            right_of[k] = np.maximum(right_of[k], LENGTH - back)
    member = np.flatnonzero(right_of)
    return member, left_of[member], right_of[member]


def border_repeats(made: DataFrame) -> DataFrame:
    """Per chunk the spans (number of the document, start, end) that border contexts lose."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        places, lefts, rights, chunks = [], [], [], []
        for chunk, blob, packed in zip(part["chunk"], part["places"], part["contexts"]):
            place = np.frombuffer(blob, "i8").reshape(-1, 4)
            lengths = np.frombuffer(packed[: 2 * len(place)], "<u2").astype("i8")
            ends = np.cumsum(lengths) + 2 * len(place)
            for end, size, left in zip(ends.tolist(), lengths.tolist(), place[:, 3].tolist()):
                middle = end - size + left
                lefts.append(packed[end - size : middle][::-1])
                rights.append(packed[middle:end])
            places.append(place)
            chunks.append(np.full(len(place), chunk, "i8"))
        place, chunk = np.concatenate(places), np.concatenate(chunks)
        rank = np.empty(len(place), "i8")
        rank[np.lexsort((place[:, 2], place[:, 1], chunk, place[:, 0]))] = np.arange(len(place))
        who, left_of, right_of = losses(lefts, rights, rank)
        spans = np.stack([place[who, 1], place[who, 2] - left_of, place[who, 2] + right_of], 1)
        owner = chunk[who]
        out = [(int(c), spans[owner == c].tobytes()) for c in np.unique(owner)]
        return pd.DataFrame(out, columns=["chunk", "spans"])

    return made.where("kind = 'border'").select("chunk", "bucket", "places", "contexts").groupBy("bucket").applyInPandas(run, "chunk int, spans binary")


def hot_repeats(made: DataFrame) -> DataFrame:
    """Per chunk the spans (number of the document, start, end) that windows around hot anchors lose: all but the first of equal ones."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        windows = [np.frombuffer(x, WINDOW) for x in part["places"]]
        chunk = np.repeat(part["chunk"].to_numpy("i8"), [len(x) for x in windows])
        every = np.concatenate(windows)
        rank = np.lexsort((chunk, every["order"], every["k1"], every["k0"]))
        same = (np.diff(every["k0"][rank]) == 0) & (np.diff(every["k1"][rank]) == 0)
        who = rank[1:][same]
        spans = np.stack([every["doc"][who], every["start"][who], every["start"][who] + LENGTH], 1).astype("i8")
        owner = chunk[who]
        by = np.argsort(owner, kind="stable")
        out = [(int(owner[x[0]]), spans[x].tobytes()) for x in np.split(by, np.flatnonzero(np.diff(owner[by])) + 1) if len(x)]
        return pd.DataFrame(out, columns=["chunk", "spans"])

    return made.where("kind = 'windows'").select("chunk", "bucket", "places").groupBy("bucket").applyInPandas(run, "chunk int, spans binary")


def finish(waiting: DataFrame, borders: DataFrame) -> DataFrame:
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        lost = np.concatenate([np.empty((0, 3), "i8"), *[np.frombuffer(x, "i8").reshape(-1, 3) for x in answers["spans"]]])
        lost = lost[np.argsort(lost[:, 0], kind="stable")]
        out = []
        for row in zip(docs["text"], docs["places"], docs["contexts"]):
            for number, doc_id, text, spans in _unpacked(*row):
                i, j = np.searchsorted(lost[:, 0], [number, number + 1])
                out.append((doc_id, *_result(text, np.concatenate([spans, lost[i:j, 1:]]))))
        made = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        made["doc_id"] = pd.array([x[0] for x in out], "Int64")
        return made

    return (
        waiting.select("chunk", "text", "places", "contexts")
        .groupBy("chunk")
        .cogroup(borders.groupBy("chunk"))
        .applyInPandas(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of every document."""
    spark = docs.sparkSession
    n = chunks_for(text_bytes(docs), CHUNK_BYTES)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("rowkey"))
    rows = rows.withColumn("chunk", F.pmod("rowkey", F.lit(n)).cast("int"))
    path = run_dir(spark, "repeats")
    with shuffles_removed(spark):
        whole_repeats(rows, repeated_contexts(rows, n, hot), n).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    made = spark.read.schema(MADE).parquet(path)
    done = made.where("kind = 'done'").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return done.union(finish(made.where("kind = 'waits'"), border_repeats(made).union(hot_repeats(made))))
