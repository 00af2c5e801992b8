"""Token ids in zstandard files whose frames can be read one by one.

A file is a row of independent zstandard frames, each with whole documents and its own content checksum; then a skippable frame with
the index of documents; then a skippable frame with the seek table of the public zstandard seekable format (sizes and a
checksum of every frame). A reader fetches the tail, finds the frames of the documents it wants, and decompresses only these.

Null and empty texts have the end id alone. Rows are written by doc_id (nulls first), then by a hash of the text; repeated rows stay,
each with its own place. Other columns are not read. An empty table gives no file and no row.
"""

from __future__ import annotations

import os
import re
import string
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swaplens.llm.common import chunks_for, slices, text_bytes
from swaplens.plans.scale import run_dir

# Fixed values of the zstandard formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 256 * 1024
FILE_TEXT_BYTES = 32 * 2**20
SLICE_BYTES = 2 * 2**20  # of texts whose words are told apart at once
CACHED_WORDS, CACHED_BYTES = 150_000, 16 * 2**20  # and the bytes of the words themselves, in each of two generations; about 160 bytes a short word


def _stays_letters(stem: str) -> bool:
    """Whether a stem is all letters before and after the tokenizer's normalisation."""
    return stem.isalpha() and unicodedata.normalize("NFC", stem).lower().isalpha()


_GAP = re.compile(rb"[\t-\r ]")
_WHITE = np.isin(np.arange(256), [*range(9, 14), 32])
_MARK = np.isin(np.arange(256), [*b".,"])
_SMALL = np.isin(np.arange(256), [*b"abcdefghijklmnopqrstuvwxyz"])
_PUNCTUATION = string.punctuation.encode()


def _pieces(text: str | None) -> Iterator[bytes]:
    """The bytes of a text, in lower case unless an added token may stand in it; long ones in pieces, cut at white space."""
    raw = (text or "").encode("utf-8", "replace")
    if b"<" not in raw:
        raw = raw.lower()
    begin = 0
    while len(raw) - begin > SLICE_BYTES and (gap := _GAP.search(raw, begin + SLICE_BYTES)):
        yield raw[begin : gap.start()]
        begin = gap.end()
    yield raw[begin:]


def _parted(pieces: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all pieces as one array, a full stop or comma that closes ASCII letters apart, and the number of words up to each piece's end."""
    data = np.frombuffer(b"".join([x + b" " for x in pieces]), "u1")
    white, black = _WHITE[data], ~_WHITE[data]
    begins = black.copy()
    begins[1:] &= white[:-1]
    begins[1:-1] |= _MARK[data[1:-1]] & white[2:] & _SMALL[data[:-2]]
    starts = np.flatnonzero(begins)
    letters = data[black]
    offsets = np.append(np.cumsum(black, dtype="i4")[starts] - 1, len(letters)).astype("i4")
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.searchsorted(starts, np.cumsum([len(x) + 1 for x in pieces]))


class WordEncoder:
    """Ids of texts from the ids of their words.

    The tokenizer drops white space and splits at it, so a text's ids are those of its words in order, and the library sees each
    distinct word once while it is remembered. Words are told apart and their ids put in place by arrays; only the distinct words of about
    ``SLICE_BYTES`` of texts are looked at one by one. A word of letters followed by ASCII punctuation is two pre-tokens; ASCII letters
    are lower-cased by the tokenizer anyway. Both make fewer distinct words; all others go to the library as they are, also words whose letters become
    a letter and a mark when normalised or lower-cased, since marks join the punctuation behind them. Stems of letters are encoded
    many at a time, and cut after the tokens that end a word; where the cuts are not as many as the stems, one at a time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.size = 0  # bytes of the words that came in since the older ones

    def _one_by_one(self, parts: list[bytes]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in parts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _together(self, stems: list[bytes]) -> list[bytes]:
        groups = [stems[k : k + 64] for k in range(0, len(stems), 64)]
        done = self.tokenizer.encode_batch_fast([b" ".join(g).decode("utf-8", "replace") for g in groups], add_special_tokens=False)
        out = []
        for group, e in zip(groups, done):
            ids = np.array(e.ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            raw = ids.tobytes()
            if len(ends) == len(group) and ends[-1] == len(raw):
                ends = ends.tolist()
                out += [raw[i:j] for i, j in zip([0, *ends], ends)]
            else:
                out += self._one_by_one(group)
        return out

    def _remember(self, new: list[bytes]) -> None:
        words, older = self.words, self.older
        self.size += sum(map(len, new))
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        stems: set[bytes] = set()
        for word in new:
            if (known := older.get(word)) is not None:
                words[word] = known
                continue
            if word.isalpha() or (not word.isascii() and _stays_letters(word.decode("utf-8", "replace"))):
                stems.add(word)
                continue
            stem = word.rstrip(_PUNCTUATION)
            if stem.isalpha():
                parts[word] = (stem.lower(), word[len(stem) :])
            elif not stem.isascii() and _stays_letters(stem.decode("utf-8", "replace")):
                parts[word] = (stem, word[len(stem) :])
            else:
                parts[word] = (b"", word)
        stems.update(stem for stem, _ in parts.values())
        for some_parts, encode in ((stems, self._together), ({tail for _, tail in parts.values()}, self._one_by_one)):
            unknown = [x for x in some_parts if x and x not in words and x not in older]
            for k in range(0, len(unknown), 16384):
                some = unknown[k : k + 16384]
                words.update(zip(some, encode(some)))
        for word, (stem, tail) in parts.items():
            if word not in words:
                both = [words[x] if x in words else older[x] for x in (stem, tail) if x]
                words[word] = both[0] if len(both) == 1 else both[0] + both[1]

    def _ids(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        if len(self.words) > CACHED_WORDS or self.size > CACHED_BYTES:
            self.words, self.older, self.size = {}, self.words, 0
        parted, ends = _parted(pieces)
        coded = parted.dictionary_encode()
        which, distinct, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words
        self._remember([w for w in distinct if w not in words])
        found = [words[w] for w in distinct]
        sizes = np.array([len(x) for x in found], "i8") // 4
        place, count = (np.cumsum(sizes) - sizes)[which], sizes[which]
        done = np.concatenate([[0], np.cumsum(count)])
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(place - done[:-1], count) + np.arange(done[-1])]
        return np.split(ids, done[ends[:-1]])

    def encode(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        """The ids of each text, the end id last."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        owners: list[int] = []
        held: list[bytes] = []
        size = 0
        for k, text in enumerate(texts):
            for piece in _pieces(text):
                owners.append(k)
                held.append(piece)
                size += len(piece)
                if size >= SLICE_BYTES:
                    for owner, ids in zip(owners, self._ids(held)):
                        out[owner].append(ids)
                    owners, held, size = [], [], 0
        if held:
            for owner, ids in zip(owners, self._ids(held)):
                out[owner].append(ids)
        end = np.array([end_id], "<u4")
        return [np.concatenate([*ids, end]) for ids in out]


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(body)) + body


class FrameWriter:
    """Writes documents to a stream, a frame whenever ``frame_bytes`` have gathered."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int | None, int, int]] = []  # doc_id, frame, ids
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += ids.nbytes
        self.index.append((doc_id, len(self.frames), len(ids)))
        if self.size >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        raw = np.concatenate(self.held).tobytes()
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        known = np.array([i is not None for i, _, _ in self.index], "u1")
        ids = np.array([i or 0 for i, _, _ in self.index], "<i8")
        where = np.array([(f, n) for _, f, n in self.index], "<u4").reshape(-1, 2)
        body = struct.pack("<I", len(ids)) + self.compressor.compress(known.tobytes() + ids.tobytes() + where.tobytes())
        index = struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body
        self.stream.write(index)
        self.frames.append((len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        self.stream.write(seek_table(self.frames))


class FrameReader:
    """Reads single documents of a file. ``source`` has ``read_at(size, offset)`` and ``size()``."""

    def __init__(self, source):
        self.source, end = source, source.size()
        count, flag, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(source.read_at(12 * count, end - 9 - 12 * count), "<u4").reshape(-1, 3)
        self.sizes, self.raw, self.sums = (table[:, k].astype("i8") for k in range(3))
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        body = source.read_at(int(self.sizes[-1]), int(self.at[-2]))
        (n,) = struct.unpack("<I", body[8:12])
        plain = zstandard.ZstdDecompressor().decompress(body[12:]) if n else b""
        self.known = np.frombuffer(plain[:n], "u1").astype(bool)
        self.doc_ids = np.frombuffer(plain[n : 9 * n], "<i8")
        self.frame, self.n_ids = np.frombuffer(plain[9 * n :], "<u4").reshape(-1, 2).T.astype("i8")
        ends = np.cumsum(self.n_ids)
        self.start = ends - self.n_ids  # ids of the file before the document
        if n:
            first = np.searchsorted(self.frame, np.arange(self.frame[-1] + 1))
            self.inside = self.start - self.start[first][self.frame]
        self.open = (-1, b"")
        self.decompressed = 0

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document; decompresses its frame alone, and checks it."""
        f = int(self.frame[k])
        if self.open[0] != f:
            packed = self.source.read_at(int(self.sizes[f]), int(self.at[f]))
            raw = zstandard.ZstdDecompressor().decompress(packed)
            if len(raw) != self.raw[f] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f} is damaged")
            self.open, self.decompressed = (f, raw), self.decompressed + 1
        at = int(self.inside[k])
        return np.frombuffer(self.open[1], "<u4")[at : at + int(self.n_ids[k])]


class FileSource:
    def __init__(self, path: str):
        system, inner = pafs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)

    def size(self) -> int:
        return self.file.size()

    def read_at(self, size: int, offset: int) -> bytes:
        return self.file.read_at(size, offset)


def read_documents(path: str, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """The ids of the named documents of one file."""
    reader, wanted = FrameReader(FileSource(path)), set(doc_ids)
    return {int(i): reader.ids(k) for k, i in enumerate(reader.doc_ids) if reader.known[k] and int(i) in wanted}


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer; it stays from task to task. (A function that travels by value takes copies of the globals it names; this one travels by name.)"""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode doc_id and text to one file per range of ids; returns the files: part, file, n_docs, n_ids.

    A file appears under its name by a rename when it is whole, and a repeated task writes the same bytes again. Ranges are of
    doc_id, the text's hash and the row's number, so that one id with many rows is cut as well.
    """
    n = chunks_for(text_bytes(docs), FILE_TEXT_BYTES)
    rows = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(n, "doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inner = pafs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        encoder = encoder_of(tokenizer_path)
        writer, part, n_ids = None, 0, 0
        temporary = f"{inner}/.{uuid.uuid4().hex}"
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                part = int(batch["part"].iloc[0])
                stream = system.open_output_stream(temporary)
                writer = FrameWriter(stream, frame_bytes)
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            known = batch["doc_id"].notna().to_numpy()
            doc_ids = batch["doc_id"].fillna(0).astype("int64").to_numpy()
            for begin, end in slices(texts, SLICE_BYTES):
                for k, ids in enumerate(encoder.encode(texts[begin:end], end_id), begin):
                    writer.add(int(doc_ids[k]) if known[k] else None, ids)
                    n_ids += len(ids)
        if writer is not None:
            writer.close()
            stream.close()
            name = f"part-{part:06d}.zst"
            system.move(temporary, f"{inner}/{name}")
            yield pd.DataFrame({"part": [part], "file": [f"{folder}/{name}"], "n_docs": [len(writer.index)], "n_ids": [n_ids]})

    written = rows.select("part", F.col("doc_id").cast("decimal(20,0)").cast("bigint").alias("doc_id"), "text").mapInPandas(
        write, "part int, file string, n_docs bigint, n_ids bigint"
    )
    written.write.mode("overwrite").parquet(f"{folder}/files")
    return docs.sparkSession.read.parquet(f"{folder}/files")


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for.

    Files are few (one per 32 MB of text), so their running total is one small window.
    """
    before = F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")
    placed = files.withColumn("file_start", before)
    n = max(1, files.count())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["file"], batch["file_start"]):
                reader = FrameReader(FileSource(path))
                for begin in range(0, len(reader.doc_ids), 4096):
                    some = range(begin, min(begin + 4096, len(reader.doc_ids)))
                    ids = [reader.ids(k) for k in some]
                    out = pd.DataFrame({"doc_id": pd.array(reader.doc_ids[some.start : some.stop], "Int64")})
                    out.loc[~reader.known[some.start : some.stop], "doc_id"] = pd.NA
                    out["start"] = start + reader.start[some.start : some.stop]
                    out["n_tokens"] = reader.n_ids[some.start : some.stop]
                    out["ids_crc32"] = [zlib.crc32(x.tobytes()) for x in ids]
                    if with_ids:
                        out["ids"] = [x.astype("i8") for x in ids]
                    yield out

    return placed.select("part", "file", "file_start").repartition(n, "part").mapInPandas(read, schema)


def token_documents(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token files and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, folder or run_dir(spark, "tokens"), tokenizer_path, end_id))
