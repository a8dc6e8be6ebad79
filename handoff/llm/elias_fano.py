"""Token ids in binary files with Elias-Fano document boundaries.

``write`` encodes texts with a tokenizer of the tokenizers library, appends an end id to each, and
writes the ids in ascending document order into segment files; ``read`` gives them back. Texts are
range-partitioned by id, each task writes the segments of its range, and segments in (part, number)
order hold the documents in ascending order.

A segment file (little-endian) is: the magic bytes, six 64-bit numbers (documents, documents with a
null id, ids, bytes of an id, smallest document id, length of the first Elias-Fano block), the
Elias-Fano block of the document ids less the smallest, the block of the boundaries (the number of
ids up to and with each document), and the concatenated ids. An Elias-Fano block stores n ascending
numbers in about n x (2 + log2(largest / n)) bits: the low bits of each number side by side, the
high parts in unary, and the place of every 64th set bit, from which ``select`` finds any entry
without a table of 64-bit offsets.

Files are written under a name of the attempt and then moved, so a task that runs again leaves the
same whole file. A segment ends after ``segment_ids`` ids; a longer document is a segment of its own.

Encoding keeps the ids of words that it has seen. A byte-level BPE never joins text across a blank
that stands before a non-blank, so a text may be cut there and its words encoded one by one; other
tokenizers get whole texts.

Defined cases: null text counts as empty (one end id); null ids come first; repeated ids keep a row
each, ordered by their text's hash; extra columns are not read; an empty table writes no files.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from handoff.llm.common import open_folder, shared_path, write_shared

MAGIC = b"EFIDS001"
SAMPLE = 64
#: Words whose ids a worker keeps.
KEPT = 1_000_000
#: Characters of text encoded together.
CHUNK_CHARS = 4_000_000
#: Words that go to the library as one text.
JOINED = 100
#: How byte-level vocabularies write a blank.
BLANK = "\u0120"
_BLANK_BEFORE_BLANK = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")


class EliasFano:
    """An ascending sequence of numbers, with access to any entry."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        largest = int(values[-1]) if n else 0
        low_bits = max(0, (largest // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(places[-1]) + 1 if n else 0) // 64) * 64, dtype=np.uint8)
        bits[places] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little").view(np.uint64), places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.ones.tobytes()
        return struct.pack("<5q", self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> EliasFano:
        n, low_bits, a, b, c = struct.unpack_from("<5q", data)
        at = 40
        return cls(n, low_bits, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a).view(np.uint64),
                   np.frombuffer(data, np.uint8, c, at + a + b).view(np.uint32))

    def _low(self, i: int) -> int:
        value = 0
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            value |= ((int(self.low[bit >> 3]) >> (bit & 7)) & 1) << k
        return value

    def select(self, i: int) -> int:
        """Entry i: from the sampled set bit before it, count set bits word by word."""
        at = int(self.ones[i // SAMPLE])
        left = i % SAMPLE
        word_no = at >> 6
        word = int(self.high[word_no]) >> (at & 63) << (at & 63)
        while word.bit_count() <= left:
            left -= word.bit_count()
            word_no += 1
            word = int(self.high[word_no])
        for _ in range(left):
            word &= word - 1
        place = (word_no << 6) + (word & -word).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        """All entries."""
        places = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        low = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits).astype(np.int64)
        return ((places - np.arange(self.n)) << self.low_bits) | (low @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64)))


def pack_segment(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of one file; ``ids`` are each document's little-endian ids of ``width`` bytes."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    names = EliasFano.of((known - first).astype(np.uint64)).to_bytes()
    ends = np.cumsum([len(x) // width for x in ids])
    head = struct.pack("<6q", len(ids), len(ids) - len(known), int(ends[-1]) if len(ids) else 0, width, first, len(names))
    return b"".join([MAGIC, head, names, EliasFano.of(ends).to_bytes(), *ids])


class Segment:
    """One file's content; ``document(i)`` reads a single document by ``select``."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if data[:8] != MAGIC:
            raise ValueError("not a segment file")
        self.n, self.nulls, self.n_ids, self.width, self.first, names = struct.unpack_from("<6q", view, 8)
        self.names = EliasFano.from_bytes(view[56: 56 + names])
        self.ends = EliasFano.from_bytes(view[56 + names:])
        self.ids = np.frombuffer(data, dtype=f"<u{self.width}", count=self.n_ids, offset=len(data) - self.n_ids * self.width)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0: self.ends.select(i)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.all() + self.first).tolist()


class Encoder:
    """Texts to id bytes with the tokenizers library; keeps the words it has met."""

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.width = 2 if max(self.plain.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.end = np.array([end_id], dtype=f"<u{self.width}").tobytes()
        self.by_word = type(self.plain.pre_tokenizer).__name__ == "ByteLevel"
        specials = [t for t in self.plain.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)]
        self.mark = specials[0].content if specials and self.by_word else None
        self.mark_id = self.plain.token_to_id(self.mark) if self.mark else -1
        added = self.plain.get_added_tokens_decoder()
        plain_added = not any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added.values())
        self.starts = None  # by id: whether it starts with a blank
        if self.by_word and plain_added:
            vocabulary = self.plain.get_vocab()
            self.starts = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=bool)
            self.starts[[i for t, i in vocabulary.items() if t.startswith(BLANK) and i not in added]] = True
        self.first: dict[str, bytes] = {}  # words at a text's start
        self.later: dict[str, bytes] = {}  # words after a blank
        self.counts: dict[str, int] = {}  # words after a blank: number of ids

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        run = getattr(self.plain, "encode_batch_fast", self.plain.encode_batch)
        return [np.array(e.ids, dtype=f"<u{self.width}") for e in run(texts, add_special_tokens=False)]

    def _learn(self, words: list[str], blank: str, known: dict[str, bytes]) -> None:
        """Ids of new words; many go to the library as one text, held apart by its special token."""
        if self.mark:
            odd = [w for w in words if self.mark in w]
            words = [w for w in words if self.mark not in w]
            groups = [words[i: i + 500] for i in range(0, len(words), 500)]
            for group, ids in zip(groups, self._encode([self.mark.join(blank + w for w in g) for g in groups])):
                cuts = np.flatnonzero(ids == self.mark_id)
                if len(cuts) != len(group) - 1:
                    odd += group
                    continue
                edges = [0, *(cuts + 1).tolist()]
                ends = [*cuts.tolist(), len(ids)]
                raw = ids.tobytes()
                known.update((w, raw[a * self.width: z * self.width]) for w, a, z in zip(group, edges, ends))
            words = odd
        for w, ids in zip(words, self._encode([blank + w for w in words])):
            known[w] = ids.tobytes()

    def _learn_later(self, words: list[str], known: dict[str, bytes] | dict[str, int]) -> None:
        """Ids, or their numbers, of new words after a blank. They go to the library as a text of many words: ids that start
        with a blank part them again."""
        odd = words
        if self.starts is not None:
            odd = [w for w in words if " " in w]
            words = [w for w in words if " " not in w]
            groups = [words[i: i + JOINED] for i in range(0, len(words), JOINED)]
            for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups])):
                cuts = np.flatnonzero(self.starts[ids])
                if len(cuts) != len(group) or cuts[0]:
                    odd += group
                elif known is self.counts:
                    known.update(zip(group, np.diff(cuts, append=len(ids)).tolist()))
                else:
                    raw, edges = ids.tobytes(), (cuts * self.width).tolist()
                    known.update(zip(group, map(raw.__getitem__, map(slice, edges, [*edges[1:], len(raw)]))))
        if known is self.counts:
            known.update((w, len(ids)) for w, ids in zip(odd, self._encode([" " + w for w in odd])))
        else:
            self._learn(odd, " ", known)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Id bytes of each whole text, the end id last."""
        if not self.by_word:
            return [ids.tobytes() + self.end for ids in self._encode(texts)]
        return [b"".join([self.first[first], *ids, self.end]) for first, ids in self._looked_up(texts, self.later)]

    def lengths(self, texts: list[str], kept: int = KEPT) -> list[int]:
        """Number of ids of each whole text, the end id counted; at most about ``kept`` words stay in memory."""
        if not self.by_word:
            return [len(ids) + 1 for ids in self._encode(texts)]
        return [len(self.first[first]) // self.width + sum(n) + 1 for first, n in self._looked_up(texts, self.counts, kept)]

    def _looked_up(self, texts: list[str], known: dict, kept: int = KEPT) -> list[tuple[str, list]]:
        """Each text's first word, learned, and what ``known`` holds for its later ones, after learning the new ones."""
        if len(self.first) + len(self.later) + len(self.counts) > kept:
            self.first.clear()
            self.later.clear()
            self.counts.clear()
        out, gaps = [], []
        for text in texts:
            first, *words = _CUT.split(text) if _BLANK_BEFORE_BLANK.search(text) else text.split(" ")
            found = list(map(known.get, words))
            out.append((first, found))
            if None in found:
                gaps.append((found, [(i, words[i]) for i, x in enumerate(found) if x is None]))
        self._learn(list({first for first, _ in out}.difference(self.first)), "", self.first)
        self._learn_later(list({w for _, new in gaps for _, w in new}), known)
        for found, new in gaps:
            for i, w in new:
                found[i] = known[w]
        return out


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The worker's encoder; Python workers are used again by later tasks."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          segment_ids: int = 4_000_000) -> DataFrame:
    """Write all texts to segment files in ``folder``; returns the table of files (part, number, file, n_docs, n_ids)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (fs, root) = encoder(tokenizer, end_id), open_folder(folder)
        fs.create_dir(root, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number, names, ids, size
            file = f"part-{part:06d}-{number:06d}.efids"
            draft = f"{root}/_{file}-{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write(pack_segment(names, ids, enc.width))
            fs.move(draft, f"{root}/{file}")
            told = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "file": [file],
                                               "n_docs": [len(ids)], "n_ids": [size // enc.width]})
            number, names, ids, size = number + 1, [], [], 0
            return told

        def add(keys: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal size
            for key, data in zip(keys, enc.encode(texts)):
                if ids and size + len(data) > segment_ids * enc.width:
                    yield close()
                names.append(key)
                ids.append(data)
                size += len(data)

        for batch in batches:
            keys, held, chars = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                held.append(text.as_py())
                chars += len(held[-1])
                if chars >= CHUNK_CHARS:
                    yield from add(keys, held)
                    keys, held, chars = [], [], 0
            yield from add(keys, held)
        if ids:
            yield close()

    return write_shared(rows.mapInArrow(run, "part int, number int, file string, n_docs long, n_ids long"), "segments")


def read(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the segment files.

    ``start`` counts the ids of all documents before it; the files' starts are a running sum over
    the table of files, one row a file.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = files.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 2), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_stream(f"{root}/{file}") as source:
                    segment = Segment(source.read())
                ends = segment.ends.all()
                starts = np.concatenate([[0], ends[:-1]])
                wide = segment.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:z]) for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(segment.doc_ids(), pa.int64()), pa.array(starts + base), pa.array(ends - starts),
                                                  pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write to a fresh folder of the shared place and read the files back."""
    folder = shared_path(spark, "token-ids")
    return read(write(docs, folder, tokenizer, end_id), folder)
