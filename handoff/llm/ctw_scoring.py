"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; the decision after bit prefix p in context s (the last d bytes)
is a node with its own zero and one counts. A node's Krichevsky-Trofimov estimate is weighed against
the product of its children's (the contexts one byte longer), half and half, from DEPTH bytes up to
the empty context: log Pw = log(1/2 KT + 1/2 product of the children's Pw). A text's probability
mixes all depths with the weights that training left in the nodes; divided by the text's bytes it is
the code length per byte. Next to it stands a smoothed unigram word model.

How it runs on Spark: texts are put into chunks of about ``chunk_bytes``. Each chunk emits its
distinct (DEPTH + 1)-byte grams and words with their training counts, so frequent keys are summed
before the shuffle. Totals over all chunks are the corpus counts. The tree below each pair of last
bytes is complete in one group of the sorted grams and is weighed there by array operations; the at
most 257 x 255 nodes above are summed up in Spark and read back. Every gram then has one value and
every word one count; they are joined back to the chunks that asked, written to the shared folder
chunk by chunk, and the task that scores a chunk reads the answers to its own keys. No table of the
model is ever whole in one place, texts are never shuffled, and no text is cut.

Texts are lower-cased (A-Z). Words are split at space and 0x09-0x0D; one end follows and counts as
a token. The byte model reads DEPTH zero bytes before a text and codes a zero byte as its end.

Defined cases: null text is empty (its end only); without training rows all KT estimates are 1/2 and
the word model gives probability 1. Null ids are kept, repeated rows are rows, extra columns are not
read, and an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from handoff.llm.common import open_folder, shared_path, text_bytes, whole_groups, write_shared

DEPTH = 5
#: Keys are longs: grams are not negative, words (a 63-bit hash) are.
#: Bytes whose grams are held at a time.
BLOCK = 2_000_000
_LN10 = math.log(10.0)


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Gram codes of the texts and their ends (oldest byte highest, the coded byte lowest), and each text's count."""
    pad = bytes(DEPTH)
    line = np.frombuffer(b"".join([pad + t + b"\0" for t in texts]), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    codes = np.zeros(max(0, len(line) - DEPTH), dtype=np.int64)
    for k in range(DEPTH + 1):
        codes = (codes << 8) | line[k: k + len(codes)]
    whole = np.concatenate([[0], np.cumsum(sizes + DEPTH)])  # text i's bytes start at whole[i] + DEPTH
    keep = np.repeat(whole[:-1] - np.cumsum(np.concatenate([[0], sizes[:-1]])), sizes) + np.arange(int(sizes.sum()))
    return codes[keep], sizes


def blocks_of(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in lists of about BLOCK bytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_key(word: bytes) -> int:
    return -1 - (xxh64_intdigest(word) >> 1)


def is_gram(key: str = "key") -> Column:
    return F.col(key) >= 0


def chunked(docs: DataFrame, id_col: str, text_col: str, train: Column, chunk_bytes: int) -> DataFrame:
    """(doc_id, text, train, chunk): rows of a task in chunks of about ``chunk_bytes``, written once.

    Input splits are joined (without a shuffle) until a task holds about one chunk.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = rows.coalesce(max(1, math.ceil(size / chunk_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = np.fromiter((len(t) for t in text_bytes(batch.column(1))), dtype=np.int64, count=batch.num_rows)
            number = (size + np.cumsum(lengths)) // (2 * chunk_bytes)
            size += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((part << 32) + number)], names=["doc_id", "text", "train", "chunk"])

    kind = docs.schema[id_col].dataType.simpleString()
    return write_shared(rows.mapInArrow(run, f"doc_id {kind}, text string, train boolean, chunk long"), "lm-chunks")


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    all_codes, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return all_codes, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(all_codes)).astype(np.int64)


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows in pieces of one chunk each; a chunk's rows follow one another."""
    for batch in batches:
        chunk = batch.column(3).to_numpy()
        edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
        for a, z in zip(edges, edges[1:]):
            if z > a:
                yield int(chunk[a]), batch.slice(a, z - a)


def block_keys(texts: list[bytes], train: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block's texts and their training counts."""
    codes, n = np.unique(grams_of(texts)[0], return_counts=True)
    words = Counter(b" ".join(texts).split())
    keys = np.fromiter(map(word_key, words), dtype=np.int64, count=len(words))
    counts = np.concatenate([n, np.fromiter(words.values(), dtype=np.int64, count=len(words))])
    return np.concatenate([codes, keys]), counts if train else np.zeros_like(counts)


def chunk_keys(chunks: DataFrame) -> DataFrame:
    """(chunk, key, n): distinct grams and words of each chunk, n their count in training texts."""

    def told(chunk: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, n = _merge(*zip(*parts)) if parts else _merge([], [])
        for lo in range(0, len(keys), 200_000):
            k = keys[lo: lo + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk)), pa.array(k), pa.array(n[lo: lo + 200_000])], names=["chunk", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for chunk, rows in by_chunk(batches):
            if chunk != now:
                yield from told(now, parts) if parts else ()
                now, parts = chunk, []
            train = rows.column(2).to_numpy(zero_copy_only=False)
            texts = [t.lower() for t in text_bytes(rows.column(1))]
            for use in (True, False):
                for block in blocks_of([t for t, u in zip(texts, train) if u == use]):
                    parts.append(block_keys(block, use))
                    if len(parts) > 8:
                        parts = [_merge(*zip(*parts))]
        yield from told(now, parts) if parts else ()

    return write_shared(chunks.mapInArrow(run, "chunk long, key long, n long"), "lm-keys")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series after a shift by 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8.0
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Tree:
    """The nodes of one bit position below given grams, from DEPTH down to ``top`` bytes of context.

    ``codes`` holds all grams that share their last ``top`` context bytes with any of its rows.
    """

    def __init__(self, codes: np.ndarray, n: np.ndarray, bit: int, top: int):
        byte = codes & 255
        prefix = (1 << bit) | (byte >> (8 - bit))
        self.one = ((byte >> (7 - bit)) & 1).astype(bool)
        self.node, self.key, self.zeros, self.ones, self.log_pw, self.log_beta = {}, {}, {}, {}, {}, {}
        for d in range(DEPTH, top - 1, -1):
            context = (codes >> 8) & ((1 << 8 * d) - 1)
            self.key[d], first, self.node[d] = np.unique((context << 8) | prefix, return_index=True, return_inverse=True)
            size = len(self.key[d])
            self.zeros[d] = np.bincount(self.node[d], weights=np.where(self.one, 0, n), minlength=size)
            self.ones[d] = np.bincount(self.node[d], weights=np.where(self.one, n, 0), minlength=size)
            kt = log_kt(self.zeros[d], self.ones[d])
            if d == DEPTH:
                self.log_pw[d] = kt
            else:
                below = np.bincount(self.node[d][first_below], weights=self.log_pw[d + 1], minlength=size)
                self.log_beta[d] = kt - below
                self.log_pw[d] = np.logaddexp(kt, below) - math.log(2.0)
            first_below = first

    def estimate(self, d: int) -> np.ndarray:
        """KT probability of a one at depth d, for every row."""
        return ((self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1.0))[self.node[d]]


def mixed(one_below: np.ndarray, estimate: np.ndarray, log_beta: np.ndarray) -> np.ndarray:
    """Probability of a one at a node: its own estimate against its child's, by the trained weight."""
    share = 1.0 / (1.0 + np.exp(-np.clip(log_beta, -60, 60)))
    return share * estimate + (1.0 - share) * one_below


def _upper(grams: DataFrame) -> np.ndarray:
    """(257, 256, 2) array: KT estimate and log weight of the nodes without context (row 256) and with one byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["pair"]):
            codes, n = t.column("key").to_numpy(), t.column("n").to_numpy()
            for bit in range(8):
                tree = Tree(codes, n, bit, 2)
                yield pa.RecordBatch.from_arrays([pa.array(tree.key[2]), pa.array(tree.zeros[2]), pa.array(tree.ones[2]), pa.array(tree.log_pw[2])],
                                                 names=["node", "zeros", "ones", "log_pw"])

    two = grams.mapInArrow(run, "node long, zeros double, ones double, log_pw double")
    kind = F.struct((F.shiftright("node", 8).bitwiseAND(F.lit(255))).alias("last"), F.col("node").bitwiseAND(F.lit(255)).alias("prefix"))
    one = two.groupBy(kind.alias("k")).agg(F.sum("zeros"), F.sum("ones"), F.sum("log_pw")).collect()  # at most 256 x 255 nodes
    zeros, ones, below = (np.zeros((257, 256)) for _ in range(3))
    for k, z, o, b in one:
        zeros[k["last"], k["prefix"]], ones[k["last"], k["prefix"]], below[k["last"], k["prefix"]] = z, o, b
    kt = log_kt(zeros, ones)
    pw = np.where(zeros + ones > 0, np.logaddexp(kt, below) - math.log(2.0), 0.0)
    zeros[256], ones[256], below[256] = zeros[:256].sum(0), ones[:256].sum(0), pw[:256].sum(0)
    kt[256] = log_kt(zeros[256], ones[256])
    return np.stack([(ones + 0.5) / (zeros + ones + 1.0), kt - below], axis=2)


def gram_values(totals: DataFrame) -> DataFrame:
    """(key, value): log10 probability of each gram's byte in its context, all depths mixed."""
    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)).cast("int")
    grams = totals.where(is_gram()).select(pair.alias("pair"), "key", "n").repartition("pair").sortWithinPartitions("pair", "key")
    upper = _upper(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["pair"]):
            codes, n = t.column("key").to_numpy(), t.column("n").to_numpy()
            value = np.zeros(len(codes))
            last = (codes >> 8) & 255
            for bit in range(8):
                tree = Tree(codes, n, bit, 2)
                prefix = (1 << bit) | ((codes & 255) >> (8 - bit))
                one = tree.estimate(DEPTH)
                for d in range(DEPTH - 1, 1, -1):
                    one = mixed(one, tree.estimate(d), tree.log_beta[d][tree.node[d]])
                for row in (last, np.full(len(codes), 256)):
                    one = mixed(one, upper[row, prefix, 0], upper[row, prefix, 1])
                value += np.log10(np.where(tree.one, one, 1.0 - one))
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(value)], names=["key", "value"])

    return grams.mapInArrow(run, "key long, value double")


class Lookup:
    """Values of 64-bit keys: a direct table, and a search for keys that share a slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float | None = None):
        order = np.argsort(keys)
        self.keys, self.values, self.default = keys[order], values[order], default
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys))))) + 2)
        self.slots = np.zeros(1 << self.bits, dtype=np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.default if self.default is not None else np.nan)
        at = self.slots[self._slot(keys)]
        miss = np.flatnonzero(self.keys[at] != keys)
        at[miss] = np.minimum(np.searchsorted(self.keys, keys[miss]), len(self.keys) - 1)
        found = self.values[at]
        gone = miss[self.keys[at[miss]] != keys[miss]]
        if len(gone):
            if self.default is None:
                raise KeyError(int(keys[gone[0]]))
            found[gone] = self.default
        return found


#: Folders of answers at most; a chunk's rows lie together in one of them.
FOLDERS = 1024


def write_answers(keys: DataFrame, totals: DataFrame) -> str:
    """Write (chunk, key, value) for every chunk, value being a gram's log10 probability or a word's
    count; words that training holds once are left out. Returns the folder."""
    values = gram_values(totals).unionByName(totals.where(~is_gram() & (F.col("n") != 1)).select("key", F.col("n").cast("double").alias("value")))
    answers = keys.select("chunk", "key").join(values, "key").withColumn("folder", F.pmod(F.xxhash64("chunk"), F.lit(FOLDERS)).cast("int"))
    path = shared_path(keys.sparkSession, "lm-answers")
    answers = answers.repartition("chunk").sortWithinPartitions("folder", "chunk", "key")
    answers.write.partitionBy("folder").option("compression", "zstd").parquet(path)
    return path


def answers_of(path: str, chunk: int, folder: int) -> tuple[Lookup, Lookup]:
    """Values of a chunk's grams, and counts of its words."""
    fs, root = open_folder(f"{path}/folder={folder}")
    t = pq.read_table(root, filesystem=fs, columns=["key", "value"], filters=[("chunk", "=", chunk)], partitioning=None)
    keys, values = t.column("key").to_numpy(), t.column("value").to_numpy()
    gram = keys >= 0
    return Lookup(keys[gram], values[gram]), Lookup(keys[~gram], values[~gram], default=1.0)


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 64_000_000) -> DataFrame:
    """One row for each text: doc_id, train, n_bytes, n_tokens, n_known, train_tokens, base_score, score and
    bits_per_byte. ``train`` says which rows the models learn from."""
    chunks = chunked(docs, id_col, text_col, train, chunk_bytes)
    keys = chunk_keys(chunks)
    totals = write_shared(keys.groupBy("key").agg(F.sum("n").alias("n")), "lm-totals")
    train_docs = chunks.where("train").count()
    words = totals.where(~is_gram() & (F.col("n") > 0)).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n, v = int(words[1]) + train_docs, int(words[0]) + (train_docs > 0)
    scale = n + 0.1 * (v + 1)
    path = write_answers(keys, totals)
    end, known_end = math.log10((train_docs + 0.1) / scale), int(train_docs > 0)
    names = ["doc_id", "train", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            texts = [t.lower() for t in text_bytes(batch.column(1))]
            sizes, scores, tokens, known, base = [], [], [], [], []
            at = 0
            for chunk, rows in by_chunk([batch]):
                if chunk != now:
                    by_gram, by_word = answers_of(path, chunk, rows.column(4)[0].as_py())
                    now = chunk
                for block in blocks_of(texts[at: at + rows.num_rows]):
                    codes, lengths = grams_of(block)
                    sizes += lengths.tolist()
                    scores += np.add.reduceat(by_gram[codes], np.cumsum(lengths) - lengths).tolist()
                    split = [t.split() for t in block]
                    own = list(set().union(*split))
                    counts = by_word[np.fromiter(map(word_key, own), dtype=np.int64, count=len(own))]
                    logs = np.log10((counts + 0.1) / scale).tolist()
                    of_word = dict(zip(own, zip(logs, (counts > 0).tolist())))
                    for words in split:
                        found = [of_word[w] for w in words]
                        tokens.append(len(words) + 1)
                        known.append(sum(f[1] for f in found) + known_end)
                        base.append(math.fsum(f[0] for f in found) + end)
                at += rows.num_rows
            columns = [batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in (sizes, tokens, known, [n] * len(sizes))],
                       pa.array(base, pa.float64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    asked = chunks.withColumn("folder", F.pmod(F.xxhash64("chunk"), F.lit(FOLDERS)).cast("int"))
    out = asked.mapInArrow(run, f"doc_id {kind}, train boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("bits_per_byte", -F.col("score") * F.lit(_LN10 / math.log(2.0)) / F.col("n_bytes"))
