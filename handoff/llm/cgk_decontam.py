"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are sequences of lower-case words (runs of letters and digits). The CGK walk reads a window:
step j looks at the current word, writes it, and moves on by one word if the word's random bit for
step j is set. Two windows at a small edit distance run into step again after each edit, so their
outputs differ in few places (edit distance becomes Hamming distance). A table has its own random
bits and compares ``samples`` of the written places; a pair that agrees on all of them in any table
is a candidate. Candidates are checked by the exact word edit distance of the item against the
region of the text (Myers' bit vectors), and kept within ``max_ratio`` x item words edits.

A passage may start at any word of a text. The text's windows start at every s-th word, the item's
at every word, where s is about a third of the item: a passage then holds a text window that is
aligned exactly with one of the item's windows, whatever stands before it. Windows are as long as
the smallest item of that s less this play, so that items of one s share walks; a longer item of the
same s is met by several windows.

A table's walk ends at its last sampled step. At each sampled step before it, a text window goes on only
if some item's window wrote the same words so far (a bitmap of those keys), which most do not: later
steps are walked by the few that can still meet.

The number of tables comes from the target recall: items are edited at random at ``design_ratio``
(``max_ratio`` unless given, the most edits that are kept), several times each, and tables are added
until the share of edited items that meet the original in some table reaches the target, less one
standard error. If MOST tables do not reach it, they are used and a warning is logged.

Items are processed in blocks of bounded size; each block's index goes to the tasks with the code,
and every block sees all texts. Items of more than PART words have windows of their parts, which only
give places where the whole item may stand; its edits are checked as a whole like any other's.

Defined cases: null and empty texts hold nothing, items without words are never found; short items
(fewer than 1 / max_ratio words) must stand in the text word for word. ``leaks`` answers by id: documents
of one id (null is one id) and items of one id are taken together, with the fewest edits and the sum of
the places over all their pairs of rows. ``keep_uncontaminated`` judges every row by itself. Extra columns
are not read; empty tables give no rows.
"""

from __future__ import annotations

import logging
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from handoff.llm.common import fresh_name

SEED = 4
PART = 256
SAMPLES = 3
#: Least distance of two sampled steps.
GAP = 6
#: Tables at most; items, and edited copies of each, by which a number of tables is judged.
MOST, JUDGED, COPIES = 64, 256, 8
#: Words of a batch of texts that are walked together.
CHUNK_WORDS = 400_000
_WORD = re.compile(r"[^\W_]+")
_BITMAP = 1 << 22
#: Steps served by one product of a word's hash; its low bits are not random enough.
BLOCK_BITS = 48


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's words; never 0, which stands for the end of a window."""
    words = _WORD.findall(text.lower()) if text else []
    out = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    out[out == 0] = 1
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit hash step of an array."""
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(0)


def stride_for(m: int) -> int:
    """Start distance of text windows for an item of m words: a power of two, a third of m or less, 64 at most."""
    s = 1
    while s < 64 and 2 * s <= m // 3:
        s *= 2
    return s


def window_size(m: int) -> int:
    """Words of a window for an item of m words: 3s words, the smallest item of its stride, less the play."""
    s = stride_for(m)
    return m if s == 1 else 2 * s + 1


class Sampler:
    """Sampled steps and random bits of every table; the same for texts and items."""

    def __init__(self, tables: int, samples: int = SAMPLES, seed: int = SEED):
        self.tables, self.samples, self.seed = tables, samples, seed

    def steps(self, table: int, n: int) -> list[int]:
        """Sampled steps of windows of n words, ascending; the walk covers n words in about 2n steps."""
        rng = np.random.default_rng([self.seed, table, n])
        span = max(1, 9 * n // 5)
        count = min(self.samples, span)
        # steps side by side often read one word, and a key of one common word meets far too many windows
        gap = max(1, min(GAP, (span - 1) // max(1, count - 1))) - 1
        picked = sorted(rng.choice(span - (count - 1) * gap, count, replace=False).tolist())
        return [step + k * gap for k, step in enumerate(picked)]

    def bits(self, words: np.ndarray, table: int, block: int) -> np.ndarray:
        """Random bits of each word for the steps of one block, the first step's bit highest."""
        factor = int(np.random.default_rng([self.seed, table, block, 1]).integers(0, 1 << 63)) * 2 + 1
        return words * np.uint64(factor)  # modulo 2^64; word hashes are random, so the high bits are

    def walk(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int, table: int, meets: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """Walk the windows of n words at ``starts`` (no word at ``ends`` or later is read) to the last sampled step.

        Returns the windows that went all the way and the key at each sampled step; with ``meets``, bitmaps
        of the keys that are looked for at each sampled step, windows stop where they meet none of them
        (only the last keys are returned).
        """
        steps = self.steps(table, n)
        own = np.arange(len(starts))
        at, stop = starts.astype(np.int64), np.minimum(starts + n, ends)
        key = np.full(len(starts), np.uint64((table + 1) * 1_000_003 + n), dtype=np.uint64)
        padded = np.append(words, np.zeros(steps[-1] + 2, dtype=np.uint64))
        keys, bits = [], None
        for j in range(steps[-1] + 1):
            if j % BLOCK_BITS == 0:
                bits = self.bits(padded, table, j // BLOCK_BITS)
            if j in steps:
                key = _mix(key + np.where(at < stop, padded[at], np.uint64(0)), j + 1)
                if meets is None:
                    keys.append(key)
                else:
                    hit = np.flatnonzero(meets[steps.index(j)][(key & np.uint64(_BITMAP - 1)).astype(np.int64)])
                    own, at, stop, key = own[hit], at[hit], stop[hit], key[hit]
            if j < steps[-1]:
                word = bits[at]
                word >>= np.uint64(63 - j % BLOCK_BITS)
                word &= np.uint64(1)
                at += word.view(np.int64)
        return own, keys if meets is None else [key]


def edit_distance_within(masks: dict[int, int], m: int, region: list[int]) -> int:
    """Smallest edit distance of the m-word item to any stretch of the region (Myers' bit vectors)."""
    full = (1 << m) - 1
    top = 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for word in region:
        same = masks.get(word, 0)
        across = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(across | up))
        fall = up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        diagonal = same | down
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | (full & ~(diagonal | rise))
        down = rise & diagonal
        best = min(best, score)
    return best


def bit_masks(words: np.ndarray) -> dict[int, int]:
    """For each word of an item, the bits of its places."""
    places: dict[int, int] = defaultdict(int)
    for k, w in enumerate(words.tolist()):
        places[w] |= 1 << k
    return dict(places)


class Index:
    """Windows of a block of items: sorted keys with the item and the window's offset in it."""

    def __init__(self, items: list[np.ndarray], tables: int, max_ratio: float, samples: int = SAMPLES):
        self.items, self.max_ratio = items, max_ratio
        self.sampler = Sampler(tables, samples)
        self.groups: dict[int, list[int]] = defaultdict(list)  # stride -> window sizes
        #: Which keys (by their low bits) some item's window has at its first, second, ... sampled step.
        self.meets = [np.zeros(_BITMAP, dtype=bool) for _ in range(samples)]
        rows = [[], [], []]
        by_size = defaultdict(list)
        for i, words in enumerate(items):
            first = 0
            for part in np.array_split(words, max(1, -(-len(words) // PART))):
                if len(part):
                    s = stride_for(len(part))
                    n = window_size(len(part))
                    by_size[s, n].append((i, first, part))
                first += len(part)
        for (s, n), own in sorted(by_size.items(), key=lambda group: group[0]):
            self.groups[s].append(n)
            line = np.concatenate([part for _, _, part in own])
            base = np.cumsum([0] + [len(part) for _, _, part in own])
            offsets = [np.arange(len(part) - n + 1) for _, _, part in own]
            starts = np.concatenate([b + o for b, o in zip(base, offsets)])
            ends = np.concatenate([np.full(len(o), e) for e, o in zip(base[1:], offsets)])
            item = np.concatenate([np.full(len(o), i) for (i, _, _), o in zip(own, offsets)])
            offset = np.concatenate([first + o for (_, first, _), o in zip(own, offsets)])
            for t in range(tables):
                _, keys = self.sampler.walk(line, starts, ends, n, t)
                for level, key in enumerate(keys):
                    self.meets[level][(key & np.uint64(_BITMAP - 1)).astype(np.int64)] = True
                rows[0].append(keys[-1])
                rows[1].append(item)
                rows[2].append(offset)
        keys, item, offset = (np.concatenate(r) if r else np.empty(0, np.int64) for r in rows)
        order = np.argsort(keys, kind="stable")
        self.key, self.item, self.offset = keys[order].astype(np.uint64), item[order], offset[order]
        # a long item's masks grow with the square of its words: made for each search that meets it
        self.masks = [bit_masks(words) if len(words) <= PART else None for words in items]

    def candidates(self, words: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
        """(place of the item's first word, item, text) for all windows that share a key, each once."""
        found = []
        lengths = np.diff(doc_start)
        for s, sizes in self.groups.items():
            per_doc = -(-lengths // s)
            doc = np.repeat(np.arange(len(lengths)), per_doc)
            first = np.cumsum(per_doc) - per_doc
            starts = doc_start[doc] + (np.arange(len(doc)) - first[doc]) * s
            ends = doc_start[doc + 1]
            for lo in range(0, len(starts), 1 << 16):
                hi = lo + (1 << 16)
                a, z, d = starts[lo:hi], ends[lo:hi], doc[lo:hi]
                base, stop = int(a[0]), min(int(z[-1]), int(a[-1]) + 2 * max(sizes) + 64)
                part = words[base:stop]
                for t in range(self.sampler.tables):
                    for n in sizes:
                        hit, (key,) = self.sampler.walk(part, a - base, z - base, n, t, self.meets)
                        left = np.searchsorted(self.key, key, "left")
                        count = np.searchsorted(self.key, key, "right") - left
                        hit, left, count = hit[count > 0], left[count > 0], count[count > 0]
                        if len(hit):
                            at = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
                            hit = np.repeat(hit, count)
                            found.append(np.column_stack([a[hit] - self.offset[at], self.item[at], d[hit]]))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)

    def search(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """For each text: (item, fewest edits, number of places checked within the limit)."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not len(self.key) or not texts:
            return out
        doc_start = np.cumsum([0] + [len(t) for t in texts])
        words = np.concatenate(texts)
        if not len(words):
            return out
        best: dict[tuple[int, int], list[int]] = {}
        long: tuple[int, dict[int, int]] = (-1, {})  # the masks of the last long item
        found = self.candidates(words, doc_start)
        for place, item, doc in found[np.lexsort((found[:, 0], found[:, 1], found[:, 2]))].tolist():
            m = len(self.items[item])
            limit = int(self.max_ratio * m)
            had = best.get((doc, item))
            if had and had[2] >= place - limit:  # the same passage, met at a shifted place
                continue
            # the passage may start and end up to the limit away from where the window puts it
            region = words[max(doc_start[doc], place - limit): max(doc_start[doc], min(doc_start[doc + 1], place + m + 2 * limit))]
            masks = self.masks[item]
            if masks is None:
                if long[0] != item:
                    long = item, bit_masks(self.items[item])
                masks = long[1]
            region = region.tolist()
            # every word of the item that is not edited stands in the region
            if sum(map(masks.__contains__, region)) < m - limit:
                continue
            edits = edit_distance_within(masks, m, region)
            if edits <= limit:
                if had:
                    had[0], had[1], had[2] = min(had[0], edits), had[1] + 1, place
                else:
                    best[doc, item] = [edits, 1, place]
        for (doc, item), (edits, places, _) in sorted(best.items()):
            out[doc].append((item, edits, places))
        return out


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The words after so many random replacements, deletions and insertions."""
    line = words.tolist()
    for _ in range(edits):
        k, kind = int(rng.integers(0, len(line) + 1)), int(rng.integers(0, 3))
        if kind == 0 and k < len(line):
            line[k] = int(rng.integers(1, 1 << 62))
        elif kind == 1 and k < len(line) and len(line) > 1:
            del line[k]
        else:
            line.insert(k, int(rng.integers(1, 1 << 62)))
    return np.array(line, dtype=np.uint64)


def tables_for(items: list[np.ndarray], recall: float, design_ratio: float, max_ratio: float, most: int = MOST) -> int:
    """Fewest tables (even, 4 at least) with which randomly edited items are found at the target recall."""
    rng = np.random.default_rng(SEED)
    own = [w for w in items if len(w)]
    own = [own[i] for i in rng.permutation(len(own))[:JUDGED]]
    if not own:
        return 4
    filler = rng.integers(1, 1 << 62, 64).astype(np.uint64)
    texts = [np.concatenate([filler[: int(rng.integers(0, 17))], edited(w, int(design_ratio * len(w)), rng), filler[40:]])
             for _ in range(COPIES) for w in own]
    share = 0.0
    for tables in range(4, most + 1, 2):
        found = Index(own, tables, max_ratio).search(texts)
        share = sum(any(f[0] == i % len(own) for f in hits) for i, hits in enumerate(found)) / len(texts)
        if share - math.sqrt(share * (1.0 - share) / len(texts)) >= recall:
            return tables
    logging.getLogger(__name__).warning("%d tables find %.3f of the edited items, not the target of %.3f", most, share, recall)
    return most


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_items: int = 2000, block_words: int = 200_000) -> Iterator[list]:
    """Lists of (item_id, words) of bounded size."""
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // (5 * block_words)))
    for b in range(blocks):
        out = []
        for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).sort("item_id", "text").collect():
            out.append((r["item_id"], word_hashes(r["text"])))
        yield out


def matches(index: Index, text: Column) -> Column:
    """Array of (item, edits, places) of a text column; item is the place in the index's list."""
    kind = pa.list_(pa.struct([("item", pa.int32()), ("edits", pa.int32()), ("places", pa.int32())]))

    def run(texts: pa.Array) -> pa.Array:
        out, held, size = [], [], 0
        for t in texts:
            held.append(word_hashes(t.as_py()))
            size += len(held[-1])
            if size >= CHUNK_WORDS:
                out += index.search(held)
                held, size = [], 0
        out += index.search(held)
        return pa.array([[dict(zip(("item", "edits", "places"), f)) for f in hits] for hits in out], kind)

    return F.arrow_udf(run, "array<struct<item:int,edits:int,places:int>>")(text.cast("string"))


def indexes(items: DataFrame, item_id_col: str = "item_id", item_text_col: str = "text", recall: float = 0.98,
            design_ratio: float | None = None, max_ratio: float = 0.2) -> Iterator[tuple[list, Index]]:
    """Each block's item ids and index."""
    for block in item_blocks(items, item_id_col, item_text_col):
        words = [w for _, w in block]
        tables = tables_for(words, recall, max_ratio if design_ratio is None else design_ratio, max_ratio)
        yield [i for i, _ in block], Index(words, tables, max_ratio)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", **how: float) -> DataFrame:
    """(doc_id, item_id, edits, places): items found, one row for each pair of a document id and an item id."""
    out = None
    for ids, index in indexes(items, item_id_col, item_text_col, **how):
        found = docs.select(F.col(id_col).alias("doc_id"), F.explode(matches(index, F.col(text_col))).alias("m"))
        names = docs.sparkSession.createDataFrame([(k, i) for k, i in enumerate(ids)], f"item int, item_id {items.schema[item_id_col].dataType.simpleString()}")
        block = found.select("doc_id", "m.*").join(names, "item").select("doc_id", "item_id", "edits", "places")
        out = block if out is None else out.unionByName(block)
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.sum("places").alias("places"))


def keep_uncontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                        item_text_col: str = "text", **how: float) -> DataFrame:
    """Rows whose text holds no item, all columns kept."""
    for _, index in indexes(items, item_id_col, item_text_col, **how):
        mark = fresh_name(docs, "_leaks")
        docs = docs.withColumn(mark, F.size(matches(index, F.col(text_col)))).where(F.col(mark) == 0).drop(mark)
    return docs
