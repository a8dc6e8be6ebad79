"""Best-fit packing into sequences of several permitted lengths.

A document of ``length`` ids goes into a bin whole, or in pieces of the largest permitted length and
a rest. Pieces are placed in falling length: into the open bin with the least room that still holds
the piece (best fit), else into a new bin. A bin of size c costs c + ``bin_cost``. The new bin's
size is the one with the least cost per id that it is expected to hold: the piece, and of the ids
still to come in pieces that fit the rest, what the open bins' room does not already wait for. Each
group of pieces is also packed with every single opening size; the cheapest packing stays, so the
joint choice never loses to one fixed length. In the end each bin shrinks to the smallest permitted
length that holds its contents.

Pieces are dealt to groups of about ``group_pieces`` by a hash, and each group is packed by one task
on its own: lengths and ids only, texts stay where they are. More groups leave at most a few
part-filled bins each.

Lengths are those of a tokenizer's ids with the end id (``token_length``), or of UTF-8 bytes for byte-level
training (``byte_length``); any other length column may be given.

Defined cases: a document without text has its end id only (length 1 by either measure); a null
or non-positive given length places nothing. Null ids are kept, repeated rows are documents of their
own, extra columns are not read, and an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import write_shared

SIZES = (1024, 2048, 4096, 8192, 16384)
BIN_COST = 64
#: Characters encoded at a time.
HELD_CHARS = 1_000_000


def byte_length(text_col: str = "text") -> Column:
    """Ids of a byte-level vocabulary: one for each UTF-8 byte, and the end id."""
    return F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1


def token_length(tokenizer: str, text_col: str = "text", kept: int = 1_000_000) -> Column:
    """Ids of a tokenizer of the tokenizers library, without special ones, and the end id.

    A task keeps the ids of about ``kept`` words: fewer take less memory and more time.
    """

    def run(texts: pa.Array) -> pa.Array:
        from handoff.llm.elias_fano import encoder

        enc, out, held, chars = encoder(tokenizer, 0), [], [], 0
        for text in texts:
            held.append(text.as_py() or "")
            chars += len(held[-1])
            if chars >= HELD_CHARS:
                out += enc.lengths(held, kept)
                held, chars = [], 0
        return pa.array(out + enc.lengths(held, kept), pa.int64())

    return F.arrow_udf(run, "long")(F.col(text_col).cast("string"))


def best_fit(lengths: Sequence[int], sizes: Sequence[int], bin_cost: int, only: int | None = None) -> tuple[list[int], list[int], list[int]]:
    """Bins of pieces given in falling length: (bin of each piece, offset of each piece, size of each bin).

    ``only`` opens every bin at this size (a larger one where the piece needs it).
    """
    sizes = sorted(sizes)
    n = len(lengths)
    after = np.concatenate([np.cumsum(np.asarray(lengths, dtype=np.int64)[::-1])[::-1], [0]]).tolist()  # ids from piece i on
    falling = [-x for x in lengths]
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, sorted
    used: list[int] = []
    open_room = 0
    bins, offsets = [], []
    for i, length in enumerate(lengths):
        k = bisect_left(room, (length, -1))
        if k < len(room):
            left, b = room.pop(k)
            open_room -= left
        else:
            b, best = len(used), None
            for size in sizes if only is None else [s for s in sizes if s >= max(only, length)][:1] or sizes[-1:]:
                if size < length:
                    continue
                fits = max(i + 1, bisect_left(falling, length - size))  # the first later piece that fits the rest
                to_come = max(0, after[min(fits, n)] - open_room)
                cost = (size + bin_cost) / (length + min(size - length, to_come))
                if best is None or cost < best[0]:
                    best = (cost, size)
            left = best[1]
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += length
        if left > length:
            insort(room, (left - length, b))
            open_room += left - length
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pack_group(lengths: Sequence[int], sizes: Sequence[int], bin_cost: int) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the joint choice and each single opening size."""
    found = [best_fit(lengths, sizes, bin_cost, only) for only in (None, *sorted(sizes))]
    return min(found, key=lambda f: sum(f[2]) + bin_cost * len(f[2]))


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, sizes: Sequence[int] = SIZES,
         bin_cost: int = BIN_COST, group_pieces: int = 50_000) -> DataFrame:
    """One row for each piece: doc_id, piece, start and n_ids of the piece in its document; bin_id,
    bin_size, bin_used and offset of its place."""
    largest = max(sizes)
    length = byte_length() if length is None else length
    # written before it is filtered: a filter on the length would have it computed twice
    rows = write_shared(docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("length")), "lengths")
    rows = rows.where("length > 0").withColumn("row", F.monotonically_increasing_id())
    pieces = rows.select("doc_id", "row", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {largest}"))).alias("piece"))
    n = rows.agg(F.sum(F.expr(f"(length - 1) div {largest} + 1"))).first()[0] or 0
    groups = max(1, -(-n // group_pieces))
    start = F.col("piece") * largest
    pieces = pieces.select(F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group"), "doc_id", "row", "piece", start.alias("start"),
                           F.least(F.lit(largest), F.col("length") - start).alias("n_ids"))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_ids", "row", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        bins, offsets, capacity = pack_group(part["n_ids"].tolist(), sizes, bin_cost)
        bins = np.array(bins, dtype=np.int64)
        part["bin_id"] = (int(key[0]) << 32) + bins
        part["bin_size"] = np.array(capacity, dtype=np.int64)[bins]
        part["bin_used"] = np.bincount(bins, weights=part["n_ids"]).astype(np.int64)[bins]
        part["offset"] = np.array(offsets, dtype=np.int64)
        return part[["doc_id", "piece", "start", "n_ids", "bin_id", "bin_size", "bin_used", "offset"]]

    kind = docs.schema[id_col].dataType.simpleString()
    return pieces.groupBy("group").applyInPandas(run, f"doc_id {kind}, piece long, start long, n_ids long, bin_id long, bin_size long, bin_used long, offset long")
