"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

A document's words (ASCII lower case, split at space and 0x09-0x0D) give ``shingle`` -word shingles,
repeats included; each is hashed by XXH64 (seed 42) and bit i of the fingerprint is 1 if it is set
in over half of the hashes. Two fingerprints that differ in at most d bits, cut into r blocks,
agree in at least r - d blocks; so they share one of the C(r, r - d) masked keys. r follows from the
number of distinct fingerprints, so that a key holds few of them at any size, and every pair within
the distance is found at any r.

Equal fingerprints are one class from the start (a pre-aggregated grouping): copies are never
compared. Large keys are dealt to cells of bounded size (``salted_cells``), and a cell emits no
pairs but one link from each member to the smallest one it reaches there.

Defined cases: null or empty texts and texts without words have fingerprint 0 and are linked like
any other. A null id keeps its row; a component's id is its smallest non-null id, else null.
Repeated rows are rows like any other. ``near_duplicates`` reads no other columns; ``keep_first`` carries
all of them, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from handoff.llm.common import fresh_name, quoted, runs_of_equal, salted_cells, shrink_to_roots, text_bytes, whole_groups, write_shared
from handoff.llm.components import connected_components
from handoff.llm.row_marks import keep_places, placed

#: Fixed values of the fingerprint.
SEED = 42
BITS = 64
#: Shingles hashed at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text's bytes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return int.from_bytes(xxh64_digest(b" ".join(words), SEED), "big")
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-shingle])]
    total = len(starts)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, total, CHUNK):
        part = b"".join([xxh64_digest(joined[s:e], SEED)
                         for s, e in zip(starts[i: i + CHUNK], ends[shingle - 1 + i: shingle - 1 + i + CHUNK])])
        bits = np.unpackbits(np.frombuffer(part, dtype=np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def _fingerprints(texts: pa.Array, shingle: int) -> pa.Array:
    return pa.array(np.array([fingerprint(t, shingle) for t in text_bytes(texts)], dtype=np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    fp = F.arrow_udf(lambda texts: _fingerprints(texts, shingle), "long")
    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col).cast("string")).alias("fp"))


def block_count(n: int, distance: int) -> int:
    """Smallest number of blocks, distance + 2 at least, whose shared keys have more values than there
    are fingerprints."""
    r = distance + 2
    while n > 2 ** (BITS * (r - distance) // r) and r < 4 * (distance + 1):
        r += 1
    return r


def block_masks(r: int, distance: int) -> list[int]:
    """One 64-bit mask (signed) per choice of r - distance of r nearly equal blocks."""
    edges = [BITS * i // r for i in range(r + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, r - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(fps: DataFrame, distance: int, cell_limit: int = 2000) -> DataFrame:
    """(a, b): links that connect every two distinct fingerprints within ``distance`` bits.

    ``fps`` holds column fp, each value once. Pairs farther apart are never linked directly.
    """
    masks = block_masks(block_count(fps.count(), distance), distance)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("tab", "key"))
    cells = salted_cells(keyed, ["tab", "key"], "fp", cell_limit)
    group = ["tab", "key", "cell_a", "cell_b"]
    cells = cells.select(*group, "fp").repartition(*group).sortWithinPartitions(*group, "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            starts = runs_of_equal(*[t.column(c).to_numpy() for c in group])
            fp = t.column("fp").to_numpy()
            bits = fp.view(np.uint64)
            left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(fp))  # rows to the end of the own group
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            held = 0
            rows = np.flatnonzero(left > 1)
            step = 1
            while len(rows):
                near = rows[np.bitwise_count(bits[rows] ^ bits[rows + step]) <= distance]
                a.append(near)
                b.append(near + step)
                held += len(near)
                if held > 2_000_000:  # dense cells: keep what connects the same rows
                    root = shrink_to_roots(len(fp), np.concatenate(a), np.concatenate(b))
                    hung = np.flatnonzero(root != np.arange(len(fp)))
                    a, b, held = [hung], [root[hung]], len(hung)
                step += 1
                rows = rows[left[rows] > step]
            root = shrink_to_roots(len(fp), np.concatenate(a), np.concatenate(b))
            hung = np.flatnonzero(root != np.arange(len(fp)))
            if len(hung):
                yield pa.RecordBatch.from_arrays([pa.array(fp[hung]), pa.array(fp[root[hung]])], names=["a", "b"])

    return cells.mapInArrow(compare, "a long, b long")


def _components(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, component) of every distinct fingerprint in ``classes``."""
    groups = connected_components(near_links(classes.select("fp"), distance), "a", "b")
    home = classes.select("fp").join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    return home.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row; see the module text for the defined cases."""
    marked = write_shared(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    classes = write_shared(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    home = classes.join(_components(classes, distance), "fp")
    lowest = home.groupBy("component").agg(F.min("low").alias("component_id"))
    home = write_shared(home.join(lowest, "component").select("fp", "component_id"), "home")
    return marked.join(home, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               distance: int = 3) -> DataFrame:
    """One row of each group, all columns kept: the row with the group's smallest id, null ids last.

    Of several rows with that id the one whose text has the smallest XXH64 stays, then the first in the
    order in which the table is read. The rows are written once with their places; only fingerprints,
    ids and places are shuffled.
    """
    fp_name, place = fresh_name(docs, "_fp"), fresh_name(docs, "_place")
    fp = F.arrow_udf(lambda texts: _fingerprints(texts, shingle), "long")
    text, doc_id = F.col(quoted(text_col)).cast("string"), F.col(quoted(id_col))
    rows = placed(docs.withColumn(fp_name, fp(text)), place)
    rank = F.struct(doc_id.isNull(), doc_id, F.xxhash64(text), F.col(place).alias("place"))
    classes = write_shared(rows.groupBy(F.col(fp_name).alias("fp")).agg(F.min(rank).alias("first")), "classes")
    firsts = classes.join(_components(classes, distance), "fp").groupBy("component").agg(F.min("first").alias("first"))
    return keep_places(rows, place, firsts.select(F.col("first.place").alias("place")), docs.columns)
