"""Helpers shared by the operators of this subpackage.

``shared_path`` / ``write_shared`` put intermediate tables in the folder that the session names in
``spark.checkpoint.dir``: every executor reaches it, and a job that loses an executor re-reads the
files instead of recomputing the lineage.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from handoff.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str) -> DataFrame:
    """Write the table once to the shared folder and return a reader of it (lineage cut)."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not hold yet, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, mod ``modulus``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def spread(c: str | Column) -> Column:
    """A value in [0, 1) from the 64-bit hash of the column, for samples that do not depend on order."""
    return F.pmod(F.xxhash64(c), F.lit(1 << 40)) / F.lit(float(1 << 40))


def text_bytes(array: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow string array, straight from its buffer; null: empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[array.offset: array.offset + len(array) + 1]
    view = memoryview(data) if data is not None else memoryview(b"")
    null = array.is_null().to_numpy(zero_copy_only=False) if array.null_count else None
    for i in range(len(array)):
        yield b"" if null is not None and null[i] else bytes(view[at[i]: at[i + 1]])


def _word_bytes(digits: bool) -> bytes:
    """Translation table: A-Z become a-z, bytes of words stay, every other byte becomes a blank."""
    keep = set(range(0x61, 0x7B)) | set(range(0x80, 0x100)) | (set(range(0x30, 0x3A)) if digits else set())
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in keep else 0x20 for b in range(256))


_WITH_DIGITS, _LETTERS = _word_bytes(True), _word_bytes(False)


def word_table(digits: bool = True) -> bytes:
    """The translation table by which ``ascii_words`` parts words."""
    return _WITH_DIGITS if digits else _LETTERS


def ascii_words(text: bytes, digits: bool = True) -> list[bytes]:
    """Words of ASCII letters (lower-cased), characters above 0x7F and, if asked, digits; all else parts them."""
    return text.translate(word_table(digits)).split()


def quoted(name: str) -> str:
    """The column name in back quotes, so that a dot in it is no path."""
    return "`" + name.replace("`", "``") + "`"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder given as a path or URI, and the folder's name in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def runs_of_equal(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows, and the row count as the last entry."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that no group of equal keys is split between two tables.

    Holds one batch and one group; callers bound the group's size by ``salted_cells``.
    """
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if t.num_rows == 0:
            continue
        t = pa.concat_tables([held, t]) if held is not None else t
        cols = [t.column(k).to_numpy() for k in keys]
        last = int(runs_of_equal(*cols)[-2])
        if last:
            yield t.slice(0, last).combine_chunks()
        held = t.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def salted_cells(rows: DataFrame, keys: Sequence[str], member: str, limit: int) -> DataFrame:
    """Split buckets of more than ``limit`` rows into cells that together hold every pair once.

    A bucket of n rows gets s = ceil(n / limit) salts; a row of salt i goes to the cells (i, j) for
    every j, so two rows meet in the cell of their two salts and a cell holds about 2 x ``limit``
    rows at most. Adds ``salt``, ``cell_a``, ``cell_b``. Small buckets are one cell. The bucket
    sizes are counted by a pre-aggregated grouping; only the large ones are joined back.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_s"))
    out = rows.join(hot, list(keys), "left")
    out = out.withColumn("salt", F.when(F.col("_s").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(member), F.lit("cell")), F.col("_s"))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_s"), F.lit(1)) - 1))
    out = out.withColumn("_j", other)
    return (out.withColumn("cell_a", F.least("salt", "_j")).withColumn("cell_b", F.greatest("salt", "_j"))
            .drop("_j", "_s"))


def shrink_to_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row index reachable from each of n rows over the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        before = root.copy()
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        root = root[root]
        if np.array_equal(before, root):
            deeper = root[root]
            if np.array_equal(deeper, root):
                break
            root = deeper
    return root


def recall_tables(p_table: float, recall: float) -> int:
    """Tables needed so that a pair which meets in one table with p_table meets in any with ``recall``."""
    if p_table >= 1.0:
        return 1
    return max(1, math.ceil(math.log(1.0 - recall) / math.log(1.0 - p_table)))
