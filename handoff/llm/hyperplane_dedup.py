"""Embedding near-duplicates: random-hyperplane signs, exact cosine, components.

Each table cuts space by ``bits`` random hyperplanes; a vector's signs are its key there. Vectors at
cosine c agree on one sign with probability 1 - arccos(c) / pi, so the number of tables follows from
the wanted recall for a pair exactly at the threshold; the number of bits follows from the number of
vectors, so that a key holds about ``bucket`` of them at any size.

Vectors that share a key are compared by cosine in double precision. A pair that shares several keys
is counted in the first of them only, which both rows can tell from their own keys. Equal vectors
are one class from the start, with a count. Large keys are dealt to cells of bounded size. A cell
emits no pairs: for each member the number of vectors linked to it there, and one link to the
smallest member that it reaches there; so a dense group costs rows, not pairs, beyond its cells.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows
with a null id, link with nothing (n_links 0, their own component). Vectors of different lengths
never link. Repeated rows are vectors of their own that link with each other. An empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import recall_tables, runs_of_equal, salted_cells, shrink_to_roots, whole_groups, write_shared
from handoff.llm.components import connected_components

SEED = 5


def parameters(n: int, threshold: float, recall: float, bucket: int) -> tuple[int, int]:
    """(bits of a table, tables) for n vectors."""
    agree = 1.0 - math.acos(threshold) / math.pi
    bits = max(6, math.ceil(math.log2(max(2.0, n / bucket))))
    return bits, recall_tables(agree ** bits, recall)


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, bits]).standard_normal((tables * bits, dim))


def sign_keys(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) array of keys."""
    signs = (vectors @ planes(vectors.shape[1], bits, tables).T > 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _usable(vector: str) -> F.Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_links(classes: DataFrame, threshold: float, bits: int, tables: int, cell_limit: int) -> DataFrame:
    """(node, links, low): partial sums of linked vectors, and the smallest node reached, cell by cell.

    ``classes`` holds node (long), copies (long) and v (array of double); each vector once.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(sizes)])
            keys = np.empty((len(sizes), tables), dtype=np.int64)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                rows = flat[at[own][:, None] + np.arange(dim)[None, :]]
                keys[own] = sign_keys(rows, bits, tables)
            rest = [pa.array(list(k), pa.list_(pa.int64())) for k in (keys,)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, *rest], names=["node", "copies", "v", "keys"])

    signed = classes.select("node", "copies", "v").mapInArrow(sign, "node long, copies long, v array<double>, keys array<long>")
    dealt = signed.withColumn("dim", F.size("v")).select("*", F.posexplode("keys").alias("tab", "key"))
    bucket = ["dim", "tab", "key"]
    group = [*bucket, "cell_a", "cell_b"]
    cells = salted_cells(dealt, bucket, "node", cell_limit).repartition(*group).sortWithinPartitions(*group, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            starts = runs_of_equal(*[t.column(c).to_numpy() for c in group])
            node, copies, salt = (t.column(c).to_numpy() for c in ("node", "copies", "salt"))
            out = [[], [], []]
            for a, z in zip(starts[:-1], starts[1:]):
                if z - a < 2:
                    continue
                own = t.slice(a, z - a).combine_chunks()
                v = own.column("v").combine_chunks().flatten().to_numpy().reshape(z - a, -1)
                v = v / np.linalg.norm(v / np.abs(v).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(v).max(axis=1, keepdims=True)
                near = v @ v.T >= threshold
                np.fill_diagonal(near, False)
                if own.column("cell_a")[0].as_py() != own.column("cell_b")[0].as_py():
                    near &= salt[a:z, None] != salt[None, a:z]  # rows of one salt meet in its own cell
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                tab = own.column("tab")[0].as_py()
                keys = own.column("keys").combine_chunks().flatten().to_numpy().reshape(z - a, -1)
                new = np.ones(len(i), dtype=bool)
                for earlier in range(tab):
                    new &= keys[i, earlier] != keys[j, earlier]
                links = np.bincount(i[new], weights=copies[a:z][j[new]], minlength=z - a).astype(np.int64)
                root = shrink_to_roots(z - a, i, j)
                told = np.flatnonzero((links > 0) | (root != np.arange(z - a)))
                out[0].append(node[a:z][told])
                out[1].append(links[told])
                out[2].append(node[a:z][root[told]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["node", "links", "low"])

    columns = [*group, "salt", "node", "copies", "v", "keys"]
    return cells.select(*columns).mapInArrow(compare, "node long, links long, low long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    recall: float = 0.999, bucket: int = 256, cell_limit: int = 1500) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; see the module text for the defined cases."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("usable", _usable("v") & F.col("vec_id").isNotNull())
    classes = rows.where("usable").groupBy("v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    # a repeated id with different vectors: its classes share the node, and so the component
    classes = write_shared(classes, "vector-classes")
    bits, tables = parameters(classes.count(), threshold, recall, bucket)
    told = write_shared(near_links(classes, threshold, bits, tables, cell_limit), "vector-links")
    groups = connected_components(told, "node", "low").withColumnRenamed("node", "_node")
    linked = told.groupBy(F.col("node").alias("_of")).agg(F.sum("links").alias("links"))
    home = (classes.join(groups, classes["node"] == groups["_node"], "left").join(linked, classes["node"] == linked["_of"], "left")
            .select("v", F.coalesce("component", "node").alias("component"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    found = rows.where("usable").join(home, "v").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
