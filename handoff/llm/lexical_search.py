"""Ranked lexical search, term at a time with limited accumulators.

For each item of a query set the terms are taken rarest first. A document gets an accumulator when one
of the terms taken so far adds to its score. As soon as the bounds of the terms that remain add up to
less than the k-th best partial score, a document without an accumulator cannot be among the best k,
so no more are created; the remaining terms only update the survivors, exactly, and a survivor whose
partial score plus the remaining bounds falls short is let go.

As Spark jobs:

1. one pass over the texts writes, per document, its length and the query terms it holds (the forward
   rows; nothing is shuffled, and words no item asks for are never emitted);
2. two small aggregates give N, L, document frequencies and the largest weight factor of each term;
3. a few rounds over the forward rows find, per item, how many of its terms create accumulators: each
   task keeps the k best partial scores of an item, and the k-th of all is the threshold;
4. a last round scores the survivors; only rows that reach the threshold leave a task, and the best k
   are picked by a window whose limit is pushed below its shuffle.

The query set is read in blocks of a bounded number of words and bytes; only a block's vocabulary
travels to tasks and only per-term and per-item numbers come to the driver. Documents are all scored.

Terms are words of ASCII letters (A-Z lower-cased), digits and characters above 0x7F. Scores are 64-bit
integers: weight w = floor(1000 ln((2N + 2) / (2 df + 1))), length m = 100 - 50 + (50 n N) div L, and a
term adds w ((1000000000 tf) div (1000 tf + 20 m)).

Defined cases: null or empty texts and texts without terms count neither in N nor in L and are never
found; an item with a null text or without terms gives no rows. A word that an item repeats counts
once. Repeated documents and repeated items give their rows each; rows of equal score stand by document
id, null ids last. Extra columns are not read. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from handoff.llm.common import ascii_words, quoted, text_bytes, write_shared

#: Bounds of one block of items: (item, term) pairs, and bytes of their text.
BLOCK_PAIRS, BLOCK_BYTES = 1 << 18, 1 << 25
#: Fixed numbers of the score.
SCALE, TF_UNIT, LENGTH_UNIT, BASE_LENGTH, LENGTH_SHARE = 1_000_000_000, 1000, 20, 100, 50


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_blocks(items: DataFrame) -> Iterator[dict[int, list[bytes]]]:
    """Items (no, text) as {no: distinct terms}, a bounded number of terms at a time."""
    block, pairs, size = {}, 0, 0
    for row in items.select("no", "text").toLocalIterator():
        terms = sorted(set(ascii_words((row["text"] or "").encode())))
        if not terms:
            continue
        if block and (pairs + len(terms) > BLOCK_PAIRS or size + sum(map(len, terms)) > BLOCK_BYTES):
            yield block
            block, pairs, size = {}, 0, 0
        block[row["no"]] = terms
        pairs += len(terms)
        size += sum(map(len, terms))
    if block:
        yield block


def forward_rows(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs): length and query terms (numbers) of every document that has a term."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})  # one block's words
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            rows, lengths, terms, tfs, ends = [], [], [], [], [0]
            for i, text in enumerate(text_bytes(batch.column("text"))):
                words = ascii_words(text)
                if not words:
                    continue
                held = Counter(map(known.get, words))
                held.pop(None, None)
                rows.append(i)
                lengths.append(len(words))
                terms.extend(held)
                tfs.extend(held.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(count, f"doc_id {id_type}, n long, terms array<int>, tfs array<long>")


class Postings:
    """The query terms of one batch of forward rows, by term: document rows and what the term adds to each."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int):
        lists = batch.column("terms")
        counts = lists.value_lengths().to_numpy()
        rows = np.repeat(np.arange(batch.num_rows), counts)
        terms = lists.flatten().to_numpy()
        tf = batch.column("tfs").flatten().to_numpy()
        m = BASE_LENGTH - LENGTH_SHARE + LENGTH_SHARE * batch.column("n").to_numpy() * n_docs // n_terms
        adds = weights[terms] * (SCALE * tf // (TF_UNIT * tf + LENGTH_UNIT * m[rows]))
        order = np.argsort(terms, kind="stable")
        self.n = batch.num_rows
        self._rows, self._adds = rows[order], adds[order]
        self._starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self._starts[term], self._starts[term + 1]
        return self._rows[lo:hi], self._adds[lo:hi]

    def create(self, terms: list[int]) -> np.ndarray:
        """Accumulators of every row after the creating terms; 0: none created."""
        acc = np.zeros(self.n, dtype=np.int64)
        for t in terms:
            rows, adds = self.of(t)
            acc[rows] += adds
        return acc

    def update(self, acc: np.ndarray, terms: list[int], bounds: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of the survivors that reach ``least`` once the remaining terms are added."""
        rest = sum(bounds)
        alive = np.flatnonzero((acc > 0) & (acc + rest >= least))
        score = acc[alive]
        for t, bound in zip(terms, bounds):
            rows, adds = self.of(t)
            rest -= bound
            if len(rows) and len(alive):
                at = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
                score = score + np.where(rows[at] == alive, adds[at], 0)
            stay = score + rest >= least
            if not stay.all():
                alive, score = alive[stay], score[stay]
        return alive, score


class ItemPlan:
    """One item's terms, rarest first, their bounds, and how many of them create accumulators so far."""

    def __init__(self, no: int, terms: list[int], df: np.ndarray, bounds: np.ndarray, k: int):
        self.no = no
        self.terms = sorted((t for t in terms if df[t]), key=lambda t: (df[t], t))
        self.bounds = [int(bounds[t]) for t in self.terms]
        self.least = 1  # only scores above 0 are asked for
        held = 0
        self.creating = len(self.terms)
        for i, t in enumerate(self.terms, 1):
            held += int(df[t])
            if held >= k:
                self.creating = i
                break

    def settled(self) -> bool:
        """No document without an accumulator can reach the k-th partial score any more."""
        return sum(self.bounds[self.creating:]) < self.least

    def more(self) -> None:
        self.creating = min(len(self.terms), 2 * self.creating)


def _thresholds(rows: DataFrame, plans: list[ItemPlan], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> dict[int, int]:
    """The k-th best partial score of each plan's item over all documents; items with fewer have none."""
    sent = rows.sparkSession.sparkContext.broadcast((plans, weights))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, w = sent.value
        top = {p.no: np.empty(0, np.int64) for p in todo}
        for batch in batches:
            postings = Postings(batch, w, n_docs, n_terms)
            for p in todo:
                acc = postings.create(p.terms[: p.creating])
                held = np.concatenate([top[p.no], acc[acc >= p.least]])
                top[p.no] = np.partition(held, len(held) - k)[-k:] if len(held) > k else held
        for no, held in top.items():
            if len(held):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), no)), pa.array(held)], names=["no", "partial"])

    partials = rows.select("doc_id", "n", "terms", "tfs").mapInArrow(best, "no long, partial long")
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("partial")))
    kth = partials.withColumn("rank", rank).where(F.col("rank") <= k).where(F.col("rank") == k)
    return {r["no"]: r["partial"] for r in kth.collect()}


def _survivors(rows: DataFrame, plans: list[ItemPlan], weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(no, doc_id, score) of every document that reaches its item's threshold."""
    sent = rows.sparkSession.sparkContext.broadcast((plans, weights))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, w = sent.value
        for batch in batches:
            postings = Postings(batch, w, n_docs, n_terms)
            ids = batch.column("doc_id")
            for p in todo:
                acc = postings.create(p.terms[: p.creating])
                found, score = postings.update(acc, p.terms[p.creating:], p.bounds[p.creating:], p.least)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), p.no)), ids.take(pa.array(found)), pa.array(score)],
                                                     names=["no", "doc_id", "score"])

    return rows.mapInArrow(final, f"no long, doc_id {id_type}, score long")


def _search_block(docs: DataFrame, block: dict[int, list[bytes]], k: int) -> DataFrame | None:
    vocabulary = sorted({t for terms in block.values() for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    rows = write_shared(forward_rows(docs, vocabulary), "forward")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    m = F.expr(f"{BASE_LENGTH - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {n_docs}L) div {n_terms}L")
    held = rows.select(m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("m", "p.terms", "p.tfs")
    factor = F.expr(f"({SCALE}L * tfs) div ({TF_UNIT} * tfs + {LENGTH_UNIT} * m)")
    df, most = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for r in held.groupBy("terms").agg(F.count(F.lit(1)).alias("df"), F.max(factor).alias("most")).collect():  # one row per term of the block
        df[r["terms"]], most[r["terms"]] = r["df"], r["most"]
    weights = np.array([term_weight(n_docs, int(d)) for d in df], dtype=np.int64)
    plans = [ItemPlan(no, [number[t] for t in terms], df, weights * most, k) for no, terms in block.items()]
    open_plans = [p for p in plans if not p.settled()]
    while open_plans:
        kth = _thresholds(rows, open_plans, weights, n_docs, n_terms, k)
        for p in open_plans:
            p.least = max(p.least, kth.get(p.no, 0))
        open_plans = [p for p in open_plans if not p.settled()]
        for p in open_plans:
            p.more()
    found = _survivors(rows, plans, weights, n_docs, n_terms)
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("no", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    docs = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    items = items.select(F.col(quoted(item_col)).alias("item_id"), F.col(quoted(item_text_col)).cast("string").alias("text"))
    items = write_shared(items.withColumn("no", F.monotonically_increasing_id()), "items")
    parts = [part for block in item_blocks(items) if (part := _search_block(docs, block, k)) is not None]
    if not parts:
        id_type, item_type = (f.schema[c].dataType.simpleString() for f, c in ((docs, "doc_id"), (items, "item_id")))
        return docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    return ranked.join(items.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = 50) -> str:
    """The query in DuckDB's SQL: every term of every item scored against every document that holds it."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(table: str) -> str:
        return (f"regexp_extract_all(translate({table}.text, '{upper}', '{lower}'), "
                r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {words('documents')} AS w FROM documents WHERE text IS NOT NULL),
held AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM docs WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM held),
asked AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, unnest(w) AS term FROM (
  SELECT row_number() OVER () AS i, item_id, {words('benchmark')} AS w FROM benchmark WHERE text IS NOT NULL))),
postings AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM postings, total GROUP BY term, nd),
scores AS (
  SELECT i, item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // nt))))) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN held USING (r), total GROUP BY i, item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score
  FROM scores JOIN held USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {k}"""
