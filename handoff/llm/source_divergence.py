"""Source divergence audit: how the words of each source differ from its language, strings joined in last.

Every language keeps the V terms that stand in at least ``min_docs`` of its documents. A group (a source
within a language, or the language itself) with N occurrences of kept terms gives a kept term of c
occurrences p = 1 + floor(10^9 (c + 1) / (N + V)). Between two such shares the divergence is
f = floor((p - q)(p - q) / q). ``pair`` rows sum f over all kept terms, for a source against each other
source; ``term`` rows list the terms a source has more of than its language.

Late string materialization:

* one pass over the texts counts words per task and group and writes (group, 64-bit digest of the term,
  occurrences, documents, term) once; all counting afterwards reads and shuffles the digest alone: once by
  group and digest, once by language and digest;
* of every digest that enough documents hold, the smallest and the largest string are kept. Where they
  differ, two terms share the digest: such digests (only those) are split by their strings into numbered
  ones and counted anew;
* the strings are joined back to the rows that are kept for the report, and to nothing else.

Hot groups are counted within each task before any shuffle, so a source or a word that holds a third of
all rows is one row per task. Terms that a source lacks are never written out: a pair's sum is that of
two empty sources, corrected by how often each count occurs in one source, and by the terms that both
hold. These are summed within tasks: a term's counts in the sources of its language meet as arrays, and a
task adds them up by pair of sources, in tiles of a bounded number of sources. The top of a group is found
by a window whose limit is pushed below its shuffle; rows that tie at the limit are compared by their
strings the same way.

Defined cases: null text, lang and source are ''. Groups without any term have rows in ``pair`` like
any other; where a language keeps no term the value is 0. A language with one source has no ``pair``
rows. Repeated rows are documents of their own. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handoff.llm.common import quoted, runs_of_equal, text_bytes, whole_groups, write_shared
from handoff.llm.word_hashes import BATCH_BYTES, Counts, count_long_text, count_words, merged, mixed

#: Fixed number of the shares.
SCALE = 1_000_000_000
#: Terms a task holds before it writes its counts.
HELD_TERMS = 800_000
#: Sources of one tile of sums, tiles a task holds, and the bit at which sums are held in two halves (no overflow).
TILE, HELD_TILES, SPLIT = 256, 64, 20
#: Pairs of rows that a task adds up at a time.
PAIRS = 1_000_000
TERM = ["digest", "part"]
NAMES = ["lang", "source", "digest", "n", "docs", "term"]


def group_counts(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(lang, source, digest, n, docs, term) counted within tasks; one row without a digest per group seen.

    ``bits`` below 64 cuts the digests, to provoke collisions in tests.
    """
    mask = np.uint64((1 << bits) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        held: list[Counts] = []

        def out() -> Iterator[pa.RecordBatch]:
            c = merged(held)
            order = np.argsort(c.group, kind="stable")  # a group's rows together: its names take no room
            lang, source = (pa.array([g[k] for g in numbers], pa.string()).take(pa.array(c.group[order])) for k in (0, 1))
            digest = (mixed(c.hash[order]) & mask).view(np.int64)
            terms = c.terms().take(pa.array(order)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, source, pa.array(digest), pa.array(c.n[order]), pa.array(c.docs[order]), terms], names=NAMES)
            held.clear()

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts, groups, size = [], [], 0
            for lang, source, text in zip(langs, sources, text_bytes(batch.column("text"))):
                group = numbers.setdefault((lang, source), len(numbers))
                if len(text) > BATCH_BYTES:
                    held.append(count_long_text(text, group))
                else:
                    texts.append(text)
                    groups.append(group)
                    size += len(text)
                    if size > BATCH_BYTES:
                        held.append(count_words(texts, groups))
                        texts, groups, size = [], [], 0
                if sum(map(len, held)) > HELD_TERMS:
                    held[:] = [merged(held)]
                    if len(held[0]) > HELD_TERMS // 2:
                        yield from out()
            if texts:
                held.append(count_words(texts, groups))
        if held:
            yield from out()
        if numbers:
            none = [pa.nulls(len(numbers), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([*(pa.array([g[k] for g in numbers], pa.string()) for k in (0, 1)), *none], names=NAMES)

    return docs.mapInArrow(count, "lang string, source string, digest long, n long, docs long, term string")


def _kept(counted: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, digest, part, n, lang_n) of the digests that enough documents of a language hold."""
    sums = counted.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", *TERM)  # at most one row for each source of the language
    sums = sums.select("lang", "source", *TERM, "n", F.sum("n").over(whole).alias("lang_n"), F.sum("docs").over(whole).alias("docs"))
    return sums.where(F.col("docs") >= min_docs).drop("docs")


def _names(counted: DataFrame, kept: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(digest, part, term) of the kept digests, and the kept rows with the digests that two terms share split."""
    ends = counted.join(kept.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(
        F.min("term").alias("low"), F.max("term").alias("high"))
    ends = write_shared(ends, "strings")
    names = ends.where("low = high").select("digest", F.lit(0).alias("part"), F.col("low").alias("term"))
    shared = ends.where("low <> high").select("digest")
    if shared.isEmpty():
        return names, kept
    rows = counted.drop("part").join(shared, "digest", "left_semi")
    number = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    split = write_shared(rows.select("digest", "term").distinct().withColumn("part", number), "split")
    again = _kept(rows.join(split, ["digest", "term"]), min_docs)
    kept = write_shared(kept.join(shared, "digest", "left_anti").unionByName(again), "kept")
    return names.unionByName(split.select("digest", "part", "term")), kept


def _share(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    count, total, kept = (F.col(c) if isinstance(c, str) else c for c in (count, total, kept))
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), total + kept)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _big(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3,
               top: int = 200, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank) as the module text defines them."""
    blank = F.lit("")
    docs = docs.select(*[F.coalesce(F.col(quoted(c)).cast("string"), blank).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    written = write_shared(group_counts(docs, bits), "counts")
    seen = written.select("lang", "source").distinct()
    counted = written.where(F.col("digest").isNotNull())

    counted = counted.withColumn("part", F.lit(0))
    names, counts = _names(counted, write_shared(_kept(counted, min_docs), "kept"), min_docs)

    sizes = counts.select("lang", *TERM, "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = seen.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
        F.coalesce("lang_total", zero).alias("lang_total"))
    groups = write_shared(groups, "groups")
    return _pairs(counts, groups).unionByName(_terms(counts, groups, names, top))


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language, by the sum of f over all kept terms."""
    sides = ["lang", "source", "item"]
    one = groups.select("lang", "source", "total", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    pairs = one.join(other, "lang").where("source <> item")
    p0, q0 = _share(F.lit(0), "total", "v"), _share(F.lit(0), "item_total", "v")
    p, q = _share("x", "total", "v"), _share("y", "item_total", "v")
    none = F.when(F.col("v") > 0, _apart(p0, q0))
    base = pairs.select(*sides, F.coalesce(_big(F.col("v")) * _big(none), F.lit(0).cast("decimal(38,0)")).alias("value"))

    spread = counts.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms"))  # how often each count occurs
    left = pairs.join(spread.withColumnRenamed("n", "x"), ["lang", "source"]).select(
        *sides, (_big(F.col("terms")) * _big(_apart(p, q0) - _apart(p0, q0))).alias("value"))
    right = pairs.join(spread.select("lang", F.col("source").alias("item"), F.col("n").alias("y"), "terms"), ["lang", "item"]).select(
        *sides, (_big(F.col("terms")) * _big(_apart(p0, q) - _apart(p0, q0))).alias("value"))

    both = _both(counts, groups)
    total = base.unionByName(left).unionByName(right).unionByName(both).groupBy(*sides).agg(F.sum("value").cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _both(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): over the terms that both sources hold, what f adds to the sums that
    take one of the two counts as 0."""
    order = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = write_shared(groups.select("lang", "source", "total", "v", order.alias("no")), "numbered")
    key = ["lang", *TERM]
    rows = counts.join(numbered, ["lang", "source"]).select(*key, "no", "n", "total", "v")
    rows = rows.repartition(*key).sortWithinPartitions(*key, "no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, a, b), tile in sums.items():
                tile = tile.reshape(2, TILE, TILE)
                x, y = np.nonzero(tile.any(axis=0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(x)), pa.array(a * TILE + x, pa.int32()), pa.array(b * TILE + y, pa.int32()),
                     pa.array(tile[0, x, y]), pa.array(tile[1, x, y])], names=["lang", "a", "b", "high", "low"])
            sums.clear()

        for t in whole_groups(batches, key):
            lang = t.column("lang").combine_chunks().dictionary_encode()
            lang, langs = lang.indices.to_numpy(), lang.dictionary.to_pylist()
            digest, part, no, n, total, v = (t.column(c).to_numpy().astype(np.int64) for c in ("digest", "part", "no", "n", "total", "v"))
            p, zero = 1 + SCALE * (n + 1) // (total + v), 1 + SCALE // (total + v)
            starts = runs_of_equal(lang, digest, part)
            size = np.diff(starts)
            for left, right in row_pairs(np.repeat(starts[:-1], size), np.repeat(size, size)):
                pa_, qa, pb, qb = p[left], zero[left], p[right], zero[right]
                more = (pa_ - pb) ** 2 // pb - (pa_ - qb) ** 2 // qb - (qa - pb) ** 2 // pb + (qa - qb) ** 2 // qb
                a, b = no[left], no[right]
                across = int(no.max()) // TILE + 1  # tiles in a row
                tile = (lang[left].astype(np.int64) * across + a // TILE) * across + b // TILE
                one = tile[0] == tile[-1] and (tile == tile[0]).all()
                for at in tile[:1].tolist() if one else np.unique(tile).tolist():
                    own = slice(None) if one else np.flatnonzero(tile == at)
                    name = langs[at // across // across], at // across % across, at % across
                    if name not in sums:
                        if len(sums) >= HELD_TILES:
                            yield from out()
                        sums[name] = np.zeros((2, TILE * TILE), dtype=np.int64)
                    where = a[own] % TILE * TILE + b[own] % TILE
                    np.add.at(sums[name][0], where, more[own] >> SPLIT)
                    np.add.at(sums[name][1], where, more[own] & ((1 << SPLIT) - 1))
        yield from out()

    found = rows.mapInArrow(run, "lang string, a int, b int, high long, low long").where("a <> b")
    found = found.groupBy("lang", "a", "b").agg((F.sum(_big(F.col("high"))) * F.lit(1 << SPLIT) + F.sum(_big(F.col("low")))).alias("value"))
    named = numbered.select("lang", "source", "no")
    found = found.join(named.withColumnRenamed("no", "a"), ["lang", "a"])
    return found.join(named.select("lang", F.col("source").alias("item"), F.col("no").alias("b")), ["lang", "b"]).select("lang", "source", "item", _big(F.col("value")).alias("value"))


def row_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every row with every row of its run (which starts at ``starts`` and has ``sizes`` rows), a bounded number at a time."""
    upto = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, side="right")))
        left = np.repeat(np.arange(i, j), sizes[i:j])
        before = np.repeat(upto[i:j] - sizes[i:j], sizes[i:j]) - (upto[i - 1] if i else 0)
        yield left, np.repeat(starts[i:j], sizes[i:j]) + np.arange(len(left)) - before
        i = j


def _terms(counts: DataFrame, groups: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """The terms that a source has more of than its language, to rank ``top``; strings joined to these rows only."""
    group = ["lang", "source"]
    p, q = _share("n", "total", "v"), _share("lang_n", "lang_total", "v")
    more = counts.join(groups, group).where(p > q).select(*group, *TERM, _apart(p, q).alias("value"))
    more = write_shared(more, "more")
    first = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value")))
    least = more.select(*group, "value").withColumn("rank", first).where(F.col("rank") <= top).groupBy(*group).agg(F.min("value").alias("least"))
    near = more.join(least, group).where(F.col("value") >= F.col("least")).join(names, TERM)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))
    ranked = near.select(*group, F.col("term").alias("item"), "value").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select(*group, F.lit("term").alias("part"), "item", "value", "rank")


def oracle_sql(min_docs: int = 3, top: int = 200) -> str:
    """The query in DuckDB's SQL, by strings and with every zero count written out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
grp AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT lang, source, term, lang_n, coalesce(n, 0) AS n,
    sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
    count(*) OVER (PARTITION BY lang, source) AS v,
    sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total
  FROM grp JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, CAST(1 + ({SCALE} * (n + 1)::HUGEINT) // (total + v) AS HUGEINT) AS p,
    CAST(1 + ({SCALE} * (lang_n + 1)::HUGEINT) // (lang_total + v) AS HUGEINT) AS q FROM dense),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item) ASC) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
