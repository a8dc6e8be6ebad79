"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1/-1 (drawn from its code point and the seed). A trigram
binds its letters by position: the first is permuted (rotated) twice, the second once, and the three
are multiplied. A text bundles (adds) the vectors of its trigrams; a language's prototype bundles
the texts of its training rows. A text gets the language whose prototype has the largest cosine.

Texts are lower-cased; letters are the Unicode letters, every run of other characters is one blank,
and the text starts and ends with a blank. Whole texts count, in training and in prediction.

Prototypes are a classifier, fitted on all labelled rows or on a bounded sample: ``fit_rows`` texts of each
language are expected at most (a hash of the id decides, so the sample does not depend on order). Floors on
the cosine are learned from all labelled rows; ``keep_above_floors`` scores each text once. Trigram counts
are summed in Spark; because bundling is linear, a prototype is the count-weighted sum of trigram
vectors, of which one partial sum per task and language is added up. The driver reads one vector
per language.

Defined cases: a null text or one without letters is ``und`` with score 0; without any training row
everything is ``und``. Rows with null lang train nothing. Of equal cosines the first language name
wins. Repeated rows are rows; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import fresh_name, quoted, spread, write_shared

DIM = 2048
SEED = 20
UNKNOWN = "und"
#: Trigram vectors that a worker keeps (64 MB); more are computed again.
KEPT = 1 << 15
#: Trigrams, distinct within their texts, that a fitting task counts at a time.
HELD_TRIGRAMS = 1 << 20
#: The floors: texts of 2^FIRST independent trigrams and more are judged, in classes up to 2^LAST.
FIRST, LAST, SHARE, FACTOR, LEAST_ROWS = 5, 15, 0.01, 0.4, 10
_BLANK = 32
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For every code point: is it a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of the whole text (three code points in 63 bits) and their counts."""
    none = np.empty(0, np.int64)
    if not text:
        return none, none
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return none, none
    after_letter = np.concatenate([[False], letter[:-1]])
    line = np.where(letter, points, _BLANK)[letter | after_letter].astype(np.int64)
    line = np.concatenate([[_BLANK], line] if letter[-1] is np.False_ else [[_BLANK], line, [_BLANK]])
    codes = (line[:-2] << 42) | (line[1:-1] << 21) | line[2:]
    return np.unique(codes, return_counts=True)


class Vectors:
    """Trigram vectors of one worker, made on demand and kept up to a bound."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.row_of: dict[int, int] = {}
        self.rows = np.empty((256, dim), dtype=np.int8)

    def letter(self, point: int) -> np.ndarray:
        v = self.letters.get(point)
        if v is None:
            if len(self.letters) >= KEPT:
                self.letters.clear()
            draw = np.random.default_rng([self.seed, point]).integers(0, 2, self.dim, dtype=np.int8)
            v = self.letters[point] = 2 * draw - 1
        return v

    def trigram(self, code: int) -> np.ndarray:
        low = (1 << 21) - 1
        return np.roll(self.letter(code >> 42), 2) * np.roll(self.letter((code >> 21) & low), 1) * self.letter(code & low)

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Count-weighted sum of the trigrams' vectors."""
        total = np.zeros(self.dim, dtype=np.float64)
        for i in range(0, len(codes), KEPT // 4):
            part = codes[i: i + KEPT // 4].tolist()
            if len(self.row_of) + len(part) > KEPT:
                self.row_of.clear()
            at = np.fromiter((self._row(c) for c in part), dtype=np.int64, count=len(part))
            total += counts[i: i + KEPT // 4].astype(np.float32) @ self.rows[at].astype(np.float32)
        return total

    def _row(self, code: int) -> int:
        row = self.row_of.get(code)
        if row is None:
            row = self.row_of[code] = len(self.row_of)
            if row >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            self.rows[row] = self.trigram(code)
        return row


_workers: dict[tuple[int, int], Vectors] = {}


def vectors(dim: int = DIM, seed: int = SEED) -> Vectors:
    """The worker's vectors; Python workers are used again by later tasks."""
    return _workers.setdefault((dim, seed), Vectors(dim, seed))


def _labelled(docs: DataFrame, text_col: str, lang_col: str, id_col: str, train: Column | None, fit_rows: int | None) -> DataFrame:
    """(lang, text) of the rows where ``train`` holds and lang is not null: all, or ``fit_rows`` of a language expected at most."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       (F.lit(True) if train is None else train).alias("use")).where("use and lang is not null")
    if fit_rows is None:
        return rows.select("lang", "text")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.coalesce(spread(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(0.0))
    # one row for each language, as the model itself has
    return rows.join(F.broadcast(sizes), "lang").where(share * F.col("n") < F.lit(float(fit_rows))).select("lang", "text")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        train: Column | None = None, fit_rows: int | None = 5000) -> dict[str, np.ndarray]:
    """Prototype of each language, learned from the rows where ``train`` holds and lang is not null (None: from all of them)."""
    sample = _labelled(docs, text_col, lang_col, id_col, train, fit_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list] = {}
            held = 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = trigrams(text.as_py())
                seen.setdefault(lang, []).append(found)
                held += len(found[0])
                if held >= HELD_TRIGRAMS:
                    yield from sums(seen)
                    seen, held = {}, 0
            yield from sums(seen)

    def sums(seen: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, parts in seen.items():
            codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(n.astype(np.int64))],
                                             names=["lang", "gram", "n"])

    grams = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            codes, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lang in set(langs):
                own = langs == lang
                sums[lang] = sums.get(lang, 0.0) + vectors().bundle(codes[own], n[own])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                             names=["lang", "v"])

    partial = grams.mapInArrow(bundle, "lang string, v array<double>")
    summed = partial.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # one number per language and dimension
        out.setdefault(r["lang"], np.zeros(DIM))[r["i"]] = r["x"]
    return {lang: v for lang, v in sorted(out.items()) if np.linalg.norm(v) > 0}


def _placed(text: str | None, names: list[str], unit: np.ndarray) -> tuple[str, float, int]:
    """Language, cosine (not below 0) and class of independent trigrams of one text."""
    codes, counts = trigrams(text)
    if not len(codes) or not names:
        return UNKNOWN, 0.0, 0
    size = min(LAST, int(np.log2(counts.sum() ** 2.0 / (counts.astype(np.float64) ** 2).sum())))
    v = vectors().bundle(codes, counts)
    length = float(np.linalg.norm(v))
    if length == 0.0:
        return names[0], 0.0, size
    cosine = unit @ v / length
    best = int(np.argmax(cosine))
    return names[best], float(min(1.0, max(0.0, cosine[best]))), size


def predict(text: str | None, names: list[str], unit: np.ndarray) -> tuple[str, float]:
    """Language and cosine (not below 0) of one text; ``unit`` holds the prototypes at length 1."""
    return _placed(text, names, unit)[:2]


def predicted(prototypes: dict[str, np.ndarray], text: Column) -> Column:
    """Struct (lang_pred, score, size) of a text column; size is the class of independent trigrams."""
    names = list(prototypes)
    unit = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]) if names else np.empty((0, DIM))

    def run(texts: pa.Array) -> pa.Array:
        found = [_placed(t.as_py(), names, unit) for t in texts]
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.int32()))]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "size"])

    return F.arrow_udf(run, "struct<lang_pred:string,score:double,size:int>")(text.cast("string"))


def fit_floors(scored: DataFrame, names: Iterable[str]) -> dict[str, list[float]]:
    """For each language, the floor on the cosine by class of independent trigrams (0: not judged).

    ``scored`` holds every labelled row as (lang, found), found as of ``predicted``.
    """
    scored = scored.where((F.col("found")["lang_pred"] != UNKNOWN) & (F.col("found")["size"] >= FIRST))
    steps = scored.groupBy("lang", F.col("found")["size"].alias("size"), F.floor(F.col("found")["score"] * 200).alias("step"))
    rows: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for r in steps.agg(F.count(F.lit(1)).alias("n")).collect():  # at most 201 rows for each language and class
        rows.setdefault((r["lang"], r["size"]), []).append((r["step"], r["n"]))
    own: dict[tuple[str, int], float] = {}
    for key, steps_of in rows.items():
        step, n = zip(*sorted(steps_of))
        if sum(n) >= LEAST_ROWS:
            own[key] = FACTOR * step[int(np.searchsorted(np.cumsum(n), SHARE * sum(n), "right"))] / 200
    floors = {}
    for lang in names:
        floors[lang] = [0.0] * (LAST + 1)
        judged = sum(n for (name, _), steps_of in rows.items() if name == lang for _, n in steps_of) >= LEAST_ROWS
        for size in range(FIRST, LAST + 1) if judged else ():
            others = [floor for (_, k), floor in own.items() if k == size]
            floors[lang][size] = own.get((lang, size), min(others, default=floors[lang][size - 1]))
    return floors


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    found = docs.select(F.col(id_col).alias("doc_id"), predicted(prototypes, F.col(text_col)).alias("found"))
    return found.select("doc_id", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float, text_col: str = "text") -> DataFrame:
    """Rows whose text has a language: not ``und``, and a cosine of at least ``min_score``."""
    mark = fresh_name(docs, "_found")
    return _known(docs.withColumn(mark, predicted(prototypes, F.col(text_col))), mark, min_score, {}).select(*map(quoted, docs.columns))


def keep_above_floors(docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float = 0.0, text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """As ``keep_identified``, and a cosine of at least the floor that all labelled rows teach for the language.

    The rows are written with what was predicted, so each text is scored once for the floors and the choice.
    """
    mark = fresh_name(docs, "_found")
    found = write_shared(docs.withColumn(mark, predicted(prototypes, F.col(text_col))), "identified")
    labelled = found.select(F.col(lang_col).cast("string").alias("lang"), F.col(mark).alias("found")).where("lang is not null")
    return _known(found, mark, min_score, fit_floors(labelled, prototypes)).select(*map(quoted, docs.columns))


def _known(found: DataFrame, mark: str, min_score: float, floors: dict[str, list[float]]) -> DataFrame:
    lang, score, size = (F.col(mark)[k] for k in ("lang_pred", "score", "size"))
    known = (lang != UNKNOWN) & (score >= min_score)
    for name, floor in floors.items():
        known = known & ((lang != name) | (score >= F.array(*map(F.lit, floor))[size]))
    return found.where(known)
