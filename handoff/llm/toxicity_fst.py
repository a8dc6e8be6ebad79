"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read a clause word by word, each over the symbols other, insult, threat,
target, negation and report; a missing arc copies its symbol at weight 1:

- report: after a word of saying, insults and threats of the clause count half;
- negation: within three words after a negation they count 0.3;
- target: an insult within four words after a person counts 1.5;
- insult: an insult right after an insult counts 1.2;
- threat: a threat word alone counts nothing; a person within three words after it completes it.

A threat's weight is that of the threat word: report and negation rewrite it to a symbol that names
its weight, and the completion carries this weight (of several open threats, the largest).

They are composed into one transducer (weights multiply along a path), and a clause scores the sum
of its outputs' weights times the insult's learned strength. Clauses end at punctuation and line
ends; a word of saying holds on over colons, commas, double quotes and the line end after a colon,
up to the end of its sentence or bracket. A text is scored by its matched
clauses: the strongest clause, the sum, and the number of matched clauses go through a logistic.

The insults are learned, as whole words and as stems (word beginnings), from a bounded sample of
labelled rows: ``fit_rows`` of each label at most, picked by the hash of the id. A term's support is
the number of different neighbour pairs it stands between in toxic texts, so the words of one text
that was copied many times are not taken for insults. A word that the sample holds is judged by itself: it
takes its stems' strength only if no clean text holds it. For a word that the sample lacks, a stem counts
by the share of its completions in toxic texts that were new when they came (types / (texts + types)): a
stem that only ever was one word says little about another one ("idiot" does not mark "idiom"), one with
many endings says more. Word lists of the other symbols are fixed.

Defined cases: null and empty texts get the logistic's value without matches; without rows of both
labels no term is learned and no text is marked. Repeated label rows of one id count once (the
higher label). Repeated documents are rows; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import fresh_name, write_shared

# Words of the grammar's symbols (English, German, French, Spanish).
NEGATIONS = "not no never without nicht kein keine nie ohne pas jamais sans nunca sin ningún".split()
REPORTS = "said says called wrote quoted claimed sagte nannte schrieb dit appelé écrit dijo llamó escribió".split()
TARGETS = ("you your he she him her they them du dich dein ihr euch er sie tu toi vous il elle ils elles "
           "tú te usted ustedes él ella ellos ellas").split()
THREATS = ("kill hurt beat destroy punish strangle töten schlagen vernichten erwürgen tuer frapper détruire "
           "matar golpear destruir").split()
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, HIT, SAID_THREAT, NO_THREAT, SAID_NO_THREAT = range(10)
READ = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
REPORTED, NEGATED = 0.5, 0.3
#: Weight of a threat word by the symbol that report and negation write for it.
THREAT_WEIGHT = {THREAT: 1.0, SAID_THREAT: REPORTED, NO_THREAT: NEGATED, SAID_NO_THREAT: REPORTED * NEGATED}
SYMBOL_OF = ({w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS} | {w: TARGET for w in TARGETS}
             | {w: THREAT for w in THREATS})
#: Strength of a completed threat, in the unit of an insult's learned log-odds.
THREAT_STRENGTH = 6.0
STEMS = (4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[.!?;:,()\"\r\n]+")
#: What ends a sentence; a colon is matched with the line ends after it, which do not.
_END = re.compile(r":\s+|[.!?;()\r\n]")


@dataclass
class Transducer:
    """Arcs (state, symbol) -> (state, symbol, weight); state 0 is the start, every state may end."""

    arcs: dict[tuple[int, int], tuple[int, int, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def then(self, other: Transducer) -> Transducer:
        """Composition: the other reads what this one writes; weights multiply."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            pair = todo.pop()
            for symbol in READ:
                a, mid, w1 = self.step(pair[0], symbol)
                b, out, w2 = other.step(pair[1], mid)
                if (a, b) not in number:
                    number[a, b] = len(number)
                    todo.append((a, b))
                arcs[number[pair], symbol] = (number[a, b], out, w1 * w2)
        return Transducer(arcs)


def _scope(openers: tuple[int, ...], length: int, weights: dict[int, float], rewrite: dict[int, int] | None = None) -> Transducer:
    """After an opener, the next ``length`` words are in scope: symbols get the weights and rewrites."""
    arcs: dict[tuple[int, int], tuple[int, int, float]] = {(0, opener): (length, opener, 1.0) for opener in openers}
    for state in range(1, length + 1):
        for symbol in (*READ, HIT, SAID_THREAT):
            after = length if symbol in openers else state - 1
            arcs[state, symbol] = (after, (rewrite or {}).get(symbol, symbol), weights.get(symbol, 1.0))
    return Transducer(arcs)


def _threat() -> Transducer:
    """A person within three words after a threat word is a HIT with the largest weight of those words.

    A state is the weights of the last three words, newest first (0: no threat word); a weight that
    a newer one reaches is never used and counts as 0.
    """
    number, todo, arcs = {(0.0, 0.0, 0.0): 0}, [(0.0, 0.0, 0.0)], {}
    while todo:
        last = todo.pop()
        for symbol in (*READ, SAID_THREAT, NO_THREAT, SAID_NO_THREAT):
            new = THREAT_WEIGHT.get(symbol, 0.0)
            after = (new, *(w if w > max((new, *last[:k])) else 0.0 for k, w in enumerate(last[:2])))
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            out, weight = (HIT, max(last)) if symbol == TARGET and any(last) else (THREAT if new else symbol, 1.0)
            arcs[number[last], symbol] = (number[after], out, weight)
    return Transducer(arcs)


def grammar() -> Transducer:
    """The composed transducer; HIT is the output of a completed threat."""
    report = Transducer({(0, REPORT): (1, REPORT, 1.0), (1, INSULT): (1, INSULT, REPORTED), (1, THREAT): (1, SAID_THREAT, 1.0)})
    negation = _scope((NEGATION,), 3, {INSULT: NEGATED}, {THREAT: NO_THREAT, SAID_THREAT: SAID_NO_THREAT})
    target = _scope((TARGET, HIT), 4, {INSULT: 1.5})
    insult = _scope((INSULT,), 1, {INSULT: 1.2})
    return report.then(negation).then(_threat()).then(target).then(insult)


def clause_score(machine: Transducer, symbols: list[int], strengths: list[float], reported: bool = False) -> float:
    """Weighted sum of a clause's insults and completed threats; ``reported``: a word of saying stands before it."""
    state, total = machine.step(0, REPORT)[0] if reported else 0, 0.0
    for symbol, strength in zip(symbols, strengths):
        state, out, weight = machine.step(state, symbol)
        if out == INSULT:
            total += weight * strength
        elif out == HIT:
            total += weight * THREAT_STRENGTH
    return total


@dataclass
class Model:
    """Learned insult terms with strengths, and the logistic's weights.

    A trailing * marks a stem, which counts for words that are not terms themselves; a word of strength 0
    is known to be none.
    """

    lexicon: dict[str, float]
    weights: list[float]

    def __post_init__(self) -> None:
        self.machine = grammar()
        self.finder = None
        patterns = {t.rstrip("*") for t, s in self.lexicon.items() if s > 0} | set(THREATS)
        if patterns:
            self.finder = ahocorasick.Automaton()
            for p in patterns:
                self.finder.add_word(p, p)
            self.finder.make_automaton()

    def __reduce__(self):  # tasks build the automaton again
        return Model, (self.lexicon, self.weights)

    def strength(self, word: str) -> float:
        """The word's own strength if it is a term, else that of its strongest stem; 0 if none."""
        if word in self.lexicon:
            return self.lexicon[word]
        best = 0.0
        for k in STEMS:
            if len(word) >= k:
                best = max(best, self.lexicon.get(word[:k] + "*", 0.0))
        return best

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Strongest clause, log of the sum, log of the number of matched clauses, over the whole text."""
        low = (text or "").lower()
        starts = []
        for end, found in self.finder.iter(low) if low else ():
            start = end - len(found) + 1
            if start == 0 or not low[start - 1].isalpha():
                starts.append(start)
        if not starts:
            return 0.0, 0.0, 0.0
        breaks = [m.start() for m in _BREAK.finditer(low)]
        ends = [m.start() for m in _END.finditer(low) if m[0][0] != ":"]
        best = total = matched = 0.0
        read, reported = 0, False  # the text is read up to here for words of saying
        for k in sorted({bisect_right(breaks, s) for s in starts}):
            first = breaks[k - 1] if k else 0
            # a run of breaks may hold the end of a sentence behind its first character
            last = bisect_right(ends, _BREAK.match(low, first).end() - 1 if k else 0)
            if last and ends[last - 1] >= read:
                read, reported = ends[last - 1], False
            reported = reported or any(SYMBOL_OF.get(w) == REPORT for w in _WORD.findall(low, read, max(read, first)))
            read = max(read, first)
            words = _WORD.findall(low, first, breaks[k] if k < len(breaks) else len(low))
            strengths = [self.strength(w) for w in words]
            symbols = [INSULT if s else SYMBOL_OF.get(w, OTHER) for w, s in zip(words, strengths)]
            score = clause_score(self.machine, symbols, strengths, reported)
            if score > 0:
                best, total, matched = max(best, score), total + score, matched + 1
        return best, math.log1p(total), math.log1p(matched)

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


#: Used where there is nothing to learn from: no match, no mark.
UNFITTED = Model({}, [-4.0, 1.0, 0.5, 0.5])


def _terms(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in STEMS if len(word) >= k)]


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column | None,
            fit_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``fit_rows`` texts of each label, and the number of labelled rows of each."""
    rows = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    rows = rows.where(F.lit(True) if train is None else train).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64(F.lit(6), F.col("id")), F.col("id")]
    picked = rows.where("label = 1").orderBy(*by_hash).limit(fit_rows).unionByName(rows.where("label = 0").orderBy(*by_hash).limit(fit_rows))
    # at most 2 x fit_rows ids go to every task
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(picked), "id").select("label", F.coalesce("text", F.lit("")).alias("text")).distinct()
    return write_shared(found, "toxicity-sample"), totals


def _document_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): texts that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[label].update({t for w in set(_WORD.findall(text.as_py().lower())) for t in _terms(w)})
        keep = list(seen[1].keys())  # a term that no toxic text of the task holds only counts against others
        keep += [t for t in seen[0] if t not in seen[1]]
        yield pa.RecordBatch.from_arrays([pa.array(keep, pa.string()), pa.array([seen[1][t] for t in keep], pa.int64()),
                                          pa.array([seen[0][t] for t in keep], pa.int64())], names=["term", "toxic", "clean"])

    found = sample.mapInArrow(run, "term string, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _support(sample: DataFrame, candidates: set[str]) -> dict[str, int]:
    """For each candidate, how many different neighbour pairs it stands between in toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = set()
            for text in batch.column(1):
                words = ["", *_WORD.findall(text.as_py().lower()), ""]
                for i in range(1, len(words) - 1):
                    for t in _terms(words[i]):
                        if t in candidates:
                            pairs.add((t, f"{words[i - 1]} {words[i + 1]}"))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=["term", "around"])

    found = sample.where("label = 1").mapInArrow(run, "term string, around string").distinct()
    return {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}


def _judge_stems(sample: DataFrame, lexicon: dict[str, float]) -> dict[str, float]:
    """Stems at what they say about words not in the sample, and the sample's words that they match."""
    stems = {t: s for t, s in lexicon.items() if t.endswith("*")}
    out = {t: s for t, s in lexicon.items() if t not in stems}
    if not stems:
        return out
    whole = ~F.col("term").endswith("*")
    match = F.lit(False)
    for k in STEMS:
        match = match | ((F.length("term") >= k) & F.concat(F.substring("term", 1, k), F.lit("*")).isin([t for t in stems if len(t) == k + 1]))
    seen = _document_counts(sample).where(whole & match).collect()  # words of the sampled texts
    texts, types = Counter(), Counter()
    for r in seen:
        own = [t for t in _terms(r["term"]) if t in stems]
        if r["toxic"]:
            texts.update({t: r["toxic"] for t in own})
            types.update(own)
        if not r["clean"]:
            out[r["term"]] = max(out.get(r["term"], 0.0), *(stems[t] for t in own))
        else:
            out.setdefault(r["term"], 0.0)
    return out | {t: s * types[t] / (texts[t] + types[t]) for t, s in stems.items() if types[t]}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w)), grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train: Column | None = None, fit_rows: int = 6000, min_strength: float = 1.5,
        caution: float = 2.0) -> Model:
    """Learn the insult terms and the logistic from labelled rows; ``train`` is a filter on ``labels``.

    A term is kept if its log-odds, less ``caution`` standard errors, reach ``min_strength``.
    """
    sample, totals = _sample(docs, labels, id_col, text_col, label_col, train, fit_rows)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return UNFITTED
    least = max(2, math.ceil(0.004 * sizes[1]))  # so at most (words of the sampled texts) / least candidates
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    candidates = {r["term"]: (r["toxic"], r["clean"]) for r in
                  _document_counts(sample).where((F.col("toxic") >= least) & (odds >= min_strength)).collect()}
    support = _support(sample, set(candidates))
    lexicon = {}
    for term, (toxic, clean) in candidates.items():
        n = min(toxic, support.get(term, 0))
        strength = math.log((n + 0.5) / (sizes[1] + 1.0)) - math.log((clean + 0.5) / (sizes[0] + 1.0))
        sure = strength - caution * math.sqrt(1.0 / (n + 0.5) + 1.0 / (clean + 0.5))  # less the log-odds' standard errors
        if n >= least and sure >= min_strength:
            lexicon[term] = strength
    lexicon = dict(sorted(_judge_stems(sample, lexicon).items()))
    model = Model(lexicon, UNFITTED.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]],
                                             names=["label", "f0", "f1", "f2"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, f0 double, f1 double, f2 double").toPandas()
    y = rows["label"].to_numpy(dtype=float)
    prior = np.where(y == 1, totals[1] / sizes[1], totals[0] / sizes[0])  # the sample's shares are not the table's
    return Model(lexicon, _logistic(rows[["f0", "f1", "f2"]].to_numpy(), y, prior / prior.mean()).tolist())


def toxicity(model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    return F.arrow_udf(lambda texts: pa.array([model.score(t.as_py()) for t in texts], pa.float64()), "double")(text.cast("string"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    out = docs.select(F.col(id_col).alias("doc_id"), toxicity(model, F.col(text_col)).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows that score below 0.5."""
    mark = fresh_name(docs, "_score")
    return docs.withColumn(mark, toxicity(model, F.col(text_col))).where(F.col(mark) < 0.5).select(*docs.columns)
