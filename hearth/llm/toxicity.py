"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, report, quote, other).
Small transducers for target, negation scope and reported speech read the
symbols and scale the weight of each insult or threat; they are composed into
one automaton, and a clause's weight is the sum along its path. Clauses without
an insult or threat weigh nothing, so only those around a lexicon hit are read.

The insult lexicon is learned: stems that labelled training rows tie to the
label, by a likelihood-ratio test on document counts. A logistic curve fitted
on the same rows turns the clause weights of a document into its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, filter_rows, map_texts, written

THRESHOLD = 0.3
#: Labelled training rows of each label that the model is fitted on, at most (the rows of smallest id hash).
SAMPLE = 6000
STEM = (4, 9)
MIN_G2, MIN_LOG_ODDS, MAX_WEIGHT = 30.0, 2.5, 6.0

# Closed word classes in English, German, French and Spanish.
THREATS = "kill murder shoot stab strangle töten umbringen erschießen tuer égorger matar asesinar".split()
TARGETS = "you your youre yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted tus vosotros".split()
NEGATIONS = "not no never none isnt arent dont nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say wrote claimed quoted called reported alleged sagte schrieb behauptet dit disait écrit prétend dijo dice escribió afirma".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = range(7)
CLOSED = {w: s for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
WORD = re.compile(r"[^\W\d_]+|[\"“”«»„]")
LETTERS = re.compile(r"[^\W\d_]+")
CLAUSE_END = ".!?;:\n"
FEATURES = 4


@dataclass(frozen=True)
class Machine:
    """A deterministic weighted transducer: ``step(state, symbol)`` gives the next state and a factor for the symbol's weight."""

    start: int
    step: Callable[[int, int], tuple[int, float]]


def _negation(state: int, symbol: int) -> tuple[int, float]:
    """A negation covers the next three words."""
    return (3 if symbol == NEGATION else max(0, state - 1)), 0.3 if state else 1.0


def _report(state: int, symbol: int) -> tuple[int, float]:
    """State 1 behind a verb of saying, 2 inside quotation marks."""
    if symbol == QUOTE:
        return (0 if state == 2 else 2), 1.0
    return (1 if symbol == REPORT and state == 0 else state), (1.0, 0.6, 0.5)[state]


def _target(state: int, symbol: int) -> tuple[int, float]:
    """An addressee in the five words before raises the weight; a threat without one counts half."""
    factor = (1.5 if state else 1.0) if symbol == INSULT else (1.0 if state else 0.5)
    return (5 if symbol == TARGET else max(0, state - 1)), factor


def compose(*machines: Machine) -> list[list[tuple[int, float]]]:
    """The product automaton, states reachable from the start: ``table[state][symbol]`` is (next state, factor)."""
    states = {tuple(m.start for m in machines): 0}
    queue, table = list(states), []
    for state in queue:
        row = []
        for symbol in range(OTHER + 1):
            moves = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            target = tuple(s for s, _ in moves)
            if target not in states:
                states[target] = len(states)
                queue.append(target)
            row.append((states[target], math.prod(f for _, f in moves)))
        table.append(row)
    return table


GRAMMAR = compose(Machine(0, _target), Machine(0, _negation), Machine(0, _report))


@dataclass
class Model:
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 2.0, 0.3, 0.0, 0.0]))

    def __post_init__(self):
        self.index = None

    def _index(self) -> ahocorasick.Automaton:
        if self.index is None:
            self.index = ahocorasick.Automaton()
            for stem, weight in {**{w: 3.0 for w in THREATS}, **self.stems}.items():
                self.index.add_word(stem, (stem, weight))
            self.index.make_automaton()
        return self.index

    def features(self, text: str | None) -> list[float]:
        """[log of total clause weight, heaviest clause, log of hits, share of matched clauses per hundred words]."""
        low = (text or "").lower()
        index = self._index()
        hits: dict[int, tuple[str, float]] = {}
        if len(index):
            for end, (stem, weight) in index.iter(low):
                begin = end - len(stem) + 1
                if begin and low[begin - 1].isalpha():
                    continue
                if stem in CLOSED and end + 1 < len(low) and low[end + 1].isalpha():
                    continue
                if len(stem) > len(hits.get(begin, ("", 0.0))[0]):
                    hits[begin] = (stem, weight)
        total = heaviest = 0.0
        clauses, at = 0, -1
        for place in sorted(hits):
            if place < at:
                continue
            begin = max(low.rfind(c, 0, place) for c in CLAUSE_END) + 1
            ends = [e for c in CLAUSE_END if (e := low.find(c, place)) >= 0]
            at = min(ends, default=len(low))
            weight = self.clause(low, begin, at, hits)
            total += weight
            heaviest = max(heaviest, weight)
            clauses += 1
        return [math.log1p(total), min(heaviest, 20.0) / 10, math.log1p(len(hits)), min(1.0, 100.0 * clauses / (len(low) + 1))]

    def clause(self, low: str, begin: int, end: int, hits: dict[int, tuple[str, float]]) -> float:
        state, weight = 0, 0.0
        for m in WORD.finditer(low, begin, end):
            word, hit = m[0], hits.get(m.start())
            symbol = CLOSED.get(word, OTHER)
            if symbol in (OTHER, THREAT) and hit:
                symbol = THREAT if hit[0] in CLOSED else INSULT
            elif not word[0].isalpha():
                symbol = QUOTE
            state, factor = GRAMMAR[state][symbol][0], GRAMMAR[state][symbol][1]
            if hit and symbol in (INSULT, THREAT):
                weight += hit[1] * factor
        return weight

    def score(self, text: str | None) -> float:
        return float(_logistic(np.array([1.0, *self.features(text)]) @ self.weights))


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def terms(text: str | None) -> set[str]:
    """The stems a text has: the first ``STEM`` letters of its words, at every length of that range."""
    out: set[str] = set()
    for word in set(LETTERS.findall((text or "").lower())):
        for n in range(STEM[0], min(len(word), STEM[1]) + 1):
            out.add(word[:n])
    return out


def _g2(a: Column, b: Column, na: int, nb: int) -> Column:
    """Likelihood-ratio statistic of a term in ``a`` of ``na`` and ``b`` of ``nb`` texts."""
    share = (a + b) / F.lit(float(na + nb))
    part = lambda seen, want: F.when(seen > 0, seen * F.log(seen / want)).otherwise(F.lit(0.0))
    return 2 * (part(a, share * na) + part(b, share * nb) + part(na - a, (1 - share) * na) + part(nb - b, (1 - share) * nb))


def _pick(rows: list[tuple[str, int, int]], na: int, nb: int) -> dict[str, float]:
    """The shortest stems among the tied ones, with their log odds as weights."""
    stems: dict[str, float] = {}
    for term, a, b in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if not any(term[:n] in stems for n in range(STEM[0], len(term))):
            stems[term] = min(MAX_WEIGHT, math.log((a + 0.5) / (na + 1)) - math.log((b + 0.5) / (nb + 1)))
    return stems


def _fit(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Logistic weights by Newton steps with a small ridge, rows weighted to the share ``prior`` of label 1."""
    x = np.hstack((np.ones((len(x), 1)), x))
    share = y.mean()
    row = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[0.5] * (x.shape[1] - 1)])
    for _ in range(40):
        p = _logistic(x @ w)
        grad = x.T @ (row * (p - y)) + ridge @ w
        step = np.linalg.solve(x.T @ (x * (row * p * (1 - p))[:, None]) + ridge, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Learn stems and weights from the training rows (those not held out), ``sample`` of each label at most.

    An id counts once; if it has several texts, with that of the smallest digest.
    Without training rows of both labels the model has no learned stems and default weights.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = written(known.where("y = 1").orderBy(*order).limit(sample).unionByName(known.where("y = 0").orderBy(*order).limit(sample)), "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # the sample's size is bounded by the parameter, so its ids may go to every task; an id that repeats counts with one text
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = written(rows.groupBy("id", "y").agg(F.min_by("text", F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text")).select("y", "text"), "toxicity-texts")
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[y].update(terms(text))
        return arrow(term=pa.array([t for c in seen.values() for t in c], pa.string()), y=pa.array([y for y, c in seen.items() for _ in c], pa.int32()),
                     n=pa.array([k for c in seen.values() for k in c.values()], pa.int64()))

    counts = (map_texts(rows, count, "term string, y int, n bigint").groupBy("term")
              .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")))
    odds = F.log((F.col("a") + 0.5) / (n[1] + 1)) - F.log((F.col("b") + 0.5) / (n[0] + 1))
    # every stem that passes the tests: those of 2 * ``sample`` texts at most, each in several of them
    tied = counts.withColumn("g2", _g2(F.col("a"), F.col("b"), n[1], n[0])).where((F.col("g2") >= MIN_G2) & (odds >= MIN_LOG_ODDS)).collect()
    model = Model(_pick([(r["term"], r["a"], r["b"]) for r in tied], n[1], n[0]))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [model.features(t) for t in batch.column(1).to_pylist()]
        return arrow(y=batch.column(0), x=pa.array(x, pa.list_(pa.float64())))

    fitted = map_texts(rows, measure, "y int, x array<double>").collect()  # two times ``sample`` rows at most
    model.weights = _fit(np.array([r["x"] for r in fitted]), np.array([r["y"] for r in fitted], dtype=float), sizes[1] / (sizes[0] + sizes[1]))
    return model


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; null and empty texts score as texts without any matched clause. Rows and ids may repeat."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.weights))
    holder: dict[str, Model] = {}

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = holder.setdefault("model", Model(*shared.value))
        return arrow(id=batch.column(0), score=pa.array([m.score(t) for t in batch.column(1).to_pylist()], pa.float64()))

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), kernel, f"id {id_type}, score double")


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under ``threshold``, all columns unchanged; every row is judged by its own text, whatever its id."""
    model = train(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.weights))
    holder: dict[str, Model] = {}

    def keep(texts: list[str | None]) -> list[bool]:
        m = holder.setdefault("model", Model(*shared.value))
        return [m.score(t) < threshold for t in texts]

    return filter_rows(docs, text_col, keep)
