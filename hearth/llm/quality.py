"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good (1), bad (-1) or nothing (0) on every
document. Expectation-maximisation over the counts of vote patterns estimates
each labeller's accuracy for both classes and the posterior of every pattern;
patterns are few (three to the number of labellers at most), so this needs one
aggregation. Posterior labels then train a hashed linear scorer on a bounded
sample, and the scorer rates every document.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, map_texts, written

#: Documents that the scorer is trained on, at most (those of smallest id hash).
SAMPLE = 8000
BUCKETS = 1 << 13
EPOCHS, RATE, RIDGE = 30, 0.5, 1e-4
CACHE_WORDS = 200_000
# Fixed thresholds of the labellers: good on one side of the first number, bad on the other side of the second.
LABELLERS = ("length", "symbols", "capitals", "repeated_lines", "vocabulary", "sentence_ends", "top_word", "word_length")


def signals(text: str | None) -> dict[str, float]:
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for line in text.split("\n") if (x := line.strip())]
    seen = Counter(w.lower() for w in words)
    joined = "".join(words)
    plain = sum(map(joined.count, ".,;:'\"!?-()"))
    return {
        "words": len(words), "symbols": (len(joined) - sum(map(str.isalnum, joined)) - plain) / chars, "capitals": sum(map(str.isupper, joined)) / chars,
        "repeated": 1 - len(set(lines)) / len(lines) if lines else 0.0, "distinct": len(seen) / n,
        "ends": sum(x[-1] in ".!?\"”»" for x in lines) / max(1, len(lines)), "stops": sum(map(joined.count, ".!?")) / n,
        "top": max(seen.values(), default=0) / n, "mean": len(joined) / n,
    }


def votes(text: str | None) -> tuple[int, ...]:
    """One vote for each of ``LABELLERS``; a text without words gets bad for its length and abstentions."""
    s = signals(text)
    if not s["words"]:
        return (-1, *[0] * (len(LABELLERS) - 1))
    n = s["words"]

    def side(value: float, good: float, bad: float) -> int:
        """Good up to ``good``, bad from ``bad`` (a larger value is worse)."""
        return 1 if value <= good else -1 if value >= bad else 0

    # the share of distinct words falls as texts grow: compare with a typical curve
    typical = min(1.0, 1.6 * n ** -0.12)
    return (
        1 if n >= 30 else -1 if n < 5 else 0,
        side(s["symbols"], 0.01, 0.04),
        side(s["capitals"], 0.06, 0.2),
        side(s["repeated"], 0.05, 0.2) if n >= 10 else 0,
        side(typical - s["distinct"], 0.25, 0.45) if n >= 30 else 0,
        side(-s["stops"], -0.04, -0.01) if n >= 30 else 0,
        side(s["top"], 0.15, 0.3) if n >= 30 else 0,
        0 if n < 10 else 1 if 3.0 <= s["mean"] <= 7.5 else -1 if not 2.0 <= s["mean"] <= 12.0 else 0,
    )


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[dict[tuple[int, ...], float], np.ndarray, float]:
    """(posterior of good by pattern, P(vote | class) by labeller as [labeller, class, vote + 1], prior of good).

    Votes are independent given the class. The start is the share of good votes,
    which also fixes which class is the good one; pseudo-counts keep rates off 0.
    """
    if not patterns:
        return {}, np.full((len(LABELLERS), 2, 3), 1 / 3), 0.5
    votes_ = np.array([p for p, _ in patterns])
    count = np.array([n for _, n in patterns], dtype=float)
    cast = np.abs(votes_).sum(axis=1)
    good = (0.5 + (votes_ == 1).sum(axis=1)) / (1.0 + cast)
    good = np.where(good >= (good * count).sum() / count.sum(), 0.5 + good / 2, good / 2)
    onehot = np.stack([votes_ == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        mass = np.stack((count * (1 - good), count * good))
        rate = np.einsum("cp,plv->lcv", mass, onehot) + 0.5
        rate /= rate.sum(axis=2, keepdims=True)
        prior = np.clip(mass[1].sum() / count.sum(), 1e-6, 1 - 1e-6)
        logs = np.einsum("plv,lcv->pc", onehot, np.log(rate)) + np.log([1 - prior, prior])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -35, 35)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return {p: float(g) for (p, _), g in zip(patterns, good, strict=True)}, rate, float(prior)


def bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % BUCKETS


class Hasher:
    """Hashed features of a text: ends and beginnings of words, by share of words."""

    def __init__(self) -> None:
        self.cache: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = (bucket("^" + w[:2]), bucket(w[-2:] + "$"))
        found = np.array([cache[w] for w in words], dtype=np.int64).reshape(-1)
        places, counts = np.unique(found, return_counts=True)
        return places, counts / max(1, len(words))


@lru_cache(maxsize=1)
def hasher() -> Hasher:
    """One per worker, so that words are hashed once for all batches."""
    return Hasher()


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights (the last one the intercept) of a logistic scorer for soft labels, by full-batch adaptive gradient steps."""
    at = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    place = np.concatenate([p for p, _ in rows]) if rows else np.zeros(0, dtype=np.int64)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    w, square = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    for _ in range(EPOCHS * bool(len(rows))):
        z = np.bincount(at, weights=value * w[place], minlength=len(rows)) + w[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - target
        grad = np.append(np.bincount(place, weights=value * gap[at], minlength=BUCKETS), gap.sum()) / len(rows)
        grad[:-1] += RIDGE * w[:-1]
        square += grad * grad
        w -= RATE * grad / np.sqrt(square)
    return w


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, votes, posterior, score), one row for each input row.

    ``votes`` has a letter (+, -, 0) for each labeller, ``posterior`` the
    probability of good given the votes, ``score`` the linear scorer's. Null is
    the empty text. Rows and ids may repeat; an id with several texts trains on
    the one of smallest digest; other columns are ignored; an empty table gives
    no rows. Very long texts are read whole.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    # a text is named by two digests; null and the empty text are one
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("c"), F.xxhash64(F.lit(1), text).alias("g"), text.alias("text"))
    letters = {1: "+", -1: "-", 0: "0"}

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        cast = ["".join(letters[v] for v in votes(t)) for t in batch.column("text").to_pylist()]
        return arrow(id=batch.column("id"), c=batch.column("c"), g=batch.column("g"), votes=pa.array(cast, pa.string()))

    voted = written(map_texts(named, vote, f"id {id_type}, c bigint, g bigint, votes string"), "quality-votes")
    back = {v: k for k, v in letters.items()}
    patterns = [(tuple(back[c] for c in r["votes"]), r["count"]) for r in voted.groupBy("votes").count().orderBy("votes").collect()]  # 3^8 rows at most
    posterior, _, _ = estimate(patterns)
    goals = spark.createDataFrame([("".join(letters[v] for v in p), g) for p, g in posterior.items()], "votes string, posterior double")

    # one text for each id: that of smallest digest
    one = voted.groupBy("id").agg(F.min(F.struct("c", "g", "votes")).alias("x")).select("id", "x.*")
    picked = written(one.orderBy(F.xxhash64("id"), "id").limit(sample).join(F.broadcast(goals), "votes"), "quality-sample")
    # the sample's size is bounded by the parameter, so its ids may go to every task; rows that repeat a text of an id are one
    chosen = F.broadcast(picked.select(F.col("id").alias("i"), "c", "g", "posterior"))
    taken = (named.join(chosen, ["c", "g"]).where(F.col("id").eqNullSafe(F.col("i")))
             .groupBy("id").agg(F.first("posterior").alias("goal"), F.first("text").alias("text")))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [hasher()(t) for t in batch.column("text").to_pylist()]
        return arrow(place=pa.array([p for p, _ in rows], pa.list_(pa.int32())), value=pa.array([v for _, v in rows], pa.list_(pa.float32())),
                     goal=batch.column("goal"), key=batch.column("key"))

    def trainer(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")  # sums in a fixed order
        rows = [(np.array(p, dtype=np.int64), np.array(v)) for p, v in zip(group["place"].to_pylist(), group["value"].to_pylist(), strict=True)]
        return pa.table({"weights": pa.array([fit(rows, np.asarray(group["goal"])).tobytes()], pa.binary())})

    features = map_texts(taken.select(F.xxhash64("id").alias("key"), "goal", "text"), hashed,
                         "place array<int>, value array<float>, goal double, key bigint").withColumn("all", F.lit(1))
    first = features.groupBy("all").applyInArrow(trainer, "weights binary").first()
    weights = np.frombuffer(bytes(first["weights"])) if first else np.zeros(BUCKETS + 1)
    shared = spark.sparkContext.broadcast(weights)

    def rate(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = shared.value
        z = np.array([(v * w[p]).sum() + w[-1] for p, v in map(hasher(), batch.column("text").to_pylist())])
        return arrow(id=batch.column("id"), c=batch.column("c"), g=batch.column("g"), score=pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))), pa.float64()))

    rated = map_texts(named, rate, f"id {id_type}, c bigint, g bigint, score double")
    # votes depend on the text alone: one row a text comes back from the votes, written, so that AQE can split the rows of a frequent text
    of_text = written(voted.groupBy("c", "g").agg(F.first("votes").alias("votes")), "quality-texts")
    return (rated.join(of_text, ["c", "g"]).join(F.broadcast(goals), "votes")
            .select("id", "votes", "posterior", "score"))
