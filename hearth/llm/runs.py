"""Periodic runs of words by recompression.

The words of a slice of texts are one sequence, texts parted by unique symbols.
Block compression (equal neighbours become one symbol with a count) and pair
compression (neighbours from a left and a right half of the alphabet become one
symbol) alternate until little is left; the levels are a run-length grammar of
the sequence. The longest common extension of two positions climbs the levels
while both stand at the beginning of a symbol of the next level, and descends
from the first two symbols that differ: a constant number of comparisons each
level, exact, for all questions at once.

A run of period q and four periods at least holds a multiple x of 3q whose
partner x + q is in the run too. The extensions of (x, x + q) to both sides give
the whole run, so a grid of n/3q questions for each period q finds every run.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, map_texts

MIN_WORDS = 6
MIN_PERIODS = 4
#: Bytes of text whose grammar is built at once (a longer text has one of its own).
SLICE = 1 << 20
#: Symbols at which the grammar ends; questions answered at once.
TOP = 16
QUESTIONS = 1 << 18


class Level:
    """A sequence of symbols; how it is compressed to the next level: each symbol's parent, and whether it begins one."""

    __slots__ = ("sym", "up", "first", "begins", "left")

    def __init__(self, sym: np.ndarray, begins: np.ndarray, block: bool):
        self.sym = sym
        self.begins = begins
        self.up = np.cumsum(begins, dtype=np.int32) - 1
        self.first = np.flatnonzero(begins).astype(np.int32)
        #: Symbols left in the block, this one included (block compression only).
        self.left = np.append(self.first[1:], len(sym))[self.up] - np.arange(len(sym)) if block else None

    def mirrored(self) -> Level:
        """The level read from its end."""
        ends = np.append(self.begins[1:], True)[::-1]
        return Level(self.sym[::-1], ends, self.left is not None)


class Grammar:
    """Levels of a sequence whose first and last symbols occur nowhere else."""

    def __init__(self, words: np.ndarray):
        sym, fresh = words.astype(np.int64), int(words.max(initial=0)) + 1
        self.levels: list[Level] = []
        turn = 0
        while len(sym) > TOP:
            same = sym[1:] == sym[:-1]
            if same.any():
                level = Level(sym, np.concatenate(([True], ~same)), True)
                count = level.left[level.first]
                sym = sym[level.first]
                long_ = np.flatnonzero(count > 1)
                names, which = np.unique(np.stack((sym[long_], count[long_])), axis=1, return_inverse=True)
                sym[long_] = fresh + which.reshape(-1)
                fresh += names.shape[1]
                self.levels.append(level)
            if len(sym) <= TOP:
                break
            # neighbours differ now: deal the alphabet into halves, the way round that makes more pairs
            turn += 1
            mixed = (sym.astype(np.uint64) + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            half = (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
            joins = [half[:-1] & ~half[1:], ~half[:-1] & half[1:]]
            join = joins[0] if joins[0].sum() >= joins[1].sum() else joins[1]
            if not join.any():
                continue  # the next deal differs
            level = Level(sym, np.concatenate(([True], ~join)), False)
            pair = np.flatnonzero(join)
            # both numbers under 2^31, as symbols are fewer than twice the words of a slice
            names, which = np.unique(sym[pair] << 31 | sym[pair + 1], return_inverse=True)
            sym = sym[level.first]
            sym[level.up[pair]] = fresh + which.reshape(-1)
            fresh += len(names)
            self.levels.append(level)
        self.top = sym
        self.n = len(words)

    def mirrored(self) -> Grammar:
        back = object.__new__(Grammar)
        back.levels, back.top, back.n = [level.mirrored() for level in self.levels], self.top[::-1], self.n
        return back

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the sequences from i and from j; i differs from j."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        found = np.full(len(a), len(self.levels))  # the level where two symbols differ
        live = np.arange(len(a))
        for h, level in enumerate(self.levels):
            if level.left is None:
                for _ in range(2):
                    inner = live[~(level.begins[a[live]] & level.begins[b[live]])]
                    same = level.sym[a[inner]] == level.sym[b[inner]]
                    found[inner[~same]] = h
                    a[inner[same]] += 1
                    b[inner[same]] += 1
                    live = live[found[live] > h]
            else:
                inner = live[~(level.begins[a[live]] & level.begins[b[live]])]
                same = level.sym[a[inner]] == level.sym[b[inner]]
                found[inner[~same]] = h
                inner = inner[same]
                x, y = level.left[a[inner]], level.left[b[inner]]
                step = np.minimum(x, y)
                a[inner] += step
                b[inner] += step
                found[inner[x != y]] = h
                live = live[found[live] > h]
            a[live], b[live] = level.up[a[live]], level.up[b[live]]
        while len(live):
            live = live[self.top[a[live]] == self.top[b[live]]]
            a[live] += 1
            b[live] += 1
        for h in range(len(self.levels) - 1, -1, -1):
            level = self.levels[h]
            down = np.flatnonzero(found > h)
            x, y = level.first[a[down]].astype(np.int64), level.first[b[down]].astype(np.int64)
            same = level.sym[x] == level.sym[y]
            step = same.astype(np.int64) if level.left is None else np.where(same, np.minimum(level.left[x], level.left[y]), 0)
            a[down], b[down] = x + step, y + step
        return a - i


def find_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs in the texts ``words[bounds[k]:bounds[k + 1]]``, by start, then period.

    ``words`` hold numbers from 0; runs never cross texts. Starts count in ``words``.
    """
    sizes = np.diff(bounds)
    longest = int(sizes.max(initial=0))
    none = np.zeros(0, dtype=np.int64)
    if longest < MIN_WORDS:
        return none, none, none
    # unique symbols before, between and behind the texts: position i of text k stands at i + k + 1
    parted = np.empty(len(words) + len(sizes) + 1, dtype=np.int64)
    walls = bounds + np.arange(len(bounds))
    mask = np.ones(len(parted), dtype=bool)
    mask[walls] = False
    parted[mask] = words
    parted[walls] = int(words.max()) + 1 + np.arange(len(walls))
    grammar = Grammar(parted)
    mirror = grammar.mirrored()
    n, found = len(parted), []
    at, period, asked = [], [], 0

    def answer() -> None:
        nonlocal asked
        if at:
            x = np.concatenate(at)
            q = np.repeat(np.array(period), [len(p) for p in at])
            ahead = grammar.extension(x, x + q)
            behind = mirror.extension(n - 1 - x, n - 1 - (x + q))  # x itself included
            start, end = x - behind + 1, x + q + ahead
            keep = (end - start) >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
            if keep.any():
                found.append(np.unique(np.stack((start[keep], end[keep], q[keep])), axis=1))
        at.clear()
        period.clear()
        asked = 0

    for q in range(1, longest // MIN_PERIODS + 1):
        step = (MIN_PERIODS - 1) * q
        x = np.flatnonzero(parted[:n - q:step] == parted[q::step]) * step
        if len(x):
            at.append(x)
            period.append(q)
            asked += len(x)
            if asked >= QUESTIONS:
                answer()
    answer()
    if not found:
        return none, none, none
    start, end, q = np.unique(np.concatenate(found, axis=1), axis=1)
    new = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))  # the smallest period of a stretch
    start, end, q = start[new], end[new], q[new]
    shift = np.searchsorted(walls, start)
    order = np.lexsort((q, start))
    return (start - shift)[order], (end - shift)[order], q[order]


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by crc32 of its id repeats a stretch of its words to its end; others stay as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + (cycle * (-(-(n - a) // p)))[:n - a]


_LONGS = ("n_runs", "start", "length", "period", "exponent_milli")
_TEXTS = ("runs_sha256", "collapsed_sha256")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """(id, n_words, n_runs, start, length, period, exponent_milli, runs, runs_sha256, collapsed, collapsed_sha256), one row for each input row.

    A run is a stretch of consecutive words with smallest period q, at least
    MIN_PERIODS periods and MIN_WORDS words long, that no neighbour extends. ``start``,
    ``length`` and ``period`` are those of the longest run (ties: smallest start,
    then period), null without runs; ``runs`` lists all of them as text;
    ``collapsed`` is the text with one period left of every run, its words joined by
    one space. Words are parted by ASCII white space. ``rewrite(id, words)`` may
    change the words of a row before.

    Null and empty texts have no words: no runs, empty texts. Texts of any
    length are taken whole. Repeated rows and ids have equal rows; a null id
    stays null. Other columns are ignored. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        texts = [(t or "").encode("utf-8").split() for t in batch.column(1).to_pylist()]
        if rewrite:
            texts = [rewrite(i, w) for i, w in zip(ids, texts, strict=True)]
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in texts]))).astype(np.int64)
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for text in texts for w in text), dtype=np.int64, count=int(bounds[-1]))
        start, end, q = find_runs(words, bounds)
        edge = np.searchsorted(start, bounds)
        out: dict[str, list] = {k: [] for k in ("n_words", *_LONGS, "runs", "collapsed", *_TEXTS)}
        for k, text in enumerate(texts):
            lo, hi = int(edge[k]), int(edge[k + 1])
            s, e, p = start[lo:hi] - bounds[k], end[lo:hi] - bounds[k], q[lo:hi]
            listed = "".join(f"{a},{b - a},{c}\n" for a, b, c in zip(s.tolist(), e.tolist(), p.tolist(), strict=True))
            best = [None] * 4
            if hi > lo:
                i = np.lexsort((p, s, s - e))[0]
                size = int(e[i] - s[i])
                best = [int(s[i]), size, int(p[i]), 1000 * size // int(p[i])]
                change = np.bincount(s + p, minlength=len(text) + 1) - np.bincount(e, minlength=len(text) + 1)
                text = [text[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            whole = b" ".join(text)
            row = (int(bounds[k + 1] - bounds[k]), hi - lo, *best, listed, whole.decode("utf-8"),
                   hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(whole).hexdigest())
            for name, value in zip(out, row, strict=True):
                out[name].append(value)
        return arrow(id=batch.column(0), **{k: pa.array(v, pa.int64() if k in _LONGS or k == "n_words" else pa.string()) for k, v in out.items()})

    schema = (f"id {id_type}, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              "runs string, collapsed string, runs_sha256 string, collapsed_sha256 string")
    return map_texts(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), kernel, schema, SLICE)
