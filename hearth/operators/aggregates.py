"""Aggregations: exact quantiles, medians, mode, mean/count, null and column profiles.

Exact quantiles never gather a group in one task, at any size: rows are counted
by bins of their value, and only the bin that holds the wanted rank is divided
again, until it holds one value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import compiled, materialise

COLUMN, PROB, VALUE = "column", "q", "value"

# Bins of the first count in each doubling of the value, bins that a bracket is divided
# into, and the rows of a bracket that are counted by value. Constant: no count holds more
# keys for more rows.
PER_OCTAVE = 64
DIVIDE = 1 << 13
BY_VALUE = 20_000
# Rows that are sorted at once where no keys part them, and the brackets that are looked for one by one.
CHUNK = 1 << 17
FEW = 6


def numeric_input(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The keys and the columns as doubles, NaN as NULL, written once."""
    values = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(c) for c in cols]
    return materialise(df.select(*by, *values), "quantile-input")


def _first_bin(v: Column) -> Column:
    """Bins of equal width on a logarithmic scale, below and above zero."""
    size = F.when(F.abs(v) == float("inf"), 1025.0).otherwise(F.log2(F.abs(v)))
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.floor(PER_OCTAVE * size) + 2048 * PER_OCTAVE).cast("double"))


def _first_bins(v: np.ndarray) -> np.ndarray:
    """Bins of the same kind for sorted values: ``PER_OCTAVE`` of equal width in every doubling, the head of a double's bits."""
    return ((v + 0.0).view(np.int64) >> 53 - PER_OCTAVE.bit_length()).astype(np.float64)


def _sorted_counts(cells: Sequence[tuple[int, int]], parts: int, brackets: Sequence[tuple[int, float, float, int]] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts by bin of batches (m, a column for each cell): every column of a chunk is sorted, so that bins are runs.

    A cell is (i, the parts it belongs to). Without ``brackets`` the bins are the first ones, else each (i, at, hi, inside) is divided.
    """
    def count(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        mask = chunk.column(0).to_numpy()
        kinds = np.unique(mask).tolist()  # rows of the same parts are sorted together
        where = {m: slice(None) if len(kinds) == 1 else np.flatnonzero(mask == m) for m in kinds}
        for k, (i, every) in enumerate(cells, 1):
            mine = [b for b in brackets if b[0] == i] if brackets is not None else [(i, None, None, 0)]
            if not mine:
                continue
            column = chunk.column(k).to_numpy()
            for bits, rows in ((m & every, rows) for m, rows in where.items() if m & every):
                v = column[rows]
                few = brackets is not None and len(mine) <= FEW
                if not few:
                    v = np.sort(v[~np.isnan(v)] if brackets is None else v[(v >= min(b[1] for b in mine)) & (v <= max(b[2] for b in mine))])
                for _, at, hi, inside in mine:
                    if few:  # a bracket holds few of the values: only they are sorted
                        part = np.sort(v[(v >= at) & (v <= hi)])
                    else:
                        part = v if at is None else v[np.searchsorted(v, at, "left"):np.searchsorted(v, hi, "right")]
                    if not len(part):
                        continue
                    key = _first_bins(part) if at is None else part if inside <= BY_VALUE else np.minimum(np.floor((part - at) / (hi - at) * DIVIDE), DIVIDE - 1)
                    first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
                    last = np.concatenate((first[1:], [len(part)]))
                    n = (last - first).astype(np.int64)
                    columns = [np.full(len(first), i, dtype=np.int32), np.full(len(first), at or 0.0), key[first], part[first], part[last - 1], n,
                               *[n if bits >> p & 1 else np.zeros_like(n) for p in range(parts)]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "at", "bin", "lo", "hi", "inside", *[f"n{p}" for p in range(parts)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield from count(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from count(pa.Table.from_batches(held))

    return run


def _quantiles(long: DataFrame, probs: list[float], by: list[str], parts: int, cells: tuple[DataFrame, list[tuple[int, int]]] | None = None,
               levels: Column | None = None) -> DataFrame:
    """(by..., i, part, q, value) over rows (by..., i, m, v): value v of column i in the parts whose bits m has.

    With ``levels``, an array of the groups (``by`` as a struct, ``_lvl`` the last) that a row with
    the other keys belongs to, the rows have those other keys only: it is the first counts that are
    dealt to both levels, and the rows inside of the brackets.

    ``cells`` has the same rows side by side, if no keys part them: (m, a column for each cell) and what ``_sorted_counts`` calls cells.

    Each round counts the rows of the open brackets by bin, in all parts at once
    (map-side combined), and looks up the bin of every wanted rank: the counts
    below it are exact, so is the rank inside. Bins whose values overlap are one
    bin: a bin function that isn't monotone costs rounds, never the result.
    """
    same = lambda a, b: F.lit(True) if not by else _all(F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by)
    counts = [F.sum(F.when(F.col("m").bitwiseAND(F.lit(1 << p)) != 0, 1).otherwise(0)).alias(f"n{p}") for p in range(parts)]

    def counted_side_by_side(brackets: DataFrame | None) -> DataFrame:
        """Counts by bin of all columns at once; the brackets are a few for each column, part and rank."""
        wide, each = cells
        open_ = None if brackets is None else [(r["i"], r["at"], r["hi"], r["inside"]) for r in brackets.collect()]
        schema = "i int, at double, bin double, lo double, hi double, inside bigint, " + ", ".join(f"n{p} bigint" for p in range(parts))
        runs = wide.mapInArrow(_sorted_counts(each, parts, open_), schema)
        return runs.groupBy("i", "at", "bin").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in ("inside", *[f"n{p}" for p in range(parts)])])

    def counted_by_key(rows: DataFrame, key: Column, over: list[str]) -> DataFrame:
        return rows.withColumn("bin", key).groupBy(*over, "i", "at", "bin").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("inside"), *counts)

    def first_counts() -> DataFrame:
        if levels is None:
            return counted_by_key(rows, _first_bin(F.col("v")), by)
        each = counted_by_key(rows, _first_bin(F.col("v")), by[:-1])
        numbers = ["lo", "hi", "inside", *[f"n{p}" for p in range(parts)]]
        dealt = each.select("i", "at", "bin", *numbers, F.explode(F.filter(levels, lambda x: x.isNotNull())).alias("g")).select("i", "at", "bin", *numbers, "g.*")
        return dealt.groupBy(*by, "i", "at", "bin").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in numbers[2:]])

    def within(rows: DataFrame, brackets: DataFrame, dealt: bool) -> DataFrame:
        """(by..., i, m, v, at, hi, inside) of the rows in a bracket of their group."""
        a, kept = rows.alias("a"), [F.col(f"a.{c}") for c in ("i", "m", "v")]
        found = []
        for mine, on in ([(brackets, by)] if dealt else [(brackets.where("_lvl = 0"), by[:-1]), (brackets.where("_lvl = 1"), [])]):
            b = mine.alias("b")
            equal = _all(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on)
            found.append(a.join(b, equal & (F.col("a.i") == F.col("b.i")) & F.col("a.v").between(F.col("b.at"), F.col("b.hi")))
                         .select(*[F.col(f"b.{c}") for c in by], *kept, "b.at", "b.hi", "b.inside"))
        return reduce(DataFrame.unionByName, found)

    def bins(counted: DataFrame) -> DataFrame:
        """(by..., i, at, part, n, lo, hi, inside, upto): a bracket's bins by value, with running counts."""
        ahead = Window.partitionBy(*by, "i", "at").orderBy("lo", "hi", "bin")
        before = F.max("hi").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
        islands = counted.withColumn("island", F.coalesce((before < F.col("lo")).cast("int"), F.lit(0))).withColumn("island", F.sum("island").over(ahead))
        merged = islands.groupBy(*by, "i", "at", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("inside").alias("inside"),
                                                                *[F.sum(f"n{p}").alias(f"n{p}") for p in range(parts)])
        each = F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(f"n{p}").alias("n")) for p in range(parts)]))
        spread = merged.select(*by, "i", "at", "lo", "hi", "inside", each).where("n > 0")
        return spread.withColumn("upto", F.sum("n").over(Window.partitionBy(*by, "i", "at", "part").orderBy("lo")))

    def ranks(asked: DataFrame, found: DataFrame) -> DataFrame:
        """The wanted ranks with the bin that holds each."""
        a, b = asked.alias("a"), found.alias("b")
        inside = (F.col("a.k") >= F.col("a.below") + F.col("b.upto") - F.col("b.n")) & (F.col("a.k") < F.col("a.below") + F.col("b.upto"))
        on = same("a", "b") & (F.col("a.i") == F.col("b.i")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.at") == F.col("b.at")) & inside
        return a.join(b, on).select(*[F.col(f"a.{c}") for c in (*by, "i", "part", "q", "h", "k")], (F.col("a.below") + F.col("b.upto") - F.col("b.n")).alias("below"),
                                    F.col("b.lo").alias("at"), F.col("b.hi").alias("hi"), F.col("b.inside").alias("inside"))

    rows = long.withColumn("at", F.lit(0.0))
    found = materialise(bins(counted_side_by_side(None) if cells else first_counts()), "quantile-bins")
    totals = found.groupBy(*by, "i", "part").agg(F.sum("n").alias("n"))
    wanted = totals.select(*by, "i", "part", "n", F.explode(F.array(*[F.lit(p) for p in probs])).alias("q")).withColumn("h", (F.col("n") - 1) * F.col("q"))
    wanted = wanted.select(*by, "i", "part", "q", "h", F.explode(F.array(F.floor("h"), F.ceil("h"))).alias("k"), F.lit(0).cast("bigint").alias("below"), F.lit(0.0).alias("at"))
    asked = materialise(ranks(wanted, found), "quantile-ranks")
    solved = asked.where(F.col("at") == F.col("hi"))
    dealt = levels is None
    while not (open_ := asked.where(F.col("at") < F.col("hi"))).isEmpty():
        brackets = open_.select(*by, "i", "at", "hi", "inside").distinct()
        if cells:
            counted = counted_side_by_side(brackets)
        else:
            rows = within(long, brackets, dealt)
            if not brackets.where(F.col("inside") > BY_VALUE).isEmpty():
                # another round will come: it need not look at all rows again
                rows = materialise(rows, "quantile-rows")
                long, dealt = rows.drop("at", "hi", "inside"), True
            place = F.least(F.floor((F.col("v") - F.col("at")) / (F.col("hi") - F.col("at")) * DIVIDE), F.lit(DIVIDE - 1)).cast("double")
            counted = counted_by_key(rows, F.when(F.col("inside") <= BY_VALUE, F.col("v")).otherwise(place), by)
        found = materialise(bins(counted), "quantile-bins")
        asked = materialise(ranks(open_, found), "quantile-ranks")
        solved = solved.unionByName(asked.where(F.col("at") == F.col("hi")))
    ends = solved.groupBy(*by, "i", "part", "q", "h").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        (F.ceil("h") - F.col("h")) * F.col("lo") + (F.col("h") - F.floor("h")) * F.col("hi"))
    return ends.select(*by, "i", "part", PROB, value.alias(VALUE))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), with_total: bool = False, stored: bool = False,
                   parts: Mapping[int, Column] | None = None, own: Mapping[str, Mapping[int, str]] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas "linear", SQL quantile_cont).

    Returns long rows ``(by..., [_lvl,] [_part,] column, q, value)``; groups whose column
    is all null get no row (callers left-join and fall back). With
    ``with_total`` the overall quantiles come along as ``_lvl = 1`` rows with
    NULL keys, from the same passes. The result is a written table, so
    the planner knows that it is small and the rows it is joined to stay put.
    ``stored`` says that ``df`` is a ``numeric_input`` already.

    ``parts`` names subsets of the rows (number from 0 → condition): the quantiles
    of each come from the same passes, as ``_part``. A column in ``own`` has a
    source column of its own in each part. ``df`` must then be a written table.
    """
    compiled(df.sparkSession)
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    own = own or {}
    if parts is None:
        wide, mask = (df if stored else numeric_input(df, cols, by)), [F.lit(1)]
    else:
        wide, mask = df, [F.when(c, 1 << p).otherwise(0) for p, c in sorted(parts.items())]
    everywhere = sum(mask[1:], mask[0])
    number = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    every = (1 << len(mask)) - 1
    cells = [(i, every, c) for i, c in enumerate(cols) if c not in own] + [(cols.index(c), 1 << p, source) for c, sources in own.items() for p, source in sources.items()]
    at = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in cells]), F.col("pos") + 1)
    # a plain array of values: an array of structs would be built by slow code
    flat = wide.select(*by, everywhere.alias("m"), F.posexplode(F.array(*[number(c) for *_, c in cells])).alias("pos", "v")).where("v is not null")
    long = flat.select(*by, at(0).alias("i"), F.col("m").bitwiseAND(at(1)).cast("bigint").alias("m"), "v").where("m != 0")
    keys, levels = list(by), None
    if by:
        known = _all(F.col(k).isNotNull() for k in by)  # like pandas groupby: rows without a key join no group
        if with_total:
            nothing = [F.lit(None).cast(wide.schema[k].dataType).alias(k) for k in by]
            levels = F.array(F.when(known, F.struct(F.lit(0).alias("_lvl"), *by)), F.struct(F.lit(1).alias("_lvl"), *nothing))
        else:
            long = long.where(known)
    if with_total:
        keys = [*by, "_lvl"]
        if not by:
            long = long.withColumn("_lvl", F.explode(F.array(F.lit(0), F.lit(1))))
    side_by_side = None
    if not keys:
        side_by_side = (wide.select(everywhere.cast("bigint").alias("m"), *[number(c).alias(f"v{k}") for k, (*_, c) in enumerate(cells)]), [(i, bits) for i, bits, _ in cells])
    out = _quantiles(long, probs, keys, len(mask), side_by_side, levels)
    named = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias(COLUMN)
    return materialise(out.select(*keys, *([F.col("part").alias("_part")] if parts is not None else []), named, PROB, VALUE), "quantiles")


def quantiles_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), name=lambda c, p: f"{c}_p{round(p * 100):02d}",
                   with_total: bool = False, stored: bool = False) -> DataFrame:
    """Quantiles as one row per group, one column per (column, probability).

    With ``with_total`` the overall row comes too, keys NULL and ``_lvl = 1``.
    """
    qt = quantile_table(df, cols, probs, by, with_total, stored)
    lab_map = {f"{c}\u0001{float(p)}": name(c, p) for c in cols for p in probs}
    key = F.concat_ws("\u0001", F.col(COLUMN), F.col(PROB).cast("string"))
    ids = list(by) + (["_lvl"] if with_total else [])
    piv = qt.select(*ids, key.alias("_k"), VALUE)
    w = piv.groupBy(*ids).pivot("_k", list(lab_map)).agg(F.first(VALUE))
    return w.select(*ids, *[F.col(f"`{k}`").alias(v) for k, v in lab_map.items()])


def split_total(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per-group rows, overall row) of a ``with_total`` result."""
    return (wide.where(F.col("_lvl") == 0).drop("_lvl"),
            wide.where(F.col("_lvl") == 1).drop("_lvl"))


def group_median(df: DataFrame, key: str | Sequence[str], col: str, alias: str | None = None) -> DataFrame:
    """Exact median of ``col`` per key (nulls skipped)."""
    keys = [key] if isinstance(key, str) else list(key)
    return quantiles_wide(df, [col], [0.5], keys, name=lambda c, p: alias or f"{c}_median")


def global_median(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Exact median over all rows, as a one-row table (null when no value)."""
    return quantiles_wide(df, [col], [0.5], (), name=lambda c, p: alias or f"{c}_median")


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
            with_total: bool = False, stored: bool = False) -> DataFrame:
    """Medians of several columns in one pass; columns named ``<col>`` (one row per group)."""
    return quantiles_wide(df, cols, [0.5], by, name=lambda c, p: c, with_total=with_total, stored=stored)


def mode_of(df: DataFrame, col: str, by: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """Most frequent non-null value, smallest value on ties (pandas ``mode()[0]``).

    Counting per (group, value) first keeps every task's state bounded; the
    second step keeps only the best (count, value) per group.
    """
    by = list(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    best = F.min_by(F.col(col), F.struct((-F.col("_c")).alias("nc"), F.col(col).alias("v")))
    agg = counts.groupBy(*by).agg(best.alias(alias or col))
    return agg


def mean_count(df: DataFrame, key: str, y: str) -> DataFrame:
    """Mean and count of ``y`` per key."""
    return df.groupBy(key).agg(F.avg(y).alias("mean"), F.count(y).alias("count"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column in one pass, as (column, nulls, has_nulls)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot([], cols, "column", "nulls")
    return long.select("column", "nulls", (F.col("nulls") > 0).alias("has_nulls"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per column (``describe().T``)."""
    cols = list(cols)
    stats = ["count", "mean", "std", "min", "max"]
    m = df.agg(*[e for c in cols for e in (
        F.count(c).cast("double").alias(f"{c}\u0001count"), F.avg(c).alias(f"{c}\u0001mean"),
        F.stddev_samp(c).alias(f"{c}\u0001std"), F.min(c).cast("double").alias(f"{c}\u0001min"),
        F.max(c).cast("double").alias(f"{c}\u0001max"))])
    moments = m.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(COLUMN), *[F.col(f"`{c}\u0001{s}`").alias(s) for s in stats])
        for c in cols])).alias("r")).select("r.*")
    qt = quantile_table(df, cols, [0.25, 0.5, 0.75])
    q = qt.groupBy(COLUMN).pivot(PROB, [0.25, 0.5, 0.75]).agg(F.first(VALUE))
    q = q.select(COLUMN, F.col("`0.25`").alias("p25"), F.col("`0.5`").alias("p50"),
                 F.col("`0.75`").alias("p75"))
    return moments.join(q, COLUMN, "left").select(COLUMN, "count", "mean", "std", "min",
                                                  "p25", "p50", "p75", "max")


def audit(df: DataFrame, copies: str, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step_no, step, rows_in, rows_out, removed): deduplication, then filters, in one aggregation.

    ``df`` holds every distinct row once with its number of copies; each filter
    applies to what the ones before it kept.
    """
    kept, counts = F.lit(True), [F.sum(copies).alias("n0"), F.count("*").alias("n1")]
    for i, (_, condition) in enumerate(steps):
        kept = kept & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(kept).alias(f"n{i + 2}"))
    names = ["dedup", *(name for name, _ in steps)]
    rows = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"n{i}").alias("rows_in"), F.col(f"n{i + 1}").alias("rows_out"))
                     for i, name in enumerate(names)])
    return df.agg(*counts).select(F.explode(rows).alias("r")).select("r.*", (F.col("r.rows_in") - F.col("r.rows_out")).alias("removed"))
