"""Embedding near-duplicates: int8 tile products with error bounds, full precision for the pairs left.

Equal vectors of a label form one class. Classes are dealt to tiles of bounded
size, and every two tiles of a label meet once. Unit vectors are quantised to
int8 with one scale each: x = s·q + e. For the products of two tiles
``x·y <= s·t·(q·p) + |s·q|·|f| + |e|`` (f the error of y), so a pair whose bound
stays under the threshold is settled by the integer product; the others are
recomputed in double precision. A tile pair returns link counts and a spanning
forest of its links, never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, components, map_texts, written

THRESHOLD = 0.93
#: Classes of a tile (on average), rows of a product block, and pairs recomputed at once.
TILE = 2048
BLOCK = 512
PAIRS = 1 << 16
#: Covers the rounding of the bound itself, which is computed in double precision.
SLACK = 1e-6
#: Products of int8 numbers stay exact in float32 sums over so many dimensions.
EXACT_DIMS = 1024


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, error norm, norm of scale·q) of the rows of ``v``, taken as unit vectors."""
    unit = _unit(v)
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(unit - back, axis=1), np.linalg.norm(back, axis=1)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def product(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of two int8 blocks (matrix products of small integers held as floats)."""
    total = np.zeros((len(q), len(p)))
    for at in range(0, q.shape[1], EXACT_DIMS):
        total += q[:, at:at + EXACT_DIMS].astype(np.float32) @ p[:, at:at + EXACT_DIMS].astype(np.float32).T
    return total


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (smallest place) after the links a-b are added to those in ``labels``."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        new = new[new]
        new = new[new[labels]]
        if np.array_equal(new, labels):
            return labels
        labels = new


def tile_links(q, scale, error, size, unit, weight, left: np.ndarray, same: bool, threshold: float):
    """Links between the rows where ``left`` and the others (or among all, if ``same``): (weighted counts, forest labels, pairs recomputed)."""
    n = len(q)
    rows = np.arange(n) if same else np.flatnonzero(left)
    cols = np.arange(n) if same else np.flatnonzero(~left)
    counts, labels, again = np.zeros(n, dtype=np.int64), np.arange(n), 0
    for at in range(0, len(rows), BLOCK):
        i = rows[at:at + BLOCK]
        upper = product(q[i], q[cols]) * scale[i][:, None] * scale[cols] + size[i][:, None] * error[cols] + error[i][:, None]
        a, b = np.nonzero(upper >= threshold - SLACK)
        a, b = i[a], cols[b]
        if same:
            a, b = a[a < b], b[a < b]
        again += len(a)
        for k in range(0, len(a), PAIRS):
            x, y = a[k:k + PAIRS], b[k:k + PAIRS]
            linked = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            x, y = x[linked], y[linked]
            if len(x):
                counts += np.bincount(x, weights=weight[y], minlength=n).astype(np.int64) + np.bincount(y, weights=weight[x], minlength=n).astype(np.int64)
                labels = join_labels(labels, x, y)
    return counts, labels, again


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id, n_links, component): one row for each input row.

    Vectors are compared within equal, non-null labels (and dimensions) by
    cosine in double precision. Null vectors, those with a null or non-finite
    component and zero vectors link with nothing: 0 links, their own component.
    Equal vectors, repeated rows too, link with each other. ``component`` is the
    smallest id reachable; ids may be null or repeat. Other columns are ignored.
    """
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # a class is named by two digests of its label and vector
    keys = {"c": F.xxhash64("label", "v"), "g": F.xxhash64("v", "label", F.lit(1))}
    rows = written(named.select("id", *[F.when(sound, e).alias(k) for k, e in keys.items()]), "embedding-rows")
    classes = (named.where(sound).withColumns(keys).groupBy("c", "g")
               .agg(F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
               .withColumn("dim", F.size("v")))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("v")
        flat, dims = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(batch.column("dim"))
        at = np.concatenate(([0], np.cumsum(dims)))
        codes, stats, units = [], [], []
        for i, d in enumerate(dims.tolist()):
            v = flat[at[i]:at[i] + d].reshape(1, -1)
            q, scale, error, size = quantise(v)
            codes.append(q.tobytes())
            units.append(_unit(v).tobytes())
            stats.append((scale[0], error[0], size[0]))
        s = np.array(stats).reshape(-1, 3)
        return arrow(c=batch.column("c"), g=batch.column("g"), n=batch.column("n"), label=batch.column("label"), dim=batch.column("dim"),
                     q=pa.array(codes, pa.binary()), scale=pa.array(s[:, 0]), error=pa.array(s[:, 1]), size=pa.array(s[:, 2]), unit=pa.array(units, pa.binary()))

    label_type = vectors.schema[label_col].dataType.simpleString()
    packed = written(map_texts(classes.select("c", "g", "n", "label", "v", "dim"), pack,
                               f"c bigint, g bigint, n bigint, label {label_type}, dim int, q binary, scale double, error double, size double, unit binary"), "embedding-classes")
    tiles = packed.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = packed.join(tiles, ["label", "dim"]).withColumn("t", F.pmod(F.xxhash64("g"), F.col("tiles")).cast("int"))
    met = dealt.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns({"i": F.least("t", "u"), "j": F.greatest("t", "u")})

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        q = np.stack([np.frombuffer(x, dtype=np.int8) for x in group["q"].to_pylist()])
        unit = np.stack([np.frombuffer(x, dtype=np.float64) for x in group["unit"].to_pylist()])
        col = {k: np.asarray(group[k]) for k in ("c", "n", "scale", "error", "size", "t", "i", "j")}
        i, j = int(col["i"][0]), int(col["j"][0])
        counts, labels, _ = tile_links(q, col["scale"], col["error"], col["size"], unit, col["n"], col["t"] == i, i == j, threshold)
        some = (counts > 0) | (labels != np.arange(len(q)))
        return pa.table({"c": group["c"].combine_chunks().take(pa.array(np.flatnonzero(some))), "links": pa.array(counts[some], pa.int64()),
                         "root": pa.array(col["c"][labels[some]], pa.int64())})

    found = written(met.select("label", "dim", "i", "j", "t", "c", "n", "q", "scale", "error", "size", "unit").groupBy("label", "dim", "i", "j")
                    .applyInArrow(meet, "c bigint, links bigint, root bigint"), "embedding-links")
    roots = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")), "embedding")
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    members = (rows.where("c is not null").groupBy("c").agg(F.count("*").alias("n"), F.min("id").alias("low"))
               .join(links, "c", "left").join(roots, F.col("c") == F.col("node"), "left")
               .select("c", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "c").alias("root")))
    members = written(members, "embedding-members")
    lowest = members.groupBy("root").agg(F.min("low").alias("component"))
    named_classes = written(members.join(lowest, "root").select("c", "n_links", "component"), "embedding-components")
    return (rows.join(named_classes, "c", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component")).alias("component")))
