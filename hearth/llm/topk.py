"""Exact top-k inner products by norm buckets.

Vectors become integer codes; equal ones form one class. Classes are grouped by
length into buckets (ranges of the sorted norms), query vectors into blocks.
Every block meets the bucket of the greatest norms first, which gives each
query a threshold: its k-th best score so far. Another bucket is met only by
blocks with a query whose threshold its greatest norm can reach. Inside a
bucket, taken by descending norm in parts, the local cosine threshold
``threshold / (|query| * greatest norm of the part)`` chooses the pruning for
each query: above 1 the part is left out; a high one bounds single coordinates
of the unit vectors; a low one bounds the norm alone. What is left is verified by
exact integer products, and the threshold rises with what is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import arrow, map_texts, written

K = 5
EVERY = 50
SCALE = 256
#: Classes of a bucket and queries of a block (on average), classes of a part.
BUCKET = 16384
BLOCK = 4096
PART = 1024
#: Local cosine thresholds from here on prune by coordinates, on so many of the query's greatest ones.
COSINE = 0.5
FOCUS = 4
#: Relative slack of all pruning bounds: they are computed in double precision.
SLACK = 1e-9
#: Codes beyond this have no exact score in 64 bits.
MOST = 1 << 24
#: Products under this are exact in double precision.
EXACT = 2.0 ** 52
LOWEST = np.iinfo(np.int64).min


def products(q: np.ndarray, p: np.ndarray, bound: float) -> np.ndarray:
    """Integer inner products of the rows of two code matrices; ``bound`` is a bound on their size."""
    if bound < EXACT:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ p.astype(np.int64).T


def candidates(unit_q: np.ndarray, unit_p: np.ndarray, norm_q: np.ndarray, norm_p: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Which pairs can reach the queries' thresholds, by length or by coordinates as the local cosine threshold says."""
    reach = norm_q * norm_p.max() * (1 + SLACK)
    local = np.where(threshold == LOWEST, -1.0, np.divide(threshold, reach, out=np.zeros(len(reach)), where=reach > 0))
    local[(reach == 0) & (threshold > 0)] = 2.0
    mask = np.zeros((len(unit_q), len(unit_p)), dtype=bool)
    by_length = np.flatnonzero(local < COSINE)
    mask[by_length] = norm_q[by_length, None] * norm_p[None, :] * (1 + SLACK) >= threshold[by_length, None].astype(np.float64)
    by_coordinate = np.flatnonzero((local >= COSINE) & (local <= 1))
    if len(by_coordinate):
        t, q = local[by_coordinate], unit_q[by_coordinate]
        live = np.ones((len(by_coordinate), len(unit_p)), dtype=bool)
        angle = np.arccos(np.minimum(t, 1))
        focus = np.argsort(-np.abs(q), axis=1)[:, :FOCUS]
        for f in focus.T:
            own = np.arccos(np.clip(q[np.arange(len(q)), f], -1, 1))
            low, high = np.cos(np.minimum(own + angle, np.pi)) - 1e-7, np.cos(np.maximum(own - angle, 0)) + 1e-7
            at = unit_p[:, f].T
            live &= (at >= low[:, None]) & (at <= high[:, None])
        mask[by_coordinate] = live
    return mask


def best_of(codes_q, norm_q, threshold, codes_p, norm_p, name_p, keep: int):
    """(query, class, score) of the ``keep`` best classes of each query at or above its threshold, ties to the smaller name."""
    order = np.lexsort((name_p, -norm_p))
    codes_p, norm_p, name_p = codes_p[order], norm_p[order], name_p[order]
    unit_q = np.divide(codes_q, norm_q[:, None], out=np.zeros(codes_q.shape), where=norm_q[:, None] > 0)
    threshold = threshold.copy()
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for at in range(0, len(codes_p), PART):
        part, norms = codes_p[at:at + PART], norm_p[at:at + PART]
        unit_p = np.divide(part, norms[:, None], out=np.zeros(part.shape), where=norms[:, None] > 0)
        mask = candidates(unit_q, unit_p, norm_q, norms, threshold)
        rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        if not len(rows):
            continue
        score = products(codes_q[rows], part[cols], float(norm_q[rows].max() * norms[cols].max()))
        score = np.where(mask[np.ix_(rows, cols)], score, LOWEST)
        if len(cols) > keep:
            floor = np.partition(score, -keep, axis=1)[:, -keep]
            threshold[rows] = np.maximum(threshold[rows], floor)
        hit_q, hit_p = np.nonzero((score >= threshold[rows][:, None]) & (score > LOWEST))
        q, p, s = (np.concatenate(x) for x in zip(best, (rows[hit_q], at + cols[hit_p], score[hit_q, hit_p]), strict=True))
        by = np.lexsort((name_p[p], -s, q))
        q, p, s = q[by], p[by], s[by]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == keep - 1
        threshold[q[last]] = np.maximum(threshold[q[last]], s[last])
        best = (q[place < keep], p[place < keep], s[place < keep])
    q, p, s = best
    stays = s >= threshold[q]
    return q[stays], order[p[stays]], s[stays]


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, id, score): the k rows of greatest inner product for each row whose id is divisible by ``every``.

    Components become ``floor(SCALE * x)``; the score is their integer inner
    product; ties go to the smaller id, a null id last. A row is no candidate
    of its own, but of every other one, rows with the same id or vector included;
    rows that repeat an id and vector get equal lists. Only vectors of one
    dimension meet. Null vectors, those with a null or non-finite component and
    those with a code beyond 2^24 (no exact score in 64 bits) take no part; zero and
    empty vectors score 0. Queries with fewer candidates get all of them; an
    empty table gives no rows. Ids are integers. Other columns are ignored.
    """
    keep = k + 1  # one of the classes may hold the query alone
    x = F.col("v")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= MOST / SCALE))
    named = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where(finite)
    coded = named.select("id", F.transform(x, lambda e: F.floor(e * SCALE).cast("int")).alias("v"))
    keys = {"c": F.xxhash64("v"), "g": F.xxhash64(F.reverse("v"), F.lit(1))}
    rows = written(coded.withColumns(keys), "topk-rows")

    # of a class of equal vectors only the k + 1 first rows can be among the k best of any query
    copies = rows.select("c", "g", "id").withColumn("place", F.row_number().over(Window.partitionBy("c", "g").orderBy(F.asc_nulls_last("id"))))
    first = written(copies.where(F.col("place") <= keep), "topk-first")
    named_first = F.coalesce("id", F.lit((1 << 63) - 1))
    classes = (rows.groupBy("c", "g").agg(F.min(named_first).alias("name"), F.first("v").alias("v"))
               .withColumns({"dim": F.size("v"), "norm": F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e))}))
    classes = written(classes, "topk-classes")
    count = classes.count()
    ranged = classes.repartitionByRange(max(1, -(-count // BUCKET)), "dim", F.desc("norm"), "c")
    buckets = written(ranged.select("c", "g", "name", "norm", "v", "dim", F.spark_partition_id().alias("bucket")), "topk-buckets")
    # a bucket of one dimension; the range partitions of equal dimensions descend by norm
    shape = written(buckets.groupBy("dim", "bucket").agg(F.max("norm").alias("most")), "topk-shape")
    asked = rows.where(F.col("id") % every == 0).groupBy("c", "g").agg(F.count("*").alias("n"))
    queries = classes.join(asked.drop("n"), ["c", "g"]).select("c", "g", "norm", "v", "dim")
    n_blocks = max(1, -(-queries.count() // BLOCK))

    vec = "c bigint, g bigint, norm double"

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.asarray(batch.column("dim"), dtype=np.int64))).tolist()
        codes = [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return arrow(**{n: batch.column(n) for n in batch.schema.names if n not in ("v", "dim")}, dim=batch.column("dim"), codes=pa.array(codes, pa.binary()))

    packed = written(map_texts(buckets.select("c", "g", "norm", "name", "bucket", "v", "dim"), pack, f"{vec}, name bigint, bucket int, dim int, codes binary"), "topk-packed")
    questions = map_texts(queries.select("c", "g", "norm", "v", "dim"), pack, f"{vec}, dim int, codes binary")

    def matrix(t: pa.Table) -> np.ndarray:
        dim = t["dim"][0].as_py()
        return np.frombuffer(b"".join(t["codes"].to_pylist()), dtype=np.int32).reshape(t.num_rows, dim)

    found_schema = "c bigint, g bigint, pc bigint, pg bigint, name bigint, score bigint"

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """One block of queries (c, g, norm, dim, codes, threshold) and one bucket."""
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("c", "g", "pc", "pg", "name", "score")})
        name = np.asarray(right["name"])
        threshold = np.array([LOWEST if t is None else t for t in left["threshold"].to_pylist()], dtype=np.int64)
        q, p, s = best_of(matrix(left), np.asarray(left["norm"]), threshold, matrix(right), np.asarray(right["norm"]), name, keep)
        q, p = pa.array(q), pa.array(p)
        return pa.table({"c": left["c"].take(q), "g": left["g"].take(q), "pc": right["c"].take(p), "pg": right["g"].take(p), "name": right["name"].take(p),
                         "score": pa.array(s, pa.int64())})

    def rounds(asking: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        """The meetings named by ``pairs`` (block, dim, bucket)."""
        left = asking.join(pairs, ["block", "dim"]).groupBy("block", "dim", "bucket")
        named = pairs.select(F.col("block").alias("at_block"), F.col("dim").alias("at_dim"), F.col("bucket").alias("at_bucket"))
        right = (packed.join(named, (F.col("dim") == F.col("at_dim")) & (F.col("bucket") == F.col("at_bucket"))).drop("dim", "bucket")
                 .withColumnRenamed("at_dim", "dim").groupBy("at_block", "dim", "at_bucket"))
        return written(left.cogroup(right).applyInArrow(meet, found_schema), name)

    # first the bucket of the greatest norms of every dimension
    dealt = written(questions.withColumn("block", F.pmod(F.xxhash64("g", "c"), F.lit(n_blocks)).cast("int"))
                    .withColumn("threshold", F.lit(None).cast("bigint")), "topk-questions")
    top = shape.groupBy("dim").agg(F.min("bucket").alias("bucket"))
    blocks = dealt.select("block", "dim").distinct()
    seeds = rounds(dealt, blocks.join(top, "dim"), "topk-seeds")
    floors = seeds.groupBy("c", "g").agg(F.count("*").alias("found"), F.min("score").alias("low"))
    floors = floors.select("c", "g", F.when(F.col("found") >= keep, F.col("low")).alias("threshold"))

    # then the others, each by the blocks that it can serve; blocks hold queries of like demands
    wanted = written(dealt.drop("threshold", "block").join(floors, ["c", "g"], "left")
                     .withColumn("need", F.coalesce(F.try_divide(F.col("threshold").cast("double"), F.col("norm")), F.lit(0.0))), "topk-wanted")
    ranked = wanted.repartitionByRange(n_blocks, "dim", "need", "c").withColumn("block", F.spark_partition_id())
    ranked = written(ranked, "topk-ranked")
    needs = ranked.groupBy("dim", "block").agg(F.min("need").alias("need"))
    pairs = (needs.join(shape, "dim").join(top.withColumnRenamed("bucket", "seed"), "dim")
             .where((F.col("bucket") != F.col("seed")) & (F.col("most") * (1 + SLACK) >= F.col("need"))).select("block", "dim", "bucket"))
    others = rounds(ranked, written(pairs, "topk-pairs"), "topk-found")

    found = seeds.unionByName(others)
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("c", "g").orderBy(F.desc("score"), "name"))).where(F.col("place") <= keep)
    best = written(best.select("c", "g", "pc", "pg", "score"), "topk-best")
    candidates_ = first.select(F.col("c").alias("pc"), F.col("g").alias("pg"), F.col("id"), F.col("place"))
    # a query's own row is one of the rows with its id and vector: the first of them is left out
    ids = rows.where(F.col("id") % every == 0).groupBy("c", "g", "id").agg(F.count("*").alias("times"))
    lists = (ids.withColumnRenamed("id", "query_id").join(best, ["c", "g"]).join(candidates_, ["pc", "pg"])
             .withColumn("same", (F.col("pc") == F.col("c")) & (F.col("pg") == F.col("g")) & F.col("id").eqNullSafe(F.col("query_id"))))
    own = Window.partitionBy("c", "g", "query_id", "same").orderBy("place")
    lists = lists.withColumn("copy", F.row_number().over(own)).where(~(F.col("same") & (F.col("copy") == 1)))
    order = Window.partitionBy("c", "g", "query_id").orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    out = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select("query_id", "rank", "id", "score"))
