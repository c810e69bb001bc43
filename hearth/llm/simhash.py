"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming verification, components.

A fingerprint takes the majority bit of the XXH64 hashes of all 3-word shingles.
Two fingerprints within ``max_bits`` differing bits agree on at least
``BLOCKS - max_bits`` of the ``BLOCKS`` blocks, so they share one of the keys
made of that many blocks. Fingerprints meet on those keys (38 bits or more at
2 bits: the bucket size stays small at billions of fingerprints) and the
distance of every candidate pair is verified.

A bucket with more than ``HOT`` distinct fingerprints is not paired up: its
fingerprints meet on the words one bit flip away instead. Two fingerprints are
within two bits exactly when they share such a word, and at most 65
fingerprints share one, so that exact way has no hot key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, components, map_texts, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCKS = (13, 13, 13, 13, 12)
HOT = 64
#: Shingle hashes counted at once, so that a very long text needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; null and texts without words give 0."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    lo, hi = starts[:n].tolist(), (ends[-n:] - 1).tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, CHUNK):
        raw = b"".join([digest(joined[i:j], SEED) for i, j in zip(lo[at:at + CHUNK], hi[at:at + CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    value = 0
    for bit in (2 * ones > n).tolist():
        value = value << 1 | bit
    return value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed bigint; repeated rows stay repeated."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        return arrow(id=batch.column(0), fp=pa.array(fps, pa.int64()))

    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), kernel, f"id {id_type}, fp bigint")


def _masks(max_bits: int) -> list[int]:
    """Signed masks that keep all but ``max_bits`` blocks, one for each choice."""
    edges = [0]
    for width in BLOCKS:
        edges.append(edges[-1] + width)
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(kept) for kept in combinations(parts, len(BLOCKS) - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs within ``max_bits``."""
    if max_bits != 2:
        raise ValueError("the way for hot buckets is exact for two differing bits")
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(_masks(max_bits))])
    keyed = distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    sizes = written(keyed.groupBy("k", "v").count().where("count > 1"), "simhash-buckets")
    met = keyed.join(sizes, ["k", "v"])
    cold = (met.where(F.col("count") <= hot).groupBy("k", "v").agg(F.collect_list("fp").alias("fps"))
            .select(F.explode("fps").alias("a"), "fps")
            .select("a", F.explode(F.filter("fps", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= max_bits))).alias("b")))
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)])
    shared = (met.where(F.col("count") > hot).select("fp").distinct()
              .select("fp", F.explode(flips).alias("w")).groupBy("w").agg(F.collect_list("fp").alias("fps"))
              .where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b"))
    return cold.unionByName(shared)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): one row for each input row; component is the smallest id reachable by links.

    Null and empty texts have fingerprint 0 and link with each other and any
    text whose fingerprint is near 0. Rows with a null id keep their row; their
    component is the smallest non-null id, or null if there is none. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    roots = components(links(classes.select("fp"), max_bits), "simhash")
    joined = classes.join(roots, classes.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("rep").alias("component"))
    member = written(joined.join(smallest, "root").select("fp", "component"), "simhash-members")
    return prints.join(member, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near duplicates: of each component one row stays, that of the smallest id.

    Rows are named by id, text digest and a hash of the other columns, so an id
    with different texts has a row in each of their components; of several rows
    of the smallest id the one of the smallest digest stays. A decision can't
    name a row with a null id: such rows stay.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    name = F.when(key.isNotNull(), F.struct(key.alias("id"), F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("digest"), text.isNull().alias("none"),
                                            (F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("bigint")).alias("rest")))
    dups = written(near_duplicates(docs.select(name.alias("id"), text.alias("text")), "id", "text"), "simhash-classes")
    taken, mark = {c.lower() for c in docs.columns}, "_gone"
    while mark in taken:
        mark += "_"
    gone = dups.where("id != component").select(F.col("id").alias(mark)).distinct()
    kept = docs.join(gone, name == F.col(mark), "left_anti")
    if dups.where("id = component").groupBy("id").count().where("count > 1").isEmpty():
        return kept
    # what is left under one id and text are copies of one row
    return kept.where(key.isNotNull()).dropDuplicates([id_col, text_col]).unionByName(kept.where(key.isNull()))
