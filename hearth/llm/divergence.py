"""Divergence between the sources of a language, from count-level bitmaps.

Term counts of every (language, source) group come from one pass; a
language keeps the terms that enough of its documents hold. Kept terms are dealt
into chunks of bounded size. In a chunk a group has one bitset of terms for each
count that occurs: the AND of two groups' bitsets and its population count is
the number of terms with that pair of counts, which is multiplied by the
divergence of the two smoothed probabilities. Terms that one group or both lack
follow by complement, so no row stands for a zero.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import arrow, map_texts, written

#: Documents of a language that must hold a term, and the ranks listed for the terms of a group.
MIN_DOCUMENTS = 10
TOP = 10
#: Probabilities are fixed-point numbers: floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)) + 1.
SCALE = 1_000_000_000
SMOOTH = 2
#: Term counts (of all groups) and terms that one chunk holds on average.
CHUNK_COUNTS = 1 << 15
CHUNK_TERMS = 512
#: Words of the bitsets that one AND makes.
BLOCK_WORDS = 1 << 20
#: Bytes of terms, A-Z lowered; all others part them. UTF-8 has bytes of 128 and more in characters beyond ASCII only.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_BYTES).split()


def _count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Rows (lang, source, text) to partial counts (lang, source, term, n, docs) of the slice; every group has a row without a term."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
        found = terms(text)
        n.update(found)
        docs.update(set(found))
    rows = [(*g, t.decode("utf-8"), k, docs[t]) for g, (n, docs) in groups.items() for t, k in n.items()] + [(*g, None, 0, 0) for g in groups]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return arrow(**{k: pa.array(v, t) for k, v, t in zip(("lang", "source", "term", "n", "docs"), zip(*rows, strict=True), kinds, strict=True)})


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so the square fits."""
    d = p - q
    return d * d // (p + q)


def chunk_divergence(size: int, p0: np.ndarray, level_source: np.ndarray, level_p: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Sums of the divergence over the ``size`` terms of a chunk, for every two of its sources.

    ``p0`` is the probability of a term that the source lacks. Levels ascend by
    source; ``bits`` (levels x words) are the terms of a source with one count.
    """
    out = np.zeros((len(p0), len(p0)), dtype=np.int64)
    have = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    edge = np.searchsorted(level_source, np.arange(len(p0) + 1))
    in_source = np.zeros((len(level_source), len(p0)), dtype=np.int64)
    in_source[np.arange(len(level_source)), level_source] = 1
    any_of = have @ in_source
    step = max(1, BLOCK_WORDS // max(1, bits.size))
    for s in range(len(p0)):
        met = np.zeros((0, len(level_source)), dtype=np.int64)
        for a in range(edge[s], edge[s + 1], step):
            b = min(a + step, edge[s + 1])
            joint = np.bitwise_count(bits[a:b, None, :] & bits[None, :, :]).sum(axis=2, dtype=np.int64)
            met = np.concatenate((met, joint))
            out[s] += (joint * divergence(level_p[a:b, None], level_p[None, :])).sum(axis=0) @ in_source
        own_p, own = level_p[edge[s]:edge[s + 1]], have[edge[s]:edge[s + 1]]
        both = met @ in_source  # by own level and other source
        out[s] += ((own[:, None] - both) * divergence(own_p[:, None], p0[None, :])).sum(axis=0)
        out[s] += ((have - met.sum(axis=0)) * divergence(p0[s], level_p)) @ in_source
        out[s] += (size - own.sum() - any_of + both.sum(axis=0)) * divergence(p0[s], p0)
    return out


def _meet(group: pa.Table) -> pa.Table:
    """Rows (lang, size, source, bit, n, p) of one chunk to (lang, a, b, value); a row without a bit gives the p of a term that the source lacks."""
    size = group["size"][0].as_py()
    names = sorted(set(group["source"].to_pylist()))
    at = {name: i for i, name in enumerate(names)}
    source = np.array([at[x] for x in group["source"].to_pylist()])
    has = np.asarray(group["bit"].is_valid())
    p0 = np.zeros(len(names), dtype=np.int64)
    p0[source[~has]] = np.asarray(group["p"])[~has]
    bit = np.asarray(group["bit"].drop_null(), dtype=np.int64)
    levels, level = np.unique(np.stack((source[has], np.asarray(group["n"])[has], np.asarray(group["p"])[has])), axis=1, return_inverse=True)
    level = level.reshape(-1)
    bits = np.zeros((levels.shape[1], -(-size // 64)), dtype=np.uint64)
    np.bitwise_or.at(bits, (level, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    value = chunk_divergence(size, p0, levels[0], levels[2], bits)
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    return pa.table({"lang": pa.repeat(group["lang"][0], len(a)), "a": pa.array(names, pa.string()).take(pa.array(a)),
                     "b": pa.array(names, pa.string()).take(pa.array(b)), "value": pa.array(value[a, b], pa.int64())})


def _p(n: str, total: str, kept: str):
    """The fixed-point probability, exact: decimals divide to a whole number."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))) div (cast({total} as decimal(20,0)) + {SMOOTH} * cast({kept} as decimal(17,0)))")


def _f(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group that occurs.

    Part ``pair``: every other source of the language with the divergence summed
    over all kept terms (0 if the language keeps none). Part ``term``: the kept
    terms of the group that are likelier in it than in the whole language, by
    divergence, ``top`` ranks. Values descend, ties by item in UTF-8 order.

    Null text, language and source are read as ''; a text without terms, empty
    or null, still makes its group occur. Repeated rows count each; a text of any length is
    one document. Other columns are ignored, whatever their names. An empty
    table gives no rows.
    """
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    partial = map_texts(named.withColumn("text", F.col("text").cast("binary")), _count, "lang string, source string, term string, n bigint, docs bigint")
    counts = written(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    groups = counts.where("term is null").select("lang", "source")
    vocabulary = (counts.where("term is not null").groupBy("lang", "term")
                  .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"), F.count("*").alias("spread")).where(F.col("docs") >= min_documents))
    vocabulary = written(vocabulary.select("lang", "term", "in_lang", "spread"), "divergence-vocabulary")

    # terms into chunks: as many as the counts and the terms of a language need
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_total"), F.sum("spread").alias("counts"))
    langs = written(langs.select("lang", "kept", "lang_total", F.ceil(F.greatest(F.col("counts") / CHUNK_COUNTS, F.col("kept") / CHUNK_TERMS)).alias("chunks")), "divergence-langs")
    dealt = vocabulary.join(langs, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    bit = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1  # over the terms of a chunk only
    dealt = written(dealt.select("lang", "term", "chunk", bit.alias("bit"), "in_lang", "kept", "lang_total"), "divergence-chunks")

    entries = counts.where("n > 0").select("lang", "source", "term", "n").join(dealt, ["lang", "term"])
    entries = written(entries, "divergence-entries")
    totals = written(groups.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                     .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "divergence-totals")
    scored = entries.join(totals, ["lang", "source"]).withColumns({"p": _p("n", "total", "kept"), "q": _p("in_lang", "lang_total", "kept")})

    # every source of a language is told to every chunk once, with the p of a term that it lacks
    sizes = written(dealt.groupBy("lang", "chunk").agg(F.count("*").alias("size"), F.first("kept").alias("kept")), "divergence-sizes")
    said = scored.join(sizes.drop("kept"), ["lang", "chunk"]).select("lang", "chunk", "size", "source", "bit", "n", "p")
    told = sizes.join(totals, "lang").select("lang", "chunk", "size", "source", F.lit(None).cast("int").alias("bit"), F.lit(0).cast("bigint").alias("n"), _p("0", "total", "kept").alias("p"))
    cells = said.unionByName(told).groupBy("lang", "chunk").applyInArrow(_meet, "lang string, a string, b string, value bigint")
    sums = written(cells.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "divergence-pairs")
    other = groups.select(F.col("lang").alias("other_lang"), F.col("source").alias("item"))
    pairs = (groups.join(other, (F.col("lang") == F.col("other_lang")) & (F.col("source") != F.col("item")))
             .join(sums.select(F.col("lang").alias("other_lang"), F.col("a").alias("source"), F.col("b").alias("item"), "value"), ["other_lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value")))
    likelier = (scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").cast("bigint").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    best = likelier.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(best)
