"""Benchmark decontamination by suffix arrays of the training documents.

Each shard of documents (a slice of an Arrow batch, whole documents) becomes
one word sequence. Words outside the benchmark's vocabulary end every match, so
the shard's suffix array holds the suffixes that begin with a run of benchmark
words at least as long as the shortest window. Every benchmark suffix is
binary-searched in it; windows that occur one after another on the same
diagonal are joined to longest verbatim matches with their places.

Benchmark items go to the executors in blocks of bounded size, each against all
documents; there is no pair of rows beyond the matches found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, filter_rows, map_texts, written

WINDOW = 10
#: Characters of benchmark text that are sent to the executors at once.
BLOCK_CHARS = 4 << 20

#: Bytes to word bytes: A-Z to lower case, [^\x30-\x39\x61-\x7A\x80-\xFF] to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split() if text else []


@dataclass(frozen=True)
class Block:
    """Test suffixes of some benchmark items, as word numbers from 1."""

    vocabulary: dict[bytes, int]
    seq: np.ndarray  # all items' words; 0 between items and behind the last
    starts: np.ndarray  # where a window begins
    sizes: np.ndarray  # its words
    items: np.ndarray  # the number of its item
    offsets: np.ndarray  # its first word's place in the item
    ids: list
    least: int


def block_of(rows: list[tuple], window: int = WINDOW) -> Block:
    vocabulary: dict[bytes, int] = {}
    seq: list[int] = []
    starts, sizes, items, offsets, ids = [], [], [], [], []
    for item_id, text in rows:
        words = words_of(text)
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            starts.append(len(seq) + i)
            sizes.append(size)
            items.append(len(ids))
            offsets.append(i)
        seq += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words] + [0]
        ids.append(item_id)
    seq += [0] * window
    as_array = lambda x: np.array(x, dtype=np.int64)
    return Block(vocabulary, as_array(seq), as_array(starts), as_array(sizes), as_array(items), as_array(offsets), ids, min(sizes, default=0))


def suffix_order(seq: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` of ``seq`` sorted by their first ``depth`` words at least, by prefix doubling; 0 ends a suffix."""
    rank = seq.copy()
    width = 1
    while width < depth:
        ahead = np.zeros_like(rank)
        ahead[:-width] = rank[width:]
        ahead[rank == 0] = 0
        ended = np.flatnonzero(seq == 0)
        pair = rank * (int(rank.max(initial=0)) + 1) + ahead
        pair[ended] = 0
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        if pair.min(initial=0) > 0:
            rank += 1
        width *= 2
    return at[np.argsort(rank[at], kind="stable")]


def search(seq: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the block, the range of ``order`` whose suffixes begin with it."""

    def bound(right: bool) -> np.ndarray:
        lo = np.zeros(len(block.starts), dtype=np.int64)
        hi = np.full(len(block.starts), len(order), dtype=np.int64)
        for _ in range(len(order).bit_length() + 1):
            mid = np.minimum((lo + hi) // 2, len(order) - 1)
            where = order[mid]
            sign = np.zeros(len(mid), dtype=np.int64)  # of suffix against window, by the first word that differs
            for k in range(int(block.sizes.max())):
                undecided = (sign == 0) & (k < block.sizes)
                sign[undecided] = np.sign(seq[where[undecided] + k] - block.seq[block.starts[undecided] + k])
            open_ = lo < hi
            below = open_ & ((sign <= 0) if right else (sign < 0))
            lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo

    return bound(False), bound(True)


def matches_in(texts: list[str | None], block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Longest verbatim matches of a shard: (document, its first word, item, the item's first word, words), and words by document."""
    sequences = [words_of(t) for t in texts]
    counts = [len(w) for w in sequences]
    none = np.zeros(0, dtype=np.int64)
    if not block.least or not any(counts):
        return none, none, none, none, none, counts
    longest = int(block.sizes.max())
    begins = np.cumsum([0, *(n + 1 for n in counts)])
    full = np.zeros(begins[-1] + longest, dtype=np.int64)
    look = block.vocabulary.get
    for begin, words in zip(begins.tolist(), sequences, strict=False):
        full[begin:begin + len(words)] = np.fromiter(map(look, words, repeat(0)), dtype=np.int64, count=len(words))
    # words left until the next foreign word; only runs that hold a window go on, with one 0 behind each
    stops = np.flatnonzero(full == 0)
    run = stops[np.searchsorted(stops, np.arange(len(full)))] - np.arange(len(full))
    first = np.flatnonzero((run >= block.least) & (np.concatenate(([0], full[:-1])) == 0))
    if not len(first):
        return none, none, none, none, none, counts
    sizes = run[first] + 1
    place = np.repeat(first - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    seq = np.concatenate((full[place], np.zeros(longest, dtype=np.int64)))
    order = suffix_order(seq, np.flatnonzero(run[place] >= block.least), longest)
    lo, hi = search(seq, order, block)
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    where = place[order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]]
    item, offset, size = block.items[window], block.offsets[window], block.sizes[window]
    by = np.lexsort((where, where - offset, item))
    where, item, offset, size = where[by], item[by], offset[by], size[by]
    new = np.ones(len(where), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (where[1:] != where[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(where))) + size[head] - 1
    doc = np.searchsorted(begins, where[head], side="right") - 1
    return doc, where[head] - begins[doc], item[head], offset[head], length, counts


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
           chars: int = BLOCK_CHARS) -> Iterator[Block]:
    """Blocks of items whose texts hold ``chars`` characters at most, or one longer item each."""
    rows, size = [], 0
    for item_id, text in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        if rows and size + len(text) > chars:
            yield block_of(rows, window)
            rows, size = [], 0
        rows.append((item_id, text))
        size += len(text)
    yield block_of(rows, window)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
             chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, n_words, matches) for every row; matches is an array of (start, words, item, item_start), in words.

    A match is a longest run of words that a document and an item share, of
    ``window`` words at least, or a whole item of fewer. Null and empty texts
    have no words; items with null or empty texts match nothing; rows and items
    may repeat. Other columns are ignored.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    match = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())])
    schema = f"id {id_type}, n_words bigint, matches array<struct<start:int,words:int,item:string,item_start:int>>"

    def against(df: DataFrame, block) -> DataFrame:
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            b: Block = block.value
            texts = batch.column(batch.num_columns - 1)
            doc, start, item, item_start, n, counts = matches_in(texts.to_pylist(), b)
            found: list[list] = [list(x or []) for x in batch.column("matches").to_pylist()]
            for d, s, i, o, k in zip(doc.tolist(), start.tolist(), item.tolist(), item_start.tolist(), n.tolist(), strict=True):
                found[d].append({"start": s, "words": k, "item": None if b.ids[i] is None else str(b.ids[i]), "item_start": o})
            return arrow(id=batch.column("id"), n_words=pa.array(counts, pa.int64()), matches=pa.array(found, pa.list_(match)), text=texts)

        return map_texts(df, kernel, f"{schema}, text string")

    df = named.select("id", F.lit(0).cast("bigint").alias("n_words"), F.lit(None).cast("array<struct<start:int,words:int,item:string,item_start:int>>").alias("matches"), "text")
    for k, block in enumerate(blocks(benchmark, window=window, chars=chars)):
        # a further block starts from a written table: one Python worker, and one block, at a time
        df = against(written(df, "decontam-block") if k else df, spark.sparkContext.broadcast(block))
    return df.select("id", "n_words", "matches")


def contamination(found: DataFrame) -> DataFrame:
    """``overlaps`` with n_hit (words inside any match), items (sorted as text, without null ids) and contaminated."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["start"].cast("bigint").alias("a"), (m["start"] + m["words"]).cast("bigint").alias("b"))))
    zero = F.lit(0).cast("bigint")
    covered = F.aggregate(
        spans, F.struct(zero.alias("n"), zero.alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(zero, s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["b"]).alias("end")),
        lambda acc: acc["n"])
    items = F.array_sort(F.filter(F.array_distinct(F.transform("matches", lambda m: m["item"])), lambda i: i.isNotNull()))
    return found.withColumn("n_hit", covered).withColumn("items", items).withColumn("contaminated", F.size("matches") > 0)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows that share no window with any item, all columns unchanged; each row is judged by its own text."""
    for k, found in enumerate(blocks(benchmark, window=window, chars=chars)):
        block = docs.sparkSession.sparkContext.broadcast(found)

        def keep(texts: list[str | None], block=block) -> list[bool]:
            clean = np.ones(len(texts), dtype=bool)
            clean[matches_in(texts, block.value)[0]] = False
            return clean.tolist()

        docs = filter_rows(written(docs, "decontam-block") if k else docs, text_col, keep)
    return docs
