"""Removal of byte strings that occur twice or more, by a distributed sparse suffix sort.

Every ``span``-byte window of a text is filed under its anchor: the k-gram of
smallest hash inside it (leftmost among equals). Equal windows have equal
anchors at equal places, so only windows filed under the same anchor are ever
compared, and the consecutive windows of one anchor travel as one fragment.

* An anchor seen once is done; an anchor whose fragments are all equal marks
  them all repeated. Fragments are counted by digest; the least and the greatest
  bytes under one digest are compared, and if they differ the whole is done
  again with other digests.
* Where the fragments of an anchor differ, the suffixes that begin at the
  anchor and the reversed prefixes that end there are sorted in mergesort whose
  comparisons find the common extension by binary search over prefix polynomial
  hashes; each adjacent extension is verified byte by byte. Two windows are
  equal when their right part lies in one interval of the suffix order and
  their left part in one of the prefix order.
* An anchor with more than ``HOT`` different fragments is not brought together:
  its fragments are cut into shorter ones that meet under their own middle part,
  again and again until the groups are small or hold equal windows only.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import arrow, map_texts, written

SPAN = 400
GRAM_BITS = 6
GRAM = 1 << GRAM_BITS
#: Different fragments that one sort takes (under 1 MB), and the parts that fragments of larger groups are cut into.
HOT = 1024
SPLIT = 8
#: Bytes of text whose anchors are found at once.
CHUNK = 1 << 20
#: Bytes of fragments that are sorted, or cut into windows, at once.
GROUP_BYTES = 1 << 20
#: Sets of digests that are tried, one after another, if different bytes share a digest.
SALTS = 4
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Odd multipliers: the first for k-grams, the others for prefix hashes (the next one is taken after a collision).
_ODD = _RNG.integers(1 << 62, 1 << 63, 5, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of all k-grams, by doubling."""
    h = _BYTE[data]
    power = _ODD[0]
    for step in range(GRAM_BITS):
        width = 1 << step
        nxt = h[:-width] * power
        nxt += h[width:]
        h = nxt
        power = np.uint64(int(power) * int(power) & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(v)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = v
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def anchors(data: np.ndarray, bounds: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first window, last window) of the anchors of joined texts; ``bounds`` are the texts' ends, 0 first."""
    mask = np.uint64((1 << 22) - 1)
    found = []
    for at in range(0, max(0, len(data) - span + 1), CHUNK):
        part = data[at:at + CHUNK + span - 1]
        h = gram_hashes(part)
        low = sliding_min((h & ~mask) | np.arange(len(h), dtype=np.uint64), span - GRAM + 1)
        place = (low & mask).astype(np.int64)
        begin = np.arange(at, at + len(place))
        inside = np.searchsorted(bounds, begin, side="right") == np.searchsorted(bounds, begin + span - 1, side="right")
        change = np.ones(len(place), dtype=bool)
        change[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(place)) - 1
        keep = inside[first]
        first, last = first[keep], last[keep]
        found.append((place[first] + at, h[place[first]], first + at, last + at))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Prefixes:
    """Prefix polynomial hashes of a buffer, and common extensions by binary search over them."""

    def __init__(self, data: np.ndarray, base: np.uint64):
        self.data = data
        self.power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(data), base))), dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self.power[:-1], dtype=np.uint64)))

    def same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        end = len(self.data)
        return (self.sums[x + n] - self.sums[x]) * self.power[end - x] == (self.sums[y + n] - self.sums[y]) * self.power[end - y]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at x and y, ``most`` at most."""
        lo, hi = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            equal = self.same(x, y, mid)
            lo, hi = np.where(equal, mid, lo), np.where(equal, hi, mid - 1)
        return lo

    def less(self, x, y, nx, ny) -> np.ndarray:
        """Whether the suffix of ``nx`` bytes at x sorts before that at y (a prefix sorts first)."""
        most = np.minimum(nx, ny)
        n = self.common(x, y, most)
        ended = n == most
        last = len(self.data) - 1
        return np.where(ended, nx < ny, self.data[np.minimum(x + n, last)] < self.data[np.minimum(y + n, last)])

    def verified(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> bool:
        """Whether the common prefixes found by hashes hold byte by byte."""
        total = int(n.sum())
        if not total:
            return True
        step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        return bool((self.data[np.repeat(x, n) + step] == self.data[np.repeat(y, n) + step]).all())


def merge_sort(group: np.ndarray, at: np.ndarray, size: np.ndarray, text: Prefixes) -> np.ndarray:
    """Order of the suffixes (at, size) by group, then by bytes: bottom-up mergesort inside each group.

    ``group`` ascends. All runs of a level are merged together: the rank of a
    suffix in the neighbouring run comes from a binary search, with ties going
    to the left run.
    """
    n = len(at)
    order = np.arange(n)
    head = np.searchsorted(group, group)  # where the group begins
    tail = np.searchsorted(group, group, side="right")
    place = np.arange(n) - head
    widest = int((tail - head).max(initial=0))
    width = 1
    while width < widest:
        run = place // width
        left = (run & 1) == 0
        own = head + run * width
        other = np.where(left, own + width, own - width)
        end = np.minimum(other + width, tail)
        live = other < tail
        lo, hi = np.where(live, other, 0), np.where(live, end, 0)
        start = lo.copy()
        me = order
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            a, b = me[open_], order[mid]
            # elements of the other run before mine: strictly smaller, or equal if the other run is the left one
            x, y = np.where(left[open_], b, a), np.where(left[open_], a, b)
            to_right = text.less(at[x], at[y], size[x], size[y]) == left[open_]
            lo[open_] = np.where(to_right, mid + 1, lo[open_])
            hi[open_] = np.where(to_right, hi[open_], mid)
        new = np.where(left, own, other) + (np.arange(n) - own) + np.where(live, lo - start, 0)
        merged = np.empty_like(order)
        merged[new] = order
        order = merged
        width *= 2
    return order


def repeated_windows(group: np.ndarray, frags: list[bytes], anchor: np.ndarray, weight: np.ndarray, span: int = SPAN) -> list[list[tuple[int, int]]]:
    """Of each fragment, the ranges (first, last) of windows that its group holds twice or more.

    ``group`` ascends; ``anchor`` is the anchor's place in the fragment, ``weight`` how often the fragment occurs.
    """
    m = len(frags)
    sizes = np.array([len(f) for f in frags], dtype=np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    forward = np.frombuffer(b"".join(frags), dtype=np.uint8)
    backward = forward[::-1]
    sides = []
    for data, at, size in ((forward, begin + anchor, sizes - anchor), (backward, len(forward) - begin - anchor, anchor)):
        for base in _ODD[1:]:
            text = Prefixes(data, base)
            order = merge_sort(group, at, size, text)
            a, b = order[:-1], order[1:]
            common = text.common(at[a], at[b], np.minimum(size[a], size[b]))
            if text.verified(at[a], at[b], common):
                break
        else:
            raise ArithmeticError("hash collisions under every multiplier")
        common[group[a] != group[b]] = -1
        sides.append((order, np.concatenate(([-1], common))))
    (right, right_common), (left, left_common) = sides
    first, last = -anchor, sizes - span - anchor  # of the window starts, from the anchor
    marks = []
    for r in range(int(first.min()), int(last.max()) + 1):
        use = np.flatnonzero((first <= r) & (r <= last))
        if not len(use):
            continue
        interval = np.empty((2, m), dtype=np.int64)
        interval[0, right] = np.cumsum(right_common < span + r)
        interval[1, left] = np.cumsum(left_common < -r)
        key = interval[0, use] * (m + 1) + interval[1, use]
        _, same = np.unique(key, return_inverse=True)
        twice = np.bincount(same, weights=weight[use]) >= 2
        hit = use[twice[same]]
        marks.append(np.stack((hit, np.full(len(hit), r))))
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if sum(x.shape[1] for x in marks):
        frag, r = np.concatenate(marks, axis=1)
        by = np.lexsort((r, frag))
        frag, r = frag[by], r[by] - first[frag[by]]
        new = np.ones(len(frag), dtype=bool)
        new[1:] = (frag[1:] != frag[:-1]) | (r[1:] != r[:-1] + 1)
        head = np.flatnonzero(new)
        for f, a, b in zip(frag[head].tolist(), r[head].tolist(), r[np.append(head[1:], len(r)) - 1].tolist(), strict=True):
            out[f].append((a, b))
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


class Collision(ArithmeticError):
    """Different bytes have one digest."""


def _one_each(kinds: DataFrame) -> DataFrame:
    """``kinds`` without ``top`` and ``top_place``, if each digest's least and greatest bytes (``text``, ``top``) and places are equal."""
    if not kinds.where("text != top or place != top_place").isEmpty():
        raise Collision
    return kinds.drop("top", "top_place")


def _anchors_of(batch: pa.RecordBatch, salt: int = 0) -> pa.RecordBatch | None:
    texts = [t or b"" for t in batch.column("text").to_pylist()]
    joined = b"".join(texts)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    place, h, first, last = anchors(np.frombuffer(joined, dtype=np.uint8), bounds)
    doc = np.searchsorted(bounds, first, side="right") - 1
    view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
    frag = np.fromiter((digest(view[a:b + SPAN], p - a + (salt << 32)) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)),
                       dtype=np.uint64, count=len(place))
    at = bounds[doc]
    take = pa.array(doc)
    return arrow(anchor=_signed(h), frag=_signed(frag), d=batch.column("d").take(take), rid=batch.column("rid").take(take),
                 lo=pa.array((first - at), pa.int64()), hi=pa.array((last - at), pa.int64()), place=pa.array((place - at), pa.int64()))


_RANGES = "array<struct<a:bigint,b:bigint>>"
# Aggregates that tell equal bytes from different ones, and combine before a shuffle.
_LEAST_AND_GREATEST = ("min(place) as place", "max(place) as top_place", "min(text) as text", "max(text) as top")
_RANGES_ARROW = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _sort_groups(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (anchor, frags[(frag, n, place, text)]) to rows (anchor, frag, ranges)."""
    group, rows = [], []
    for anchor, frags in zip(batch.column("anchor").to_pylist(), batch.column("frags").to_pylist(), strict=True):
        group += [len(rows)] * len(frags)
        rows += [(anchor, f) for f in frags]
    ranges = repeated_windows(np.array(group, dtype=np.int64), [f["text"] for _, f in rows], np.array([f["place"] for _, f in rows], dtype=np.int64),
                              np.array([f["n"] for _, f in rows], dtype=np.float64))
    return arrow(anchor=pa.array([a for a, _ in rows], pa.int64()), frag=pa.array([f["frag"] for _, f in rows], pa.int64()),
                 ranges=pa.array([[{"a": a, "b": b} for a, b in r] for r in ranges], _RANGES_ARROW))


def _splitter(size: int, salt: int = 0):
    """Kernel: rows (anchor, frag, n, place, text) to their sub-fragments of ``size`` windows, blocks counted from the anchor.

    The windows of a block all hold the block's middle part, whatever windows of
    it a fragment has; sub-fragments meet under the hash of that part.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("anchor", "frag", "off", "block", "sub", "n", "place", "text")}
        for anchor, frag, n, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, last = -place, len(text) - SPAN - place  # window starts, from the anchor
            for block in range(-last // size, -first // size + 1):
                lo, hi = -(block + 1) * size + 1, -block * size
                shared = text[place + hi:place + lo + SPAN]
                at, end = max(lo, first) + place, min(hi, last) + place
                part = text[at:end + SPAN]
                name = xxhash.xxh3_64_intdigest(shared + anchor.to_bytes(8, "little", signed=True), (block + (salt << 32)) & (1 << 64) - 1) - (1 << 63)
                row = (anchor, frag, at, name, xxhash.xxh3_64_intdigest(part, place - at + (salt << 32)) - (1 << 63), n, place - at, part)
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
        return arrow(**{k: pa.array(v, pa.binary() if k == "text" else pa.int64()) for k, v in out.items()})

    return kernel


def _solve(frags: DataFrame, size: int, salt: int = 0) -> DataFrame:
    """(anchor, frag, ranges) of the repeated windows among ``frags`` (anchor, frag, n, kinds, place, text) of ``size`` windows.

    Groups of ``HOT`` kinds or fewer are sorted. The fragments of larger ones are
    cut into ``SPLIT`` blocks of windows; equal parts collapse and unequal
    neighbours part, so only the blocks across the edge of a common passage stay
    large, and they end as single windows, which are equal throughout.
    """
    few = (frags.where(F.col("kinds") <= HOT).groupBy("anchor").agg(F.collect_list(F.struct("frag", "n", "place", "text")).alias("frags"))
           .withColumn("bytes", F.aggregate("frags", F.lit(0).cast("bigint"), lambda n, x: n + F.octet_length(x["text"]))))
    by_sort = map_texts(few, _sort_groups, f"anchor bigint, frag bigint, ranges {_RANGES}", GROUP_BYTES).where(F.size("ranges") > 0)
    hot = frags.where(F.col("kinds") > HOT)
    if size == 1 or hot.isEmpty():
        return by_sort
    size = -(-size // SPLIT)
    parts = written(map_texts(hot.select("anchor", "frag", "n", "place", "text"), _splitter(size, salt),
                              "anchor bigint, frag bigint, off bigint, block bigint, sub bigint, n bigint, place bigint, text binary", GROUP_BYTES), "suffix-parts")
    subs = parts.groupBy("block", "sub").agg(F.sum("n").alias("n"), *map(F.expr, _LEAST_AND_GREATEST))
    subs = _one_each(written(subs, "suffix-subs"))
    kinds = written(subs.groupBy("block").agg(F.count("*").alias("kinds")), "suffix-sizes")
    subs = written(subs.join(kinds, "block").select(F.col("block").alias("anchor"), F.col("sub").alias("frag"), "n", "kinds", "place", "text"), "suffix-frags")
    solved = _solve(subs, size, salt).select(F.col("anchor").alias("block"), F.col("frag").alias("sub"), "ranges")
    moved = F.transform("ranges", lambda x: F.struct((x["a"] + F.col("off")).alias("a"), (x["b"] + F.col("off")).alias("b")))
    back = (parts.select("anchor", "frag", "off", "block", "sub").join(solved, ["block", "sub"])
            .groupBy("anchor", "frag").agg(F.flatten(F.collect_list(moved)).alias("ranges")))
    return by_sort.unionByName(back)


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans, kept = [], []
    for ranges, text in zip(batch.column("ranges").to_pylist(), batch.column("text").to_pylist(), strict=True):
        joined: list[list[int]] = []
        for x in sorted((x["a"], x["b"]) for x in ranges):
            if joined and joined[-1][1] >= x[0]:
                joined[-1][1] = max(joined[-1][1], x[1])
            else:
                joined.append(list(x))
        spans.append([{"a": a, "b": b} for a, b in joined])
        ends = [0, *(b for _, b in joined)]
        kept.append(b"".join(text[e:s] for e, s in zip(ends, [*(a for a, _ in joined), len(text)], strict=True)))
    return arrow(d=batch.column("d"), rid=batch.column("rid"), spans=pa.array(spans, _RANGES_ARROW), kept=pa.array(kept, pa.binary()))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept, text_sha256), one row for each input row.

    ``spans`` are the maximal byte runs (a, end exclusive b) covered by strings
    of ``SPAN`` bytes that also start anywhere else, in the same text or another;
    ``kept`` is what remains of a text with such runs and null if there are none.
    Null is the empty text; texts under ``SPAN`` bytes have no spans; repeated
    rows are copies of each other. Ids may be null or repeat; other columns are
    ignored. An empty table gives no rows.
    """
    for salt in range(SALTS):
        try:
            return _repeats(docs, id_col, text_col, salt)
        except Collision:
            continue
    raise Collision("different bytes shared a digest in every attempt")


def _repeats(docs: DataFrame, id_col: str, text_col: str, salt: int) -> DataFrame:
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    keyed = named.withColumns({"d": F.xxhash64("text"), "rid": F.xxhash64("id")})
    long_ = keyed.where(F.octet_length("text") >= SPAN)
    marks = written(map_texts(long_.select("d", "rid", "text"), partial(_anchors_of, salt=salt),
                              "anchor bigint, frag bigint, d bigint, rid bigint, lo bigint, hi bigint, place bigint"), "suffix-anchors")
    seen = (marks.groupBy("anchor").agg(F.count("*").alias("n"), F.min("frag").alias("f"), F.max("frag").alias("g"))
            .where("n > 1").select("anchor", (F.col("f") != F.col("g")).alias("mixed")))
    seen = written(seen, "suffix-seen")  # a join of two plain exchanges can split an anchor that a third of the texts share
    again = written(marks.join(seen, "anchor"), "suffix-again")

    # the bytes of every fragment whose anchor is seen again come together by digest
    texts = written(long_.join(again.select("d", "rid").distinct(), ["d", "rid"]).select("d", "rid", "text").dropDuplicates(["d", "rid"]), "suffix-texts")
    places = again.select("d", "rid", "anchor", "frag", "mixed", "lo", "hi", "place").distinct()
    bytes_ = (texts.join(places, ["d", "rid"])
              .select("anchor", "frag", "mixed", (F.col("place") - F.col("lo")).alias("place"), F.expr(f"substring(text, int(lo) + 1, int(hi - lo) + {SPAN})").alias("text")))
    frags = _one_each(written(bytes_.groupBy("anchor", "frag", "mixed").agg(*map(F.expr, _LEAST_AND_GREATEST)), "suffix-frags"))

    # one fragment of each kind, with its count, where an anchor has several kinds
    mixed = again.where("mixed")
    kinds = written(mixed.groupBy("anchor", "frag").agg(F.count("*").alias("n")), "suffix-kinds")
    kinds = written(kinds.join(written(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "suffix-sizes"), "anchor"), "suffix-kinds")
    frags = written(frags.where("mixed").join(kinds, ["anchor", "frag"]).select("anchor", "frag", "n", "kinds", "place", "text"), "suffix-kept")
    sorted_ = written(_solve(frags, SPAN - GRAM + 1, salt), "suffix-sorted")

    some = (mixed.join(sorted_, ["anchor", "frag"]).select("d", "rid", "lo", F.explode("ranges").alias("x"))
            .select("d", "rid", (F.col("lo") + F.col("x.a")).alias("a"), (F.col("lo") + F.col("x.b") + SPAN).alias("b")))
    every = again.where("not mixed").select("d", "rid", F.col("lo").alias("a"), (F.col("hi") + SPAN).alias("b"))
    # a set: rows that repeat a text under one id have equal ranges, however many they are
    ranges = every.unionByName(some).groupBy("d", "rid").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
    cut = map_texts(texts.join(ranges, ["d", "rid"]).select("d", "rid", "ranges", "text"), _cut, f"d bigint, rid bigint, spans {_RANGES}, kept binary")
    slim = keyed.select("id", "d", "rid", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))
    return (slim.join(written(cut, "suffix-cut"), ["d", "rid"], "left")
            .select("id", "n_bytes", F.coalesce("spans", F.array().cast(_RANGES)).alias("spans"), "kept", "text_sha256"))
