"""Secret scans with DataFrame functions only.

Base patterns (assignments, access keys, hex strings) are located by splitting
the text at their matches. Beside them, long token-like candidates are scanned
with a sliding window: its character counts change by the two characters that
leave and enter, and the window's Shannon entropy follows from the sum of
c * log2(c). Each character class has its own window and threshold, and an
allow-list suppresses words, numbers, identifiers, rules, and the parts between
separators that hold placeholders.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which they are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Characters of candidates; their places number the counts of a window.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: One case, capitalised or digits, alone or joined by separators: words, numbers, identifiers, paths, rules of dashes.
PLAIN_PART = r"([0-9]++|[A-Z]++(?![a-z])|[A-Z]?[a-z]++)?+"
PLAIN_PARTS = rf"^{PLAIN_PART}([-_/+=]++{PLAIN_PART})*+$"
PLACEHOLDER = r"(?i)example|placeholder|changeme|your[-_]?(key|token|secret|password)|x{6}|0123456789|abcdefghij"
#: What lies between separators, and placeholders that hold one. Possessive, so that Java repeats it without recursion.
PART = r"((?i:your[-_](key|token|secret|password))|[A-Za-z0-9])++"
UUID = r"(?i)^[-_/+=]*+[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}[-_/+=]*+$"


@dataclass(frozen=True)
class CharClass:
    kind: str
    pattern: str
    window: int
    bits: float


#: A candidate belongs to the first class whose pattern it matches.
CLASSES = (CharClass("entropy_hex", r"^([0-9a-f]+|[0-9A-F]+)$", 16, 3.0), CharClass("entropy_base64", "", 20, 3.7))
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
SPAN = "struct<start:int,rank:int,end:int>"


#: Items of one step of a running scan: what a step copies is bounded by it, so that a scan is linear in the items.
STRIDE = 128


def _held(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _running(items: Column, start: Column, step, kind: str) -> Column:
    """What ``step(state, item) -> (state, out)`` puts out for every item in order; nulls are left out.

    Arrays can't be appended to in place, so the results of ``STRIDE`` items are
    gathered first, then those of all strides.
    """
    none, nones = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    def stride(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return _held(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(F.filter(d["out"], lambda x: x.isNotNull()))).alias("out")))

    def scan_(all_: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / STRIDE).cast("int")), lambda k: F.slice(all_, k * STRIDE + 1, F.lit(STRIDE)))
        found = F.aggregate(parts, F.struct(start.alias("state"), nones.alias("out")), stride, lambda acc: F.flatten(acc["out"]))
        return F.when(F.size(all_) > 0, found).otherwise(none)

    return _held(items, scan_)


def _located(text: Column, pattern: str, found: Column, valid: Column, rank: int) -> Column:
    """Spans of the matches in ``found`` (all matches of ``pattern``), those with ``valid`` only."""
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"), valid.alias("ok"))
    sizes = F.transform(cut, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.coalesce(F.length(x["match"]), F.lit(0)).alias("match"),
                                                F.coalesce(x["ok"], F.lit(False)).alias("ok")))

    def step(at: Column, x: Column):
        begin = at + x["gap"]
        end = begin + x["match"]
        return end, F.when(x["ok"], F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))

    return _running(sizes, F.lit(0), step, SPAN)


def base_spans(text: Column) -> Column:
    """Spans of the three base patterns: leftmost, not overlapping within a kind."""
    none = F.array().cast(f"array<{SPAN}>")
    value = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= MIN_ASSIGN)
    assign = _located(text, ASSIGN, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)), value, 0)
    # a run that is long enough is one match of the bounded pattern, at the same place
    parts = [F.when(text.rlike(ASSIGN), assign).otherwise(none)]
    for rank, pattern in ((1, f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}+"), (2, f"[0-9a-f]{{{MIN_HEX},}}+")):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        parts.append(F.when(text.rlike(pattern), _located(text, pattern, found, F.transform(found, lambda m: F.lit(True)), rank)).otherwise(none))
    return F.concat(*parts)


#: Counts of a window: 5 bits each (windows hold 31 characters at most), so many to a word.
COUNT_BITS, PER_WORD = 5, 12
WORDS = -(-len(ALPHABET) // PER_WORD)
#: c * log2(c) in fixed-point numbers, so that adding and taking away leaves no rounding behind.
FIXED = 1 << 40
WEIGHTS = [round(c * log2(c) * FIXED) if c else 0 for c in range(1 << COUNT_BITS)]


def _entropy_span(c: Column, cls: CharClass) -> Column:
    """(first, end) of the windows of candidate ``c`` (array ``codes``) whose entropy reaches the class's threshold; null if none does.

    The state holds the counts by character, packed into a few words, and sum =
    Σ c·log2 c; a window of w characters has log2(w) - sum / w bits. A step adds
    one to the count of the character that enters and takes one from that of
    the character that leaves.
    """
    w, rises = cls.window, F.array(*[F.lit(b - a).cast("bigint") for a, b in zip(WEIGHTS, WEIGHTS[1:], strict=False)])
    most = int((log2(w) - cls.bits) * w * FIXED) + w  # w: what the rounding of the weights may add up to
    cell = "struct<word:int,place:int,unit:bigint>"
    cells = F.transform(c["codes"], lambda k: F.struct(F.floor((k - 1) / PER_WORD).cast("int").alias("word"), ((k - 1) % PER_WORD * COUNT_BITS).alias("place"),
                                                       F.call_function("shiftleft", F.lit(1).cast("bigint"), (k - 1) % PER_WORD * COUNT_BITS).alias("unit")))
    blank = F.array(*[F.lit(0).cast("bigint")] * WORDS)
    start = F.struct(F.lit(0).alias("n"), blank.alias("counts"), F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("end"))
    count = lambda words, x: F.call_function("shiftright", words[x["word"]], x["place"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def step(acc: Column, x: Column) -> Column:
        enters, leaves, n = x["enters"], x["leaves"], acc["n"]
        rise = rises[count(acc["counts"], enters)]
        change = F.when(leaves.isNull(), rise).when(leaves["unit"].eqNullSafe(enters["unit"]) & (leaves["word"] == enters["word"]), F.lit(0).cast("bigint")).otherwise(
            rise - rises[count(acc["counts"], leaves) - 1])
        counts = F.transform(acc["counts"], lambda v, k: v + F.when(k == enters["word"], enters["unit"]).otherwise(0) - F.when(k == leaves["word"], leaves["unit"]).otherwise(0))
        total = acc["sum"] + change
        high = (n >= w - 1) & (total <= most)
        return F.struct((n + 1).alias("n"), counts.alias("counts"), total.alias("sum"), F.when(high, F.coalesce(acc["first"], n - (w - 1))).otherwise(acc["first"]).alias("first"),
                        F.when(high, n + 1).otherwise(acc["end"]).alias("end"))

    def scanned(all_: Column) -> Column:
        late = F.slice(F.concat(F.array_repeat(F.lit(None).cast(cell), w), all_), F.lit(1), F.size(all_))
        moves = F.arrays_zip(all_.alias("enters"), late.alias("leaves"))
        return F.aggregate(moves, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["end"].alias("end")))

    return F.when(F.size(c["codes"]) >= w, _held(cells, scanned))


def _blanked(text: Column) -> Column:
    """The text with blanks for the parts that hold a placeholder: no window reaches into them, what stands beside them is judged alone."""
    zipped = F.arrays_zip(F.split(text, PART, -1).alias("gap"), F.regexp_extract_all(text, F.lit(PART), F.lit(0)).alias("part"))

    def shown(x: Column) -> Column:
        part = F.coalesce(x["part"], F.lit(""))
        return F.concat(x["gap"], F.when(part.rlike(PLACEHOLDER), F.repeat(F.lit(" "), F.length(part))).otherwise(part))

    return F.when(text.rlike(CANDIDATE) & text.rlike(PLACEHOLDER), F.array_join(F.transform(zipped, shown), "")).otherwise(text)


def entropy_spans(text: Column) -> Column:
    """Spans of high entropy inside the candidates that the allow-list doesn't suppress."""
    text = _blanked(text)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    suspect = F.transform(found, lambda m: ~(m.rlike(PLAIN_PARTS) | m.rlike(UUID)))
    places = _located(text, CANDIDATE, found, suspect, 0)
    strings = F.filter(F.arrays_zip(found.alias("s"), suspect.alias("ok")), lambda x: x["ok"])
    # held in the array before the scan, so that the letters are split and numbered once
    held = F.transform(F.arrays_zip(places.alias("p"), strings.alias("s")), lambda x: F.struct(
        x["p"]["start"].alias("start"), x["s"]["s"].rlike(CLASSES[0].pattern).alias("hex"),
        F.transform(F.split(x["s"]["s"], ""), lambda ch: F.instr(F.lit(ALPHABET), ch)).alias("codes")))

    def scanned(c: Column) -> Column:
        both = [(i, _entropy_span(c, cls)) for i, cls in enumerate(CLASSES)]
        span = F.when(c["hex"], both[0][1]).otherwise(both[1][1])
        return F.struct(c["start"].alias("start"), F.when(c["hex"], 3).otherwise(4).alias("rank"), span.alias("span"))

    kept = F.filter(F.transform(held, scanned), lambda x: x["span"]["first"].isNotNull())
    out = F.transform(kept, lambda x: F.struct((x["start"] + x["span"]["first"]).alias("start"), x["rank"].alias("rank"), (x["start"] + x["span"]["end"]).alias("end")))
    return F.when(text.rlike(CANDIDATE), out).otherwise(F.array().cast(f"array<{SPAN}>"))


def _beside(base: Column, extra: Column) -> Column:
    """The spans of ``extra`` that overlap none of ``base``: no base span before reaches into one, none behind begins inside."""
    both = F.array_sort(F.concat(base, extra))
    mine = "struct<span:" + SPAN + ",free:boolean>"

    def ahead(reach: Column, x: Column):
        return F.when(x["rank"] < 3, F.greatest(reach, x["end"])).otherwise(reach), F.struct(x.alias("span"), (reach <= x["start"]).alias("free"))

    def behind(begin: Column, x: Column):
        span = x["span"]
        return F.when(span["rank"] < 3, F.least(begin, span["start"])).otherwise(begin), F.when((span["rank"] >= 3) & x["free"] & (span["end"] <= begin), span)

    found = _running(F.reverse(_running(both, F.lit(0), ahead, mine)), F.lit((1 << 31) - 1), behind, SPAN)
    return F.when((F.size(base) > 0) & (F.size(extra) > 0), found).otherwise(extra)


def _free(name: str, columns: list[str]) -> str:
    """``name``, longer where the table has such a column (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, spans): every row with its secrets, sorted by start and kind; rank indexes ``KINDS``.

    Places are code points, end exclusive. High-entropy spans that overlap a
    base span are left out, base spans never. Null is the empty text, which has
    no spans. Rows and ids may repeat, ids may be null; other columns are
    ignored, whatever their names. An empty table gives no rows. The work is
    linear in a text and its matches, whatever their number.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # one-element explodes hold the results, which later expressions use several times
    held = named.select("id", "text", F.explode(F.array(F.struct(base_spans(F.col("text")).alias("base"), entropy_spans(F.col("text")).alias("extra")))).alias("x"))
    return held.select("id", "text", F.explode(F.array(F.array_sort(F.concat("x.base", _beside(F.col("x.base"), F.col("x.extra")))))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Characters of the pieces of a text that gaps are cut from: reaching a place inside a text costs its distance from the start.
PIECE = 256


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by ``mask`` (overlapping spans by one); texts without secrets, and nulls, stay as they are.

    All columns stay, whatever their names; rows and ids may repeat or be null.
    An empty table gives no rows. The work is linear in a text and its matches.
    """
    cols = docs.columns
    text, x = F.col(f"`{text_col}`"), _free("_x", cols)
    spans = F.array_sort(F.concat(f"{x}.base", f"{x}.extra"))
    held = docs.select(*[F.col(f"`{c}`") for c in cols], F.explode(F.array(F.struct(
        base_spans(F.coalesce(text, F.lit(""))).alias("base"), entropy_spans(F.coalesce(text, F.lit(""))).alias("extra")))).alias(x))

    def gap(at: Column, s: Column):
        """What stays before a span, unless it begins inside of those before."""
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.struct(at.alias("a"), s["start"].alias("b")))

    last = F.aggregate(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
    gaps = F.concat(_running(spans, F.lit(0), gap, "struct<a:int,b:int>"), F.array(F.struct(last.alias("a"), F.length(text).alias("b"))))

    def kept(pieces: Column, g: Column) -> Column:
        first, end = F.floor(g["a"] / PIECE).cast("int"), F.floor(g["b"] / PIECE).cast("int")
        piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
        within = F.substring(piece(first), g["a"] % PIECE + 1, g["b"] - g["a"])
        across = F.concat(F.substring(piece(first), g["a"] % PIECE + 1, F.lit(PIECE)), F.array_join(F.slice(pieces, first + 2, F.greatest(end - first - 1, F.lit(0))), ""),
                          F.substring(piece(end), F.lit(1), g["b"] % PIECE))
        return F.when(first == end, within).otherwise(across)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    masked = F.array_join(_held(pieces, lambda p: F.transform(gaps, lambda g: kept(p, g))), mask)
    new = F.when(F.size(spans) > 0, masked).otherwise(text)
    return held.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols])
