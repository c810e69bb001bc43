"""Token counts with a digest cache.

The cache is a Parquet table (digest, n_tokens) below a folder named after the
digest of the tokenizer file. Contents are normalised where the tokenizer can't
tell (runs of ASCII white space, if the file is seen to drop it), digested, and joined to the cache; one text of
each distinct miss is encoded and the new counts are appended.

A miss is encoded by words: the tokenizer's own pattern cuts what stands between
white space, and the distinct words go to the library's model once per worker. Texts with characters whose
treatment might differ between libraries go to the tokenizer whole.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from hearth.llm.common import arrow, map_texts, written
from hearth.session import ensure_checkpoint_dir

LIMIT = 2048
CACHE_WORDS = 300_000
#: The pre-tokenizer's pattern; fixed value of the vocabulary file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space, ASCII and Latin letters up to U+017F, whose classes, lower case and composition all libraries share.
PLAIN = regex.compile("[\\x09-\\x0D\\x20-\\x7E\\xA1-\\u012F\\u0131-\\u017F]*")


class Counter:
    """Counts tokens with one tokenizer file."""

    def __init__(self, path: str):
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(WORDS)
        self.spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.by_word = self._splits_alike()

    def _splits_alike(self) -> bool:
        """Whether this file cuts and counts a probe as the word path does; other files are always given whole texts."""
        probe = "it's a ünïté of 12 \t tests, isn't it?! we'll see... 'dogs' ¡ok!"
        config, pre = self.lib.to_str(), self.lib.pre_tokenizer
        if pre is None or '"Lowercase"' not in config or WORDS.replace("\\", "\\\\") not in config or '"ByteLevel"' not in config:
            return False
        cut = [probe[a:b] for _, (a, b) in pre.pre_tokenize_str(probe)]
        return cut == self.pattern.findall(probe) and self._by_chunks(probe) == len(self.lib.encode(probe, add_special_tokens=False))

    def drops_space(self) -> bool:
        """Whether this file is seen to drop ASCII white space, so that its runs, and its kinds, make no token and no difference."""
        if not self.by_word or any(regex.search(r"\s", s) for s in self.special):
            return False
        size = lambda text: len(self.lib.encode(text, add_special_tokens=False))
        base = size("it's one, two 3")
        return all(size(f"{a}it's{b}one,{a}two{b}3{b}") == base for a in "\t\n\v\f\r " for b in (a, a * 2, a + " ", " " + a + "\n"))

    def _word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.words[word] = len(self.model.tokenize(word if word.isascii() else self.spell(word)[0][0]))
        return n

    def _by_chunks(self, text: str) -> int:
        """Sum over what stands between white space; no word of the pattern holds any."""
        chunks = text.lower().split()
        for cache in (self.chunks, self.words):
            if len(cache) > CACHE_WORDS:
                cache.clear()
        known = self.chunks
        for chunk in set(chunks):
            if chunk not in known:
                known[chunk] = sum(map(self._word, self.pattern.findall(chunk)))
        return sum(map(known.__getitem__, chunks))

    def count(self, text: str) -> int:
        if not self.by_word or not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return len(self.lib.encode_batch_fast([text], add_special_tokens=False)[0])
        return self._by_chunks(text)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def content_digest(text: Column, fold: bool = True) -> Column:
    """Digest of the content as the tokenizer sees it: with ``fold``, runs of ASCII white space count as one space; else the text as it is, marked so."""
    text = F.coalesce(text, F.lit(""))
    if not fold:
        return F.concat(F.lit("raw:"), F.sha2(text, 256))
    return F.sha2(F.trim(F.regexp_replace(text, r"[\x09-\x0D\x20]+", " ")), 256)


def version(path: str) -> str:
    """Digest of the tokenizer file and of the library's release."""
    import hashlib

    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + f.read()).hexdigest()


def count_tokens(docs: DataFrame, tokenizer: str, cache_dir: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens), one row for each input row.

    ``tokenizer`` is a path that the driver and every executor have;
    ``cache_dir`` a shared folder that keeps counts between calls (a new one
    below the checkpoint folder if None). Null counts as the empty text: no
    bytes, no tokens. Rows may repeat, and ids may repeat or be null.
    """
    spark = docs.sparkSession
    root = (cache_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/token-cache-{uuid.uuid4().hex}").rstrip("/")
    folder = f"{root}/{version(tokenizer)}"
    schema = "digest string, n_tokens bigint"
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(folder)
    known = spark.read.schema(schema).parquet(folder)

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    digest = content_digest(F.col("text"), counter(tokenizer).drops_space())
    rows = written(named.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), digest.alias("digest")), "token-rows")
    stored = known.select("digest").distinct()
    # one text for each content: copies are combined before they are dealt out
    misses = (named.select(digest.alias("digest"), "text").groupBy("digest").agg(F.first("text").alias("text"))
              .join(stored, "digest", "left_anti"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        lib = counter(tokenizer)
        return arrow(digest=batch.column(0), n_tokens=pa.array([lib.count(t or "") for t in batch.column(1).to_pylist()], pa.int64()))

    map_texts(misses.select("digest", "text"), kernel, schema).write.mode("append").parquet(folder)
    counts = spark.read.schema(schema).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = written(counts, "token-counts")  # a join of two plain exchanges can split the digest of a frequent text
    return rows.join(counts, "digest").select("id", "n_bytes", "n_tokens")
