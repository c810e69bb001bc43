"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import decontam, divergence, embeddings, pieces, quality, quotes, runs, secrets, simhash, suffixes, tokencount, topk, toxicity
from hearth.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and places of the base patterns, and all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    return found.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior and score of every document."""
    found = quality.classify(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "votes", F.round("posterior", 6).alias("posterior"), F.round("score", 6).alias("score"),
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM low LEFT JOIN n USING (vec_id)
"""


@query("op4_embedding_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, spans and decoded text of every document, as digests."""
    found = pieces.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        F.sha2("spans", 256).alias("spans_sha256"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, from a cache that this call begins and fills."""
    found = tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > tokencount.LIMIT).alias("over_limit"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside strings of 400 bytes that occur elsewhere too, and what remains."""
    found = suffixes.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["b"] - x["a"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                        F.coalesce(F.sha2("kept", 256), "text_sha256").alias("kept_sha256"))


OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, k FROM places JOIN wins USING (k, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark passages."""
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.contamination(found).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r'''
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations),
told AS (
  SELECT conv_id, turn, len(marks) - len(replace(marks, '>', '')) AS level,
         trim(regexp_replace(lower(regexp_replace(line, '^([ 	]*>)+', '')), '\s+', ' ', 'g')) AS body
  FROM (SELECT conv_id, turn, line, regexp_extract(line, '^([ 	]*>)+') AS marks
        FROM (SELECT conv_id, turn, unnest(ls) AS line FROM base WHERE conv_id IS NOT NULL AND turn IS NOT NULL))),
lines AS (SELECT * FROM told WHERE regexp_matches(body, '[\p{L}\p{N}]')),
origin AS (SELECT conv_id, body, min(turn) AS source FROM lines WHERE level = 0 GROUP BY ALL),
linked AS (SELECT l.conv_id, l.turn, l.level, CASE WHEN o.source < l.turn THEN o.source END AS source
           FROM lines l LEFT JOIN origin o ON l.conv_id = o.conv_id AND l.body = o.body WHERE l.level > 0),
votes AS (SELECT conv_id, turn, level, source, count(*) AS n FROM linked GROUP BY ALL),
best AS (SELECT conv_id, turn, source AS parent FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) AS k
                                                      FROM votes WHERE source IS NOT NULL) WHERE k = 1),
sums AS (SELECT conv_id, turn, sum(n) AS n_quoted, max(level) AS max_level FROM votes GROUP BY ALL),
chain AS (SELECT conv_id, turn, parent AS thread, 1 AS depth FROM best
          UNION ALL SELECT c.conv_id, c.turn, b.parent, c.depth + 1 FROM chain c JOIN best b ON c.conv_id = b.conv_id AND c.thread = b.turn),
place AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM chain GROUP BY ALL),
own AS (SELECT conv_id, turn, role, CASE WHEN NOT regexp_matches(t, '(?m)^[ 	]*>') THEN t ELSE
          trim(regexp_replace(array_to_string(list_filter(ls, lambda x, i: NOT regexp_matches(x, '^[ 	]*>') AND NOT
            (regexp_matches(x, '^[^>]*\b(wrote|writes|schrieb|a écrit|escribió):[ 	]*$') AND regexp_matches(coalesce(ls[i + 1], ''), '^[ 	]*>'))), chr(10)),
            '\n{3,}', chr(10) || chr(10), 'g'), chr(10) || ' ' || chr(9)) END AS text FROM base)
SELECT o.conv_id, o.turn, o.role, b.parent AS parent_turn, coalesce(p.thread, o.turn) AS thread_turn, coalesce(p.depth, 0) AS depth,
       CAST(coalesce(s.n_quoted, 0) AS BIGINT) AS n_quoted, coalesce(s.max_level, 0) AS max_level, o.text,
       '<|' || o.role || '|>' || chr(10) || o.text || chr(10) AS rendered
FROM own o LEFT JOIN best b ON o.conv_id = b.conv_id AND o.turn = b.turn LEFT JOIN sums s ON o.conv_id = s.conv_id AND o.turn = s.turn
LEFT JOIN place p ON o.conv_id = p.conv_id AND o.turn = p.turn
'''


@query("op9_quote_linking", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its parent, thread and text without quotations; ordered by (conv_id, thread, turn) it is the formatted chat."""
    found = quotes.link_conversations(table(spark, sf_dir, "conversations"))
    return found.select(F.col("conv").alias("conv_id"), "turn", "role", F.col("parent").alias("parent_turn"), F.col("thread").alias("thread_turn"),
                        "depth", "n_quoted", "max_level", "text", "rendered")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM met) WHERE rank <= 5
"""


@query("op11_topk", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest inner products of every query vector."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op12_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, the longest one, and digests of all runs and of the text without repetitions."""
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=runs.repeat_tail)
    return found.select(F.col("id").alias("doc_id"), "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
told AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS in_lang FROM told GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS n FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS c FROM told SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
cells AS (SELECT lang, source, term, in_lang, coalesce(c, 0) AS c, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2)) // (t.n + 2 * v) AS p,
                 1 + (CAST(1000000000 AS HUGEINT) * (in_lang + 2)) // (langs.n + 2 * v) AS whole
          FROM totals t JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - whole) * (p - whole)) // (p + whole) FROM cells WHERE c > 0 AND p > whole)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) WHERE part = 'pair' OR rank <= 10
"""


@query("op13_divergence", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms that mark it."""
    return divergence.audit(table(spark, sf_dir, "documents"))
