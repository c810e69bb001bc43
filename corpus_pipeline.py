"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, benchmark passages
go with their documents, secrets are masked, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and reread as the next one's docs. Learning (stage 1) uses the labels
table; stage 3 the benchmark table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import decontam, pieces, secrets, simhash, toxicity
from hearth.llm.common import table, written
from hearth.llm.queries import tokenizer_path

# No stage but the third can be said in SQL, so the whole has none; tests/llm compares it with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity operator rejects go, others stay unchanged. A null or empty text has no clause and is scored
    by the intercept alone; equal rows share one decision; an empty table gives no rows; other columns pass, whatever their names.
    """
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, of the smallest id. Null and empty texts have no words and form one group;
    repeated rows are copies; rows with a null id stay; an empty table gives no rows; other columns pass, whatever their names.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share a window with any benchmark item go. Null and empty texts have no words and stay; each row is judged
    by its own text, however long; an empty table or benchmark is allowed; other columns pass, whatever their names.
    """
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; spans of secrets in its text are replaced, and ``n_chars``, if there, follows the text. Null stays
    null; texts of any length take time linear in them; an empty table gives no rows; other columns pass.
    """
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit, with begin and end) of every document, and digests.

    One row for each input row; null is the empty text (begin and end only); an empty table gives no rows; other columns go.
    """
    found = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))
    return found.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
