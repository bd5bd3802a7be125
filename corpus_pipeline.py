"""A training-corpus pipeline: five operators in a row, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared
folder and reads it again as the next stage's docs. All stages but the last return the columns of documents. Rows with
a null doc_id are never joined to others and stay unless a decision on their own text drops them. Rows that repeat a
doc_id are one document to near-dedup, and stay or go together there, equal ones too; quality and contamination are
decided for each row on its own text. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import bpe, decontaminate, minhash, quality, queries, secrets
from wattframe.llm.common import discard, settle, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.3 go."""
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, trees)
    return scored.filter(F.col(scored.columns[-1]) >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies stays."""
    gone = settle(minhash.near_duplicates(docs).filter("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words benchmark windows cover a twentieth or more go; the others stay as they are."""
    found = decontaminate.scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~decontaminate.is_contaminated(*found.columns[-4:-2])).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; n_chars follows where a text changed."""
    clean = secrets.redact(docs.withColumn("__before", F.length("text")))
    changed = F.length("text") != F.col("__before")
    return clean.select(*[F.when(changed, F.length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, counts and digests of every remaining text."""
    return bpe.encode_documents(docs, f"{queries.TOKENIZERS}/word_bpe_49k.json", keep_ids=True).drop("decoded")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret scan", redact_secrets),
    ("bpe encoding", encode),
]

#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if hasattr(docs, "settled_path"):
            discard(docs)
        docs = done
    return docs
