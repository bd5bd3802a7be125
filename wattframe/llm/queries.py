"""The thin queries over the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import ann, bpe, chat, clusters, decontaminate, html_extract, licenses, minhash, negatives, oracle, quality, repetition, secrets, token_counts
from wattframe.llm.common import table

#: Folder of the public tokenizers' vocabulary files; a parameter of whoever runs the queries elsewhere.
TOKENIZERS = "/opt/tokenizers"


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(licenses.find_licenses(table(spark, sf_dir, "documents")))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    columns = ["conv_id", "turn", "role", "text"]
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(more)
    return chat.read_back(chat.format_turns(turns, chat.text_part(F.col("text"))))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))).drop("spans")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_edited(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", token_counts.usual_edits(F.col("text")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.digests(clusters.cluster(table(spark, sf_dir, "embeddings")))


def op13_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.digests(repetition.judge(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
