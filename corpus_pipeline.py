"""Corpus preparation: language ID, exact dedup, near dedup, secret scan, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read as the next one's docs. All but the last return the columns of documents.
Null, empty and very long texts, repeated rows and empty tables follow the operators' docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import exact, language, near, packing, secrets
from quillstone.llm.common import join_small, written

#: A language is rejected below this probability; a text without letters has none.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model fitted on the labelled ones; lang holds the label as it was.

    Without any labelled document there is no model to reject by, and all documents stay.
    """
    model = language.fit(docs)
    if model is None:
        return docs
    found = language.identify(docs, model, into=("__lang", "__score"))
    return found.filter((F.col("__lang") != language.UND) & (F.col("__score") >= LEAST_SCORE)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, on five-word shingles at a similarity of 0.8.

    Rows are numbered and dropped by number, so that rows which share an identifier, or have none, are judged apart.
    """
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = near.near_duplicates(rows, id_col="__row").join(rows.select("__row", "doc_id"), "__row")
    found = written(found.select("__row", F.when(F.col("n_shingles") == 0, F.col("__row")).otherwise(F.col("component_id")).alias("group"), "doc_id"), "near")
    stays = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"].alias("__row"))
    gone = written(found.select("__row").join(stays.select("__row"), "__row", "left_anti"), "gone")
    return join_small(rows, gone, ["__row"], "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; n_chars follows the text."""
    clean = secrets.redact(docs, secrets.fitted(spark))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids, with the ids."""
    import public_tokenizers as P

    return packing.pack(docs, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packed)]
#: Trained models and the near-duplicate join have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
