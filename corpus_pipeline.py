"""Clean a corpus and pack it for training, stage by stage.

Each stage takes the documents that the stage before it kept and has columns doc_id, text, lang, source,
n_chars; the last one returns packed pieces. Between stages the documents are written to the shared folder
and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import minhash, packing, secrets, substring, toxicity
from tablewright.session import materialize, ship_package


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents more probably toxic than not go; the model learns from the labelled ones."""
    ship_package(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("NOT is_toxic").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of least doc_id stays."""
    ship_package(spark)
    return minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that stand earlier in the corpus are cut out of the text."""
    ship_package(spark)
    return _counted(substring.remove_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    ship_package(spark)
    return _counted(secrets.redact(docs, secrets.train(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4096."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

# Trained models, similarity classes and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, label=name)
    return docs
