"""A corpus pipeline: toxic documents go, then copies, near copies and leaked
benchmark passages; what stays is packed into token sequences.

Each stage takes ``(spark, docs, sf_dir)`` and is written as Parquet and read
again before the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dossierflow.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from dossierflow.llm.queries import VOCABULARY, held_out, table
from dossierflow.session import new_scratch_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(spark, docs, labels.where(~held_out(labels.doc_id)))
    return toxicity.drop_toxic(spark, docs, model)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(exact_dedup.new_index(spark), docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(spark, docs, shingle=3, radius=2)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path(VOCABULARY), size=1024)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("simhash_near_dedup", remove_near_copies),
    ("decontamination", remove_leaks),
    ("packing", pack),
]

#: The learned score, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
