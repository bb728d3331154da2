"""A corpus from raw documents to tokens.

Five stages, each written as Parquet and read again by the next: documents that the quality
classifier rejects go; of equal texts one stays; of near copies one stays; sources are mixed to
their target weights (documents repeat as often as the mix takes them); what is left is encoded.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adit.llm import bpe, exact_dedup, mixing, preference, simhash
from adit.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of the training folds."""
    model = preference.learn(docs, preference.training_labels(table(spark, sf_dir, "labels")))
    return preference.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near copies the document with the smallest id. Texts link by their SimHashes, as in the
    operator's query, and where their five-word shingles are alike by 0.8."""
    return simhash.keep_one_of_each(docs, alike=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every row."""
    return bpe.encode_documents(docs, bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("mix sources", mix), ("encode", encode)]

#: Fingerprints and the encoding are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. What lies between them goes to the shared folder; a stage's
    input is removed once its output is written, so that only the last one's input stays."""
    docs, here = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{here}/{k}")
            docs = spark.read.parquet(f"{here}/{k}")
        if 0 < k < len(STAGES) - 1:
            gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{here}/{k - 1}")
            gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return docs
