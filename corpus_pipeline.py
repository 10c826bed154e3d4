"""A training corpus from raw documents, stage by stage.

Each stage takes all documents that the one before kept, as (spark, docs,
sf_dir), and returns the columns of ``documents``; the last returns ids.
Rows with a null doc_id pass the stages that compare documents.
"""

from __future__ import annotations

import functools
import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import decontamination, minhash_dedup, nb_svm, piece_codec, suffix_dedup
from eddy.llm.graph import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Bytes of texts that go to a Python worker at once; the stages share the workers.
BATCH_BYTES = 8 << 20


def _bounded(stage):
    """The stage, with its Arrow batches bounded by bytes and not by rows alone."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)
    return run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = nb_svm.train(docs, _table(spark, sf_dir, "labels"))
    return nb_svm.keep_good(docs.select(COLUMNS), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    classes = minhash_dedup.near_duplicates(docs)
    copies = classes.where("not kept").select("doc_id").distinct()
    return docs.select(COLUMNS).join(copies, "doc_id", "left_anti").select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes that an earlier document has.

    A document of which no word is left goes.
    """
    cut = suffix_dedup.remove_repeats(docs, keep="kept_text", carry=("lang", "source"))
    left = cut.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                       F.length("kept_text").cast("bigint").alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    pairs = decontamination.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return docs.select(COLUMNS).join(pairs.select("doc_id").distinct(), "doc_id", "left_anti").select(COLUMNS)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, checked against the sentencepiece library and by decoding."""
    return piece_codec.encode_and_check(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", _bounded(quality)),
    ("MinHash near-dedup", _bounded(near_duplicates)),
    ("suffix-array dedup", _bounded(repeated_passages)),
    ("benchmark decontamination", _bounded(benchmark_leaks)),
    ("SentencePiece encoding and decoding", _bounded(sentencepiece_ids)),
]

#: The stages have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs
