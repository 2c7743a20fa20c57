"""From raw documents to packed training sequences, in five stages.

Each stage gets the rows that the one before kept, as a stored table, and returns rows in the columns
of `documents`; the last returns the packed pieces. A stage only takes out what it decides against:
whole documents (toxic ones, and all but one of each group of near copies), or words of them (repeated
passages, benchmark phrases), with `n_chars` kept right. Documents without findings are unchanged, and
one that loses all its words stays, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.common import read
from tallyhouse.llm.decontaminate import decontaminate
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.passages import drop_repeated_words
from tallyhouse.llm.simhash import near_dedup
from tallyhouse.llm.toxicity import drop_toxic
from tallyhouse.session import drop_stored, scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_words(docs, chars="n_chars")


def benchmark_phrases(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), chars="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_phrases),
    ("packing", packing),
]

#: Fitted weights, groups by Hamming distance and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # the stored input of the stage that has just been stored itself
            drop_stored(spark, before)
        before = path
    return docs
