"""A corpus from raw documents to packed sequences, one stage after the other.

Every stage but the last takes and returns rows with the columns of
``documents``; each is written as Parquet in the shared folder and read again
as the next one's input, so a lost executor costs at most a stage's tasks.

Toxicity drops documents scored at or above the operator's threshold (rows
without a text are scored like empty ones).  Exact dedup and the Jaccard join
keep one document per group.  Suffix-array dedup removes bytes that smaller ids
hold too; ``n_chars`` follows the text.  Packing returns the pieces.  When a
stage's output is written, the tables it was made from are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlmill.llm import exact_dedup, jaccard, packing, suffix, toxicity
from sqlmill.llm.common import table
from sqlmill.session import drop_scratch, scratch_path, scratch_tables


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.teaches()))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def repeated_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_documents_go),
    ("exact_dedup", exact_copies_go),
    ("ngram_jaccard", near_copies_go),
    ("suffix_array", repeated_passages_go),
    ("packing", packed),
]

#: The toxicity model, the tokenizer and the packing order are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = scratch_tables(spark)
    for name, stage in STAGES:
        path = scratch_path(spark, f"llm-pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        drop_scratch(spark, keep=(*before, path))
        # the driver's heap shrinks again, and Spark's cleaner deletes the stage's shuffles and broadcasts
        spark._jvm.System.gc()
    return docs
