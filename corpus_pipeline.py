"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and reread as the next
stage's docs. All but the last return the columns of documents; the last returns the packed pieces.

Cases, of every stage: a null text counts as empty and is kept as it is; rows that repeat a doc_id stay or go together in near_duplicates, else each row is
judged on its own text; a null doc_id is a row like any other and never a duplicate of one that has an id; texts of any length are read whole; an empty table gives an
empty result; further columns pass through under any name, up to packing. Ties are stated by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm.common import shared_folder
from vellum.llm.decontaminate import drop_contaminated
from vellum.llm.near import one_of_each_group
from vellum.llm.packing import pack_documents
from vellum.llm.pii import mask_pii
from vellum.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null labels count for nothing; without usable labels all stay; a score of 0.5 stays."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id; links are pairs whose SimHash fingerprints of
    five-word shingles agree on 0.8 of the bits or more. Texts without a word are one group."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Items without a word have none; an item of fewer words than a window is one."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and n_chars, where there is one, set to the new length."""
    return mask_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens; an empty text is one piece of the end id."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The classifier's weights, fingerprints and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again. A stage's rows are deleted
    once the next stage has written its own; the caller deletes the last ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return docs
