"""A cleaned and mixed corpus from ``documents``, stage by stage.

Every stage works on all that its predecessor kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.decontaminate import without_contaminated
from cratewise.llm.exact import exact_duplicates
from cratewise.llm.jaccard import jaccard_classes
from cratewise.llm.mixing import mix
from cratewise.llm.tables import partitions, table
from cratewise.llm.toxicity import without_toxic
from cratewise.session import prepare, shared_folder


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _kept(docs: DataFrame, dropped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``docs`` whose id is not among the ids that ``dropped`` gives for them.

    Where ids repeat or are missing, rows are numbered in the order of their ids (missing ones
    last) and of digests of what they hold, and these numbers stand in for the ids. So rows of
    one id spread over tasks, and reruns agree.
    """
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if counts.where("rows > 1 or doc_id is null").isEmpty():
        return docs.join(dropped(docs).select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    by = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.xxhash64("source", "lang")]
    # With a number given, Spark does not merge small ranges into one task.
    ranges = partitions(docs.sparkSession)
    sorted_rows = docs.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    numbered = _stored(
        sorted_rows.select(
            F.monotonically_increasing_id().alias("number"), F.struct(*docs.columns).alias("row")
        )
    )
    texts = numbered.select(F.col("number").alias("doc_id"), "row.text")
    gone = dropped(texts).select(F.col("doc_id").alias("number"))
    return numbered.join(gone, "number", "left_anti").select("row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return _kept(docs, lambda x: exact_duplicates(x).where("not kept"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every class of alike texts."""
    return _kept(docs, lambda x: jaccard_classes(x).where("doc_id != component_id"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold the benchmark's passages."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document left."""
    return mix(docs).documents


STAGES = [
    ("toxicity", not_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

# A trained classifier decides the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = _stored(stage(spark, docs, sf_dir))
    return docs
