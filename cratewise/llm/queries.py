"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.align import aligned
from cratewise.llm.decontaminate import benchmark_hits, is_contaminated
from cratewise.llm.exact import exact_duplicates
from cratewise.llm.jaccard import jaccard_classes
from cratewise.llm.language import languages
from cratewise.llm.mixing import mix
from cratewise.llm import secrets as secret_rules
from cratewise.llm import pii
from cratewise.llm.phrases import collocations
from cratewise.llm.spans import as_text, count_of, of_kinds
from cratewise.llm.substrings import without_repeats
from cratewise.llm.tables import table
from cratewise.llm.toxicity import held_out, toxicity
from cratewise.llm.urls import url_verdicts
from cratewise.llm.vectors import near_vectors
from cratewise.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; the session gets the library's settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_url_filter(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))


@query
def op3_benchmark_hits(spark, sf_dir):
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


@query
def op4_ngram_jaccard(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("set_id")


def _span_digests(found: DataFrame, base: Column, kinds: list[str]) -> DataFrame:
    """doc_id, a count per base kind, the digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


@query
def op2_personal_data(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return _span_digests(found, F.col("base"), pii.KINDS)


@query
def op5_secret_scan(spark, sf_dir):
    found = secret_rules.secrets(table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secret_rules.BASE]
    return _span_digests(found, of_kinds(F.col("spans"), kinds), kinds)


@query
def op6_substring_dedup(spark, sf_dir):
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_toxicity(spark, sf_dir):
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op8_language(spark, sf_dir):
    found = languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op9_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("chars")


@query
def op10_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).documents.drop("source")


@query
def op11_tokenizer_alignment(spark, sf_dir):
    return aligned(table(spark, sf_dir, "documents"))


@query
def op12_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
