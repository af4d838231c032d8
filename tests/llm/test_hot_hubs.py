"""Hubs that hold a third of all edges, in the joins that find components and overlaps."""

import pytest
from pyspark.sql import functions as F

from cratewise.llm import jaccard
from cratewise.llm.components import _large_star, _small_star
from tests.test_hot_keys import no_broadcast  # noqa: F401

EDGES = 60_000


def edges(spark, hub):
    """A third of all edges at one node, the others in pairs."""
    ids = F.col("id") + 10
    other = F.when(F.col("id") % 3 == 0, F.lit(hub)).otherwise(ids + 1_000_000)
    return spark.range(0, EDGES, 1, 8).select(ids.alias("a"), other.alias("b"))


@pytest.mark.parametrize("step, hub", [(_large_star, 0), (_small_star, 10_000_000)])
def test_spark_cuts_the_edges_of_a_hub(spark, no_broadcast, plan_of, step, hub):  # noqa: F811
    df = step(edges(spark, hub))
    df.collect()
    assert "skew=true" in plan_of(df)


def test_spark_cuts_the_postings_of_a_token(spark, no_broadcast, plan_of, monkeypatch):  # noqa: F811
    """A third of all sets share a token; their list meets its hub in pieces."""
    seen = []

    def overlaps(pairs, found):
        seen.append(pairs)
        return pairs.limit(0).selectExpr("a", "b", *[f"a as {x}" for x in ("a_n", "b_n", "a_s", "b_s", "overlap")])

    monkeypatch.setattr(jaccard, "overlaps", overlaps)
    found = spark.range(0, EDGES, 1, 8).select(
        F.col("id").alias("set_id"),
        F.lit(20).alias("n").cast("bigint"),
        F.lit(18).alias("s").cast("bigint"),
        F.array(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.floor(F.col("id") / 4))).alias("prefix"),
    )
    jaccard.heavy_links(found, 0)
    seen[0].collect()
    assert "skew=true" in plan_of(seen[0])
