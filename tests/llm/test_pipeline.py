import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cratewise.llm.tables import table
from tests.llm.test_decontaminate import brute as benchmark_brute
from tests.llm.test_exact import brute as exact_brute
from tests.llm.test_jaccard import brute as class_brute

SF_DIR = "/root/testdata/sf0.001"
STAGE = dict(pipeline.STAGES)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="module")
def sample(spark):
    return table(spark, SF_DIR, "documents")


def test_stages_are_named_in_order():
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination",
        "mixing sources to target weights",
    ]


def test_all_stages_in_a_row(spark, sample):
    """Every stage against brute force on what its predecessor kept."""
    benchmark = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    docs = sample
    for name, stage in pipeline.STAGES[:-1]:
        before = rows_of(docs)
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        docs = pipeline._stored(kept)
        ids = {r[0] for r in rows_of(docs)}
        if name == "exact dedup":
            assert ids == {x[1] for x in exact_brute(before)}
        elif name == "n-gram Jaccard join":
            assert ids == {x[2] if x[2] is not None else int(x[0]) for x in class_brute(before)}
        elif name == "benchmark decontamination":
            assert ids == {int(x[0]) for x in benchmark_brute(before, benchmark) if not x[4]}
        else:
            from cratewise.llm.toxicity import toxicity

            scored = toxicity(sample, table(spark, SF_DIR, "labels"))
            assert ids == {r.doc_id for r in scored.where("predicted = 0").collect()}
    mixed = {r.doc_id: r for r in STAGE["mixing sources to target weights"](spark, docs, SF_DIR).collect()}
    assert set(mixed) == ids
    assert sum(r.taken for r in mixed.values()) == pytest.approx(
        1.5 * sum(r.size for r in mixed.values()), rel=0.01
    )
    again = {r.doc_id: r for r in pipeline.run(spark, SF_DIR).collect()}
    assert again == mixed


def test_stages_take_awkward_rows(spark, documents, awkward):
    """Nulls, repeated ids and rows, and columns with the operators' own names."""
    docs = documents(awkward)
    texts = lambda df: sorted(re.sub(r"\s", "", r[1] or "") for r in rows_of(df))
    exact = STAGE["exact dedup"](spark, docs, SF_DIR)
    assert exact.columns == docs.columns
    assert texts(exact) == sorted({x for x in texts(docs)})
    near = STAGE["n-gram Jaccard join"](spark, docs, SF_DIR)
    # Texts without words are linked with nothing: all three stay.
    assert texts(near).count("") == 3
    assert len(rows_of(near)) == len({x[2] for x in class_brute(
        [(i, *r[1:]) for i, r in enumerate(awkward)]
    )})
    clean = STAGE["benchmark decontamination"](spark, docs, SF_DIR)
    assert clean.columns == docs.columns and sorted(
        (tuple(r)[:4] for r in rows_of(clean)), key=str
    ) == sorted(awkward, key=str)
    # The labels of the sample tables say nothing of these texts; only the form is tested.
    calm = STAGE["toxicity"](spark, docs, SF_DIR)
    assert calm.columns == docs.columns and set(rows_of(calm)) <= set(rows_of(docs))
    mixed = STAGE["mixing sources to target weights"](spark, docs, SF_DIR)
    assert mixed.count() == len(awkward)


def test_rows_that_share_an_id_are_judged_one_by_one(spark, documents):
    rows = [(1, "a b c"), (1, "x y z"), (2, "abc"), (None, "x yz"), (None, "else")]
    kept = rows_of(STAGE["exact dedup"](spark, documents(rows), SF_DIR))
    assert sorted((str(r[0]), r[1]) for r in kept) == [
        ("1", "a b c"), ("1", "x y z"), ("None", "else")
    ]


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_stages_take_no_rows(spark, documents, name):
    docs = documents([])
    assert STAGE[name](spark, docs, SF_DIR).count() == 0


def test_the_session_folder_holds_what_lies_between(spark, sample):
    stored = pipeline._stored(sample.limit(3).withColumn("n", F.lit(1)))
    folder = spark.sparkContext.getCheckpointDir()
    assert all(folder.split(":", 1)[-1] in path for path in stored.inputFiles())


def test_rows_of_one_id_spread_over_tasks(spark, documents):
    """A third of all rows share an id, a third have none."""
    rows = [((7, None, i)[i % 3], f"text number {i}") for i in range(3000)]
    seen = []

    def dropped(texts):
        seen.append([r.doc_id for r in texts.collect()])
        return texts.where("text like '%5'")

    runs = []
    for partitions in (3, 5):
        docs = documents(rows, partitions=partitions)
        runs.append(sorted(map(str, rows_of(pipeline._kept(docs, dropped)))))
    assert runs[0] == runs[1] and len(runs[0]) == 2700
    # A number tells the task that gave it; no task holds more than its share of four.
    tasks = [n >> 33 for n in seen[0]]
    assert max(tasks.count(t) for t in set(tasks)) < 1200
