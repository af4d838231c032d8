from cratewise import fixtures
from cratewise.plans.models import Models

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def test_documents_are_made_in_tasks_of_bounded_rows(spark, rows, as_of, tmp_path, monkeypatch):
    """One file of one task's size; keys may repeat or be missing."""
    parts = [(i % 190 if i % 50 else None, f"n{i}", "B", "T", i % 7, 1.0) for i in range(200)]
    rows(parts, PART).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    whole = fixtures.landing(spark, str(tmp_path))["recording_payloads"]
    expected = sorted(map(str, whole.collect()))
    monkeypatch.setitem(fixtures.DOCUMENT_ROWS, "recording_payloads", 10)
    landing = fixtures.landing(spark, str(tmp_path))
    payloads = landing["recording_payloads"]
    assert sorted(map(str, payloads.collect())) == expected
    # Two snapshots are made in 21 tasks each, about ten rows a task.
    sizes = [len(x) for x in payloads.rdd.glom().collect()]
    assert len(sizes) == 42 and max(sizes) < 30
    latest = Models(landing, as_of).recordings
    assert sorted(map(str, latest.collect())) == sorted(
        map(str, Models({"recording_payloads": whole}, as_of).recordings.collect())
    )
