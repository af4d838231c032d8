import math
import re

import pytest
from pyspark.sql import functions as F

from cratewise.llm import mixing
from cratewise.llm.mixing import mix, running_sum


def sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]


def brute_targets(rows):
    """Fill by weight, cap, share out again, until none is above."""
    size = {}
    for row, n in zip(rows, sizes(rows)):
        size[row[3]] = size.get(row[3], 0) + n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        left = [s for s in order if s not in full]
        rest = total - sum(2 * size[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] > 2 * size[s]}
        if not above:
            return {**{s: 2.0 * size[s] for s in full}, **share}
        full |= above


@pytest.mark.parametrize("block_tokens", [3, 50, 4096])
def test_targets_and_taken_words(documents, awkward, block_tokens):
    found = mix(documents(awkward), block_tokens=block_tokens)
    want = brute_targets(awkward)
    rows = found.documents.collect()
    assert sorted((r.doc_id or 0, r.size) for r in rows) == sorted(
        (r[0] or 0, n) for r, n in zip(awkward, sizes(awkward))
    )
    taken = {}
    for r in rows:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, target in want.items():
        assert taken[source] == math.floor(target)


def test_every_needed_block_has_one_slot_and_slots_interleave(documents):
    rows = [(i, "w " * 50, "en", "abc"[i % 3]) for i in range(300)]
    found = mix(documents(rows), block_tokens=40)
    schedule = found.schedule.collect()
    needed = {r.source_no: r.blocks for r in found.sources.collect()}
    got = {}
    for r in schedule:
        got.setdefault(r.source_no, []).append(r.block)
    assert {s: sorted(b) for s, b in got.items()} == {s: list(range(n)) for s, n in needed.items()}
    assert len({r.slot for r in schedule}) == len(schedule)
    # Any stretch of the mix holds each source about by its share.
    ordered = [r.source_no for r in sorted(schedule, key=lambda r: r.slot)]
    total = len(ordered)
    for start in range(0, total - 100, 50):
        part = ordered[start : start + 100]
        for source, n in needed.items():
            assert abs(part.count(source) - 100 * n / total) <= 4


def test_reruns_agree_whatever_the_partitions(documents, awkward):
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    first = sorted(key(r) for r in mix(documents(awkward, 1)).documents.collect())
    again = sorted(key(r) for r in mix(documents(awkward, 5)).documents.collect())
    assert first == again


def test_hot_source_and_many_small_ones(documents, monkeypatch):
    monkeypatch.setattr(mixing, "chunk_rows", lambda rows: 7)
    rows = [(i, "w " * (i % 9), "en", "hot" if i % 3 else f"s{i}") for i in range(120)]
    want = brute_targets(rows)
    taken = {}
    for r in mix(documents(rows), block_tokens=4).documents.collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: math.floor(t + 1e-9) for s, t in want.items()}


def test_no_rows_and_no_words(documents):
    assert mix(documents([])).documents.count() == 0
    rows = mix(documents([(1, None), (2, " ")])).documents.collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


def test_running_sum_over_chunks(spark):
    df = spark.range(100).select(
        (F.col("id") % 2).alias("k"), F.expr("id div 10").alias("c"), "id"
    )
    rows = running_sum(df, ["k"], "c", [F.col("id")], F.col("id"), "s").collect()
    for r in rows:
        assert r.s == sum(x for x in range(r.id) if x % 2 == r.k)


def test_no_python_runs(documents, awkward, plan_of):
    plan = plan_of(mix(documents(awkward)).documents)
    assert "Python" not in plan and "Arrow" not in plan
