import random
import re
import tracemalloc

import pyarrow as pa
import pyspark
import pytest

from cratewise.llm import jaccard
from cratewise.llm.components import components
from cratewise.llm.jaccard import choose_boundary, jaccard_classes, overlap_needed, subset_sizes


def shingles(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(row[1]) for row in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted((str(r[0]), len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets)))


def result(docs, **options):
    found = jaccard_classes(docs, **options)
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found.collect())


def near_copies(seed, groups, copies, words, changes):
    """Groups of texts with a few changed, dropped or added words each."""
    random.seed(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, doc_id = [], 1000
    for _ in range(groups):
        base = random.choices(vocabulary, k=random.randint(*words))
        for _ in range(random.randint(*copies)):
            own = list(base)
            for _ in range(random.randint(*changes)):
                place = random.randrange(len(own) + 1)
                own[place : place + random.randint(0, 2)] = random.choices(vocabulary, k=random.randint(0, 2))
            rows.append((doc_id, " ".join(own)))
            doc_id += 1
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [0, 12])
def test_equals_brute_force(documents, awkward, small):
    rows = awkward + near_copies(1, 12, (1, 9), (20, 90), (0, 5))
    rows += near_copies(2, 30, (1, 4), (1, 16), (0, 2))
    rows = [(100_000 + i, text) if i % 7 == 0 else (d, text, *rest) for i, (d, text, *rest) in enumerate(rows)]
    assert result(documents(rows), small=small) == brute(rows)


def test_a_large_group_of_near_copies(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 16)
    rows = near_copies(3, 2, (70, 90), (80, 90), (1, 5))
    want = brute(rows)
    assert 2 < len({x[2] for x in want}) < len(rows)
    assert result(documents(rows)) == want


def test_small_sets_by_subsets_alone(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda sizes, small: small)
    rows = near_copies(4, 40, (1, 6), (1, 14), (0, 1))
    assert result(documents(rows)) == brute(rows)


def short_copies(groups, alone):
    """Texts of seven and eight words, alike in groups of three, and others like none."""
    rows = []
    for g in range(groups):
        words = [f"g{g}w{i}" for i in range(8)]
        for own in (words, words[:7], words[1:]):
            rows.append((len(rows), " ".join(own)))
    return rows + [(len(rows) + i, " ".join(f"a{i}w{j}" for j in range(7 + i % 2))) for i in range(alone)]


@pytest.mark.parametrize("groups, alone, low, high", [(60, 5, 3, 12), (3, 400, 0, 0)])
def test_the_boundary_follows_the_table(documents, monkeypatch, groups, alone, low, high):
    """Many short texts alike are enumerated, a few among many are scanned."""
    chosen = []
    real = jaccard.choose_boundary
    monkeypatch.setattr(
        jaccard, "choose_boundary", lambda *x: chosen.append(real(*x)) or chosen[-1]
    )
    rows = short_copies(groups, alone) + [
        (10_000 + i, text) for i, (_, text) in enumerate(near_copies(5, 6, (2, 5), (20, 40), (0, 2)))
    ]
    assert result(documents(rows)) == brute(rows)
    assert low <= chosen[0] <= high


def test_links_at_the_limit(documents):
    # 11 words have 7 shingles; 10 of them have 6, 9 have 5 ...: 6 / 7 and 5 / 7.
    text = [f"w{i}" for i in range(11)]
    rows = [(1, " ".join(text)), (2, " ".join(text[:10])), (3, " ".join(text[:7]))]
    assert [x[2] for x in result(documents(rows))] == [1, 1, 3]
    four = [(1, "a b c d e f g h"), (2, "a b c d e f g")]  # 3 of 4 shingles
    assert [x[2] for x in result(documents(four))] == [1, 1]


def test_no_rows(documents):
    assert jaccard_classes(documents([])).count() == 0


def test_boundary_weighs_subsets_against_entries():
    assert choose_boundary({}, 12) == 0
    assert choose_boundary({3: (10, 1)}, 12) == 0
    assert choose_boundary({3: (10, 10_000), 9: (10_000, 20)}, 12) == 3
    for n in range(1, 13):
        for m in range(1, 13):
            size = overlap_needed(n, m)
            if size <= min(n, m):
                assert size in subset_sizes(n, 12) and size in subset_sizes(m, 12)


def test_components(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(60)]
    edges = chain + [(100, 101), (101, 100), (105, 105), (200, 201), (202, 201), (203, 202)]
    random.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert roots == {
        **{i: 0 for i in range(61)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 204)}
    }
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def most_memory(run, batch):
    """Bytes that a task's function holds at once, for every byte of text."""
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1] / batch.column("text").nbytes
    finally:
        tracemalloc.stop()


def test_memory_of_a_chunk(monkeypatch):
    """Arrays of a chunk's shingles are not all held until its rows are made."""

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    random.seed(8)
    texts = [" ".join(f"{random.getrandbits(22):x}" for _ in range(400)) for _ in range(1500)]
    batch = pa.table({"doc_id": list(range(1500)), "text": texts}).combine_chunks().to_batches()[0]
    assert most_memory(jaccard._entries(8, 5), batch) < 11
    assert most_memory(jaccard._describe(12, 5), batch) < 5
