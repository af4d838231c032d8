import random
import re

import pytest

from cratewise.llm.decontaminate import benchmark_hits, is_contaminated, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items):
    windows = set()
    for item_id, text in items:
        own = words(text)
        for i in range(max(len(own) - 13, 0) + 1):
            if own and item_id is not None:
                windows.add((str(item_id), tuple(own[i : i + 13])))
    out = []
    for doc in docs:
        own, hit, found = words(doc[1]), set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((str(doc[0]), len(own), len(hit), sorted(found), bad))
    return sorted(out)


def result(docs, items, **options):
    found = benchmark_hits(docs, items, **options).withColumn("bad", is_contaminated())
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids), r.bad) for r in found.collect()
    )


@pytest.fixture
def case(awkward):
    random.seed(11)
    vocabulary = ["ab", "Ba", "c9", "é", "dd", "Élan", "x"]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, text(random.randint(1, 40))) for i in range(25)]
    items += [(3, items[4][1]), (30, None), (31, " .! "), (None, text(20)), (32, items[0][1])]
    items += [(40, awkward[10][1]), (41, " ".join(awkward[5][1].split()[500:600]))]
    docs = list(awkward)
    for i in range(20):
        item = items[random.randrange(25)][1]
        docs.append((100 + i, f"{text(9)} {item.upper().replace(' ', '-- ')} {text(random.randint(0, 300))}"))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000])
def test_equals_brute_force(spark, documents, case, block_bytes):
    docs, items = case
    table = spark.createDataFrame([(*x, 5) for x in items], "item_id bigint, text string, spans int")
    got = result(documents(docs), table, block_bytes=block_bytes)
    assert got == brute(docs, items)


def test_spans_tell_the_hit_words(spark, documents):
    passage = " ".join(f"w{i}" for i in range(15))
    table = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    docs = documents([(1, f"a b {passage} c"), (2, f"{passage[:-4]}")])
    rows = {r.doc_id: r for r in benchmark_hits(docs, table).collect()}
    assert rows[1].spans == [2, 17]
    # The last word is missing: one window of the two is left.
    assert rows[2].n_hit == 14 - 0 and rows[2].spans == [0, 14]


def test_one_word_off_is_no_hit(spark, documents):
    passage = [f"w{i}" for i in range(13)]
    table = spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, text string")
    docs = [(i, " ".join([*passage[:i], "other", *passage[i + 1 :]])) for i in range(13)]
    assert all(r[2] == 0 for r in result(documents(docs), table))


def test_empty_tables(spark, documents, awkward):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert result(documents([]), none) == []
    assert all(r[2:] == (0, [], False) for r in result(documents(awkward), none))


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_items_without_an_id_hit(spark, documents, block_bytes):
    first, second, both = (" ".join(f"{x}{i}" for i in range(15)) for x in "abc")
    items = [(None, first), (None, both), (7, both), (8, second)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([(1, f"x {first} y"), (2, both), (3, second), (4, "x y")])
    assert result(docs, table, block_bytes=block_bytes) == [
        ("1", 17, 15, [], True), ("2", 15, 15, ["7"], True), ("3", 15, 15, ["8"], True),
        ("4", 2, 0, [], False),
    ]
    assert [r.doc_id for r in without_contaminated(docs, table).collect()] == [4]
