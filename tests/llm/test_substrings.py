import random
import re

import pytest

from cratewise.llm.substrings import COVER, PERIOD, without_repeats


def brute(rows):
    key = lambda doc_id: float("inf") if doc_id is None else doc_id
    texts = [re.findall(r"[^\x20\x09-\x0D]+", row[1] or "") for row in rows]
    first = {}
    for row, words in zip(rows, texts):
        for i in range(len(words) - 12):
            window = tuple(words[i : i + 13])
            first[window] = min(first.get(window, key(row[0])), key(row[0]))
    out = []
    for row, words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < key(row[0]):
                gone |= set(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((str(row[0]), len(words), len(gone), kept))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in df.collect())


@pytest.fixture
def passages():
    """Texts that share passages of 8 to 40 words at any offset, some often."""
    random.seed(8)
    word = lambda: "".join(random.choices("abcdé", k=3))
    shared = [[word() for _ in range(random.randint(8, 40))] for _ in range(12)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(random.randint(0, 4)):
            text += [word() for _ in range(random.randint(0, 25))]
            text += random.choice(shared if i % 3 else shared[:1])
        rows.append((random.randrange(60), " ".join(text)))
    return rows


@pytest.mark.parametrize("chunk_bytes", [300, 3 << 20])
def test_equals_brute_force(documents, awkward, passages, chunk_bytes):
    rows = awkward + passages
    assert result(without_repeats(documents(rows), chunk_bytes)) == brute(rows)


def test_the_cover_aligns_any_two_positions():
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))


def test_the_smallest_id_keeps_its_words(documents):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(5, f"a {passage}"), (2, f"{passage} b"), (9, passage), (9, f"c {passage}")]
    got = {(r.doc_id, r.text): r.n_removed for r in without_repeats(documents(rows)).collect()}
    assert got[2, f"{passage} b"] == 0 and got[5, "a"] == 60
    assert got[9, ""] == 60 and got[9, "c"] == 60


def test_no_rows(documents):
    assert without_repeats(documents([])).count() == 0
