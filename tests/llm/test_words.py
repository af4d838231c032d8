import re

import numpy as np
import pyarrow as pa
import pytest

from cratewise.llm import words as w

TEXTS = ["", "one", " one  two ", "A\tb\x0bC d é", "12-ab_ÉÖ:x", "\x00a\x7fb`c{d", "z" * 300, "ab" * 9]
RULES = [
    (w.SPACED, r"[^\x20\x09-\x0D]+", False),
    (w.SPACED_FOLDED, r"[^\x20\x09-\x0D]+", True),
    (w.ALNUM_FOLDED, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
]


def folded(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


@pytest.mark.parametrize("table, pattern, fold", RULES)
def test_words_are_those_of_the_pattern(table, pattern, fold):
    data, offsets = w.buffers(pa.array([*TEXTS, None]))
    found = w.split_words(data, offsets, table)
    seen = {}
    for i, text in enumerate([*TEXTS, ""]):
        want = re.findall(pattern, folded(text) if fold else text)
        got = [found.word(j) for j in range(found.first[i], found.first[i + 1])]
        assert [folded(x.decode()) if fold else x.decode() for x in got] == want
        for j, word in zip(range(found.first[i], found.first[i + 1]), want):
            assert seen.setdefault(word, found.hashes[j]) == found.hashes[j]
    assert len(set(seen.values())) == len(seen)


def test_sequences_hash_by_content_and_length():
    data, offsets = w.buffers(pa.array(["a b c a b", "a b", "b a"]))
    found = w.split_words(data, offsets, w.SPACED)
    pairs = w.sequence_hashes(found.hashes, 2)
    assert pairs[0] == pairs[3] == pairs[5]
    assert pairs[7] != pairs[0]
    assert w.whole_sequences(found, 2).tolist() == [True] * 4 + [False, True, False, True]
    assert len(w.sequence_hashes(found.hashes[:1], 2)) == 0


def test_slices_cover_all_rows_whole():
    texts = ["x" * n for n in (0, 5, 40, 3, 0, 100, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(1)
    parts = list(w.slices(batch, limit=45))
    assert [p.num_rows for p, _, _ in parts] == [2, 2, 1, 1]
    assert [x for p, _, _ in parts for x in p.column("text").to_pylist()] == texts[1:]
    for part, data, offsets in parts:
        got = [data[a:z].tobytes().decode() for a, z in zip(offsets[:-1], offsets[1:])]
        assert got == part.column("text").to_pylist()
    assert not np.any(w.mixed(np.arange(1, 1000, dtype=np.uint64)) == 0)
