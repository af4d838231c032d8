import hashlib
import re

import pytest

from cratewise.llm.exact import exact_duplicates


def brute(rows):
    clean = [re.sub("[\x20\x09-\x0d]", "", row[1] or "") for row in rows]
    out = []
    for row, own in zip(rows, clean):
        group = [r for r, c in zip(rows, clean) if c == own]
        best = max(group, key=lambda r: (len(r[1] or ""), r[0] is not None, -(r[0] or 0)))
        out.append((row[0], best[0], len(group), hashlib.sha256(own.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str
    )


@pytest.mark.parametrize("block_bytes", [7, 64, 4096])
def test_equals_brute_force(documents, awkward, block_bytes):
    found = exact_duplicates(documents(awkward), block_bytes)
    assert result(found) == brute(awkward)


def test_one_row_of_every_group_is_kept(documents, awkward):
    rows = exact_duplicates(documents(awkward)).where("kept").collect()
    groups = {r.text_sha256 for r in rows}
    assert len(groups) == len(rows) == len({x[3] for x in brute(awkward)})
    assert all(r.doc_id == r.keep_id for r in rows)


def test_poor_keys_cost_turns_not_results(documents, awkward):
    import zlib

    turns = lambda block, turn: len(block) % 3 if turn < 2 else zlib.crc32(block)
    assert result(exact_duplicates(documents(awkward), 16, turns)) == brute(awkward)


def test_ties_take_the_smallest_id(documents):
    rows = [(7, "a b"), (3, "ab "), (5, "a  b"), (4, "a\n b"), (9, "ab")]
    found = exact_duplicates(documents(rows)).collect()
    assert {r.keep_id for r in found} == {4}
    assert sorted(r.doc_id for r in found if r.kept) == [4]


def test_no_rows(documents):
    assert exact_duplicates(documents([])).count() == 0
