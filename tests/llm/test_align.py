import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cratewise.llm import align
from cratewise.llm.align import BYTE_LEVEL, PIECES, TOKENIZERS, aligned, tokenizers
from cratewise.llm.words import buffers


def whole(text):
    """Groups of a text, tokenised whole; None where a tokenizer does not spell it back."""
    found = tokenizers(TOKENIZERS, BYTE_LEVEL, PIECES)
    a = found.a.encode(" " + text, add_special_tokens=False).ids
    b = found.b.encode(text)
    target = (" " + text).encode()
    if b"".join(found.of_a.entries[i] for i in a) != target or b"".join(found.of_b.entries[i] for i in b) != target:
        return None
    out, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(a):
        mine, theirs = [], []
        while not mine or at_a != at_b:
            if at_a <= at_b and i < len(a) and (not mine or at_a < at_b or j == len(b)):
                mine.append(a[i])
                at_a += len(found.of_a.entries[a[i]])
                i += 1
            else:
                theirs.append(b[j])
                at_b += len(found.of_b.entries[b[j]])
                j += 1
        out.append((mine, theirs))
    return out


def brute(rows):
    per_row = [(doc_id, whole(text) if text else None) for doc_id, text in rows]
    held = Counter()
    for _, groups in per_row:
        held.update({(a, b) for mine, theirs in groups or [] for a in mine for b in theirs})
    highest = defaultdict(int)
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    out = []
    for doc_id, groups in per_row:
        links = [(a, b) for mine, theirs in groups or [] for a in mine for b in theirs]
        told = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or [])
        out.append(
            (
                doc_id,
                sum(len(x) for x, _ in groups or []),
                sum(len(x) for _, x in groups or []),
                len(groups or []),
                len(links),
                sum(held[x] == highest[x[0]] for x in links),
                sum(held[x] for x in links),
                hashlib.sha256(told.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


HARD = [
    "<|endoftext|> plain <s> </s> <unk> <0x0A>",
    " leading and  double   blanks ",
    "mark ▁ is not spelled back",
    "tabs\tand\nlines \n and   hard  blanks ᠎ here",
    "don't can't we'll I'D 1234567 x=1;y",
    "日本語のテキスト と 한국어 और हिन्दी 😀😀 👩‍👩‍👧",
    "\x00 nul \x7f",
    "x" * 5000 + " " + "ab" * 2000,
    " ",
    "\n",
    "the the the",
    " " * 30_000 + "x" + "\n" * 30_000,
]


def test_matches_whole_texts(spark, documents, awkward):
    rows = [(x[0], x[1]) for x in awkward] + [(100 + i, x) for i, x in enumerate(HARD)]
    got = aligned(documents(awkward + [(100 + i, x, "en", "a") for i, x in enumerate(HARD)]))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_rare_pairs_meet_their_counts_in_a_join(documents, awkward):
    docs = documents(awkward)
    got = aligned(docs, broadcast_pairs=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(x[0], x[1]) for x in awkward])


def test_no_pairs_are_broadcast_if_none_fit(documents):
    rows = [(1, "a b"), (2, "a b"), (3, "a c")]
    got = aligned(documents(rows), broadcast_pairs=0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty_table(documents):
    assert aligned(documents([(1, "a")]).where("false")).collect() == []
    assert [r["n_a"] for r in aligned(documents([(1, None), (2, "")])).collect()] == [0, 0]


ALPHABETS = [
    "ab '1\n\u00a0\u2581.",
    "a \u3000\u2003\u0085\x1c\u180eé",
    "xy  \u2028\u2581«“",
    None,
]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_cells_encode_as_the_whole_text(alphabet):
    """One text, and several at once, for which short cells are encoded together."""
    found = tokenizers(TOKENIZERS, BYTE_LEVEL, PIECES)
    assert found.by_cells
    letters = st.sampled_from(alphabet) if alphabet else st.characters(exclude_categories=["Cs"])

    @settings(max_examples=300, deadline=None, derandomize=True)
    @given(st.lists(st.text(letters, min_size=1), min_size=1, max_size=4))
    def same(texts):
        data, offsets = buffers(pa.array(texts))
        got = [x.to_pylist() for x in align.align_texts(found, data, offsets)]
        for i, text in enumerate(texts):
            truth = brute([(0, text)])[0]
            assert [*[x[i] for x in got[:4]], got[4][i]] == [*truth[1:5], truth[7]]

    same()


def test_cells_that_do_not_spell_back_when_joined_are_encoded_alone(monkeypatch):
    found = tokenizers(TOKENIZERS, BYTE_LEVEL, PIECES)
    text = "some cells joined by blanks"
    data, offsets = buffers(pa.array([text]))
    expected = [x.to_pylist() for x in align.align_texts(found, data, offsets)]
    monkeypatch.setattr(type(found), "joined", lambda self, cells: None)
    assert [x.to_pylist() for x in align.align_texts(found, data, offsets)] == expected
    monkeypatch.setattr(found, "by_cells", False)
    assert [x.to_pylist() for x in align.align_texts(found, data, offsets)] == expected


def test_links_of_a_large_group_are_summed_up(monkeypatch):
    found = tokenizers(TOKENIZERS, BYTE_LEVEL, PIECES)
    data, offsets = buffers(pa.array(["日本語 😀x " * 30, "abc don't"]))
    expected = [x.to_pylist() for x in align.align_texts(found, data, offsets)]
    monkeypatch.setattr(align, "LISTED_LINKS", 1)
    assert [x.to_pylist() for x in align.align_texts(found, data, offsets)] == expected


def test_copies_are_tokenised_once(documents, plan_of):
    """A text that a third of all rows share comes to one task as a row per task before."""
    rows = [(i, "one and the same text" if i % 3 else f"text {i}") for i in range(600)]
    got = aligned(documents(rows, partitions=6))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
