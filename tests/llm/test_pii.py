import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cratewise.llm import pii
from cratewise.llm.pii import KINDS, personal_data
from cratewise.llm.words import SPACED, buffers, split_words


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    total = 0
    for place, char in enumerate(reversed(text)):
        value = int(char) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def brute(text):
    found = []
    for place, (kind, pattern, keep) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if keep(m[0]):
                found.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def made(seed, n):
    random.seed(seed)
    pieces = [
        "a.b", "x@", "@", "@c.de", "mail@host.org", "-", ".", "..", "+", "%", "_", " ", "  ", "(", ")", "1",
        "12", "255", "256", "0.0.0.0", "1.2.3", "000255", "4111 1111", "4111111111111111", "+49", "7", "é", "😀",
        "\n", "9" * 30, "79927398713", "4242-4242-4242-4242", "+1 (555) 123-4567",
    ]
    return [(i, "".join(random.choices(pieces, k=random.randint(0, 50)))) for i in range(n)]


def test_base_spans_equal_brute_force(documents, awkward):
    rows = awkward + [(1000 + d, t) for d, t in made(3, 400)]
    rows += [(5000, "a" * 50_000 + " " + "1" * 50_000 + "." * 50_000 + "@" * 1000)]
    found = personal_data(documents(rows)).collect()
    got = sorted((str(r.doc_id), [tuple(s) for s in r.base]) for r in found)
    assert got == sorted((str(r[0]), brute(r[1])) for r in rows)
    assert {s[0] for x in got for s in x[1]} == set(KINDS)
    for r in found:
        base, every = [tuple(s) for s in r.base], [tuple(s) for s in r.spans]
        assert set(base) <= set(every) and every == sorted(
            every, key=lambda s: (s[1], KINDS.index(s[0]), s[2])
        )
        for kind, start, end in set(every) - set(base):
            assert kind in KINDS and start < end
            assert not any(a < end and start < z for _, a, z in base)


def tokens_of(text):
    data, offsets = buffers(pa.array([text]))
    return pii.tokens(split_words(data, offsets, SPACED))


def test_edges_join_neighbours_and_repeats():
    found = tokens_of("call 555-1234 or 555 1234 x x x x x 5551234 mail a@b.org and c@b.org")
    word = [found.start[i] for i in range(len(found.start))]
    assert len(word) == 6
    assert found.chain.tolist() == [[0, 1], [1, 2], [3, 4], [4, 5]]
    # Same letters and digits (0 and 3), same domain (4 and 5).
    assert found.skip.tolist() == [[0, 3], [4, 5]]


def test_a_repeated_token_takes_the_label_of_its_evidence():
    found = tokens_of("+12125551234 then 12125551234 then 98765")
    labels = pii.observed(found, {0: [("phone", 0, 12)]})
    assert labels.tolist() == [4, 0, 0]
    calm = np.full((pii.LABELS, pii.LABELS), 0.0)
    same = np.where(np.eye(pii.LABELS), 2.0, -2.0)
    field = pii.Field(np.zeros((pii.FEATURES, pii.LABELS)), calm, same)
    chance = pii.marginals(found, labels, field)
    assert np.allclose(chance.sum(1), 1)
    assert chance[1].argmax() == 4 and chance[1, 4] > 0.9
    assert chance[2].max() < 0.5


def test_marginals_of_a_tree_are_exact():
    found = tokens_of("1a 2b 3c")
    random = np.random.default_rng(0)
    field = pii.Field(
        random.normal(size=(pii.FEATURES, pii.LABELS)), random.normal(size=(pii.LABELS,) * 2),
        np.zeros((pii.LABELS,) * 2),
    )
    own = field.unary[found.features].sum(1)
    joint = own[0][:, None, None] + own[1][None, :, None] + own[2][None, None, :]
    joint = joint + field.chain[:, :, None] + field.chain[None, :, :]
    joint = np.exp(joint - joint.max())
    joint /= joint.sum()
    got = pii.marginals(found, np.zeros(3, int), field, rounds=60)
    assert np.allclose(got, [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))], atol=1e-6)


def test_consistency_in_whole_documents(documents):
    random.seed(4)
    rows = []
    for i in range(150):
        number = "".join(random.choices("0123456789", k=10))
        rows.append((i, f"ring +1{number} now, yes 1{number} is the line and {i} are here"))
    found = personal_data(documents(rows)).collect()
    more = sum(any(s.kind == "phone" and s not in r.base for s in r.spans) for r in found)
    assert more > 130


@pytest.mark.parametrize("repeats", [50, 3000])
def test_evidence_reaches_every_repeat(repeats):
    found = tokens_of("+12125551234 is it, " + "so 12125551234 is the line to call " * repeats)
    labels = pii.observed(found, {0: [("phone", 0, 12)]})
    same = np.where(np.eye(pii.LABELS), 4.0, -4.0)
    field = pii.Field(np.zeros((pii.FEATURES, pii.LABELS)), np.zeros(same.shape), same)
    chance = pii.marginals(found, labels, field)
    assert len(chance) == repeats + 1 and chance[:, 4].min() >= pii.SURE
    # A text ends as it would alone, whatever lies beside it.
    data, offsets = buffers(pa.array(["7a 8b 9c"] * 3 + ["+12125551234 or 12125551234"]))
    beside = pii.tokens(split_words(data, offsets, SPACED))
    seen = pii.observed(beside, {3: [("phone", 0, 12)]})
    alone = tokens_of("+12125551234 or 12125551234")
    one = pii.marginals(alone, pii.observed(alone, {0: [("phone", 0, 12)]}), field)
    assert np.array_equal(pii.marginals(beside, seen, field)[-2:], one)


def test_evidence_edges_are_the_nearest_on_either_side():
    found = tokens_of("551-234 551234 551234 551234 551-234 551234 other@b.org")
    labels = np.array([4, 0, 0, 0, 4, 0, 0])
    assert pii.to_evidence(found, labels).tolist() == [[0, 2], [0, 3], [1, 4], [2, 4]]


def test_messages_that_go_to_and_fro_come_to_rest():
    found = tokens_of("1a 2b 3c 4d " * 6)
    apart = np.where(np.eye(pii.LABELS), -9.0, 9.0)
    unary = np.random.default_rng(2).normal(size=(pii.FEATURES, pii.LABELS))
    chance = pii.marginals(found, np.zeros(24, int), pii.Field(unary, apart, apart))
    assert np.allclose(chance.sum(1), 1)


def test_all_repeats_of_a_long_document_are_found(documents):
    random.seed(5)
    rows = []
    for i in range(150):
        number = "".join(random.choices("0123456789", k=10))
        twice = f"ring +1{number} now, or +1{number} later"
        rows.append((i, f"{twice}, and {1000 + i} or {1000 + i} are here, yes 1{number} is the line"))
    rows.append((900, "ring +12125550123 now, " + "yes 12125550123 is the line and we are here " * 50))
    found = {r.doc_id: r for r in personal_data(documents(rows)).collect()}
    assert sum(s.kind == "phone" for s in found[900].spans) == 51


def test_repeated_tokens_keep_their_share_of_the_sample(documents, monkeypatch):
    random.seed(7)
    # One token of three kinds of boilerplate a document, and one that is never the same.
    rows = [(i, f"page 12 of the {['7th', '3 xx', 'a-1-b'][i % 3]} is y{'z' * (i % 40)}{i}") for i in range(1500)]
    taught = []
    monkeypatch.setattr(pii, "SAMPLE_TOKENS", 600)
    monkeypatch.setattr(pii, "fit", lambda f, labels, pairs: taught.append(f) or pii.Field(
        np.zeros((pii.FEATURES, pii.LABELS)), *[np.zeros((pii.LABELS,) * 2)] * 2
    ))
    personal_data(documents(rows)).count()
    page = tokens_of(rows[0][1]).features[0]
    assert len(taught[0]) == 600
    assert 0.27 < (taught[0] == page).all(1).mean() < 0.40


def test_no_rows_and_no_tokens(documents):
    assert personal_data(documents([])).count() == 0
    assert [r.spans for r in personal_data(documents([(1, None), (2, "no data")])).collect()] == [[], []]
