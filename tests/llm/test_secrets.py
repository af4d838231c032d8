import random
import re
import time

import pytest

from cratewise.llm.secrets import BASE, RULES, Rule, Trigrams, secrets, trigram_query

PATTERNS = [
    (
        "assign",
        re.compile(
            r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda m: len(m[2]) >= 6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def brute(text):
    found = []
    for place, (kind, pattern, keep) in enumerate(PATTERNS):
        found += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text or "") if keep(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def result(df):
    return sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in df.collect())


def made(seed, n):
    random.seed(seed)
    pieces = [
        "password", "PassWd", "secret", "ſecret", "toKen", "toKen", "api_key", "apikey", "api__key", "AKIA",
        "AKI", "A", "0123456789abcdef", "deadbeef", "ABCDEF", "=", ":", '"', "'", " ", "  ", "é😀", "-", "_",
        "abc", "Q9", "/+", "\n", "token=x", "secret: 'abcdefg'", "key",
    ]
    return [(i, "".join(random.choices(pieces, k=random.randint(0, 60)))) for i in range(n)]


def test_base_spans_equal_brute_force(documents, awkward):
    rows = awkward + [(1000 + d, t) for d, t in made(1, 400)]
    got = result(secrets(documents(rows), BASE))
    assert got == sorted((str(r[0]), brute(r[1])) for r in rows)
    assert sum(len(x[1]) for x in got) > 100


def test_more_rules_add_spans_only(documents):
    text = "x ghp_" + "a1B2" * 10 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456-abcdef token=abcdefgh"
    spans = result(secrets(documents([(1, text)]), RULES))[0][1]
    assert {s[0] for s in spans} == {"forge", "key", "chat", "assign"}
    assert [s for s in spans if s[0] == "assign"] == brute(text)


def test_queries_are_mandatory():
    plain = lambda query: [sorted(sorted(one) for one in clause) for clause in query]
    assert plain(trigram_query(rb"AKIA[A-Z0-9]+")) == [[[b"aki", b"kia"]]]
    assert trigram_query(rb"[0-9a-f]{24,}") == []
    assert trigram_query(rb"ab?") == [] and trigram_query(rb"(abc)*") == []
    assert plain(trigram_query(rb"(abc|xyz)")) == [[[b"abc"], [b"xyz"]]]
    assert plain(trigram_query(rb"abc[0-9]+def")) == [[[b"abc"]], [[b"def"]]]
    assert plain(trigram_query(rb"(abc)+")) == [[[b"abc"]]]
    assert plain(trigram_query(rb"ab?cd")) == [[[b"abc", b"bcd"], [b"acd"]]]


def test_the_index_leaves_out_texts_without_trigrams():
    import pyarrow as pa

    from cratewise.llm.words import buffers

    rules = [Rule("one", rb"abcd[0-9]"), Rule("all", rb"[0-9]+")]
    index = Trigrams(rules)
    data, offsets = buffers(pa.array(["xab", "cdx", "zABCd", "abc bcd", "", "abcd"]))
    postings = index.postings(data, offsets)
    assert index.texts(rules[0].query, postings, 6).tolist() == [2, 3, 5]
    assert index.texts(rules[1].query, postings, 6).tolist() == list(range(6))


def test_no_rows(documents):
    assert secrets(documents([])).count() == 0


HOSTILE = [
    b"eyJ", b"eyJa.", b"eyJ.", b"a.eyJ-", b"password", b"password ", b'token"', b"token = ", b"api_", b"AKIA",
    b"AKIA0", b"gh", b"ghp_", b"xox", b"xoxb-", b"-----BEGIN ", b"-----BEGIN A", b"PRIVATE KEY", b"0a", b" ", b"=",
]


@pytest.mark.parametrize("rule", RULES, ids=lambda rule: rule.kind)
def test_a_rule_reads_hostile_texts_once(rule):
    """A megabyte of every seed, alone and after what the rule begins with."""
    for seed in HOSTILE:
        for lead in (b"", b"eyJ", b"token", b"-----BEGIN "):
            text = lead + seed * (1_000_000 // len(seed))
            started = time.process_time()
            rule.find(text)
            assert time.process_time() - started < 1, (lead, seed)


def test_signed_tokens_are_those_of_the_plain_pattern():
    (rule,) = [rule for rule in RULES if rule.kind == "signed"]
    plain = re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
    pick = random.Random(4)
    short = Rule("signed", rule.pattern, least=1, needs=1)
    for _ in range(3000):
        text = b"".join(pick.choices([b"eyJ", b"e", b".", b"..", b"a-", b" ", b"xyz"], k=pick.randint(0, 30)))
        assert [x[1:] for x in short.find(text)] == [m.span() for m in plain.finditer(text)]
    assert rule.query == trigram_query(plain.pattern)
