import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest

from cratewise.llm import filters, phrases
from cratewise.llm.phrases import collocations


def brute(rows, least, longest=5, top=2000):
    """Counts of all phrases by plain loops, scores in whole numbers of any size."""
    found, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        folded = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found[lang or "und"][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in found.items():
        listed = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        within = Counter()
        for p, n in listed.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    within[p[i : i + size]] = max(within[p[i : i + size]], n)
        best = []
        for p, a in listed.items():
            if within[p] >= a:
                continue
            cuts = [
                (1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            ]
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(n, seed=1, size=30):
    """Texts over few words with pet phrases, all kinds of separators and two languages."""
    pick = random.Random(seed)
    words = ["A", "b", "c", "dé", "ß", "e", "f’s", "ıI", "g-h", "(x)", "日本"]
    pets = ["new york city hall", "a b c dé ß", "b b b", "so  to\tspeak"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(size):
            parts.append(pick.choice(pets) if pick.random() < 0.2 else pick.choice(words))
            parts.append(pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\xa0"]))
        out.append(("".join(parts), pick.choice(["en", "de", None])))
    return out


def run(documents, rows, **settings):
    docs = documents([(i, text, lang, "a") for i, (text, lang) in enumerate(rows)])
    return sorted(tuple(r) for r in collocations(docs, **settings).collect())


@pytest.mark.parametrize("least", [1, 3, 20])
def test_matches_brute_force(documents, least):
    rows = corpus(60)
    assert run(documents, rows, least=least) == brute(rows, least)


def test_many_chunks_and_small_filters_count_alike(documents):
    rows = corpus(80, seed=2)
    got = run(documents, rows, least=4, chunk_bytes=300, entries=50, top=7)
    assert got == brute(rows, 4, top=7)


def test_phrases_that_only_seem_frequent_are_ruled_out(documents, monkeypatch):
    """A bitmap so full that every phrase passes changes no count."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 1)
    monkeypatch.setattr(phrases, "MOST_BITS", 1)
    rows = corpus(40, seed=3)
    assert run(documents, rows, least=3) == brute(rows, 3)


def test_awkward_texts(documents, awkward):
    rows = [(x[1], x[2]) for x in awkward]
    docs = documents(awkward)
    for least in (1, 2, 40):
        got = collocations(docs, least=least, top=50)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top=50)


def test_ties_go_by_bytes(documents):
    rows = [("b a. é z. z é. a b. B A", "en")] * 3
    got = run(documents, rows, least=1)
    assert got == brute(rows, 1)
    assert len({r[-1] for r in got}) < len(got)


def test_nothing_frequent(documents):
    assert run(documents, [("a b c", "en"), (None, None), ("", "en")], least=2) == []
    docs = documents([(1, "a")]).where("false")
    assert collocations(docs).collect() == []


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select 40000000000L as a, 900000000000L as total, 50000000000L as l, 60000000000L as r")
    a, n, left, right = row.first()
    assert row.selectExpr(phrases._score()).first()[0] == 1000 * a * n // (left * right)


def test_rows_of_the_word_join_follow_the_entries(documents, monkeypatch):
    """As many rows as entries of chunks, however many words are frequent; same phrases."""
    from cratewise.llm import phrases

    plans, store = [], phrases.stored

    def spied(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df)

    monkeypatch.setattr(phrases, "stored", spied)
    # The second text has no frequent word: its chunk gives nothing.
    docs = documents([(1, "a b " * 6, "xx"), (2, "c d e", "xx"), (3, "a b", None)], partitions=3)
    words, _, found = phrases.frequent_phrases(docs, least=3, longest=3)
    assert sorted(r.word for r in words.collect()) == ["a", "b"]
    # a, b, a b, b a, a b a, b a b
    assert sorted(r.f for r in found.collect()) == [5, 5, 5, 6, 6, 6]
    encoded = next(p for p in plans if "_frequent_only" in p or "run" in p and "known" in p and "body" in p)
    assert "Join LeftOuter, ((lang" in encoded


def peak_mb(run):
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_tasks_hold_few_phrases_at_once():
    """Of any number of words; two limbs a phrase, none repeated."""
    pick = np.random.default_rng(7)
    bits, n = 17, 5
    packing = filters.Packing(n, bits)

    class Every:
        value = {size: (np.full(1 << 12, 255, np.uint8), 15) for size in range(2, n)}

    def chunks():
        ids = pa.array([np.arange(1 << bits)], pa.list_(pa.int64()))
        for _ in range(12):
            body = pick.integers(1, 1 << bits, 500_000, dtype=np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays([ids, pa.array([True]), pa.array([body])], ["ids", "wide", "body"])

    sent = lambda: sum(len(b) for b in phrases._count(n, bits, 4, phrases.FILTER_ENTRIES, Every)(chunks()))
    assert peak_mb(sent) < 200

    # A range as full as it can be.
    left, blocks = packing.widths[0] - 4, []
    for _ in range(20):
        rows = phrases.RANGE_BYTES // 8 // 20
        limbs = [pick.integers(0, 1 << w, rows, np.uint64) for w in (left, *packing.widths[1:])]
        blocks.append((0, *filters.write(packing, *filters.combined(limbs, np.ones(rows, np.int64)), 4)))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    names = [x.split()[0] for x in phrases._BLOCK.split(", ")]
    table = pa.table([pa.array(x, kind) for x, kind in zip(zip(*blocks), kinds)], names)
    assert peak_mb(lambda: phrases._merge(packing, 4, 2)(table)) < 200


def test_words_of_a_chunk_make_no_objects():
    n = 100_000
    known = (np.random.default_rng(3).permutation(n) << phrases.ID_BITS) | np.arange(n)
    body = np.arange(n + 1, dtype=np.uint32).tobytes()
    columns = [pa.array([n]), pa.array([True]), pa.array([body]), pa.array([known])]
    batch = pa.RecordBatch.from_arrays(columns, ["n_words", "wide", "body", "known"])
    out = []
    assert peak_mb(lambda: out.extend(phrases._frequent_only(iter([batch])))) < 10
    got = out[0].to_pylist()[0]
    assert [got["ids"][c - 1] for c in np.frombuffer(got["body"], np.uint32)] == [
        x & ((1 << phrases.ID_BITS) - 1) for x in sorted(known.tolist())
    ]


def test_chunks_are_read_a_few_at_a_time(documents, monkeypatch):
    """Row groups hold few rows, because a reader takes a row group at once."""
    kept, store = [], phrases.stored

    def spied(df):
        kept.append(store(df))
        return kept[-1]

    monkeypatch.setattr(phrases, "stored", spied)
    docs = documents([(i, "a b c d " * 20) for i in range(60)], partitions=1)
    phrases.frequent_phrases(docs, least=3, longest=2, chunk_bytes=200)
    with_body = [df for df in kept if "body" in df.columns]
    assert len(with_body) == 2
    for df in with_body:
        files = [pa.parquet.ParquetFile(x.removeprefix("file:")) for x in df.inputFiles()]
        sizes = [f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
        assert sum(sizes) > 40 and max(sizes) <= 4
