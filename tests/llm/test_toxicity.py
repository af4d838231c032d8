import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cratewise.llm import toxicity as toxicity_module
from cratewise.llm.tables import table
from cratewise.llm.toxicity import LONG_CHARS, _chosen, held_out, toxicity, train
from tests.llm.test_jaccard import most_memory


def made(seed, n):
    """Texts in two made-up languages; insults are open word families."""
    random.seed(seed)
    docs, labels = [], []
    for i in range(n):
        lang = random.choice(["xx", "yy"])
        syllables = ["ba", "do", "ki"] if lang == "xx" else ["zu", "he", "mo"]
        word = lambda: "".join(random.choices(syllables, k=random.randint(1, 4)))  # noqa: B023, E731
        words = [word() for _ in range(random.randint(3, 200))]
        toxic = i % 4 == 0
        if toxic:
            stem = "grobian" if lang == "xx" else "vilain"
            words.insert(random.randrange(len(words)), stem + word())
        docs.append((i, " ".join(words).capitalize() + ".", lang))
        labels.append((i, int(toxic), None))
    return docs, labels


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, toxic int, score int")


def test_held_out_accuracy(documents, labels):
    docs, known = made(1, 1600)
    truth = {i: toxic for i, toxic, _ in known}
    rows = toxicity(documents(docs), labels(known)).withColumn("out", held_out()).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.out]
    assert 250 < len(out) < 550
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.95


def test_scores_depend_on_the_text_alone(documents, labels):
    docs, known = made(2, 400)
    twins = [(i + 10_000, text, "zz" if i % 2 else None) for i, text, _ in docs]
    rows = toxicity(documents(docs + twins), labels(known)).collect()
    score = {r.doc_id: r.score for r in rows}
    # Other ids and languages of equal texts; language only teaches.
    texts = {}
    for i, text, _ in docs + twins:
        texts.setdefault(text, set()).add(round(score[i], 9))
    assert all(len(found) == 1 for found in texts.values())


def test_held_out_labels_teach_nothing(spark, documents, labels):
    docs, known = made(3, 300)
    ids = spark.createDataFrame([(i,) for i, _, _ in docs], "doc_id bigint")
    out = {r.doc_id for r in ids.where(held_out()).collect()}
    flipped = [(i, 1 - t if i in out else t, None) for i, t, _ in known]
    score = lambda rows: {r.doc_id: r.score for r in toxicity(documents(docs, 1), labels(rows)).collect()}
    a, b = score(known), score(flipped)
    assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_awkward_rows(documents, labels, awkward):
    docs, known = made(4, 200)
    odd = [(None, 1, 0), (5, None, 0), (6, 7, 0), (1, 1, 0), (1, 0, 0), (10**9, 1, 0)]
    rows = toxicity(documents(awkward + [(d + 5000, *r) for d, *r in docs]), labels(
        odd + [(d + 5000, t, 0) for d, t, _ in known]
    )).collect()
    assert len(rows) == len(awkward) + len(docs)
    assert all(0 <= r.score <= 1 for r in rows)


def test_no_rows_no_labels_one_class(documents, labels):
    assert toxicity(documents([]), labels([])).count() == 0
    rows = [(1, "a b"), (2, None)]
    assert [r.score for r in toxicity(documents(rows), labels([])).collect()] == [0.0, 0.0]
    one = toxicity(documents([(i, "a b") for i in range(9)]), labels([(i, 1, 0) for i in range(9)]))
    assert {r.score for r in one.collect()} == {1.0}


def test_sample_tables(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, known = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity(docs, known).join(known, "doc_id").where(held_out())
    right = found.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.97


def test_long_texts_teach_where_there_are_no_short_ones(documents, labels):
    docs, known = made(5, 300)
    toxic = {i for i, t, _ in known if t}
    # All of one class, and all of one language, are longer than SHORT_CHARS.
    long = [(i, text + " ba" * 7000 if i in toxic else text, "xx") for i, text, _ in docs]
    scores = {r.doc_id: r.score for r in toxicity(documents(long), labels(known)).collect()}
    assert len({round(x, 6) for x in scores.values()}) > 2
    assert sum(scores[i] for i in toxic) / len(toxic) > 0.5


def test_chosen_rows_keep_bounds_and_languages():
    row = lambda order, lang, chars: {"order": order, "lang": lang, "chars": chars}
    rows = [row(i, "xx", 500) for i in range(50)] + [row(50 + i, "xx", 30_000) for i in range(1000)]
    rows += [row(2000, "yy", 60_000_000), row(2001, "yy", 50_000_000), row(2002, None, 25_000)]
    found = _chosen(rows, 5000)
    long = [r for r in found if r["chars"] > 20_000]
    assert [r for r in rows if r["chars"] == 500] == [r for r in found if r["chars"] == 500]
    assert {r["order"] for r in long if r["lang"] != "xx"} == {2001, 2002}
    assert 0 < sum(r["chars"] for r in long if r["lang"] == "xx") <= LONG_CHARS
    assert {2001, 2002} <= {r["order"] for r in _chosen(rows, 10)} and len(_chosen(rows, 10)) == 10


def test_an_id_on_many_rows_teaches_once(documents, labels, monkeypatch):
    docs, known = made(6, 60)
    many = [*docs, *[(4, f"{docs[4][1]} {i % 3}", ["xx", "yy", None][i % 2]) for i in range(500)]]
    taught = []
    monkeypatch.setattr(toxicity_module, "train", lambda ids, counts, *_: taught.append(len(counts)) or train(ids, counts, *_))
    assert toxicity(documents(many + docs), labels(known)).count() == len(many) + len(docs)
    assert 0 < taught[0] <= len(docs)


def test_all_labelled_rows_teach_beyond_what_the_driver_learns(documents, labels, monkeypatch):
    """Insults of a kind that few texts have, more texts than the driver takes."""
    docs, known = made(7, 1600)
    truth = {i: toxic for i, toxic, _ in known}
    # One id on many rows, of which one teaches.
    many = [(8, f"{docs[8][1]} {i % 3}", ["xx", "yy", None][i % 2]) for i in range(300)]
    monkeypatch.setattr(toxicity_module, "SAMPLE", {1: 40, 0: 60})
    learned = []
    monkeypatch.setattr(toxicity_module, "train", lambda *_: pytest.fail("learned from a part"))

    def all_features(docs, known):
        rows = all_of(docs, known)
        learned.append(rows.count())
        return rows

    all_of = toxicity_module._all_features
    monkeypatch.setattr(toxicity_module, "_all_features", all_features)
    rows = toxicity(documents(docs + many), labels(known)).withColumn("out", held_out()).collect()
    out = [r for r in rows if r.out]
    taught = {r.doc_id for r in rows if not r.out}
    assert learned == [len(taught)] and len(rows) == len(docs) + len(many)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.95
    again = toxicity(documents(docs + many), labels(known)).collect()
    score = {(r.doc_id, round(r.score, 6)) for r in rows}
    assert score == {(r.doc_id, round(r.score, 6)) for r in again}


def test_one_class_beyond_what_the_driver_learns(documents, labels, monkeypatch):
    monkeypatch.setattr(toxicity_module, "SAMPLE", {1: 2, 0: 2})
    one = toxicity(documents([(i, "a b") for i in range(40)]), labels([(i, 1, 0) for i in range(40)]))
    assert {r.score for r in one.collect()} == {1.0}


def test_memory_of_features():
    """Words of a batch are split some texts at a time."""
    random.seed(9)
    n = 1500
    texts = [" ".join(f"{random.getrandbits(22):x}" for _ in range(400)) for _ in range(n)]
    batch = pa.table(
        {"doc_id": list(range(n)), "text": texts, "lang": ["en"] * n, "toxic": [0] * n}
    ).combine_chunks().to_batches()[0]
    # An id of two batches counts once, and every word has its ids.
    found = list(toxicity_module._features(iter([batch, batch])))
    assert [x for b in found for x in b.column("doc_id").to_pylist()] == list(range(n))
    assert {len(x) for b in found for x in b.column("ids").to_pylist()} == {400 * 3 * 4}
    assert most_memory(toxicity_module._features, batch) < 6
