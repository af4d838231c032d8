import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cratewise.llm.language import UNKNOWN, languages, scripts, viterbi
from cratewise.llm.tables import table
from cratewise.llm.toxicity import held_out
from cratewise.llm.words import ALNUM_FOLDED, buffers, split_words

SYLLABLES = {"aa": ["ba", "do", "ki", "re"], "bb": ["zu", "he", "mo", "re"], "cc": ["жо", "ди", "ка"]}


def sentence(lang, n):
    return " ".join("".join(random.choices(SYLLABLES[lang], k=random.randint(1, 4))) for _ in range(n))


@pytest.fixture
def trained(documents):
    random.seed(6)
    return [(i, sentence(lang, 40), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]


def test_mixed_texts_get_spans(documents, trained):
    text = " ".join([sentence("aa", 30), sentence("bb", 50), sentence("cc", 20)])
    rows = [(1000, text, None), (1001, "ЖОДИ", "aa"), (1002, sentence("bb", 3), None)]
    found = {r.doc_id: r for r in languages(documents(trained + rows)).collect()}
    mixed = found[1000]
    assert mixed.lang_pred == "bb" and 0.3 < mixed.score < 0.7
    kinds = [s.kind for s in mixed.spans]
    ends = [s.end for s in mixed.spans]
    assert kinds == ["aa", "bb", "cc"]
    assert abs(ends[0] - 30) <= 3 and abs(ends[1] - 80) <= 3 and ends[2] == 100
    # The label of a row is no input, its script narrows the languages.
    assert found[1001].lang_pred == "cc" and found[1002].lang_pred == "bb"


def test_awkward_rows(documents, trained, awkward):
    rows = [(d, t, None) for d, t, *_ in awkward] + [(i + 500, t, k) for i, t, k in trained]
    rows += [(900, "12 34 !?", "aa"), (901, "日本語", "aa"), (902, "«»—", "aa")]
    found = {r.doc_id: r for r in languages(documents(rows)).collect()}
    for i in (1, 2, 3, 14, 900, 902):
        assert (found[i].lang_pred, found[i].score) == (UNKNOWN, 0.0)
    assert found[901].lang_pred in SYLLABLES
    assert all(r.lang_pred in {*SYLLABLES, UNKNOWN} and 0 <= r.score <= 1 for r in found.values())


def test_no_rows_and_nothing_to_learn(documents):
    assert languages(documents([])).count() == 0
    assert languages(documents([(1, "abc", None)])).first().lang_pred == UNKNOWN


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    found = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where(held_out())
    right = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.99


def test_viterbi_equals_all_paths():
    random_ = np.random.default_rng(1)
    first = np.array([0, 4, 4, 9, 10])
    scores = random_.normal(0, 3, (10, 3)).astype(np.float32)
    labels = viterbi(scores, first, penalty=2.0)
    for low, high in zip(first[:-1], first[1:]):
        def worth(path):
            switches = sum(a != b for a, b in zip(path, path[1:]))
            return sum(scores[low + i, k] for i, k in enumerate(path)) - 2.0 * switches  # noqa: B023

        best = max(itertools.product(range(3), repeat=int(high - low)), key=worth)
        assert worth(tuple(labels[low:high])) == pytest.approx(worth(best), abs=1e-4)


def test_scripts():
    import pyarrow as pa

    text = "abc Éa 12ж ж1 日本 한국 αβγ 99 ẞx عرب"
    data, offsets = buffers(pa.array([text]))
    from cratewise.llm.language import _NAMES

    got = [_NAMES[i] for i in scripts(split_words(data, offsets, ALNUM_FOLDED))]
    assert got == "latin latin cyrillic cyrillic han hangul greek other latin arabic".split()


def test_every_letter_has_a_script():
    from cratewise.llm.language import _NAMES, _SCRIPT

    letters = [i for i in range(0x110000) if chr(i).isalpha()]
    assert len(_SCRIPT) > max(letters)
    assert all(_NAMES[_SCRIPT[i]] != "other" for i in letters)
    samples = "aжαאعकবਕગଓகతಕമසกລཀကგ한አᎠᐁកᠠかㄅ日ꀀ𐎀𠀀"
    assert len({_SCRIPT[ord(x)] for x in samples}) == len(samples) - 1
    # Signs and digits are no letters; words are told by the first letter.
    text = "«» — 12 ₹५ “ಕನ್ನಡ” —mot"
    data, offsets = buffers(pa.array([text]))
    got = [_NAMES[i] for i in scripts(split_words(data, offsets, ALNUM_FOLDED))]
    assert got == "other other other other kannada latin".split()


def test_languages_in_scripts_of_their_own(documents):
    random.seed(8)
    letters = {"kn": "ಕಗಚಜಟ", "ml": "കഗചജട", "gu": "કગચજટ", "am": "ሀለሐመሠ", "km": "កខគឃង", "zz": "abcde"}
    made = lambda lang, n: " ".join("".join(random.choices(letters[lang], k=4)) for _ in range(n))
    rows = [(i, made(lang, 40), lang) for i, lang in enumerate(list(letters) * 30)]
    tests = [(1000 + i, made(lang, 30), None) for i, lang in enumerate(letters)]
    found = {r.doc_id: r for r in languages(documents(rows + tests)).collect()}
    for i, lang in enumerate(letters):
        assert (found[1000 + i].lang_pred, found[1000 + i].score) == (lang, 1.0)


def test_a_script_of_no_language_is_told_by_trigrams(documents, trained):
    # Greek words are less than a hundredth of the words of either language.
    rows = [(i, f"{text} {sentence(lang, 160)}" + " λόγος" * (lang == "bb"), lang) for i, text, lang in trained]
    found = {r.doc_id: r for r in languages(documents([*rows, (1000, "λόγος λόγος", None)])).collect()}
    assert (found[1000].lang_pred, found[1000].score) == ("bb", 1.0)


def test_a_language_with_long_texts_only_is_learned(documents, trained):
    rows = [(i, sentence(lang, 8000 if lang == "bb" else 40), lang) for i, _, lang in trained]
    found = {r.doc_id: r for r in languages(documents([*rows, (1000, sentence("bb", 30), None)])).collect()}
    assert found[1000].lang_pred == "bb"
