"""Language of whole texts, and of the spans of mixed ones.

The script of a word narrows the languages it can be of. Of these each gets a score by the
word's hashed byte trigrams and, where it is known, by the word itself. Viterbi over the words
of a text, with a penalty for each switch, labels spans; the language of most of the text's
word bytes is the text's.

The tables are counted over a bounded, hash-ordered sample of each language's documents.
Labelling is one pass over all documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.spans import Span, spans_array
from cratewise.llm.tables import thinned
from cratewise.llm.toxicity import held_out
from cratewise.llm.words import ALNUM_FOLDED, Words, mixed, slices, split_words
from cratewise.operators.ranking import keep_first
from cratewise.session import checkpointed

UNKNOWN = "und"
# Bound of the training sample: documents of a language.
SAMPLE_DOCS = 1500
TRIGRAMS = 1 << 16
WORDS = 1 << 17
# Times that a word must be seen in the sample for its own score.
SEEN = 3
SWITCH = 12.0
# For a language that does not use the word's script.
FOREIGN = 30.0
# Scores of words times languages that are held at once.
SCORES = 1 << 23

# First letters of ranges and the script of each range, for all letters of Unicode.
# Letters that many scripts' texts use as symbols are a script of their own, "letterlike".
SCRIPTS = [
    (0x0000, "other"), (0x0041, "latin"), (0x00B5, "greek"), (0x00BA, "latin"), (0x0370, "greek"),
    (0x03E2, "coptic"), (0x03F0, "greek"), (0x0400, "cyrillic"), (0x0531, "armenian"),
    (0x05D0, "hebrew"), (0x0620, "arabic"), (0x0710, "syriac"), (0x0750, "arabic"),
    (0x0780, "thaana"), (0x07CA, "nko"), (0x0800, "samaritan"), (0x0840, "mandaic"),
    (0x0860, "syriac"), (0x0870, "arabic"), (0x0904, "devanagari"), (0x0980, "bengali"),
    (0x0A05, "gurmukhi"), (0x0A85, "gujarati"), (0x0B05, "oriya"), (0x0B83, "tamil"),
    (0x0C05, "telugu"), (0x0C80, "kannada"), (0x0D04, "malayalam"), (0x0D85, "sinhala"),
    (0x0E01, "thai"), (0x0E81, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"),
    (0x1401, "canadian"), (0x1681, "ogham"), (0x16A0, "runic"), (0x1700, "tagalog"),
    (0x1720, "hanunoo"), (0x1740, "buhid"), (0x1760, "tagbanwa"), (0x1780, "khmer"),
    (0x1820, "mongolian"), (0x18B0, "canadian"), (0x1900, "limbu"), (0x1950, "tai le"),
    (0x1980, "new tai lue"), (0x1A00, "buginese"), (0x1A20, "tai tham"), (0x1B05, "balinese"),
    (0x1B83, "sundanese"), (0x1BC0, "batak"), (0x1C00, "lepcha"), (0x1C5A, "ol chiki"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CE9, "devanagari"), (0x1D00, "latin"),
    (0x1D26, "greek"), (0x1D2B, "cyrillic"), (0x1D2C, "latin"), (0x1D66, "greek"),
    (0x1D6B, "latin"), (0x1D78, "cyrillic"), (0x1D79, "latin"), (0x1F00, "greek"),
    (0x2071, "latin"), (0x2102, "letterlike"), (0x2126, "greek"), (0x2128, "letterlike"),
    (0x212A, "latin"), (0x212C, "letterlike"), (0x2132, "latin"), (0x2133, "letterlike"),
    (0x214E, "latin"), (0x2C00, "glagolitic"), (0x2C60, "latin"), (0x2C80, "coptic"),
    (0x2D00, "georgian"), (0x2D30, "tifinagh"), (0x2D80, "ethiopic"), (0x2E2F, "cyrillic"),
    (0x3005, "han"), (0x3031, "kana"), (0x303B, "han"), (0x303C, "kana"), (0x3105, "bopomofo"),
    (0x3131, "hangul"), (0x31A0, "bopomofo"), (0x31F0, "kana"), (0x3400, "han"), (0xA000, "yi"),
    (0xA4D0, "lisu"), (0xA500, "vai"), (0xA640, "cyrillic"), (0xA6A0, "bamum"), (0xA717, "latin"),
    (0xA800, "syloti nagri"), (0xA840, "phags-pa"), (0xA882, "saurashtra"), (0xA8F2, "devanagari"),
    (0xA90A, "kayah li"), (0xA930, "rejang"), (0xA960, "hangul"), (0xA984, "javanese"),
    (0xA9E0, "myanmar"), (0xAA00, "cham"), (0xAA60, "myanmar"), (0xAA80, "tai viet"),
    (0xAAE0, "meetei mayek"), (0xAB01, "ethiopic"), (0xAB30, "latin"), (0xAB65, "greek"),
    (0xAB66, "latin"), (0xAB70, "cherokee"), (0xABC0, "meetei mayek"), (0xAC00, "hangul"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "linear b"), (0x10280, "lycian"), (0x102A0, "carian"), (0x10300, "old italic"),
    (0x10330, "gothic"), (0x10350, "old permic"), (0x10380, "ugaritic"), (0x103A0, "old persian"),
    (0x10400, "deseret"), (0x10450, "shavian"), (0x10480, "osmanya"), (0x104B0, "osage"),
    (0x10500, "elbasan"), (0x10530, "caucasian albanian"), (0x10570, "vithkuqi"),
    (0x10600, "linear a"), (0x10780, "latin"), (0x10800, "cypriot"), (0x10840, "imperial aramaic"),
    (0x10860, "palmyrene"), (0x10880, "nabataean"), (0x108E0, "hatran"), (0x10900, "phoenician"),
    (0x10920, "lydian"), (0x10980, "meroitic hieroglyphic"), (0x109A0, "meroitic cursive"),
    (0x10A00, "kharoshthi"), (0x10A60, "old south arabian"), (0x10A80, "old north arabian"),
    (0x10AC0, "manichaean"), (0x10B00, "avestan"), (0x10B40, "inscriptional parthian"),
    (0x10B60, "inscriptional pahlavi"), (0x10B80, "psalter pahlavi"), (0x10C00, "old turkic"),
    (0x10C80, "old hungarian"), (0x10D00, "hanifi rohingya"), (0x10E80, "yezidi"),
    (0x10F00, "old sogdian"), (0x10F30, "sogdian"), (0x10F70, "old uyghur"),
    (0x10FB0, "chorasmian"), (0x10FE0, "elymaic"), (0x11003, "brahmi"), (0x11083, "kaithi"),
    (0x110D0, "sora sompeng"), (0x11103, "chakma"), (0x11150, "mahajani"), (0x11183, "sharada"),
    (0x11200, "khojki"), (0x11280, "multani"), (0x112B0, "khudawadi"), (0x11305, "grantha"),
    (0x11400, "newa"), (0x11480, "tirhuta"), (0x11580, "siddham"), (0x11600, "modi"),
    (0x11680, "takri"), (0x11700, "ahom"), (0x11800, "dogra"), (0x118A0, "warang citi"),
    (0x11900, "dives akuru"), (0x119A0, "nandinagari"), (0x11A00, "zanabazar square"),
    (0x11A50, "soyombo"), (0x11AB0, "canadian"), (0x11AC0, "pau cin hau"), (0x11C00, "bhaiksuki"),
    (0x11C72, "marchen"), (0x11D00, "masaram gondi"), (0x11D60, "gunjala gondi"),
    (0x11EE0, "makasar"), (0x11F02, "kawi"), (0x11FB0, "lisu"), (0x12000, "cuneiform"),
    (0x12F90, "cypro-minoan"), (0x13000, "egyptian"), (0x14400, "anatolian"), (0x16800, "bamum"),
    (0x16A40, "mro"), (0x16A70, "tangsa"), (0x16AD0, "bassa vah"), (0x16B00, "pahawh hmong"),
    (0x16E40, "medefaidrin"), (0x16F00, "miao"), (0x16FE0, "tangut"), (0x16FE1, "nushu"),
    (0x16FE3, "han"), (0x17000, "tangut"), (0x18B00, "khitan"), (0x18D00, "tangut"),
    (0x1AFF0, "kana"), (0x1B170, "nushu"), (0x1BC00, "duployan"), (0x1D400, "letterlike"),
    (0x1DF00, "latin"), (0x1E030, "cyrillic"), (0x1E100, "nyiakeng"), (0x1E290, "toto"),
    (0x1E2C0, "wancho"), (0x1E4D0, "nag mundari"), (0x1E7E0, "ethiopic"),
    (0x1E800, "mende kikakui"), (0x1E900, "adlam"), (0x1EE00, "arabic"), (0x20000, "han"),
]
_NAMES = sorted({name for _, name in SCRIPTS})
_POINTS = 0x40000  # no letters from here on


def _script_table() -> np.ndarray:
    """Number of the script of every code point; what is no letter is "other"."""
    starts = np.array([start for start, _ in SCRIPTS] + [_POINTS])
    table = np.repeat([_NAMES.index(name) for _, name in SCRIPTS], np.diff(starts))
    letter = np.fromiter((chr(i).isalpha() for i in range(_POINTS)), bool, _POINTS)
    return np.append(np.where(letter, table, _NAMES.index("other")), _NAMES.index("other"))


_SCRIPT = _script_table()


def _script_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Script of the characters that begin at ``at``; four bytes follow the last."""
    a, b, c, d = (data[at + i] for i in range(4))
    point = np.where(
        a < 0x80, a,
        np.where(a < 0xE0, (a & 31) << 6 | b & 63,
        np.where(a < 0xF0, (a & 15) << 12 | (b & 63) << 6 | c & 63,
                 (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63)),
    )
    return _SCRIPT[np.minimum(point, _POINTS)]


def scripts(words: Words) -> np.ndarray:
    """Script of every word by its first letter; "other" for a word without letters."""
    data = np.append(words.data, np.zeros(4, np.uint8)).astype(np.int64)
    other = _NAMES.index("other")
    letter = np.flatnonzero((words.data > 0x39) | (words.data >= 0x80))
    place = np.searchsorted(letter, words.starts)
    at = np.append(letter, len(words.data))[place]
    has = at < words.ends
    found = np.where(has, _script_at(data, np.minimum(at, len(words.data))), other)
    # Words that begin with a sign or a mark are read on.
    rest = np.flatnonzero(has & (found == other))
    lengths = words.ends[rest] - words.starts[rest]
    owner = np.repeat(np.arange(len(rest)), lengths)
    at = np.arange(len(owner)) + np.repeat(words.starts[rest] - (np.cumsum(lengths) - lengths), lengths)
    begins = (data[at] & 0xC0) != 0x80
    owner, at = owner[begins], at[begins]
    script = _script_at(data, at)
    owner, script = owner[script != other], script[script != other]
    owner, first = np.unique(owner, return_index=True)
    found[rest[owner]] = script[first]
    return found


def trigram_ids(words: Words) -> np.ndarray:
    """At every byte, the bucket of the trigram it is in the middle of; words end in 0."""
    values = np.zeros(len(words.data) + 2, np.uint64)
    values[1:-1] = ALNUM_FOLDED[words.data]
    joint = values[:-2] * np.uint64(3) + values[1:-1] * np.uint64(5) + values[2:] * np.uint64(7)
    return (mixed(joint) % np.uint64(TRIGRAMS)).astype(np.int64)


def word_ids(words: Words) -> np.ndarray:
    return (words.hashes % np.uint64(WORDS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    trigrams: np.ndarray  # languages x buckets: log probability, less the mean of all
    words: np.ndarray  # the same of known words, else 0
    allowed: np.ndarray  # scripts x languages


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Words x languages; 0 throughout where a word has no letter and says nothing.

    A script that no language uses narrows nothing: all languages are scored.
    """
    out = np.zeros((len(words.starts), len(model.languages)), np.float32)
    ids, own, script = trigram_ids(words), word_ids(words), scripts(words)
    for number in range(len(model.languages)):
        sums = np.zeros(len(words.data) + 1)
        np.cumsum(model.trigrams[number][ids], out=sums[1:])
        out[:, number] = (sums[words.ends] - sums[words.starts]) / 2 + model.words[number][own]
    possible = model.allowed | ~model.allowed.any(1, keepdims=True)
    out -= np.where(possible[script], 0, FOREIGN).astype(np.float32)
    out[script == _NAMES.index("other")] = 0
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of every word, text by text; all texts advance together.

    Of equal labels the one listed first, and no switch where one gains nothing.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, sizes = first[:-1][order], counts[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left") if steps else []
    labels = np.zeros(len(scores), np.int16)
    if not steps or not scores.shape[1]:
        return labels
    switched = np.zeros(scores.shape, bool)
    best_at = np.zeros(len(scores), np.int16)
    value = np.zeros((int(active[0]), scores.shape[1]), np.float32)
    for step in range(steps):
        n = active[step]
        at = begin[:n] + step
        now = value[:n]
        if step:
            best = now.argmax(1)
            best_at[at] = best
            jump = now[np.arange(n), best][:, None] - penalty
            moves = jump > now
            switched[at] = moves
            now = np.where(moves, jump, now)
            # Only differences matter; the values stay small.
            now -= jump
        value[:n] = now + scores[at]
    state = value.argmax(1)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        labels[at] = state[:n]
        moved = switched[at, state[:n]]
        state[:n] = np.where(moved, best_at[at], state[:n])
    return labels


# --- training ---------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of trigrams (table 0), words (1) and scripts (2) by language."""
    names = ["lang", "place", "bucket", "n"]
    for batch in batches:
        for part, data, offsets in slices(batch):
            words = split_words(data, offsets, ALNUM_FOLDED)
            langs = np.array(part.column("lang").to_pylist(), object)
            of_word = words.text_of_word()
            owner = np.repeat(np.arange(len(words.starts)), words.ends - words.starts)
            inside = ALNUM_FOLDED[words.data] != 0
            trigrams = trigram_ids(words)[inside]
            sources = [
                (of_word[owner], trigrams),
                (of_word, word_ids(words)),
                (of_word, scripts(words)),
            ]
            for lang in sorted(set(langs)):
                for place, (text, bucket) in enumerate(sources):
                    found, n = np.unique(bucket[(langs == lang)[text]], return_counts=True)
                    columns = [
                        pa.array([lang] * len(found), pa.string()),
                        pa.array(np.full(len(found), place, np.int64)),
                        pa.array(found.astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)


def learn(docs: DataFrame) -> Model:
    """Tables from rows with text and language that are not held out.

    At most SAMPLE_DOCS documents of a language, by a hash of doc_id. Their texts are counted
    whole, however long, in the tasks; what the driver gets is bounded by the tables.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    place = F.xxhash64(F.lit("language"), "doc_id")
    some = thinned(usable.select("doc_id", "lang"), ["lang"], place, SAMPLE_DOCS)
    # The shifted hash orders as the unsigned one, as which it was cut.
    order = [F.shiftrightunsigned(place, 1), F.col("doc_id")]
    chosen = checkpointed(keep_first(some, ["lang"], order, SAMPLE_DOCS))
    # The sample of up to 64 languages meets the texts where these are.
    chosen = F.broadcast(chosen) if chosen.count() <= 64 * SAMPLE_DOCS else chosen
    texts = usable.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
    counted = texts.select("lang", "text").mapInArrow(
        _count, "lang string, place bigint, bucket bigint, n bigint"
    )
    # Bounded by the sample: at most its different trigrams and words.
    table = counted.groupBy("lang", "place", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    which = np.array([names.index(x) for x in table.column("lang").to_pylist()], np.int64)
    place, bucket, n = (table.column(x).to_numpy() for x in ("place", "bucket", "n"))
    sizes = (TRIGRAMS, WORDS, len(_NAMES))
    counts = [np.zeros((len(names), size)) for size in sizes]
    for number in range(3):
        rows = place == number
        counts[number][which[rows], bucket[rows]] = n[rows]
    tables = []
    for found, least in ((counts[0], 1), (counts[1], SEEN)):
        share = np.log((found + 0.1) / (found.sum(1, keepdims=True) + 0.1 * found.shape[1]))
        share -= share.mean(0) if len(names) else 0
        tables.append(np.where(found.sum(0) >= least, share, 0).astype(np.float32))
    used = counts[2] / np.maximum(counts[2].sum(1, keepdims=True), 1)
    allowed = (used >= 0.01).T
    allowed[_NAMES.index("other")] = False
    return Model(names, *tables, allowed)


# --- labelling --------------------------------------------------------------------------


def _has_letter(text: bytes) -> bool:
    lowered = text.lower()
    if lowered.translate(None, b"abcdefghijklmnopqrstuvwxyz") != lowered:
        return True
    return not text.isascii() and any(x.isalpha() for x in text.decode("utf-8", "replace"))


def _parts(batch: pa.RecordBatch, languages: int):
    """Slices with words and scores, as many at a time as SCORES allows."""
    limit = max(1 << 20, SCORES // max(languages, 1) * 4)
    yield from slices(batch, limit=limit)


def _words(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores and byte lengths of all words, and where each text's words lie."""
    scores = [np.zeros((0, len(model.languages)), np.float32)]
    lengths, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, last = 0, len(offsets) - 1
    while at < last:
        to = int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1
        to = min(max(to, at + 1), last)
        words = split_words(
            data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], ALNUM_FOLDED
        )
        scores.append(word_scores(words, model))
        lengths.append(words.ends - words.starts)
        counts.append(words.counts)
        at = to
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return np.concatenate(scores), np.concatenate(lengths), first


def label_texts(data: np.ndarray, offsets: np.ndarray, model: Model):
    """(language, share, spans in words) of every text."""
    scores, lengths, first = _words(data, offsets, model)
    labels = viterbi(scores, first)
    # Words that say nothing take part in spans, not in the vote.
    weight = np.where(scores.any(1), lengths, 0)
    out = []
    for i, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        text = data[offsets[i] : offsets[i + 1]].tobytes()
        if not model.languages or not _has_letter(text):
            out.append((UNKNOWN, 0.0, []))
            continue
        own = labels[low:high]
        votes = np.bincount(own, weight[low:high], len(model.languages))
        total = votes.sum()
        best = int(votes.argmax()) if total else int(own[0]) if len(own) else 0
        share = float(votes[best] / total) if total else 0.0
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        spans: list[Span] = [
            (model.languages[own[a]], a, z) for a, z in zip(cuts[:-1], cuts[1:]) if a < z
        ]
        out.append((model.languages[best], share, spans))
    return out


def _label(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, data, offsets in _parts(batch, len(model.languages)):
                rows = label_texts(data, offsets, model)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([row[0] for row in rows], pa.string()),
                        pa.array([row[1] for row in rows], pa.float64()),
                        spans_array([row[2] for row in rows]),
                    ],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    return run


def languages(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, spans) for every row of ``docs`` (doc_id, text).

    ``learn_from`` (doc_id, text, lang) is ``docs`` by default. ``score`` is the share of the
    word bytes that are of the predicted language; ``spans`` tell the language (kind) of runs
    of words (numbered from 0). A text that is null or has no letter, and every text where no
    language could be learned, is UNKNOWN with score 0.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(learn_from or docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _label(model),
        f"doc_id {kind}, lang_pred string, score double, "
        "spans array<struct<kind: string, start: bigint, end: bigint>>",
    )
