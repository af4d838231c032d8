"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label clean-up as (pattern, replacement) steps over lower-cased text.
# AS_PUBLISHED gives the published results, in which the doubled backslashes make
# steps 2 and 4 match literal backslashes, so brackets become spaces and runs of
# spaces stay. STRIPPED is the evident intent.
LABEL_STEPS_AS_PUBLISHED = [
    (r"<[^>]*>", ""),
    (r"\\[\[\^\\]\]*\\\]|\\([^\\)]*\\)", ""),
    (r"[^a-z0-9\\s]", " "),
    (r"\\s+", " "),
]
LABEL_STEPS_STRIPPED = [
    (r"<[^>]*>", ""),
    (r"\[[^\]]*\]|\([^)]*\)", ""),
    (r"[^a-z0-9\s]", " "),
    (r"\s+", " "),
]

# Fixed value: a stand-alone three-digit HTTP status in an error text.
STATUS_PATTERN = r"\b([1-5]\d\d)\b"


def tidy_code(code: Column) -> Column:
    """Recording code as compared everywhere: trimmed and upper-cased."""
    return F.upper(F.trim(code))


def is_filled(text: Column) -> Column:
    """True for text with something besides spaces; NULL counts as empty."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def join_parts(*parts: Column) -> Column:
    """Concatenate, leaving out NULL parts."""
    return F.concat_ws("", *[part.cast("string") for part in parts])


def first_listed(names: Column) -> Column:
    """First name of a ', ' separated list."""
    return F.split_part(names, F.lit(", "), F.lit(1))


def normalize_label(label: Column, strip_wrappers: bool = False) -> Column:
    """Lower-case label without markup and punctuation; '' for NULL."""
    steps = LABEL_STEPS_STRIPPED if strip_wrappers else LABEL_STEPS_AS_PUBLISHED
    cleaned = F.lower(F.coalesce(label, F.lit("")))
    for pattern, replacement in steps:
        cleaned = F.regexp_replace(cleaned, pattern, replacement)
    return F.trim(cleaned)


def status_code(message: Column) -> Column:
    """First HTTP status in an error text, '' when there is none."""
    return F.regexp_extract(F.coalesce(message, F.lit("")), STATUS_PATTERN, 1)


def has_word(text: Column, word: str) -> Column:
    """True where ``word``, taken literally, stands between word boundaries."""
    return F.coalesce(text, F.lit("")).rlike(rf"\b\Q{word}\E\b")
