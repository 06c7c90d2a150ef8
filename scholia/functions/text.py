"""Text primitives as columns. All patterns give the same result in Java and, as far as an oracle needs it, in RE2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: what a word, a sentence end and the first person are ----
ASCII_WORD = r"[A-Za-z]+(?:[-'][A-Za-z]+)?"
UNICODE_WORD = r"(?U)\b[\w\-]+\b"
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z0-9])"
FIRST_PERSON = r"(?i)\b(?:we|our|us)\b"


def nz(c: Column) -> Column:
    """Null for blank text."""
    return F.nullif(F.trim(c), F.lit(""))


def compact(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(ASCII_WORD)), F.lit(0)).cast("long")


def sentences(c: Column, least_words: int = 4) -> Column:
    """Sentences of at least so many words."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SENTENCE_GAP), lambda s: F.regexp_count(s, F.lit(ASCII_WORD)) >= least_words)


def first_person(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(FIRST_PERSON)), F.lit(0)).cast("long")


def doi(c: Column) -> Column:
    """Lower-case DOI without resolver prefix and closing punctuation; null for blank."""
    # fixed values: the prefixes and closing marks that are no part of a DOI
    bare = F.regexp_replace(F.lower(F.trim(c)), r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return F.nullif(F.regexp_replace(bare, r"[.,;:)\]}>]+$", ""), F.lit(""))


# fixed values: letters whose folded form is more than their lower case
FOLDS = {"ß": "ss", "ς": "σ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ŉ": "ʼn", "ſ": "s"}


def casefold(c: Column) -> Column:
    """Case folded text: lower case, and 'ss' for 'ß'."""
    out = F.lower(c)
    for letter, form in FOLDS.items():
        out = F.replace(out, F.lit(letter), F.lit(form))
    return out


def let(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often `use` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def title_key(c: Column) -> Column:
    return F.regexp_replace(casefold(c), r"[^\p{L}\p{N}]", "")


def scaled(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """floor(10^digits * a / b + 0.5) / 10^digits from integers, the same in every engine; 0 for b = 0."""
    unit = float(10**digits)
    return F.when(denominator == 0, F.lit(0.0)).otherwise(F.floor(numerator / denominator * unit + 0.5) / unit)
