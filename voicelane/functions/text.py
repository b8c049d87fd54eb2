"""Text preparation as column expressions.

Every function takes and returns a ``Column`` and is row-local, so a whole
scoring job stays a single scan-and-project without a shuffle or Python worker.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The characters Python's str.split() and \s treat as white space.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
TAG = "<[^>]+>"
APOSTROPHES = "’'`´"
LETTER_RUN = r"([a-z])\1{2,}"
LETTERS = "[a-z]+"
WORD = r"[\p{L}\p{N}_]{2,}"
CLAUSE_BREAK = "[.!?;,]+"
# ----------------------------------------------------------------------------

_RULES = [
    ("lower",),
    ("replace", TAG, " "),
    ("delete", APOSTROPHES),
    ("replace", LETTER_RUN, "$1$1"),
    ("squeeze", WHITESPACE),
    ("strip",),
    ("word", WORD),
]


def rules_fingerprint() -> str:
    """Hash of the normalisation rules, stored with every saved model."""
    return hashlib.sha256(repr(_RULES).encode("utf-8")).hexdigest()[:16]


def _whitespace_chars() -> str:
    spans = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
             (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
             (0x3000, 0x3000)]
    return "".join(chr(c) for lo, hi in spans for c in range(lo, hi + 1))


def normalize(text: Column) -> Column:
    """Lower-case, drop markup and apostrophes, shorten elongations, tidy blanks."""
    out = F.regexp_replace(F.lower(text), TAG, " ")
    # One pass: every blank character becomes a plain space, apostrophes vanish.
    blanks = _whitespace_chars()
    out = F.translate(out, blanks + APOSTROPHES, " " * len(blanks))
    out = F.regexp_replace(out, LETTER_RUN, "$1$1")
    return F.trim(F.regexp_replace(out, " {2,}", " "))


def tokens(norm: Column) -> Column:
    """The a-z runs of normalised text, in order."""
    return F.regexp_extract_all(norm, F.lit(LETTERS), F.lit(0))


def clauses(norm: Column) -> Column:
    """Array of token arrays, one for each non-blank clause."""
    parts = F.filter(F.split(norm, CLAUSE_BREAK), lambda c: F.trim(c) != "")
    return F.transform(parts, tokens)


def words(text: Column) -> Column:
    """Blank-separated words of raw text."""
    return F.regexp_extract_all(text, F.lit(f"[^{WHITESPACE}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def is_blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(f"[^{WHITESPACE}]"))


def model_words(norm: Column) -> Column:
    """The model's words: runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(norm, F.lit(WORD), F.lit(0))


def word_ngrams(unigrams: Column, lo: int = 1, hi: int = 2) -> Column:
    """Word n-grams for every n in lo..hi over a word array column, as one array."""
    if not 1 <= lo <= hi:
        raise ValueError("need 1 <= lo <= hi")
    grams, parts = unigrams, []
    for n in range(1, hi + 1):
        if n > 1:
            # Glue the n-th word onto each (n-1)-gram that has one after it.
            room = F.greatest(F.size(unigrams) - F.lit(n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, F.lit(1), room),
                F.slice(unigrams, F.lit(n), room),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        if n >= lo:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_ngrams(norm: Column, lo: int = 3, hi: int = 5) -> Column:
    """Character n-grams that stay inside a word padded by one blank per side.

    A window over the padded text lies inside one padded word exactly if no
    blank is in its interior, so one look-ahead regex per n lists them all. The
    trailing ``.`` consumes a whole code point, which keeps pairs together. A
    padded word shorter than ``lo`` is listed once, whole.
    """
    if not 2 <= lo <= hi:
        raise ValueError("need 2 <= lo <= hi")
    padded = F.concat(F.lit(" "), norm, F.lit(" "))

    def windows(body: str) -> Column:
        return F.regexp_extract_all(padded, F.lit(f"(?s)(?=({body}))."), F.lit(1))

    parts = [windows(f".[^ ]{{{n - 2}}}.") for n in range(lo, hi + 1)]
    if lo > 3:
        parts.append(windows(f" [^ ]{{1,{lo - 3}}} "))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def shout_intensity(raw: Column) -> Column:
    """Exclamation marks and all-capital words of the raw text, 0..1."""
    bangs = F.length(raw) - F.length(F.replace(raw, F.lit("!"), F.lit("")))
    n_words = F.regexp_count(raw, F.lit("[A-Za-z]{3,}"))
    n_caps = F.regexp_count(raw, F.lit("(?=[A-Z]{3})(?<![A-Za-z])[A-Z]++(?![a-z])"))
    # Words are counted only where there are capital ones to compare with.
    ratio = F.when(n_caps > 0, n_caps / n_words).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), bangs / 3 * 0.5 + ratio * 5 * 0.5)
