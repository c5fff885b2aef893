"""Text clean-up, word splitting and casing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the cleaning and tokenising rules.
COPYRIGHT_TAIL = r"©[^\n]*"
KEYWORD_TAIL = r"(?iu)keywords?:[^\n]*"
NON_ASCII_RUN = r"[^\x00-\x7F]+"
ASCII_SPACES = r"\t-\r\x1c-\x20"
SPACE_RUN = f"[{ASCII_SPACES}]+"
# Letters and blanks are spelled out: single characters are looked up in a bit table by the regular
# expression engine, ranges are tested one by one.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SINGLE_SPACES = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f "
NOT_TOKEN_CHAR = f"[^{LETTERS}{SINGLE_SPACES}]+"
WIDE_SPACES = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
NOT_LETTERS = f"[^{LETTERS}]+"
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WORD_AND_BREAK = f"[^{SINGLE_SPACES}]++[{SINGLE_SPACES}]*+"
WORD_CHARS = r"[\p{L}\p{N}_]{2,}"
MIN_TOKEN_LENGTH = 3


def clean_text(text: Column, null_text: str = "") -> Column:
    """Drop copyright and keyword tails line by line, then everything outside ASCII.

    Runs of non-ASCII characters and runs of white space become one blank. A null becomes
    ``null_text``: empty by default, so that later filters drop the row.
    """
    out = F.coalesce(text, F.lit(null_text))
    out = F.regexp_replace(out, COPYRIGHT_TAIL, "")
    out = F.regexp_replace(out, KEYWORD_TAIL, "")
    out = F.regexp_replace(out, NON_ASCII_RUN, " ")
    return F.trim(F.regexp_replace(out, SPACE_RUN, " "))


def plain_spaces(text: Column) -> Column:
    """White space beyond ASCII as blanks: patterns that name it cost ten times as much a character."""
    beyond_ascii = F.octet_length(text) != F.length(text)
    return F.when(beyond_ascii, F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))).otherwise(text)


def whitespace_words(text: Column) -> Column:
    """Words between white space, empty pieces removed."""
    return F.filter(F.split(plain_spaces(text), f"[{SINGLE_SPACES}]+"), lambda w: w != "")


def count_words(text: Column) -> Column:
    """Number of words between white space: each word shrinks to one letter, so no word is copied or kept in an array."""
    return F.length(F.regexp_replace(F.ltrim(plain_spaces(text), F.lit(SPACE_CHARS)), WORD_AND_BREAK, "x"))


def word_terms(text: Column) -> Column:
    """Lower-case terms of two or more letters, digits or underscores, any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CHARS), F.lit(0))


def drop_words(words: Column, stopwords) -> Column:
    """Remove ``stopwords`` from an array column; duplicates and order stay.

    A long ``isin`` list turns into a hash-set test, so the cost per word is constant.
    """
    stop = sorted(set(stopwords))
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def tokens(text: Column, stopwords=(), min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Lower-case letter-only tokens of at least ``min_length``, stop words removed.

    Characters outside a-z are deleted rather than blanked: "state-of-the-art" gives
    "stateoftheart" and "don't" gives "dont".
    """
    lowered = F.lower(text)
    beyond_ascii = F.octet_length(text) != F.length(text)
    spaced = F.when(beyond_ascii, F.translate(lowered, WIDE_SPACES, " " * len(WIDE_SPACES))).otherwise(lowered)
    kept = F.regexp_replace(spaced, NOT_TOKEN_CHAR, "")
    stop = sorted(set(stopwords))

    def keep(word: Column) -> Column:
        long_enough = F.length(word) >= min_length
        return long_enough & ~word.isin(*stop) if stop else long_enough

    # only letters and white space are left
    return F.filter(F.split(kept, NOT_LETTERS), keep)


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere ("Don'T", "3D")."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def title_line(text: Column) -> Column:
    """First line of a text."""
    return F.substring_index(text, "\n", 1)


def body_lines(text: Column) -> Column:
    """Everything after the first line; empty when there is only one line."""
    at = F.instr(text, "\n")
    return F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(F.lit(""))
