"""Text expressions. All run inside the JVM; none needs a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as whitespace when stripping and splitting.
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# The same set as a negated class: the Unicode property is much faster than listed ranges.
NOT_SPACE = r"(?U)[^\s\x1c\x1d\x1e\x1f]+"
CYRILLIC_WORD = "[а-яё]{3,}"
ANY_LETTER_WORD = r"\p{L}{3,}"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def strip(c: Column) -> Column:
    """Trim every kind of whitespace, not only U+0020."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def text_length(c: Column) -> Column:
    return F.length(c)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NOT_SPACE))


def average_word_length(c: Column) -> Column:
    """Characters per whitespace-separated word; null when there is no word."""
    return average_length(F.length(c), word_count(c))


def average_length(length, words) -> Column:
    return F.round(F.try_divide(length, words), 2)


def punctuation_ratio(c: Column) -> Column:
    """Share of characters that are an exclamation mark, question mark or ellipsis."""
    return F.regexp_count(c, F.lit("[!?…]")) / F.greatest(F.length(c), F.lit(1))


def letter_words(c: Column, pattern: str = CYRILLIC_WORD) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))


def tokens(c: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    A named computed column used twice may be inlined twice by the optimizer; a
    lambda variable is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def one_and_two_grams(c: Column) -> Column:
    """Every token followed by every pair of neighbouring tokens joined by a blank."""
    def grams(t: Column) -> Column:
        n = F.size(t)
        pairs = F.zip_with(
            F.slice(t, F.lit(1), F.greatest(n - 1, F.lit(0))),
            F.slice(t, F.lit(2), F.greatest(n - 1, F.lit(0))),
            lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(t, pairs)
    return let(tokens(c), grams)


def shorten(c: Column, limit: int = 200) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("…"))).otherwise(c)
