"""Text normalization as Column expressions.

Each function builds one expression from functions that take part in whole-stage code generation, so
normalizing a column never leaves the JVM and never breaks the generated stage (higher-order functions such as
``transform`` would).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace for Java regular expressions, whose own \s is ASCII only: separators and control characters.
# Written as a category rather than as single code points, which Java matches several times slower.
WS = r"\p{Z}\t-\r\x1c-\x1f\x85"

# Street words and their short forms.
STREET_WORDS = {
    "street": "st",
    "avenue": "ave",
    "boulevard": "blvd",
    "road": "rd",
    "drive": "dr",
    "court": "ct",
    "lane": "ln",
    "place": "pl",
    "circle": "cir",
}


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


#: The ASCII characters of `WS` but for the space, and those that are neither among them nor letter, digit or space.
_WS_ASCII = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x20)]))
_SIGNS = "".join(c for c in map(chr, range(0x80)) if not c.isalnum() and c not in _WS_ASCII + " ")


def _words(text: Column, kept: str, gaps: str, ascii_kept: str = "", ascii_gaps: str = "") -> Column:
    """Keep the characters in ``kept``; a run of ``gaps`` becomes one space; all else goes.

    ``text`` is in lower case. A regular expression costs several times a translation of single characters, so ASCII
    goes through the latter, where ``ascii_kept`` and ``ascii_gaps`` are the signs that ``kept`` and ``gaps`` name; only text
    with other characters, or with longer runs of gaps, takes the expressions.
    """
    spaces = _WS_ASCII + ascii_gaps
    gone = "".join(c for c in _SIGNS if c not in ascii_kept + ascii_gaps)
    simple = F.replace(F.translate(text, spaces + gone, " " * len(spaces)), F.lit("  "), F.lit(" "))
    done = (F.length(simple) == F.octet_length(simple)) & ~F.contains(simple, F.lit("  "))
    cleaned = F.regexp_replace(simple, f"[^{kept}{gaps}]+", "")
    return F.trim(F.when(done, simple).otherwise(F.regexp_replace(cleaned, f"[{gaps}]+", " ")))


def strip_whitespace(column: Column | str) -> Column:
    """Drop Unicode whitespace at both ends (``trim`` alone drops U+0020 only)."""
    return F.regexp_replace(_col(column), f"^[{WS}]+|[{WS}]+$", "")


def is_blank(column: Column | str) -> Column:
    """True when the value is null, empty or whitespace only; never null."""
    return ~F.coalesce(_col(column), F.lit("")).rlike(f"[^{WS}]")


def normalize_name(column: Column | str) -> Column:
    """Lower-case letters and digits, single-spaced; hyphens and underscores count as spaces; null gives ''."""
    return _words(F.lower(F.coalesce(_col(column), F.lit(""))), kept="a-z0-9", gaps=f"{WS}_\\-", ascii_gaps="_-")


def normalize_address(column: Column | str) -> Column:
    """Lower-case words, single-spaced, without punctuation, with street words shortened; null gives ''."""
    lowered = F.lower(F.coalesce(_col(column), F.lit("")))
    words = _words(lowered, kept=r"a-z0-9_\p{L}\p{N}", gaps=WS, ascii_kept="_")
    # Give every word a space of its own on both sides, so that a plain literal replacement of " word " hits
    # whole words only and also hits neighbouring repeats.
    padded = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    shortened = reduce(
        lambda text, pair: F.replace(text, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")),
        STREET_WORDS.items(),
        padded,
    )
    return F.trim(F.replace(shortened, F.lit("  "), F.lit(" ")))


def address_source(city: Column | str, state: Column | str) -> Column:
    """City and state joined by one space; nulls count as ''."""
    return F.concat(F.coalesce(_col(city), F.lit("")), F.lit(" "), F.coalesce(_col(state), F.lit("")))


def normalize_zip(column: Column | str) -> Column:
    """First five digits, zero-padded on the left; '' when there is no digit or the value is null."""
    digits = F.regexp_replace(_col(column), r"\P{Nd}+", "")
    # Null takes the place of '' on the way: a condition on the digits would evaluate the expression once more.
    return F.coalesce(F.lpad(F.nullif(F.substring(digits, 1, 5), F.lit("")), 5, "0"), F.lit(""))
