"""Text features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define the features.
TITLE_PATTERN = r"([A-Za-z]+)\."
PARENTHESES_PATTERN = r"\(([A-Za-z ]+)\)"
LETTERS_PATTERN = r"([A-Za-z]+)"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    """NULL for an empty string, else the string."""
    return F.nullif(_column(c), F.lit(""))


def title_prefix(c: Column | str) -> Column:
    """First word that a period follows; ``''`` if there is none, NULL for NULL."""
    return F.regexp_extract(_column(c), TITLE_PATTERN, 1)


def optional_capture(
    c: Column | str, pattern: str = PARENTHESES_PATTERN, group: int = 1
) -> Column:
    """One capture group of ``pattern``; NULL if the pattern does not match."""
    return empty_to_null(F.regexp_extract(_column(c), pattern, group))


def alpha_code(c: Column | str) -> Column:
    """First run of letters in upper case; NULL if there is none."""
    return F.upper(optional_capture(c, LETTERS_PATTERN, 1))


def first_char(c: Column | str) -> Column:
    """First character; ``''`` for ``''``, NULL for NULL."""
    return F.substring(_column(c), 1, 1)


def token_count(c: Column | str) -> Column:
    """Number of space-separated tokens as a string: ``'0'`` for NULL, ``'1'`` for ``''``.

    Splitting gives one token more than there are spaces, so spaces are counted by the bytes that
    removing them saves (a space is one byte in UTF-8). No array of tokens is built, and NULL is
    tested on the input because the size of a NULL array depends on the ANSI setting.
    """
    text = _column(c)
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text.isNull(), F.lit("0")).otherwise((spaces + 1).cast("string"))
