"""Small string expressions used across the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SQL LIKE without an escape character: \u0001 never occurs in the data, so
# backslashes are plain characters, as in the source system's LIKE.
NO_ESCAPE = "\u0001"


def term_code(year: Column) -> Column:
    """Requirement year -> term code: drop blanks, then drop the 2nd character.

    ``'20187'`` and ``'2018 7'`` -> ``'2187'``. NULL stays NULL, '' stays ''.
    """
    y = F.replace(year, F.lit(" "), F.lit(""))
    return F.when(year.isNull() | (year == ""), year).otherwise(
        F.concat(F.substring(y, 1, 1), F.substring(y, 3, 1 << 30)))


def like(value: Column, pattern: Column) -> Column:
    """``value LIKE pattern`` with a column pattern and no escape character."""
    return F.like(value, pattern, F.lit(NO_ESCAPE))


def eq_blank_padded(value: Column, literal: str) -> Column:
    """CHAR-style equality: trailing blanks of the column are ignored."""
    return F.rtrim(value) == F.lit(literal)


def third_from_last_in(value: Column, digits: str) -> Column:
    """``value LIKE '%d__'`` for any d in ``digits`` (length >= 3 implied)."""
    return (F.char_length(value) >= 3) & F.substring(value, -3, 1).isin(*list(digits))
