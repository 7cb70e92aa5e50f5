"""Words of a text, in the two forms the search predicates need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters and digits in any script, lower-cased.
SEPARATOR_PATTERN = r"[^\p{L}\p{N}]+"


def word_line(text: Column) -> Column:
    """``' word word '``: single spaces, one at each end, so words and phrases
    are found by a plain substring test."""
    words = F.btrim(F.regexp_replace(F.lower(text), SEPARATOR_PATTERN, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def words(text: Column) -> Column:
    """The words as an array, in text order."""
    return F.filter(F.split(F.lower(text), SEPARATOR_PATTERN), lambda w: w != "")


def literal_words(text: str) -> list[str]:
    """The same split for a query literal."""
    out, current = [], []
    for char in text.lower():
        if char.isalnum():
            current.append(char)
        elif current:
            out.append("".join(current))
            current = []
    if current:
        out.append("".join(current))
    return out
