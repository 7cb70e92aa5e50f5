"""Regular expressions over property values, with candidates from a table of trigrams.

The literal parts of a pattern name trigrams that every match must hold. Values that hold all of
them are found by counting rows of a stored table, whose buckets are the only ones opened; the
pattern itself runs over these candidates alone. Each distinct value is stored once, however many
entities have it. A pattern without three literal characters in a row scans the values, and
``required_trigrams`` says so.
"""

from __future__ import annotations

import re
import string
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.operators import predicates as P
from entitylake.sources.buckets import BUCKETS, read_buckets, write_buckets

try:
    from re import _parser as _patterns
except ImportError:
    import sre_parse as _patterns

#: Alternatives of one pattern that are looked up apart; a pattern with more of them scans.
MAX_ALTERNATIVES = 64


# --- What a pattern requires ----------------------------------------------


#: What Java reads in another way than the parser used here: flags, quotes, classes inside classes, numbers.
_UNLIKE = re.compile(r"\(\?[a-zA-Z^-]|\\[QEpPXRhHVNkGxuc0]|\\\d\d|&&|\[[^\]]*\[")


def _lower(text: str) -> str:
    return "".join(c.lower() if c in string.ascii_letters else c for c in text)


class _Literals:
    """Literal stretches of one alternative: closed ones, and one that the next literal continues."""

    def __init__(self, closed: frozenset[str] = frozenset(), open_end: str = "") -> None:
        self.closed, self.open_end = closed, open_end

    def literal(self, char: str) -> _Literals:
        return _Literals(self.closed, self.open_end + char)

    def broken(self) -> _Literals:
        return _Literals(self.closed | {self.open_end}) if self.open_end else self


def _walk(nodes, found: list[_Literals]) -> list[_Literals]:
    """Literals of all alternatives behind those in ``found``; whatever is not understood breaks a stretch."""
    for kind, value in nodes:
        name = str(kind)
        if name == "LITERAL":
            found = [x.literal(chr(value)) for x in found]
        elif name == "SUBPATTERN":
            found = _walk(value[3], found)
        elif name == "BRANCH":
            found = [x for branch in value[1] for x in _walk(branch, found)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
            # The first time belongs to the stretch before it; what follows may be a repetition.
            found = [x.broken() for x in _walk(value[2], found)]
        elif name not in ("AT",):
            found = [x.broken() for x in found]
        if len(found) > MAX_ALTERNATIVES:
            raise ValueError("too many alternatives")
    return found


def required_trigrams(pattern: str) -> list[frozenset[str]] | None:
    """Per alternative of the pattern the trigrams that a match holds, in small ASCII letters.

    None where some alternative requires none, so that only a scan is right. Inline flags other
    than ``(?i)`` at the start and syntax that is not understood count as such.
    """
    body = pattern.removeprefix("(?i)")
    fold = body != pattern
    if _UNLIKE.search(body):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            found = _walk(_patterns.parse(body), [_Literals()])
    except (re.error, ValueError, OverflowError, RecursionError, FutureWarning, DeprecationWarning):
        return None
    out = []
    for literals in found:
        stretches = [_lower(s) for s in literals.broken().closed]
        grams = {s[i : i + 3] for s in stretches for i in range(len(s) - 2)}
        if fold:
            grams = {g for g in grams if g.isascii()}
        if not grams:
            return None
        out.append(frozenset(grams))
    return list(dict.fromkeys(out))


# --- The stored table -----------------------------------------------------


def trigrams_of(value: Column) -> Column:
    """Distinct stretches of three characters, in small ASCII letters."""
    lowered = F.translate(value, string.ascii_uppercase, string.ascii_lowercase)
    places = F.when(F.length(lowered) >= 3, F.sequence(F.lit(1), F.length(lowered) - 2)).otherwise(
        F.array().cast("array<int>")
    )
    # Characters as an array: a substring of a long text would be sought from its start each time.
    signs = F.split(lowered, "")
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(signs, i, 3), "")))


def property_values(entities: DataFrame, key: str) -> DataFrame:
    """The distinct values of a property: ``value``."""
    return entities.select(F.explode(P.values(key)).alias("value")).filter(F.col("value").isNotNull()).distinct()


def value_trigrams(values: DataFrame) -> DataFrame:
    """``gram, value`` for a table of distinct values."""
    return values.select(F.explode(trigrams_of(F.col("value"))).alias("gram"), "value")


def write_trigrams(grams: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    write_buckets(grams, path, "gram", "value", buckets=buckets)


def read_trigrams(spark: SparkSession, path: str, pattern: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The stored table; with a pattern only the buckets of what it requires."""
    required = None if pattern is None else required_trigrams(pattern)
    wanted = None if required is None else sorted(set().union(*required))
    return read_buckets(spark, path, "gram", wanted, buckets)


def matching_values(values: DataFrame, grams: DataFrame, pattern: str) -> DataFrame:
    """The values that a pattern matches as a whole; ``values`` are scanned only if they must be."""
    whole = F.col("value").rlike(rf"\A(?:{pattern})\z")
    required = required_trigrams(pattern)
    if required is None:
        return values.filter(whole)
    wanted = sorted(set().union(*required))
    held = grams.filter(F.col("gram").isin(*wanted)).groupBy("value").agg(F.collect_set("gram").alias("held"))

    def complete(one: frozenset[str]) -> Column:
        # Whatever the alternative, its trigrams are few; `held` has no more than all of them.
        return F.size(F.array_intersect("held", F.array(*[F.lit(g) for g in sorted(one)]))) == len(one)

    candidates = held.filter(reduce(lambda a, b: a | b, [complete(one) for one in required])).select("value")
    return candidates.filter(whole)


def regex_ids(entities: DataFrame, key: str, grams: DataFrame, pattern: str) -> DataFrame:
    """Ids of entities with a value of ``key`` that the pattern matches; equal to ``predicates.prop_regex``.

    Entities meet the matched values in a semi join.
    """
    values = property_values(entities, key)
    found = matching_values(values, grams, pattern)
    named = entities.select("id", F.explode(F.array_distinct(P.values(key))).alias("value"))
    return named.join(found, "value", "left_semi").select("id").distinct()
