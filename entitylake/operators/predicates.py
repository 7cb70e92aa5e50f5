"""Search predicates as Columns; combine them with ``&``, ``|`` and ``~``.

A predicate on a property holds when any of its values satisfies it and is false, not
NULL, when the property is absent, so ``~`` means "does not have".
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import bounds as B
from entitylake.functions import text as T
from entitylake.functions import tokens as W

_COMPARE = {
    ">": lambda x, y: x > y,
    ">=": lambda x, y: x >= y,
    "<": lambda x, y: x < y,
    "<=": lambda x, y: x <= y,
    "=": lambda x, y: x == y,
}


def search_text() -> Column:
    """Everything a free-text query looks at: properties and bodies, mail without tags."""
    plain = [F.array_join(F.col(f"texts.{f}"), " ") for f in K.HEAVY_FIELDS if f != "bodyHtml"]
    html = F.regexp_replace(
        F.array_join(F.col("texts.bodyHtml"), " "), K.HIGHLIGHT_TAG_PATTERN, " "
    )
    return F.concat_ws(" ", F.flatten(F.map_values("props")), html, *plain)


def search_line() -> Column:
    return W.word_line(search_text())


def search_words() -> Column:
    return W.words(search_text())


# --- Free text ------------------------------------------------------------


def match_all() -> Column:
    return F.lit(True)


def has_phrase(phrase: str, line: Column | None = None) -> Column:
    """The words of ``phrase`` next to each other, as a substring test."""
    wanted = W.literal_words(phrase)
    if not wanted:
        return match_all()
    line = search_line() if line is None else line
    return F.coalesce(F.contains(line, F.lit(f" {' '.join(wanted)} ")), F.lit(False))


def has_term(term: str, line: Column | None = None) -> Column:
    return has_phrase(term, line)


def on_text(test: Callable[[Column], Column]) -> Column:
    """A condition of several terms and phrases on one entity: ``test`` gets the word
    line, which is made once however often it is used."""
    return F.coalesce(T.bind(search_line(), test), F.lit(False))


def has_all(terms: Iterable[str], line: Column | None = None) -> Column:
    wanted = list(terms)
    if line is None:
        return on_text(lambda x: has_all(wanted, x))
    return reduce(and_, [has_phrase(t, line) for t in wanted], match_all())


def has_any(terms: Iterable[str], line: Column | None = None) -> Column:
    wanted = list(terms)
    if line is None:
        return on_text(lambda x: has_any(wanted, x))
    return reduce(or_, [has_phrase(t, line) for t in wanted], F.lit(False))


def must(*conditions: Column) -> Column:
    """All conditions; none at all hold for every entity."""
    return reduce(and_, conditions, match_all())


def must_not(*conditions: Column) -> Column:
    return reduce(and_, [~c for c in conditions], match_all())


def is_close(word: Column, term: str, n: int) -> Column:
    """Edit distance at most ``n``; the length test spares most comparisons."""
    return (F.abs(F.length(word) - len(term)) <= n) & (
        F.levenshtein(word, F.lit(term), n) >= 0
    )


def has_fuzzy(term: str, n: int = 2, words: Column | None = None) -> Column:
    words = search_words() if words is None else words
    wanted = term.lower()
    return F.coalesce(F.exists(words, lambda w: is_close(w, wanted, n)), F.lit(False))


def near(terms: Iterable[str], n: int, words: Column | None = None) -> Column:
    """All terms within a stretch of text whose ends lie ``n`` words apart or less."""
    wanted = list(dict.fromkeys(w for t in terms for w in W.literal_words(t)))
    if not wanted:
        return match_all()

    def close_together(all_words: Column) -> Column:
        places = F.filter(
            F.transform(all_words, lambda w, i: F.when(w.isin(*wanted), i)),
            lambda i: i.isNotNull(),
        )
        return F.exists(
            places,
            lambda i: T.bind(
                F.slice(all_words, i + 1, n + 1),
                lambda stretch: reduce(and_, [F.array_contains(stretch, t) for t in wanted]),
            ),
        )

    words = search_words() if words is None else words
    return F.coalesce(
        T.bind(
            words,
            lambda all_words: reduce(and_, [F.array_contains(all_words, t) for t in wanted])
            & close_together(all_words),
        ),
        F.lit(False),
    )


# --- Properties -----------------------------------------------------------


def values(key: str) -> Column:
    return F.try_element_at("props", F.lit(key))


def linked(key: str) -> Column:
    """Ids that a property points to."""
    return F.coalesce(F.try_element_at("linked", F.lit(key)), values(key))


def _any_value(key: str, test) -> Column:
    return F.coalesce(
        F.exists(values(key), lambda v: F.coalesce(test(v), F.lit(False))), F.lit(False)
    )


def prop_eq(key: str, value: str) -> Column:
    return F.coalesce(F.array_contains(values(key), value), F.lit(False))


def prop_fuzzy(key: str, value: str, n: int = 2) -> Column:
    return _any_value(key, lambda v: is_close(F.lower(v), value.lower(), n))


def prop_regex(key: str, pattern: str) -> Column:
    return _any_value(key, lambda v: v.rlike(rf"\A(?:{pattern})\z"))


def prop_date_cmp(key: str, op: str, date: str) -> Column:
    wanted = F.lit(date).cast("date")
    return _any_value(key, lambda v: _COMPARE[op](v.try_cast("date"), wanted))


def period_end(date: str) -> str:
    """The last day of a year or month; a whole date as it is."""
    parts = [int(part) for part in date.strip().split("-")] if re.fullmatch(r"\d{4}(-\d{1,2})?", date.strip()) else []
    if not parts:
        return date
    month = parts[1] if len(parts) == 2 else 12
    return f"{parts[0]:04d}-{month:02d}-{calendar.monthrange(parts[0], month)[1]:02d}"


def prop_date_between(key: str, low: str, high: str) -> Column:
    """Both ends included: an upper end that is a year or a month counts to its last day."""
    first, last = F.lit(low).cast("date"), F.lit(period_end(high)).cast("date")
    return _any_value(key, lambda v: v.try_cast("date").between(first, last))


def prop_num_cmp(key: str, op: str, number: float) -> Column:
    return _any_value(key, lambda v: _COMPARE[op](v.try_cast("double"), F.lit(float(number))))


def nonempty_props(props: Column) -> Column:
    return F.map_filter(props, lambda k, v: v.isNotNull() & (F.size(v) > 0))


# --- Types, collections and exact filters ---------------------------------


def schema_is(name: str) -> Column:
    return F.col("schema") == name


def schema_in(names: str | Iterable[str]) -> Column:
    return F.col("schema").isin(*B.schema_names(names))


def schemata_in(names: str | Iterable[str]) -> Column:
    """Any of the types or a type below one of them."""
    wanted = F.array(*[F.lit(name) for name in B.schema_names(names)])
    return F.coalesce(F.arrays_overlap("schemata", wanted), F.lit(False))


schemata_is = schemata_in


def with_descendants(entities: DataFrame, names: str | Iterable[str], closure: DataFrame) -> DataFrame:
    """The same by a table of types and ancestors, joined without a job of its own."""
    below = closure.filter(F.col("ancestor").isin(*B.schema_names(names))).select("schema").distinct()
    return entities.join(below, "schema", "left_semi").select(*entities.columns)


def in_collection(collection_id: str) -> Column:
    return F.col("collection_id") == collection_id


def child_of(entity_id: str) -> Column:
    return F.coalesce(F.array_contains("document_ids", entity_id), F.lit(False))


def field_eq(key: str, value: str) -> Column:
    """Exact filter by name: an outer column, or a property with or without prefix."""
    name = key.strip()
    if name in ("schema", "collection_id", "dataset", "id"):
        return F.col(name) == value
    if name == "schemata":
        return F.coalesce(F.array_contains("schemata", value), F.lit(False))
    if name == "properties.document":
        return child_of(value)
    return prop_eq(name.removeprefix("properties."), value)


def extra_filters(filters: Mapping[str, str | None] | None) -> Column:
    """All filters together; blank names and missing values are skipped."""
    wanted = [
        field_eq(key, value)
        for key, value in (filters or {}).items()
        if key.strip() and value is not None
    ]
    return reduce(and_, wanted, match_all())
