"""Text expressions: trimming, cutting, flattening and number prefixes.

All functions take and return Columns. Lengths count code points, so they differ
from a UTF-16 count only for characters outside the basic plane.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitylake import constants as K


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    Without it a long expression that is used ten times is planned, and often run, ten
    times, and filters pushed below a projection multiply it again.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def replace_where(text: Column, sign: str, pattern: str, replacement: str) -> Column:
    """``regexp_replace`` only for texts that hold ``sign``, without which the pattern
    cannot match; looking for a sign is far cheaper than a pattern."""
    return bind(
        text,
        lambda t: F.when(
            F.contains(t, F.lit(sign)), F.regexp_replace(t, pattern, replacement)
        ).otherwise(t),
    )


def squeeze_newlines(text: Column) -> Column:
    """Three and more line breaks become two."""
    return replace_where(text, "\n\n\n", "\n{3,}", "\n\n")


def literal_map(entries: dict[str, str]) -> Column:
    """A constant map, as one SQL expression instead of a call for every entry."""

    def quoted(text: str) -> str:
        escaped = text.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    return F.expr(f"map({', '.join(quoted(x) for pair in entries.items() for x in pair)})")


def js_trim(text: Column) -> Column:
    """Trim every Unicode white-space character, not only U+0020."""
    return F.btrim(text, F.lit(K.WHITESPACE))


def js_trim_end(text: Column) -> Column:
    return F.rtrim(text, F.lit(K.WHITESPACE))


def nonblank(text: Column) -> Column:
    """The trimmed text, or NULL when nothing is left."""
    return F.nullif(js_trim(text), F.lit(""))


def trimmed_values(values: Column) -> Column:
    """Trim each array item and drop the blank ones."""
    return F.filter(F.transform(values, js_trim), lambda v: v != "")


def flatten_text(values: Column) -> Column:
    """Join string items with a blank line; NULL when no item has text."""
    return F.nullif(F.array_join(trimmed_values(values), K.PARAGRAPH), F.lit(""))


def first_text(*candidates: Column) -> Column:
    """First flattened text among several value lists."""
    return F.coalesce(*[flatten_text(c) for c in candidates])


def unify_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def last_index(text: Column, needle: str) -> Column:
    """Zero-based position of the last ``needle``, or -1."""
    tail = F.substring_index(text, needle, -1)
    return F.when(
        F.contains(text, F.lit(needle)),
        F.length(text) - F.length(tail) - F.lit(len(needle)),
    ).otherwise(F.lit(-1))


def cut_at_boundary(text: Column, max_chars: int) -> Column:
    """Cut at the last blank line, line break or space that keeps enough text.

    A result can be one character longer than ``max_chars`` because the ellipsis
    comes on top of a hard cut; ``max_chars <= 0`` leaves the text alone.
    """
    if max_chars <= 0:
        return text
    keep = math.floor(max_chars * K.BOUNDARY_KEEP)

    def shorten(head: Column) -> Column:
        marks = (K.PARAGRAPH, "\n", " ")
        found = F.array(
            *[F.struct(last_index(head, m).alias("at"), F.lit(m + K.ELLIPSIS).alias("end")) for m in marks]
        )
        best = F.coalesce(
            F.get(F.filter(found, lambda c: c.getField("at") >= keep), F.lit(0)),
            F.struct(F.lit(max_chars).alias("at"), F.lit(K.ELLIPSIS).alias("end")),
        )
        return bind(
            best,
            lambda c: F.concat(js_trim_end(F.left(head, c.getField("at"))), c.getField("end")),
        )

    return bind(
        text,
        lambda t: F.when(F.length(t) <= max_chars, t).otherwise(
            bind(F.left(t, F.lit(max_chars)), shorten)
        ),
    )


def _guard(text: Column, max_chars: int, mark: str, extra: int) -> Column:
    """The whole text, or its head up to a late ``mark``."""
    keep = math.floor(max_chars * K.SOURCE_CUT_KEEP)

    def shorten(head: Column) -> Column:
        return bind(
            last_index(head, mark),
            lambda at: F.when(at >= keep, F.left(head, at + extra)).otherwise(head),
        )

    return bind(
        text,
        lambda t: F.when(F.length(t) <= max_chars, t).otherwise(
            bind(F.left(t, F.lit(max_chars)), shorten)
        ),
    )


def guard_html(html: Column, max_chars: int = K.MAX_CONVERSION_CHARS) -> Column:
    """Limit markup to ``max_chars``, ending after a late ``>`` when there is one."""
    return _guard(html, max_chars, ">", 1)


def guard_plain(text: Column, max_chars: int = K.MAX_CONVERSION_CHARS) -> Column:
    """Limit plain text to ``max_chars``, ending before a late line break."""
    return _guard(text, max_chars, "\n", 0)


# The same class as K.WHITESPACE_CLASS. Java tests a class part by part, so ruling out
# printable ASCII first makes nearly every character cost one test instead of ten.
_SPACE = r"[[^\x21-\x7E]&&" + K.WHITESPACE_CLASS + "]"
_UNEVEN_SPACE = rf"[[^\x20-\x7E]&&{K.WHITESPACE_CLASS}]{_SPACE}*| {_SPACE}+"


def collapse_space(text: Column) -> Column:
    """Every run of white space becomes one space; single spaces are left as they are."""
    return F.regexp_replace(text, _UNEVEN_SPACE, " ")


def strip_highlight(snippet: Column) -> Column:
    """Remove markup from one snippet and collapse its white space."""
    plain = F.regexp_replace(snippet, K.HIGHLIGHT_TAG_PATTERN, "")
    return js_trim(collapse_space(plain))


def highlight_text(snippets: Column) -> Column:
    """All snippets as plain text; NULL when none has any."""
    plain = F.filter(F.transform(snippets, strip_highlight), lambda s: s != "")
    return F.nullif(F.array_join(plain, K.HIGHLIGHT_JOINER), F.lit(""))


def leading_integer(text: Column) -> Column:
    """Integer prefix of a string: ``'12abc'`` gives 12, ``'abc'`` gives NULL."""
    prefix = F.regexp_extract(text, r"^" + K.WHITESPACE_CLASS + r"*([+-]?[0-9]+)", 1)
    return F.nullif(prefix, F.lit("")).try_cast("double")


def first_leading_integer(values: Column) -> Column:
    """First usable number in a list of display strings."""
    numbers = F.filter(F.transform(values, leading_integer), lambda n: n.isNotNull())
    return F.get(numbers, F.lit(0))


def preview(values: Column, max_chars: int) -> Column:
    """First value only, hard cut with three dots."""
    return bind(
        F.get(values, F.lit(0)),
        lambda first: F.when(
            F.length(first) > max_chars,
            F.concat(F.left(first, F.lit(max_chars)), F.lit(K.PREVIEW_SUFFIX)),
        ).otherwise(first),
    )


def is_email(schema: Column) -> Column:
    return F.lower(js_trim(schema)) == K.EMAIL_SCHEMA


def is_page(schema: Column) -> Column:
    return F.lower(js_trim(schema)).isin(*K.PAGE_SCHEMAS)


def is_page_parent(schema: Column) -> Column:
    return F.lower(js_trim(schema)) == K.PARENT_SCHEMA


def name_list(text: Column) -> Column:
    """Names separated by commas or white space: in order, without repeats."""
    parts = F.split(text, rf"(?:,|{K.WHITESPACE_CLASS})+")
    return F.array_distinct(F.filter(parts, lambda name: name != ""))
