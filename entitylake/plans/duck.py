"""SQL fragments for the DuckDB checks: the same rules, written in DuckDB's SQL.

``let`` binds a value to a name with a one-item list, so long expressions appear once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import count

from entitylake import constants as K
from entitylake.functions import html as H
from entitylake.functions import tokens as W

_fresh = count()
_ATTRS = r"(?:\s[^>]*)?"
# Tag by tag instead of in one pass, to check the pass of the Spark side.
_TAG_RULES = (
    *((rf"(?i)<h{n}{_ATTRS}/?>", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (rf"(?i)<li{_ATTRS}/?>", "\n*   "),
    (r"(?i)</li\s*>", "\n"),
    (rf"(?i)<br{_ATTRS}/?>", "\n"),
    (rf"(?i)<hr{_ATTRS}/?>", "\n\n* * *\n\n"),
    (rf"(?i)</?(?:{'|'.join(H.BLOCK_TAGS)}){_ATTRS}/?>", "\n\n"),
    (rf"</?[a-zA-Z][a-zA-Z0-9:._-]*{_ATTRS}/?>", ""),
    (r"<![a-zA-Z][^>]*>", ""),
)
ORIGIN = "https://search.example.org"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = lit(K.WHITESPACE)


def let(value: str, body: Callable[[str], str]) -> str:
    name = f"q{next(_fresh)}"
    return f"list_transform([{value}], lambda {name}: {body(name)})[1]"


def trim(x: str) -> str:
    return f"trim({x}, {WS})"


def rtrim(x: str) -> str:
    return f"rtrim({x}, {WS})"


def replace_all(x: str, pattern: str, replacement: str) -> str:
    groups = replacement.replace("\\", "\\\\")
    for n in (1, 2):
        groups = groups.replace(f"${n}", f"\\{n}")
    return f"regexp_replace({x}, {lit(pattern)}, {lit(groups)}, 'g')"


def last_index(x: str, mark: str) -> str:
    return (
        f"CASE WHEN contains({x}, {lit(mark)}) "
        f"THEN length(regexp_extract({x}, {lit('(?s)^(.*)' + mark)}, 1)) ELSE -1 END"
    )


def cut(x: str, max_chars: int) -> str:
    keep = math.floor(max_chars * K.BOUNDARY_KEEP)

    def shorten(h: str) -> str:
        cases = " ".join(
            f"WHEN {last_index(h, m)} >= {keep} THEN "
            f"{rtrim(f'left({h}, {last_index(h, m)})')} || {lit(m + K.ELLIPSIS)}"
            for m in (K.PARAGRAPH, "\n", " ")
        )
        return f"CASE {cases} ELSE {rtrim(h)} || {lit(K.ELLIPSIS)} END"

    return let(
        x,
        lambda t: f"CASE WHEN length({t}) <= {max_chars} THEN {t} "
        f"ELSE {let(f'left({t}, {max_chars})', shorten)} END",
    )


def guard(x: str, max_chars: int, mark: str, extra: int) -> str:
    keep = math.floor(max_chars * K.SOURCE_CUT_KEEP)

    def shorten(h: str) -> str:
        at = last_index(h, mark)
        return f"CASE WHEN {at} >= {keep} THEN left({h}, {at} + {extra}) ELSE {h} END"

    return let(
        x,
        lambda t: f"CASE WHEN length({t}) <= {max_chars} THEN {t} "
        f"ELSE {let(f'left({t}, {max_chars})', shorten)} END",
    )


def line(x: str) -> str:
    return f"(' ' || trim({replace_all(f'lower({x})', W.SEPARATOR_PATTERN, ' ')}) || ' ')"


def words(x: str) -> str:
    return (
        f"list_filter(string_split_regex(lower({x}), {lit(W.SEPARATOR_PATTERN)}), "
        "lambda w: w <> '')"
    )


def clean_html(x: str) -> str:
    for pattern in K.MAIL_NOISE_PATTERNS:
        x = replace_all(x, pattern, "")
    return x


def collapse(x: str) -> str:
    return replace_all(replace_all(x, K.WHITESPACE_CLASS + "+", " "), *H.TIGHTEN_RULE)


def decode(x: str) -> str:
    names = list(sorted(H.NAMED_REFERENCES.items()))
    table = (
        "MAP {" + ", ".join(f"{lit(n)}: chr({cp})" for n, cp in names) + "}"
    )

    def one(piece: str) -> str:
        return let(
            f"regexp_extract({piece}, {lit(H.REFERENCE_PATTERN)}, 1)",
            lambda n: f"CASE WHEN {n} = '' THEN '&' || {piece} ELSE coalesce("
            f"CASE WHEN starts_with({n}, '#') AND try_cast({n}[2:] AS INTEGER) > 0 "
            f"THEN chr(try_cast({n}[2:] AS INTEGER)) ELSE {table}[{n}] END "
            f"|| {piece}[length({n}) + 2:], '&' || {piece}) END",
        )

    return (
        f"array_to_string(list_transform(string_split({x}, '&'), "
        f"lambda e, i: CASE WHEN i = 1 THEN e ELSE {one('e')} END), '')"
    )


def markdown(x: str) -> str:
    """Conversion for mail without ``pre`` blocks."""
    out = collapse(trim(clean_html(x)))
    for pattern, replacement, _ in H.PAIR_RULES:
        out = replace_all(out, pattern, replacement)
    for pattern, replacement in _TAG_RULES:
        out = replace_all(out, pattern, replacement)
    out = decode(out)
    out = trim(replace_all(out, "\n{3,}", "\n\n"))
    out = (
        f"array_to_string(list_filter(string_split({out}, chr(10)), "
        f"lambda l: NOT regexp_matches(l, {lit(K.STYLE_LINE_PATTERN)})), chr(10))"
    )
    out = trim(replace_all(out, "\n{3,}", "\n\n"))
    out = replace_all(out, K.LEFTOVER_TAG_PATTERN, "")
    return f"nullif({trim(replace_all(out, K.COMMENT_PATTERN, ''))}, '')"


def fragments(rows: str, text: str, terms: list[str], count: int, length: int, keep: list[str]) -> str:
    """Tables that end in ``fragments``: term after term by recursion, for ``WITH RECURSIVE``."""
    any_term = "|".join(terms)
    side = max(0, (length - max(len(t) for t in terms)) // 2)
    names = ", ".join(keep)
    find = f"length(regexp_extract(rest, '(?is)^(.*?)(?:{any_term})', 1))"
    size = f"length(regexp_extract(rest, '(?is)({any_term})', 1))"
    return f"""walk AS (
      SELECT {names}, {text} AS whole, {text} AS rest, 0 AS free, 0 AS n, NULL::INTEGER AS start FROM {rows}
      UNION ALL
      SELECT {names}, whole, whole[stop + 1:] AS rest, stop AS free, n + 1, start FROM (
        SELECT *, greatest(start + {length}, place + wide) AS stop FROM (
          SELECT {names}, whole, n, place, wide, greatest(place - {side}, free) AS start FROM (
            SELECT {names}, whole, n, free, free + {find} AS place, {size} AS wide FROM walk
            WHERE n < {count} AND regexp_matches(rest, '(?is)(?:{any_term})'))))),
    fragments AS (
      SELECT {names}, list(regexp_replace(whole[start + 1:start + {length}], '(?is)({any_term})', '<em>\\1</em>', 'g') ORDER BY n)
        FILTER (start IS NOT NULL) AS found FROM walk GROUP BY ALL)"""


def word_fragments(rows: str, text: str, terms: list[str], count: int, length: int, keep: list[str]) -> str:
    """The same for whole words, unmarked: the sign before what is left decides about its first word."""
    side = max(0, (length - max(len(t) for t in terms)) // 2)
    names = ", ".join(keep)
    word = f"(?:{'|'.join(sorted(terms, key=len, reverse=True))})"
    find = rf"(?is)^(.*?[^\p{{L}}\p{{N}}])({word})(?:[^\p{{L}}\p{{N}}]|$)"
    rest = "CASE WHEN stop = 0 THEN ' ' || whole ELSE substring(whole, stop) END"
    return f"""walk AS (
      SELECT {names}, {text} AS whole, 0 AS stop, 0 AS n, NULL::INTEGER AS start FROM {rows}
      UNION ALL
      SELECT {names}, whole, greatest(start + {length}, place + wide) AS stop, n + 1, start FROM (
        SELECT {names}, whole, n, place, wide, greatest(place - {side}, stop) AS start FROM (
          SELECT {names}, whole, n, stop, greatest(stop - 1, -1) + length(regexp_extract(rest, '{find}', 1)) AS place,
            length(regexp_extract(rest, '{find}', 2)) AS wide FROM (
            SELECT *, {rest} AS rest FROM walk WHERE n < {count}) WHERE regexp_matches(rest, '{find}')))),
    fragments AS (
      SELECT {names}, list(whole[start + 1:start + {length}] ORDER BY n) FILTER (start IS NOT NULL) AS found FROM walk GROUP BY ALL)"""


def strip_highlight(x: str) -> str:
    plain = replace_all(x, K.HIGHLIGHT_TAG_PATTERN, "")
    return trim(replace_all(plain, K.WHITESPACE_CLASS + "+", " "))


# --- The test tables as entities ------------------------------------------

DOC_SEARCH_TEXT = "concat_ws(' ', source || '-' || doc_id || '.txt', lang, 'text/plain', text)"

DOCS = f"""docs AS (
  SELECT 'doc.' || doc_id AS id, doc_id, source, lang, text,
         {DOC_SEARCH_TEXT} AS search_text
  FROM documents)"""

# Every entity with its outer columns and its properties as (key, value) lists.
ENTITIES = """entities AS (
  SELECT 'doc.' || doc_id AS id, 'Pages' AS schema, source AS collection_id,
         MAP {'fileName': source || '-' || doc_id || '.txt', 'languages': lang, 'mimeType': 'text/plain'} AS props
  FROM documents
  UNION ALL
  SELECT DISTINCT 'conv.' || conv_id, 'Pages', 'conversations', MAP {'title': 'Conversation ' || conv_id}
  FROM conversations
  UNION ALL
  SELECT 'conv.' || conv_id || '.' || turn, 'Page', 'conversations',
         MAP {'author': role, 'document': 'conv.' || conv_id, 'index': turn::VARCHAR}
  FROM conversations
  UNION ALL
  SELECT 'mail.' || page_id, 'Email', 'mail', MAP {'subject': regexp_extract(html, '<title>([^<]*)</title>', 1)}
  FROM pages
  UNION ALL
  SELECT 'person.' || c_custkey, 'Person', 'registry',
         MAP {'name': c_name, 'countries': n_name, 'topics': c_mktsegment, 'balance': c_acctbal::VARCHAR}
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'company.' || s_suppkey, 'Company', 'registry',
         MAP {'name': s_name, 'countries': n_name, 'balance': s_acctbal::VARCHAR}
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT 'order.' || o_orderkey, 'Order', 'trade',
         MAP {'customer': 'person.' || o_custkey, 'date': o_orderdate::DATE::VARCHAR, 'status': o_orderstatus,
              'priority': o_orderpriority, 'total': o_totalprice::VARCHAR}
  FROM orders
  UNION ALL
  SELECT DISTINCT 'contract.' || l_orderkey || '.' || l_suppkey, 'Contract', 'trade',
         MAP {'supplier': 'company.' || l_suppkey, 'order': 'order.' || l_orderkey}
  FROM lineitem
  UNION ALL
  SELECT 'event.' || event_id, 'Event', event_type,
         MAP {'k': props->>'$.k', 'date': ts::DATE::VARCHAR, 'value': value::VARCHAR}
  FROM events)"""

CLOSURE = """closure(schema, ancestor) AS (VALUES
  ('Page', 'Page'), ('Page', 'Document'), ('Pages', 'Pages'), ('Pages', 'Document'),
  ('Email', 'Email'), ('Email', 'Document'), ('Person', 'Person'), ('Person', 'LegalEntity'),
  ('Company', 'Company'), ('Company', 'Organization'), ('Company', 'LegalEntity'),
  ('Contract', 'Contract'), ('Contract', 'Interval'), ('Order', 'Order'), ('Order', 'Interval'),
  ('Event', 'Event'), ('Event', 'Interval'))"""
