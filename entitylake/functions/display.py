"""Display values of JSON properties held as VARIANT.

Expressions cannot recurse, so nesting is opened level by level: lists to the depth the
display rule itself allows, names inside objects and numbers inside lists by a fold with as
many steps as the value's own type has levels.

The fragments are SQL text because one parsed expression is far cheaper to build than
hundreds of Column calls. ``v`` is always a SQL expression of type VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitylake import constants as K

_WS = "'" + K.WHITESPACE.replace("\\", "\\\\") + "'"
_fresh = count()


def _name(prefix: str) -> str:
    return f"{prefix}{next(_fresh)}"


def _kind(v: str) -> str:
    return f"schema_of_variant({v})"


# These look one level deep only, while the kind of a value describes all of it.
def _is_object(v: str) -> str:
    return f"(try_variant_get({v}, '$', 'map<string,variant>') IS NOT NULL)"


def _is_array(v: str) -> str:
    return f"(try_variant_get({v}, '$', 'array<variant>') IS NOT NULL)"


def _get(v: str, key: str, kind: str = "variant") -> str:
    return f"try_variant_get({v}, '$.{key}', '{kind}')"


def _items(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def _text(v: str) -> str:
    """The string itself when ``v`` is a JSON string."""
    return f"IF({_kind(v)} = 'STRING', CAST({v} AS STRING), NULL)"


def _nonblank(s: str) -> str:
    return f"nullif(btrim({s}, {_WS}), '')"


def _nonempty(s: str) -> str:
    return f"nullif({s}, '')"


def _number(v: str) -> str:
    return f"regexp_replace(CAST({v} AS STRING), '[.]0$', '')"


def _let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it under a name."""
    bound = _name("b")
    return f"get(transform(array({value}), {bound} -> {body(bound)}), 0)"


def _expand(values: str, step: Callable[[str], str], times: int) -> str:
    """Replace each item by the items ``step`` gives for it, in place, several times."""
    for _ in range(times):
        item = _name("x")
        values = f"flatten(transform({values}, {item} -> {step(item)}))"
    return values


def _opened(v: str, step: Callable[[str], str]) -> str:
    """The items that ``step`` gives for ``v`` and for what comes out, to the last level.

    The type of a value names each level once, whatever the length of its lists, so its
    brackets bound the number of steps.
    """
    done, i, item = _name("s"), _name("i"), _name("x")

    def fold(kind: str) -> str:
        levels = f"sequence(0, length({kind}) - length(replace({kind}, '<', '')))"
        return f"aggregate({levels}, array({v}), ({done}, {i}) -> flatten(transform({done}, {item} -> {step(item)})))"

    return _let(_kind(v), fold)


def _unnest(x: str) -> str:
    return f"IF({_is_array(x)}, {_items(x)}, array({x}))"


def _by_kind(v: str, branches: dict[str, str], otherwise: str) -> str:
    """Choose by the kind of ``v``, which is worked out once. Keys are prefixes."""

    def choose(kind: str) -> str:
        cases = " ".join(f"WHEN startswith({kind}, '{k}') THEN {e}" for k, e in branches.items())
        return f"CASE {cases} ELSE {otherwise} END"

    return _let(_kind(v), choose)


def _unnest_name(x: str) -> str:
    names = f"array({_get(x, 'name')}, {_get(x, 'properties.name')})"
    return _by_kind(x, {"STRING": f"array({x})", "OBJECT": names, "ARRAY": _items(x)}, "array()")


def _first_name(v: str) -> str:
    """First non-blank string: the string, array items in turn, an object's name."""

    def search(start: str) -> str:
        leaf, kept = _name("n"), _name("n")
        leaves = _opened(start, _unnest_name)
        return (
            f"get(filter(transform({leaves}, {leaf} -> {_nonblank(_text(leaf))}), "
            f"{kept} -> {kept} IS NOT NULL), 0)"
        )

    return _let(v, lambda n: f"IF({n} IS NULL, NULL, coalesce({_nonblank(_text(n))}, {search(n)}))")


def _object_text(v: str) -> str:
    """caption, label, name, schema and id, id, or JSON text; in that order."""
    entity_id = _nonempty(_text(_get(v, "id")))
    schema = _nonempty(_text(_get(v, "schema")))
    has_name = f"coalesce({_kind(_get(v, 'name'))} <> 'VOID', false)"
    name_source = f"IF({has_name}, {_get(v, 'name')}, {_get(v, 'properties')})"
    keep = K.MAX_DISPLAY_JSON_CHARS - len(K.PREVIEW_SUFFIX)
    json = _let(
        f"nullif(to_json({v}), '{{}}')",
        lambda j: f"IF(length({j}) > {K.MAX_DISPLAY_JSON_CHARS}, "
        f"left({j}, {keep}) || '{K.PREVIEW_SUFFIX}', {j})",
    )
    return (
        "coalesce("
        f"{_first_name(_get(v, 'caption'))}, "
        f"{_nonblank(_text(_get(v, 'label')))}, "
        f"{_first_name(name_source)}, "
        f"{schema} || ':' || {entity_id}, "
        f"{entity_id}, "
        f"{json})"
    )


def _scalar_text(v: str, nested: str) -> str:
    """One value as text; ``nested`` says what a list becomes."""
    return _by_kind(
        v,
        {
            "STRING": _nonblank(f"CAST({v} AS STRING)"),
            "VOID": "NULL",
            "OBJECT": _object_text(v),
            "ARRAY": nested,
        },
        _number(v),
    )


def _display(v: str) -> str:
    """One value as text. Nested lists share one separator, so joining the leaves in
    order gives the same text as joining level by level."""
    leaf, kept = _name("d"), _name("d")
    leaves = _expand(_items(v), _unnest, K.MAX_DISPLAY_ARRAY_DEPTH)
    joined = (
        f"array_join(filter(transform({leaves}, {leaf} -> {_scalar_text(leaf, 'NULL')}), "
        f"{kept} -> {kept} IS NOT NULL), ', ')"
    )
    return _scalar_text(v, _nonempty(joined))


def _display_list(v: str) -> str:
    item = _name("v")
    return (
        f"filter(transform({_unnest(v)}, {item} -> {_display(item)}), {item} -> {item} IS NOT NULL)"
    )


def _text_list(v: str) -> str:
    """String items only, trimmed, blank ones dropped; other shapes give an empty list."""
    item = _name("t")
    return (
        f"filter(transform({_unnest(v)}, {item} -> {_nonblank(_text(item))}), "
        f"{item} -> {item} IS NOT NULL)"
    )


def _first_number(v: str) -> str:
    """A number, the integer prefix of a string, or the first of these in a list of any depth."""

    def scalar(x: str) -> str:
        kind = _kind(x)
        prefix = f"regexp_extract(CAST({x} AS STRING), '^{_ws_class()}*([+-]?[0-9]+)', 1)"
        return (
            f"CASE WHEN {kind} = 'STRING' THEN try_cast(nullif({prefix}, '') AS DOUBLE) "
            f"WHEN {kind} IN ('BIGINT', 'DOUBLE') OR startswith({kind}, 'DECIMAL') "
            f"THEN try_variant_get({x}, '$', 'double') END"
        )

    item, kept = _name("i"), _name("k")
    found = f"filter(transform({_opened(v, _unnest)}, {item} -> {scalar(item)}), {kept} -> {kept} IS NOT NULL)"
    return f"IF({_is_array(v)}, get({found}, 0), {scalar(v)})"


def _ws_class() -> str:
    return K.WHITESPACE_CLASS.replace("\\", "\\\\")


def _reference(v: str) -> str:
    """A linked entity reduced to schema, caption and id."""
    fields = ", ".join(f"'{k}', {_text(_get(v, k))}" for k in ("schema", "caption", "id"))
    return f"named_struct({fields})"


def _references(v: str) -> str:
    item = _name("r")
    objects = f"filter({_unnest(v)}, {item} -> {_is_object(item)})"
    compact = f"transform({objects}, {item} -> {_reference(item)})"
    return _let(compact, lambda c: f"IF(size({c}) > 0, {c}, NULL)")


def _recipients(v: str) -> str:
    item = _name("p")
    entry = (
        f"named_struct('schema', {_text(_get(item, 'schema'))}, 'id', {_text(_get(item, 'id'))}, "
        f"'name', {_first_name(_get(item, 'properties.name'))}, "
        f"'email', {_first_name(_get(item, 'properties.email'))})"
    )
    objects = f"filter({_items(v)}, {item} -> {_is_object(item)})"
    kept = (
        f"filter(transform({objects}, {item} -> {entry}), {item} -> "
        f"coalesce({item}.schema, {item}.id, {item}.name, {item}.email) IS NOT NULL)"
    )
    return _let(kept, lambda c: f"IF(size({c}) > 0, {c}, NULL)")


# --- Columns --------------------------------------------------------------


def display_map(properties: str) -> Column:
    """``MAP<STRING, VARIANT>`` to display lists, empty ones left out."""
    return F.expr(
        f"map_filter(transform_values({properties}, (k, x) -> {_display_list('x')}), "
        "(k, x) -> size(x) > 0)"
    )


def text_list(v: str) -> Column:
    return F.expr(_text_list(v))


def string_field(v: str, key: str) -> Column:
    return F.expr(_text(_get(v, key)))


def first_number(v: str) -> Column:
    return F.expr(_first_number(v))


def references(v: str) -> Column:
    return F.expr(_references(v))


def recipients(v: str) -> Column:
    return F.expr(_recipients(v))


def present_keys(properties: str) -> Column:
    """Keys whose value is neither null nor an empty list; blank strings count."""
    return F.expr(
        f"map_keys(map_filter({properties}, (k, x) -> NOT is_variant_null(x) "
        "AND coalesce(size(try_variant_get(x, '$', 'array<variant>')), 1) <> 0))"
    )


def score(v: str) -> Column:
    """``score``, or ``_score`` when the first is absent; finite numbers only."""

    def number(x: str) -> str:
        kind = _kind(x)
        value = f"try_variant_get({x}, '$', 'double')"
        return (
            f"IF({kind} IN ('BIGINT', 'DOUBLE') OR startswith({kind}, 'DECIMAL') "
            f"OR {kind} = 'FLOAT', {value}, NULL)"
        )

    first, second = _get(v, "score"), _get(v, "_score")
    given = f"coalesce({_kind(first)} <> 'VOID', false)"
    either = f"IF({given}, {number(first)}, {number(second)})"
    return F.expr(_let(either, lambda n: f"IF(abs({n}) < double('Infinity'), {n}, NULL)"))


def _linked_ids(v: str) -> str:
    item, kept = _name("l"), _name("l")
    one = f"IF({_is_object(item)}, {_text(_get(item, 'id'))}, {_nonblank(_text(item))})"
    ids = (
        f"filter(transform({_unnest(v)}, {item} -> {one}), {kept} -> {kept} IS NOT NULL)"
    )
    return _let(ids, lambda c: f"IF(size({c}) > 0, {c}, NULL)")


def linked_ids(v: str) -> Column:
    """Ids a property points to: strings as they are, nested entities by their id."""
    return F.expr(_linked_ids(v))


def linked_map(properties: str) -> Column:
    """Ids of the properties that hold nested entities; NULL when none does."""
    item = _name("o")
    nested = f"map_filter({properties}, (k, x) -> exists({_unnest('x')}, {item} -> coalesce({_is_object(item)}, false)))"
    ids = f"map_filter(transform_values({nested}, (k, x) -> {_linked_ids('x')}), (k, x) -> x IS NOT NULL)"
    return F.expr(_let(ids, lambda m: f"IF(size({m}) > 0, {m}, NULL)"))


def is_object(v: str) -> Column:
    return F.expr(f"coalesce({_is_object(v)}, false)")


def is_array(v: str) -> Column:
    return F.expr(f"coalesce({_is_array(v)}, false)")


def snippets(v: str) -> Column:
    """Highlight fragments that are strings; one item when the value is no list."""
    item, kept = _name("h"), _name("h")
    listed = f"filter(transform({_unnest(v)}, {item} -> {_text(item)}), {kept} -> {kept} IS NOT NULL)"
    present = f"coalesce({_kind(v)} <> 'VOID', false)"
    return F.expr(f"IF({present}, {_let(listed, lambda c: f'IF(size({c}) > 0, {c}, NULL)')}, NULL)")


def mixed_highlight(v: str) -> Column:
    """The highlight as JSON when anything in it is not a string, for output as it came."""
    item = _name("h")
    present = f"coalesce({_kind(v)} <> 'VOID', false)"
    odd = f"exists({_unnest(v)}, {item} -> coalesce({_kind(item)} <> 'STRING', true))"
    return F.expr(f"IF({present} AND {odd}, to_json({v}), NULL)")
