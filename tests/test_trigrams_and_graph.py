"""Trigram candidates against the scan, ancestors and hops against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from entitylake.operators import graph as G
from entitylake.operators import predicates as P
from entitylake.operators import search as S
from entitylake.operators import trigrams as TG

VALUES = ["john.doe@example.org", "John Doe", "JOHN", "jo", "", "abcabcabc", "xabcy", "ab", "école normale", "ÉCOLE", "12345", "a\nb", "smile \U0001f600 face", "(x|y)[z]", "İstanbul", "aaaa", "x" * 3000 + "end"]

PATTERNS = [
    "john.?doe@example.org", "(?i)john.*", "john.*", "(abc)+", "(?:abc){2,}", "x?abc.*", ".*(?:abc|end)", "(?:john|jo|abc).*", ".*", "[a-z]+",
    "ab*c.*", "(?:ab)?c.*", ".*ormal.*", "(?i)école.*", ".*\U0001f600 f.*", r"\(x\|y\)\[z\]", r"\Qjo\E", "(?i)İst.*", "(?s)a.b", "1{1}2345", "a{2}a+", "(?:jo|(?:hn|abc)abc)abcabc", "[[a]b]+", "(", "john(?=x).*|xabcy",
]


@pytest.fixture(scope="module")
def corpus(entity):
    return entity(*[{"id": f"v{i}", "properties": {"name": [v, VALUES[i - 1]]}} for i, v in enumerate(VALUES)], {"id": "none"}).cache()


@pytest.mark.parametrize("pattern", [p for p in PATTERNS if p != "("])
def test_regex_like_the_scan(corpus, pattern):
    grams = TG.value_trigrams(TG.property_values(corpus, "name"))
    found = sorted(r.id for r in TG.regex_ids(corpus, "name", grams, pattern).collect())
    assert found == sorted(r.id for r in S.matching(corpus, P.prop_regex("name", pattern)).collect())


def test_what_patterns_require():
    need = TG.required_trigrams
    assert need("Customer#0+") == [frozenset(["cus", "ust", "sto", "tom", "ome", "mer", "er#", "r#0"])]
    assert need("abc|x+yzw") == [frozenset(["abc"]), frozenset(["yzw"])]
    assert need("abcd?e") == [frozenset(["abc"])] and need("(abc)?abc") == [frozenset(["abc"])]
    assert need("a(bb|xy)c") == [frozenset(["abb", "bbc"]), frozenset(["axy", "xyc"])]
    for scan in ("ab", "abc|d", ".*", "(", "(?i)éco", "(?x)abc", r"\p{L}abc", "[a[b]]abc", "".join(["(abc|bcd)"] * 7)):
        assert need(scan) is None, scan


def test_trigrams_count_code_points(spark):
    row = spark.createDataFrame([("A\U0001f600bc",), ("ab",), ("aaaaa",)], "v string").select(TG.trigrams_of(F.col("v"))).collect()
    assert [r[0] for r in row] == [["a\U0001f600b", "\U0001f600bc"], [], ["aaa"]]


def test_pattern_runs_on_candidates_only(spark, corpus, tmp_path):
    path = str(tmp_path / "grams")
    TG.write_trigrams(TG.value_trigrams(TG.property_values(corpus, "name")), path, buckets=16)
    grams = TG.read_trigrams(spark, path, "john.*x", buckets=16)
    plan = TG.regex_ids(corpus, "name", grams, "john.*x")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("RLIKE") > plan.index("LeftSemi")
    assert "bucket" in grams._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert TG.read_trigrams(spark, path, ".*", buckets=16).count() == TG.read_trigrams(spark, path).count()


def all_above(pairs):
    up = {}
    for child, parent in pairs:
        up.setdefault(child, set()).add(parent)
    out = set()
    for name in {x for pair in pairs for x in pair}:
        seen, queue = {name}, [name]
        while queue:
            for parent in up.get(queue.pop(), ()):
                if parent not in seen:
                    seen.add(parent)
                    queue.append(parent)
        out |= {(name, x) for x in seen}
    return out


@pytest.mark.parametrize(
    "pairs",
    [
        [("a", "b"), ("b", "c"), ("a", "d"), ("d", "c")],
        [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")],
        [(f"n{i}", f"n{i + 1}") for i in range(40)],
        [("a", "a"), ("a", "b"), ("a", "b")],
        [],
    ],
)
def test_closure(spark, pairs):
    table = spark.createDataFrame([*pairs, (None, "q"), ("r", None)] if pairs else [], "schema string, parent string")
    extra = {("q", "q"), ("r", "r")} if pairs else set()
    found = [tuple(r) for r in G.ancestor_closure(table).collect()]
    assert set(found) == all_above(pairs) | extra and len(found) == len(set(found))


def nearest(links, start, hops, both_ways):
    ways = {(a, role, b) for a, role, b in links if a != b and a is not None and b is not None}
    if both_ways:
        ways |= {(b, role, a) for a, role, b in ways}
    found = {x: (0, None, None) for x in start}
    for hop in range(1, hops + 1):
        steps = {}
        for a, role, b in sorted(ways):
            if a in found and found[a][0] == hop - 1 and b not in found:
                steps.setdefault(b, (a, role))
        found.update({b: (hop, *step) for b, step in steps.items()})
    return found


@pytest.mark.parametrize(("hops", "both_ways"), [(0, True), (1, True), (3, True), (9, True), (3, False)])
def test_hops(spark, hops, both_ways):
    draw = random.Random(hops)
    links = [(f"e{draw.randrange(60)}", draw.choice(["owns", "knows"]), f"e{draw.randrange(60)}") for _ in range(70)]
    links += [("hub", "knows", f"h{i}") for i in range(200)] + [("e1", "owns", "hub"), (None, "owns", "e1"), ("e1", "owns", None), ("e2", "owns", "e2")]
    table = spark.createDataFrame(links, "source_id string, role string, target_id string")
    start = spark.createDataFrame([("e1",), ("e1",), ("e5",), (None,)], "id string")
    found = {r.id: (r.hop, r.via, r.role) for r in G.within_hops(table, start, hops, both_ways).collect()}
    assert found == nearest(links, {"e1", "e5"}, hops, both_ways)


def test_hops_over_entities(entity):
    corpus = entity(
        {"id": "c", "schema": "Company"},
        {"id": "o", "schema": "Ownership", "properties": {"owner": [{"id": "p", "schema": "Person", "properties": {"name": ["Ann"]}}], "asset": ["c"]}},
        {"id": "o2", "schema": "Ownership", "properties": {"owner": ["p"], "asset": ["d"]}},
    )
    links = G.entity_links(corpus, ["owner", "asset", "asset"])
    found = {r.id: (r.hop, r.via) for r in G.within_hops(links, corpus.filter("schema = 'Company'"), 9).collect()}
    assert found == {"c": (0, None), "o": (1, "c"), "p": (2, "o"), "o2": (3, "p"), "d": (4, "o2")}
    with pytest.raises(ValueError):
        G.within_hops(links, corpus, -1)


def test_closure_of_many_low_types_shuffles_lists(spark):
    """Low types take no part in the rounds; a cycle above them, a diamond and a step to itself stay right."""
    pairs = [(f"low{i}", f"mid{(i + k) % 7}") for i in range(40) for k in range(3)]
    pairs += [(f"mid{i}", f"top{i % 2}") for i in range(7)] + [("top0", "a"), ("a", "b"), ("b", "a"), ("top1", "top1"), ("mid3", "a"), ("low1", "top0")]
    table = spark.createDataFrame([*pairs, pairs[0], ("alone", None), (None, "over")], "schema string, parent string")
    closure = G.ancestor_closure(table)
    found = [tuple(r) for r in closure.collect()]
    assert set(found) == all_above(pairs) | {("alone", "alone"), ("over", "over")} and len(found) == len(set(found))
    assert "collect_list" in closure._jdf.queryExecution().optimizedPlan().toString()
