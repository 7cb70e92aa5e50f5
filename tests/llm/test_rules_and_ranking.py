"""Quality rules, pairwise ranking, language codes and the mix."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from entitylake.llm import bradley_terry, ecoc_language, rule_table, weighted_mix
from entitylake.llm.rule_table import Rule

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORDS.findall(text or "")
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered |= set(range(i, i + 8))
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "the cat and the dog " * 3,
    "a b c d e f g h a b c d e f g h",
    "a a a a a a a a a a",
    "\n".join(["the same line of words is here again today", "another line that has the words of it"] * 4),
    "Größe and Äpfel 😀 word with nbsp space # * $ % & | < > !",
    "x " * 40_000 + "the end",
    " ".join(f"w{i % 977}" for i in range(60_000)),
]


def test_base_measures_match_brute_force(documents):
    found = rule_table.quality_rules(documents(*enumerate(TEXTS))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for row in found:
        assert tuple(row[name] for name in names) == brute_base(TEXTS[row["doc_id"]]), row["doc_id"]


def test_windows_of_the_same_words_in_another_order_differ(documents):
    words = "a b c d e f g h".split()
    halves, pairs = words[4:] + words[:4], [w for k in (2, 0, 6, 4) for w in words[k : k + 2]]
    texts = [" ".join(part) for part in (words + halves[::-1] + pairs + words[::-1], words + halves + words, words + ["x"] + words)]
    for row in rule_table.quality_rules(documents(*enumerate(texts))).collect():
        assert row["n_repeat_words"] == brute_base(texts[row["doc_id"]])[4], row["doc_id"]


def test_rules_are_compiled_to_one_projection(documents):
    table = documents((1, "the cat sat on the mat and " * 4))
    plan = rule_table.quality_rules(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    strict = [Rule("none", "n_words", "n_lines", high=0.0)]
    assert not rule_table.quality_rules(table, strict).first()["kept"]


def test_rules_with_clashing_columns_and_no_rows(documents):
    good = " ".join(f"the word{i} and the other{i} of it" for i in range(9))
    table = documents((1, good), (1, good), (2, "short"), extra=("n_words", "kept", "llm_row", "llm_text", "words"))
    assert rule_table.accepted(table).collect() == table.where("doc_id = 1").collect()
    judged = rule_table.quality_rules(table)
    assert [r["n_words"] for r in judged.collect()] == [63, 63, 1]
    assert rule_table.quality_rules(table.limit(0)).count() == 0


def test_ranking_learns_from_pairs(documents, spark):
    good = [f"the house number {i} is on the left side of the road and it was old." for i in range(120)]
    bad = [f"BUY!! NOW{i}!! $$$ ### CHEAP!! %%% PILLS!! &&& {i}{i}{i}" for i in range(120)]
    rows = list(enumerate(good + bad))
    table = documents(*rows, (500, None), (501, ""), (0, good[0]), extra=("score", "predicted", "label"))
    labels = spark.createDataFrame(
        [(i, int(i < 120), 0) for i, _ in rows] + [(7, None, 0), (None, 1, 0), (900, 1, 0)], "doc_id long, quality int, toxic int"
    )
    model = bradley_terry.train(table, labels)
    found = bradley_terry.ranked(table, model)
    assert found.columns == [c for c in table.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    result = {row["doc_id"]: row for row in found.collect()}
    assert all(result[i]["predicted"] == int(i < 120) for i, _ in rows)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in result.values())
    assert result[500]["score"] == result[501]["score"]
    assert bradley_terry.accepted(table, model).columns == table.columns


def joined_types(table):
    """The types of the columns on either side of the plan's joins, a set for each join."""
    nodes = [table._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        below = [node.children().apply(k) for k in range(node.children().size())]
        nodes += below
        if node.nodeName() == "Join":
            yield {x.output().apply(k).dataType().simpleString() for x in below for k in range(x.output().size())}


def labelled(documents, spark):
    texts = [f"the house number {i} is on the left side of the road." if i % 2 else f"BUY!! NOW{i}!! $$$ ### {i}{i}" for i in range(90)]
    table = documents(*enumerate(texts), (None, "the road"), (3, None), (4, "the road"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id long, quality int")
    return table, labels


def test_texts_are_not_joined_with_labels(documents, spark, tmp_path, monkeypatch):
    table, labels = labelled(documents, spark)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    plans, calls, write, measure = [], [], bradley_terry.written, bradley_terry.features
    monkeypatch.setattr(bradley_terry, "written", lambda t: plans.extend(joined_types(t)) or write(t))
    monkeypatch.setattr(bradley_terry, "features", lambda text: calls.append(1) or measure(text))
    bradley_terry.train(table, labels)
    assert len(plans) == 1 and not any("string" in types for types in plans)
    calls.clear()
    scores = bradley_terry.op4_bradley_terry(spark, str(tmp_path))
    plans += joined_types(scores)
    assert len(plans) == 2 and not any("string" in types for types in plans)
    assert len(calls) == 1  # once for a text, for training and scoring alike
    assert scores.columns == ["doc_id", "held_out", "score", "predicted"] and scores.count() == table.count()


def test_named_features_give_the_same_ranking(documents, spark):
    table, labels = labelled(documents, spark)
    with_features = bradley_terry.featured(table, name="f")
    model = bradley_terry.train(table, labels)
    for docs, found in ((with_features, "f"), (with_features.drop("text"), "f"), (table.withColumn("doc_id", F.col("doc_id").cast("int")), None)):
        other = bradley_terry.train(docs, labels, found=found)
        assert other.weights == pytest.approx(model.weights) and other.threshold == pytest.approx(model.threshold)
    found = bradley_terry.ranked(with_features, model, found="f")
    assert found.columns == [*table.columns, "f", "score", "predicted"]
    again = bradley_terry.ranked(table, model)
    assert Counter(found.select(*again.columns).collect()) == Counter(again.collect())


def test_ranking_without_both_labels(documents, spark):
    table = documents((1, "a"), (2, None))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = bradley_terry.train(table, labels)
    assert {row["score"] for row in bradley_terry.ranked(table, model).collect()} == {0.5}
    assert bradley_terry.ranked(table.limit(0), bradley_terry.train(table.limit(0), labels.limit(0))).count() == 0


def test_held_out_rows_are_not_learned(documents, spark):
    table = documents(*[(i, "the text") for i in range(60)])
    held = [r[0] for r in table.where(bradley_terry.held_out(F.col("doc_id"), 3, 1)).select("doc_id").collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in held], "doc_id long, quality int")
    assert bradley_terry.train(table, labels) == bradley_terry.UNTRAINED


def test_held_out_accuracy(spark, sf):
    root = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    ranked = bradley_terry.ranked(docs, bradley_terry.train(docs, labels)).join(labels, "doc_id")
    right = ranked.where(bradley_terry.held_out(F.col("doc_id"), 3, 1)).select(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert right.first()[0] > 0.98
    named = ecoc_language.identified(docs.drop("lang"), ecoc_language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    right = named.where(bradley_terry.held_out(F.col("doc_id"), 4, 2)).select(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")))
    assert right.first()[0] > 0.98


def test_codebook_corrects_a_wrong_bit():
    for languages in (2, 3, 4, 5, 9, 30):
        code = ecoc_language.codebook(languages)
        apart = (code.shape[1] - code @ code.T) / 2 + 99 * np.eye(languages)
        assert apart.min() >= (1 if languages == 2 else 2 if languages == 3 else 3)


SAMPLES = {
    "en": "the quick house of {} and the things that were with them there",
    "de": "das schnelle Haus von {} und die Dinge, welche nicht über sich gehen",
    "fr": "la maison de {} et les choses que vous êtes allées voir où",
}


@pytest.fixture(scope="module")
def languages(documents):
    rows = [(3 * i + k, SAMPLES[lang].format(f"x{i}"), lang, "s") for i in range(40) for k, lang in enumerate(SAMPLES)]
    return ecoc_language.train(documents(*rows, (999, "un texte", None, "s"), (None, "das", "de", "s")))


def test_languages_by_codes(documents, languages):
    assert languages.names == ["de", "en", "fr"] and languages.code.shape == (3, 3)
    long = "vous êtes allées " * 100_000
    rows = [(1, "them and the things"), (2, "über die Dinge"), (3, long), (4, None), (5, ""), (6, "12 !? \n"), (7, "them and the things")]
    table = documents(*rows, extra=("score", "lang_pred", "llm_found"))
    found = {row["doc_id"]: row for row in ecoc_language.identified(table, languages).collect()}
    assert [found[i]["lang_pred"] for i in range(1, 8)] == ["en", "de", "fr", "und", "und", "und", "en"]
    assert all(0 <= row["score"] <= 1 for row in found.values()) and found[4]["score"] == 0
    assert ecoc_language.identified(table.limit(0), languages).count() == 0


def test_counts_do_not_depend_on_slices(monkeypatch):
    text = "Über 12 Häuser, ÉCOLE normale; 日本語 and more" * 7
    whole = ecoc_language.gram_counts(text)
    monkeypatch.setattr(ecoc_language, "SLICE_CHARS", 5)
    assert (ecoc_language.gram_counts(text) == whole).all()


def test_languages_without_labels(documents):
    none = ecoc_language.train(documents((1, "text", None, "s")))
    assert none.decode("some text") == ("und", 0.0, True)
    one = ecoc_language.train(documents(*[(i, "some text", "en", "s") for i in range(8)]))
    assert one.decode("quelque chose") == ("en", 1.0, False) and one.decode("12") == ("und", 0.0, True)


def brute_targets(sizes):
    """Shared again and again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_comes_near_its_targets(documents):
    rows = [(i, "word " * (1 + i * 7 % 13), "en", ("b", "a", None, "é", "hot")[min(4, i % 9)]) for i in range(900)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "empty"), (None, "two words", "en", "b"), (3, "word " * 9, "en", "b"), (3, "word " * 9, "en", "b")]
    table = documents(*rows)
    found = weighted_mix.mix(table).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    expected = brute_targets(sizes)
    by_size = {sizes[s]: s for s in sizes}
    taken, targets = Counter(), {}
    for row in found:
        source = by_size[row["source_size"]]
        taken[source] += row["taken"]
        targets[source] = row["target"]
        assert row["taken"] <= 2 * row["size"] and (row["size"] == 0 or row["taken"] % row["size"] == 0)
    for source in sizes:
        assert targets[source] == pytest.approx(expected[source])
        assert abs(taken[source] - expected[source]) <= 7, source
    assert sorted(map(tuple, weighted_mix.mix(table.repartition(7)).collect()), key=str) == sorted(map(tuple, found), key=str)


def test_mix_takes_heavier_documents_first(documents):
    """The second source takes one epoch and a half: the half goes to documents of higher weight."""
    clean = [(i, f"clean words in number {i}", "en", "b") for i in range(2000)]
    noisy = [(10_000 + i, f"### $$$ %%% &&& {i}", "en", "b") for i in range(2000)]
    rows = documents(*clean, *noisy, *[(50_000 + i, "w " * 50, "en", "a") for i in range(1200)])
    taken = {row["doc_id"]: row["taken"] / row["size"] for row in weighted_mix.mix(rows).collect()}
    assert sum(taken[i] for i, *_ in clean) > 1.85 * len(clean)
    assert sum(taken[i] for i, *_ in noisy) < 1.15 * len(noisy)
    assert min(taken.values()) >= 1


@pytest.mark.parametrize("most", [50, 1, 100_000])
def test_key_ranges_are_cut_until_they_are_small(documents, monkeypatch, most):
    """Tables of low weight crowd into the last key range; the rows equal one sorted running sum, as DuckDB takes it."""
    monkeypatch.setattr(weighted_mix, "MOST_SORTED", most)
    monkeypatch.setattr(weighted_mix, "KEY_RANGES", 16)
    rows = [(i, f"| # | $ | {i % 7} |", "en", "table") for i in range(1500)]
    rows += [(5000 + i, "plain words " * (1 + i % 5), "en", ("a", None)[i % 2]) for i in range(900)]
    table = documents(*rows)
    sorted_, within = [], weighted_mix._within
    monkeypatch.setattr(weighted_mix, "_within", lambda *a: sorted_.append(within(*a)) or sorted_[-1])
    found = weighted_mix.mix(table).collect()
    counts = [r["count"] for r in sorted_[-1].groupBy("source").count().collect()]
    assert max(counts) <= most
    assert most < 1000 or max(counts) > 1000
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    expected = con.execute(f"SELECT doc_id, size, source_size, taken FROM ({weighted_mix.SQL})").fetchall()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in found) == sorted(expected)


def test_repeated_rows_at_the_cut_stay_together(documents, monkeypatch):
    """One document makes up most of a source: it cannot be cut, and no round is without end."""
    monkeypatch.setattr(weighted_mix, "MOST_SORTED", 10)
    table = documents(*[(1, "one two", "en", "a")] * 200, *[(i, "some words here", "en", "a") for i in range(2, 9)], (99, "x", "en", "b"))
    found = weighted_mix.mix(table).collect()
    copies = {r["taken"] for r in found if r["doc_id"] == 1}
    assert len(found) == 208 and len(copies) == 1 and copies <= {2, 4}


def test_mixed_rows_repeat_and_keep_columns(documents):
    table = documents(*[(i, "a b c", "en", "xyz"[i % 3]) for i in range(90)], extra=("size", "key", "part", "target"))
    found = weighted_mix.mixed(table)
    assert found.columns == table.columns
    expected = {row["doc_id"]: row["taken"] // 3 for row in weighted_mix.mix(table).collect()}
    assert Counter(row["doc_id"] for row in found.collect()) == Counter({k: v for k, v in expected.items() if v})
    assert weighted_mix.mix(table.limit(0)).count() == 0 and weighted_mix.mixed(table.limit(0)).count() == 0


def test_texts_without_a_letter_are_undetermined(languages):
    for text in ("½ ²", "12 34", "٣", "—", "_", "\u0301"):
        assert languages.decode(text) == ("und", 0.0, True)
    assert languages.decode("½ the house")[0] == "en"
    assert ecoc_language.has_letter("語") and not ecoc_language.has_letter("Ⅷ")


def test_most_frequent_labels_are_learned(documents):
    rows = [(i, f"the house number {i}", "en", "s") for i in range(40)] + [(100 + i, "x", f"noise {i}", "s") for i in range(30)]
    model = ecoc_language.train(documents(*rows), languages=2)
    assert len(model.names) <= 2 and "en" in model.names


def test_ranking_is_fitted_on_all_labelled_rows(spark):
    """Sums by strength give what all pairs give one by one, for more rows than a sample held."""
    draw = np.random.default_rng(3)
    width = len(bradley_terry.FEATURES)
    few = np.concatenate([draw.normal(0.4, 1, (90, width)), draw.normal(0, 1, (60, width))])
    good = np.arange(150) < 90
    schema = "good boolean, x array<double>"
    model = bradley_terry.fit(spark.createDataFrame([(bool(g), x.tolist()) for g, x in zip(good, few)], schema))
    scale = few.std(axis=0)
    gaps = ((few[good][:, None] - few[~good][None]) / scale).reshape(-1, width)
    w = np.zeros(width)
    for _ in range(30):
        p = 1 / (1 + np.exp(gaps @ w))
        slope = bradley_terry.PENALTY * w - gaps.T @ p / len(gaps)
        w -= np.linalg.solve((gaps * (p * (1 - p))[:, None]).T @ gaps / len(gaps) + bradley_terry.PENALTY * np.eye(width), slope)
    assert np.allclose(np.array(model.weights) * scale, w, atol=0.01)
    strengths = np.sort(few @ np.array(model.weights))
    assert np.isclose(model.threshold, strengths[59:61].mean())
    many = spark.range(40_000).selectExpr("id % 4 > 0 AS good", f"array_repeat(CAST(id AS double), {width}) AS x")
    assert np.isclose(bradley_terry.order_statistic(many.selectExpr("x[0] AS s"), "s", 31_234), 31_234)
