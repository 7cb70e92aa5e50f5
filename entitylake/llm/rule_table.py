"""Quality rules: a table of thresholds compiled into one projection, built-in functions only.

Each rule bounds a ratio of two measures of the text; it is compiled to a comparison without a
division, so a text without words needs no case of its own. Nothing is shuffled.

Defined results: a null or empty text has no words, all its measures are 0, and it fails the
base test (fewer than 20 words). Repeated rows are judged alike, one by one. Columns of the
input keep their values; those named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.shared import SPACES, bind, without, words_of

#: The symbols counted, and the length of the windows of repeated words (a power of two).
SYMBOLS = "#*$%&|<>"
WINDOW = 8
BASE_WORDS = 20
BASE_REPEATED_PERCENT = 30

#: Frequent function words of the languages the rules are meant for.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "with", "as", "by", "be", "this", "at", "from", "or", "a", "an", "not", "have", "has"),
    *("der", "die", "das", "und", "zu", "den", "dem", "des", "ist", "mit", "von", "für", "auf", "im", "ein", "eine", "nicht", "sich", "als", "auch", "es"),
    *("le", "la", "les", "de", "du", "et", "un", "une", "est", "en", "que", "qui", "dans", "pour", "sur", "par", "pas", "au", "avec", "ce"),
    *("el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "para", "al", "lo", "como", "más", "no", "o"),
)


@dataclass(frozen=True)
class Rule:
    """``low * whole <= part <= high * whole``; a bound of None is not tested."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None

    def verdict(self, measures: dict[str, Column]) -> Column:
        part, whole = measures[self.part], measures[self.whole]
        tests = []
        if self.low is not None:
            tests.append(part >= F.lit(self.low) * whole)
        if self.high is not None:
            tests.append(part <= F.lit(self.high) * whole)
        return reduce(lambda left, right: left & right, tests, F.lit(True))


#: The production table: word length, symbols, shouting, stop words, repeated and endless lines.
RULES: tuple[Rule, ...] = (
    Rule("word length", "word_chars", "n_words", low=1.5, high=20.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.25),
    Rule("exclamation marks per word", "n_shouts", "n_words", high=0.25),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.02),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
)


def count_chars(text: Column, chars: str) -> Column:
    """Code points of the text that are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more in the text.

    Windows are compared by a 64-bit hash, made of the hashes of their halves, down to single
    words. A text whose windows are all different (nearly every text) ends with one hash set;
    else the windows are sorted by hash, and the lengths that the repeated ones cover are summed
    in order of position: n log n in the words.
    """

    def windows(hashes: Column, span: int) -> Column:
        """From a hash at each place of the ``span`` words there to those of ``WINDOW`` words."""
        if span == WINDOW:
            return covered(hashes)
        firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - span, F.lit(0)))
        return bind(F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(hashes, i + span))), lambda h: windows(h, 2 * span))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(ordered: Column) -> Column:
            again = F.filter(
                ordered,
                lambda x, j: F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        def length(places: Column) -> Column:
            steps = F.transform(
                places,
                lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))),
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bind(bind(pairs, positions), length)
        )

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(bind(hashes, lambda h: windows(h, 1)))


def measured(text: Column) -> Column:
    """All measures of a text as one struct; its words are split once."""
    return bind(words_of(text), lambda words: measured_words(text, words))


def measured_words(text: Column, words: Column) -> Column:
    """All measures of a text whose words are split already."""
    whole = F.coalesce(text, F.lit(""))

    def fields(lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
            count_chars(whole, SYMBOLS).alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            count_chars(whole, "!").alias("n_shouts"),
            F.size(F.filter(words, lambda word: F.lower(word).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    spoken = F.filter(F.split(whole, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    return bind(spoken, fields)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The input with the measures, ``base_failed`` and ``kept``.

    The measures are computed behind a one-row generator: filters on them never repeat them.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", "n_stop_words", "n_lines")
    base = docs.withColumn("llm_text", F.col(f"`{text}`")) if text.lower() in names else docs
    source = "llm_text" if text.lower() in names else text
    kept = [F.col(f"`{name}`") for name in without(docs, *names, "base_failed", "kept").columns]
    table = base.select(*kept, F.inline(F.array(measured(F.col(f"`{source}`")))))
    measures = {name: F.col(name) for name in names}
    failed = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEATED_PERCENT * F.col("n_words")
    )
    verdict = reduce(lambda left, right: left & right, (rule.verdict(measures) for rule in rules), F.lit(True))
    return table.withColumns({"base_failed": failed, "kept": ~failed & verdict})


def accepted(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with the columns of the input."""
    judged = quality_rules(docs.select(F.struct("*").alias("llm_row"), F.col(f"`{text}`").alias("llm_text")), rules, "llm_text")
    return judged.where("kept").select("`llm_row`.*")


def _sql_ratio(rules: Sequence[Rule]) -> str:
    tests = []
    for rule in rules:
        if rule.low is not None:
            tests.append(f"{rule.part} >= {rule.low}::DOUBLE * {rule.whole}")
        if rule.high is not None:
            tests.append(f"{rule.part} <= {rule.high}::DOUBLE * {rule.whole}")
    return " AND ".join(tests)


#: The same for DuckDB, with windows unnested and counted.
SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [line FOR line IN string_split(coalesce(text, ''), chr(10))
          IF regexp_matches(line, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
grams AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
repeats AS (
  SELECT r, sum(least(8, coalesce(after - i, 8)))::BIGINT AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM again) GROUP BY r),
measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_shouts,
    len([x FOR x IN w IF list_contains({list(STOP_WORDS)!r}, lower(x))])::BIGINT AS n_stop_words,
    len(lines)::BIGINT AS n_lines
  FROM split LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_sql_ratio(RULES)} AS kept
FROM judged
"""


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document with its measures and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
