"""Quality scores by Bradley-Terry ranking: a document's strength is linear in features of its text.

Training compares pairs: of a document labelled good and one labelled bad, the good one wins
with probability sigmoid(w . (x - y)). The weights w come from logistic loss on feature
differences. The labels' share of bad documents then picks a quantile of the training scores as
threshold, and a document's score is the sigmoid of its distance from it.

The model is fitted on all labelled rows and all pairs of a good and a bad one. Each Newton step
is one pass over the rows' features: the loss of a pair depends on its two strengths only, so
rows are summed up by strength (``BINS`` of ``1 / FINE``) and pairs are taken between the sums, each
at its mean strength. The threshold is the exact quantile over all rows. Scoring is one projection of
built-in functions over the whole text, without a shuffle.

Texts never meet the labels: a row's features are computed where its text is read, and only they are
joined. Who trains and scores the same rows computes them once (``featured``) and names the column.

Defined results: a null or empty text has all ratios 0 and is scored like any other; labels that
are null are not used, and a document labelled both ways equally often is not either; without
labels of both kinds every score is 0.5; repeated rows get equal scores; columns of the input
stay, those named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.rule_table import measured_words
from entitylake.llm.shared import bind, without, words_of, written

#: Classes of strength on either side of 0, and classes in a unit of strength.
BINS = 1_024
FINE = 16
#: Strengths that are sorted on the driver to find an exact quantile, at most.
FEW = 10_000
PENALTY = 1e-3
STEPS = 40

FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "shouts",
    "stop_words",
    "repeats",
    "dup_lines",
    "distinct",
    "capitals",
    "digits",
    "log_line",
)


def held_out(ident: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves the remainder; false for a null id."""
    code = F.crc32(ident.cast("string").cast("binary"))
    return F.coalesce(code % modulus == remainder, F.lit(False))


def features(text: Column) -> Column:
    """The features of a text as an array of numbers near 0 to 1, in the order of ``FEATURES``."""
    whole = F.coalesce(text, F.lit(""))

    def numbers(m: Column, found: Column) -> Column:
        words = F.greatest(m["n_words"], F.lit(1)).cast("double")
        chars = F.greatest(m["word_chars"], F.lit(1)).cast("double")
        lines = F.greatest(m["n_lines"], F.lit(1)).cast("double")
        capitals = F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}", ""))
        digits = F.length(whole) - F.length(F.translate(whole, "0123456789", ""))
        # Of many words fewer are new, so the share of distinct words counts against its usual decline.
        distinct = F.size(F.array_distinct(found))
        return F.array(
            F.log1p(m["n_words"].cast("double")) / 10,
            F.least(F.lit(2.0), m["word_chars"] / words / 10),
            F.least(F.lit(2.0), m["n_symbols"] / words),
            F.least(F.lit(2.0), m["n_shouts"] / words),
            m["n_stop_words"] / words,
            m["n_repeat_words"] / words,
            m["n_dup_lines"] / lines,
            distinct / F.pow(words, F.lit(0.9)),
            capitals / chars,
            digits / chars,
            F.log1p(words / lines) / 10,
        )

    return bind(words_of(text), lambda found: bind(measured_words(text, found), lambda m: numbers(m, found)))


def featured(docs: DataFrame, text: str = "text", name: str = "features") -> DataFrame:
    """The input with the features of its text as a column, computed once, behind a generator."""
    kept = [F.col(f"`{column}`") for column in without(docs, name).columns]
    return docs.select(*kept, F.explode(F.array(features(F.col(f"`{text}`")))).alias(name))


@dataclass(frozen=True)
class Ranking:
    """Weights of the features, the threshold, and the spread of scores around it."""

    weights: tuple[float, ...]
    threshold: float
    spread: float

    def strength(self, found: Column) -> Column:
        terms = [F.get(found, F.lit(k)) * F.lit(w) for k, w in enumerate(self.weights)]
        return sum(terms[1:], terms[0])

    def score(self, found: Column) -> Column:
        far = (self.strength(found) - F.lit(self.threshold)) / F.lit(self.spread)
        return 1 / (1 + F.exp(-far))


UNTRAINED = Ranking((0.0,) * len(FEATURES), 0.0, 1.0)


def _sums(weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per label and class of strength: rows, summed strengths, summed features and their products."""
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            good = batch.column(0).to_numpy(zero_copy_only=False)
            strength = x @ weights
            place = np.clip(np.floor(strength * FINE), -BINS, BINS - 1).astype(np.int64) + BINS
            code = place * 2 + good
            order = np.argsort(code, kind="stable")
            edges = np.flatnonzero(np.diff(code[order], prepend=-1))
            for rows in np.split(order, edges[1:]):
                part = x[rows]
                sums = np.concatenate([[len(rows), strength[rows].sum()], part.sum(axis=0), (part.T @ part).ravel()])
                key = int(code[rows[0]])
                total[key] = total[key] + sums if key in total else sums
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["code", "sums"]
            )

    return run


def _slope_and_curve(sums: dict[int, np.ndarray], w: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean loss over all pairs, from the sums of each label and class of strength."""
    width = len(w)
    sides = [np.array([sums[k] for k in sorted(sums) if k % 2 == good]) for good in (1, 0)]
    (n, s, x, xx), (m, t, y, yy) = ((a[:, 0], a[:, 1] / a[:, 0], a[:, 2 : 2 + width], a[:, 2 + width :]) for a in sides)
    pairs = n.sum() * m.sum()
    p = 1 / (1 + np.exp(np.clip(s[:, None] - t[None, :], -30, 30)))  # how surely the pair is still lost
    q = p * (1 - p)
    slope = penalty * w - ((p @ m) @ x - (n @ p) @ y) / pairs
    own = ((q @ m) @ xx + (n @ q) @ yy).reshape(width, width)
    cross = x.T @ q @ y
    return slope, (own - cross - cross.T) / pairs + penalty * np.eye(width)


def order_statistic(table: DataFrame, column: str, place: int) -> float:
    """The value at a place (from 0) of the ascending order, by counts in ever smaller ranges."""
    low, high = table.agg(F.min(column), F.max(column)).first()
    rows = table.select(column)
    while low < high:
        step = (high - low) / 1024
        part = F.least(F.greatest(F.floor((F.col(column) - low) / step), F.lit(0)), F.lit(1023))
        found = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(found.collect(), key=lambda r: r["part"]):
            if place < row["n"]:
                break
            place -= row["n"]
        low, high = row["low"], row["high"]
        rows = rows.where(F.col(column).between(low, high))
        if row["n"] <= FEW:
            return float(sorted(r[0] for r in rows.collect())[place])
    return float(low)


def fit(rows: DataFrame, penalty: float = PENALTY) -> Ranking:
    """Newton steps on the logistic loss of all pairs (good over bad) of rows ``good, x``."""
    width = len(FEATURES)
    each = [F.get("x", F.lit(k)) for k in range(width)]
    found = rows.agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"), *[F.stddev_pop(v).alias(f"x{k}") for k, v in enumerate(each)]
    ).first()
    if not found["good"] or not found["bad"]:
        return UNTRAINED
    scale = np.array([found[f"x{k}"] for k in range(width)])
    scale[scale < 1e-9] = 1.0
    scaled = rows.select("good", F.array(*[v / F.lit(float(u)) for v, u in zip(each, scale)]).alias("x"))
    w = np.zeros(width)
    for _ in range(STEPS):
        sums: dict[int, np.ndarray] = {}
        for row in scaled.mapInArrow(_sums(w), "code int, sums array<double>").collect():
            part = np.array(row["sums"])
            sums[row["code"]] = sums[row["code"]] + part if row["code"] in sums else part
        slope, curve = _slope_and_curve(sums, w, penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    weights = tuple((w / scale).tolist())
    strengths = rows.select(Ranking(weights, 0.0, 1.0).strength(F.col("x")).alias("s"))
    # The quantile at the share of bad documents, between two neighbours in the ranking.
    place = found["bad"]
    last = found["good"] + found["bad"] - 1
    threshold = (order_statistic(strengths, "s", place - 1) + order_statistic(strengths, "s", min(place, last))) / 2
    away = strengths.agg(F.avg(F.abs(F.col("s") - F.lit(threshold)))).first()[0]
    return Ranking(weights, threshold, float(max(away / 4, 1e-9)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    modulus: int = 3,
    remainder: int = 1,
    found: str | None = None,
) -> Ranking:
    """A ranking from all labelled documents; ids whose CRC-32 leaves the remainder are held out.

    Their features (those in the column ``found``, if it is named) are written once to the shared
    folder; sums over them come to the driver.
    """
    number = F.col(f"`{ident}`")
    votes = (
        labels.where(number.isNotNull() & F.col(f"`{label}`").isNotNull() & ~held_out(number, modulus, remainder))
        .groupBy(number.alias("llm_id"))
        .agg(F.avg(F.col(f"`{label}`").cast("double")).alias("vote"))
        .where("vote != 0.5")
    )
    if found is None:
        learned = ~held_out(number.try_cast(votes.schema["llm_id"].dataType), modulus, remainder)
        some = docs.where(number.isNotNull() & learned).select(number.alias("llm_id"), F.col(f"`{text}`").alias("llm_text"))
        narrow = featured(some, "llm_text", "x").drop("llm_text")
    else:
        narrow = docs.select(number.alias("llm_id"), F.col(f"`{found}`").alias("x"))
    rows = narrow.join(votes, "llm_id").select((F.col("vote") > 0.5).alias("good"), "x")
    return fit(written(rows))


def ranked(docs: DataFrame, model: Ranking, text: str = "text", found: str | None = None) -> DataFrame:
    """The input with ``score`` and ``predicted``; the features come from the column ``found``, if it is named.

    Else they are computed once, behind a generator.
    """
    kept = [F.col(f"`{name}`") for name in without(docs, "score", "predicted").columns]
    score = bind(features(F.col(f"`{text}`")), model.score) if found is None else model.score(F.col(f"`{found}`"))
    table = docs.select(*kept, F.explode(F.array(score)).alias("score"))
    return table.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Ranking, text: str = "text") -> DataFrame:
    """The documents ranked above the threshold, with the columns of the input."""
    judged = ranked(docs.select(F.struct("*").alias("llm_row"), F.col(f"`{text}`").alias("llm_text")), model, "llm_text")
    return judged.where("predicted = 1").select("`llm_row`.*")


def op4_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    table = written(featured(docs).drop("text"))
    model = train(table, spark.read.parquet(f"{sf_dir}/labels.parquet"), found="features")
    return ranked(table, model, found="features").select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted"
    )
