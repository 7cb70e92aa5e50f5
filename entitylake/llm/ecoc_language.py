"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a linear classifier over hashed character
n-grams learns to tell the languages whose bit is 1 from the others. A text's outputs are
compared with every codeword by the logistic loss, each bit weighted by how well its classifier
did in training; the nearest codeword names the language. Texts whose best two codewords are
close, or whose hard bits lie beyond the code's correction radius, are flagged as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows (``SAMPLE`` per language and
``SAMPLE_ROWS`` in all, by hash of id and text); whole texts are used in training and prediction.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any
labelled text all are; with a single language every other text is that one with score 1; texts
of any length are counted in slices; equal texts get equal results; columns of the input stay,
those named like an output column are replaced.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.bradley_terry import held_out
from entitylake.llm.shared import fresh_name, slices, without

UNDETERMINED = "und"
BUCKETS = 4096
ORDERS = (1, 2, 3)
SAMPLE = 400
SAMPLE_ROWS = 4096
MOST_LANGUAGES = 512
STEPS = 150
PENALTY = 1e-4
CLOSE = 0.2
SLICE_CHARS = 1 << 20

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Numerals such as a half or a raised two are no letters."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def _plain_table() -> np.ndarray:
    """Code points below 0x250, with everything that is no letter as a space."""
    return np.array([ord(chr(c)) if chr(c).isalpha() else 32 for c in range(0x250)], np.uint32)


_PLAIN = _plain_table()


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket of character n-grams occurs, in lower case, all of the text."""
    total = np.zeros(BUCKETS, np.int64)
    lowered, reach = text.lower(), max(ORDERS) - 1
    for start in range(0, len(lowered), SLICE_CHARS):
        # A slice sees the characters before it that its first n-grams need.
        back = min(start, reach)
        codes = np.frombuffer(lowered[start - back : start + SLICE_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        known = codes < len(_PLAIN)
        codes = np.where(known, _PLAIN[np.where(known, codes, 0)], codes)
        mixed = codes * np.uint32(0x9E3779B1)
        for order in ORDERS:
            # Each n-gram ends at one character of the slice.
            ends = np.arange(max(back, order - 1), len(codes))
            found = np.full(len(ends), order * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
            for k in range(order):
                found = (found ^ mixed[ends[0] - k : ends[0] - k + len(ends)] if len(ends) else found) * np.uint32(0xC2B2AE35)
                found ^= found >> np.uint32(15)
            total += np.bincount(found & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return total


def profile(text: str) -> np.ndarray:
    """Square roots of the buckets' shares: a vector of length 1."""
    counts = gram_counts(text)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codebook(languages: int, seed: int = 3) -> np.ndarray:
    """A row of +1 and -1 per language. Up to six: all splits in two; more: the widest of random codes."""
    if languages < 2:
        return np.ones((languages, 0), np.float32)
    if languages <= 6:
        splits = [c for c in itertools.product((1, -1), repeat=languages) if c[0] == 1 and -1 in c]
        return np.array(splits, np.float32).T
    draw, bits = np.random.default_rng(seed), 12 * math.ceil(math.log2(languages))
    best, width = None, -1.0
    for _ in range(200):
        code = draw.choice(np.array([1, -1], np.float32), (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = (code.shape[1] - code @ code.T) / 2
        near = (apart + np.eye(languages) * bits).min()
        if near > width:
            best, width = code, near
    return best


@dataclass
class Languages:
    """Names, codewords, and one linear classifier per bit."""

    names: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous."""
        if not text or not self.names or not has_letter(text):
            return UNDETERMINED, 0.0, True
        if len(self.names) == 1:
            return self.names[0], 1.0, False
        outputs = profile(text) @ self.weights + self.bias
        losses = np.logaddexp(0, -self.code * outputs) @ self.trust
        order = np.argsort(losses, kind="stable")
        shares = np.exp(losses[order[0]] - losses)
        shares /= shares.sum()
        first, second = shares[order[0]], shares[order[1]]
        wrong = int((np.sign(outputs) != self.code[order[0]]).sum())
        return self.names[order[0]], float(min(1.0, first)), bool(first - second < CLOSE or wrong > self.radius)

    @property
    def radius(self) -> int:
        apart = (self.code.shape[1] - self.code @ self.code.T) / 2
        np.fill_diagonal(apart, self.code.shape[1])
        return int((apart.min() - 1) // 2)


def fit(profiles: np.ndarray, names: list[str]) -> Languages:
    """Logistic regression per bit by accelerated gradient steps over all rows at once."""
    languages = sorted(set(names))
    code = codebook(len(languages))
    target = code[[languages.index(name) for name in names]] if names else code
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    if code.shape[1]:
        # Rows of a language weigh as much together as those of any other.
        share = np.array([1 / names.count(name) for name in languages], np.float32)[[languages.index(n) for n in names]]
        share /= share.sum()
        x = np.hstack([profiles, np.ones((len(names), 1), np.float32)])
        w = ahead = np.zeros((BUCKETS + 1, code.shape[1]), np.float32)
        for step in range(STEPS):
            pull = target / (1 + np.exp(np.clip(target * (x @ ahead), -30, 30)))
            slope = PENALTY * ahead - x.T @ (pull * share[:, None])
            after = ahead - 2.0 * slope
            ahead = after + np.float32(step / (step + 3)) * (after - w)
            w = after
        # Scaled so that the usual training margin is 4: the losses then tell near from far.
        w = w * (4 / np.maximum(1e-6, np.median(np.abs(x @ w), axis=0)))
        weights, bias = w[:-1], w[-1]
    outputs = profiles @ weights + bias if names else np.zeros((0, code.shape[1]))
    right = (np.sign(outputs) == target).mean(axis=0) if len(names) and code.shape[1] else np.ones(code.shape[1])
    trust = np.log((right * 0.998 + 0.001) / (1 - (right * 0.998 + 0.001)))
    trust = np.clip(trust, 0.05, None)
    trust = trust / trust.mean() if len(trust) else trust
    return Languages(languages, code, weights.astype(np.float32), np.asarray(bias, np.float32), trust.astype(np.float32))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = [profile(text).tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["lang", "profile"])


def train(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    modulus: int = 4,
    remainder: int = 2,
    sample: int = SAMPLE,
    sample_rows: int = SAMPLE_ROWS,
    languages: int = MOST_LANGUAGES,
) -> Languages:
    """Classifiers from labelled rows whose id is not held out.

    Rows are counted per language first, so that each language's hash threshold lets through
    about ``sample`` rows; ``sample_rows`` profiles come to the driver at most. The ``languages``
    most frequent values of the column are learned: a column of noise stays bounded.
    """
    number = F.col(f"`{ident}`")
    rows = docs.select(
        number.alias("llm_id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & number.isNotNull() & ~held_out(number, modulus, remainder))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(languages)
    counts = {row["lang"]: row["n"] for row in sizes.collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS), np.float32), [])
    wanted = max(1, min(sample, sample_rows * 4 // 5 // len(counts)))
    pairs = [F.lit(x) for name, n in sorted(counts.items()) for x in (name, min(1.0, wanted / n))]
    share = F.try_element_at(F.create_map(*pairs), F.col("lang"))
    draw = F.pmod(F.xxhash64("llm_id", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    found = rows.where(draw < share).select("lang", "text").mapInArrow(_profiles, "lang string, profile binary")
    got = sorted((row["lang"], bytes(row["profile"])) for row in found.limit(sample_rows).collect())
    return fit(np.array([np.frombuffer(p, np.float32) for _, p in got]), [name for name, _ in got])


def identified(docs: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """The input with ``lang_pred``, ``score`` and ``ambiguous``. Only the text goes to Python."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def decoded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            yield pd.DataFrame([model.decode(x) for x in series], columns=["lang_pred", "score", "ambiguous"])

    kept = [F.col(f"`{name}`") for name in without(docs, "lang_pred", "score", "ambiguous").columns]
    found = fresh_name(docs, "llm_found")
    return docs.select(*kept, decoded(F.col(f"`{text}`")).alias(found)).select(*kept, f"{found}.*")


def op3_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the languages that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs)
    return identified(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous"
    )
