"""Line dedup: range-partitioned hashes, first occurrences, keep bitmaps; built-in functions only.

A line's key is the line stripped of white space, with A-Z lower-cased. Keys of at least ten code
points that lie in several documents keep their lines only in the smallest document. Lines become
narrow rows (128-bit hash, document, position), written once. They are range-partitioned by hash
and sorted by document and position; the first occurrence of a hash streams down its rows, and
every row of another document is dropped. What comes back is a bitmap per document that loses
lines, never a text.

A key that holds more than its share of all rows (found in a sample of the rows, which decides
about the way only, not about the result) is not shuffled: its smallest document is a minimum
with partial aggregation, and its rows are compared with it where they lie. At most ``SHARES``
keys can be that frequent, which bounds the broadcast.

A bitmap is stored as bytes in the shorter of two forms. The first byte tells the form: 0 for
plain bits (bit set: the line is dropped), 1, 2 or 4 for runs of dropped lines, as (first line,
lines) in numbers of so many bytes. Lines after the last dropped one are not stored.

Defined results: a null or empty text is one empty line; rows with the same id are one document,
so they never take each other's lines, and each row is cut for itself; rows without an id are one
document, last in order; columns of the input stay, those named like an output column are
replaced; an empty table gives no bitmaps.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylake.llm.shared import SPACES, bind, fresh_name, without, written

KEY_CHARS = 10

#: A key with more than this part of all rows takes the way without a shuffle.
SHARES = 16_384
LEAST_HOT = 1_000
#: Rows in which frequent keys are looked for.
SAMPLE = 4_000_000


def lines_of(text: Column) -> Column:
    """The lines of a text; one empty line for a null text."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_rows(docs: DataFrame, ident: str = "doc_id", text: str = "text", key_chars: int = KEY_CHARS) -> DataFrame:
    """Per line with a long enough key: the key's hash, document, hash of the whole text, position."""
    body = F.col(f"`{text}`")
    lowered = F.translate(F.coalesce(body, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    keys = F.transform(F.split(lowered, "\n"), lambda line: F.btrim(line, F.lit(SPACES)))
    return (
        docs.select(F.col(f"`{ident}`").alias("doc"), F.xxhash64(body).alias("tag"), F.posexplode(keys).alias("pos", "key"))
        .where(F.length("key") >= key_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "tag", "pos")
    )


def frequent(rows: DataFrame, shares: int = SHARES, least: int = LEAST_HOT) -> DataFrame:
    """Hashes (``h1``) that hold more than 1/``shares`` of the rows, by a sample; written."""
    total = rows.count()
    part = min(1.0, SAMPLE / max(1, total))
    bar = max(least, total / shares)
    drawn = rows.select("h1") if part == 1.0 else rows.select("h1").sample(part, seed=11)
    return written(drawn.groupBy("h1").agg(F.count("*").alias("n")).where(F.col("n") > bar * part).select("h1"))


def _order(doc: Column) -> Column:
    """Documents in order of their ids, those without an id last."""
    return F.struct(doc.isNull().alias("unnamed"), doc.alias("doc"))


def dropped_rows(rows: DataFrame, shares: int = SHARES, least: int = LEAST_HOT) -> DataFrame:
    """Document, text hash and position of every line that its document loses.

    ``rows`` must be a written table: it is read several times.
    """
    hot = frequent(rows, shares, least)
    cold = rows.join(F.broadcast(hot), "h1", "left_anti").repartitionByRange("h1", "h2")
    stream = Window.partitionBy("h1", "h2").orderBy(_order(F.col("doc")), "pos").rowsBetween(Window.unboundedPreceding, 0)
    firsts = cold.withColumn("first", F.first(_order(F.col("doc"))).over(stream))
    seldom = firsts.where(F.col("first") != _order(F.col("doc"))).select("doc", "tag", "pos")
    often = rows.join(F.broadcast(hot), "h1")
    least_doc = written(often.groupBy("h1", "h2").agg(F.min(_order(F.col("doc"))).alias("first")))
    others = often.join(F.broadcast(least_doc), ["h1", "h2"]).where(F.col("first") != _order(F.col("doc")))
    return seldom.unionByName(others.select("doc", "tag", "pos"))


# --- Bitmaps --------------------------------------------------------------


def _hex(number: Column, width: int) -> Column:
    return F.lpad(F.hex(number), 2 * width, "0")


def packed(places: Column) -> Column:
    """A bitmap as bytes from the sorted positions of the dropped lines (one at least)."""

    def encode(drops: Column) -> Column:
        starts = F.filter(drops, lambda x, i: F.coalesce(F.get(drops, i - 1) != x - 1, F.lit(True)))
        stops = F.filter(drops, lambda x, i: F.coalesce(F.get(drops, i + 1) != x + 1, F.lit(True)))
        runs = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("at"), (b - a + 1).alias("n")))

        def shorter(found: Column) -> Column:
            last = F.element_at(drops, -1)

            def written_runs(width: int) -> Column:
                pairs = F.transform(found, lambda r: F.concat(_hex(r["at"], width), _hex(r["n"], width)))
                return F.concat(F.lit(f"0{width}"), F.array_join(pairs, ""))

            # Kept and dropped stretches as signs, cut into eights.
            signs = F.array_join(
                F.transform(
                    found,
                    lambda r, i: F.concat(
                        F.repeat(F.lit("0"), r["at"] - F.coalesce(F.get(found, i - 1)["at"] + F.get(found, i - 1)["n"], F.lit(0))),
                        F.repeat(F.lit("1"), r["n"]),
                    ),
                ),
                "",
            )
            eights = F.regexp_extract_all(F.concat(signs, F.repeat(F.lit("0"), 7 - last % 8)), F.lit(".{8}"), F.lit(0))
            bits = F.concat(
                F.lit("00"), F.array_join(F.transform(eights, lambda x: F.lpad(F.conv(x, 2, 16), 2, "0")), "")
            )
            width = F.when(last < 255, 1).when(last < 65_535, 2).otherwise(4)
            runs_form = F.when(width == 1, written_runs(1)).when(width == 2, written_runs(2)).otherwise(written_runs(4))
            return F.when(2 * width * F.size(found) <= F.floor(last / 8) + 1, runs_form).otherwise(bits)

        return bind(runs, shorter)

    return F.unhex(bind(places, encode))


def kept(lines: Column, bitmap: Column) -> Column:
    """The lines that a bitmap keeps; all of them where there is none. Linear in the lines."""
    coded = F.hex(bitmap)
    form, body = F.substring(coded, 1, 2), F.substr(coded, F.lit(3))
    signs = F.array_join(
        F.transform(F.regexp_extract_all(body, F.lit(".."), F.lit(0)), lambda x: F.lpad(F.conv(x, 16, 2), 8, "0")), ""
    )
    by_bits = bind(
        F.split(signs, ""), lambda bits: F.filter(lines, lambda line, i: F.coalesce(F.get(bits, i) != "1", F.lit(True)))
    )

    def by_runs(width: int) -> Column:
        def numbers(pair: Column) -> Column:
            at, n = F.substring(pair, 1, 2 * width), F.substring(pair, 2 * width + 1, 2 * width)
            return F.struct(F.conv(at, 16, 10).cast("int").alias("at"), F.conv(n, 16, 10).cast("int").alias("n"))

        def between(runs: Column) -> Column:
            def before(i: Column, upto: Column) -> Column:
                start = F.coalesce(F.get(runs, i - 1)["at"] + F.get(runs, i - 1)["n"], F.lit(0))
                return F.slice(lines, start + 1, upto - start)

            gaps = F.transform(runs, lambda r, i: before(i, r["at"]))
            return F.concat(F.flatten(gaps), before(F.size(runs), F.size(lines)))

        pairs = F.regexp_extract_all(body, F.lit(".{%d}" % (4 * width)), F.lit(0))
        return bind(F.transform(pairs, numbers), between)

    runs = F.when(form == "01", by_runs(1)).when(form == "02", by_runs(2)).otherwise(by_runs(4))
    return F.when(bitmap.isNull(), lines).when(form == "00", by_bits).otherwise(runs)


def keep_bitmaps(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    key_chars: int = KEY_CHARS,
    shares: int = SHARES,
    least: int = LEAST_HOT,
) -> DataFrame:
    """Documents that lose lines: ``doc``, ``tag`` (hash of the whole text), ``n_dropped``, ``keep``. Written."""
    rows = written(line_rows(docs, ident, text, key_chars))
    places = dropped_rows(rows, shares, least).groupBy("doc", "tag").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    return written(
        places.select("doc", "tag", F.size("places").cast("long").alias("n_dropped"), packed(F.col("places")).alias("keep"))
    )


def deduplicated(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    key_chars: int = KEY_CHARS,
    shares: int = SHARES,
    least: int = LEAST_HOT,
) -> DataFrame:
    """The input with ``n_lines``, ``n_dropped`` and ``kept_text``.

    The join leaves texts where they are as long as the written bitmaps are small enough for a
    broadcast, which Spark knows from their files; else both sides are shuffled by document.
    """
    names = ("n_lines", "n_dropped", "kept_text")
    bitmaps = keep_bitmaps(docs, ident, text, key_chars, shares, least)
    body = F.col(f"d.`{text}`")
    tag = fresh_name(docs, "llm_tag")
    tagged = docs.withColumn(tag, F.xxhash64(F.col(f"`{text}`")))
    same = F.col(f"d.`{ident}`").eqNullSafe(F.col("b.doc")) & (F.col(f"d.`{tag}`") == F.col("b.tag"))
    whole = F.coalesce(body, F.lit(""))
    left = F.when(F.col("b.keep").isNull(), whole).otherwise(F.array_join(kept(lines_of(body), F.col("b.keep")), "\n"))
    return (
        tagged.alias("d")
        .join(bitmaps.alias("b"), same, "left")
        .select(
            *[F.col(f"d.`{name}`") for name in without(docs, *names).columns],
            (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
            F.coalesce("b.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
            left.alias("kept_text"),
        )
    )


#: The same for DuckDB, over whole keys.
SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {KEY_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT k.*, coalesce(first <> doc_id, false) AS gone FROM keyed k LEFT JOIN firsts USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines counted and what is left of its text digested."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
