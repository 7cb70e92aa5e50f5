"""Main text of web pages by deduced templates.

Tokens of a page are its elements, told apart by their path, and its blocks of text, told apart
by path and text. On the pages of one host, tokens with the same occurrence vector (how often
they occur on each page) form an equivalence class. A class that holds a text and an element
around it, at any depth, says that the element always brings this text: the text belongs to the
template. So a notice that stands once on every page is constant, also among the paragraphs of
an article. Such classes, large and frequent enough, are nested by their paths; what remains of
a page are the slots, and the main text is what stands in the slots of its main element (chosen
by the text in them), without those around it (menus, notices, adverts, forms, comments).

Vectors are never built: their number of pages, sum and a commutative hash are aggregated per
token with partial sums before the shuffle, so a host with a third of all pages is no group in
one task. A host keeps at most ``1 / SHARE`` times as many constant tokens as a page has; only
these are looked at together.

Defined results: a null or empty page has the empty text; a page without a host in its address
is read without a template, like a host of fewer than ``PAGES`` different pages; repeated rows,
and the same source at several addresses of a host, are one page of it; columns of the input stay, those named like an output column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.html_blocks import SURELY, main_text, read
from entitylake.llm.shared import slices, without, written

#: A constant text stands on so many different pages of its host at least, and on this share of them.
PAGES = 3
SHARE = 0.05

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


_TOKENS = "host string, page long, tokens array<struct<parent: long, token: long, element: boolean, n: int>>"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        rows: list[tuple[int, int, bool, int]] = []
        ends = [0]
        for source in batch.column(2).to_pylist():
            blocks, paths = read(source)
            rows += [(parent, path, True, n) for (path, parent), n in Counter(paths).items()]
            texts = Counter((block.path, block.token) for block in blocks if block.around < SURELY)
            rows += [(path, token, False, n) for (path, token), n in texts.items()]
            ends.append(len(rows))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        tokens = pa.StructArray.from_arrays(columns, ["parent", "token", "element", "n"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["host", "page", "tokens"])


def occurrences(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Per host and token: on how many different pages, how often in all, and the hash of its occurrence vector.

    Equal sources on one host are one page. The tokens of a page, not its source, are moved to
    tell them apart; copies meet within a task first.
    """
    body = F.col(f"`{source}`")
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.xxhash64(body).alias("page"), body.alias("html"))
    found = rows.where("host != '' AND html IS NOT NULL").mapInArrow(_tokens, _TOKENS).dropDuplicates(["host", "page"])
    return (
        found.select("host", "page", F.inline("tokens"))
        .groupBy("host", "parent", "token", "element")
        .agg(
            F.count("*").alias("pages"),
            F.sum("n").alias("total"),
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
        )
        .where(F.col("pages") >= PAGES)
    )


def with_class(found: DataFrame) -> DataFrame:
    """The tokens with their equivalence class: those of a host with equal vectors share one."""
    return found.withColumn("class", F.xxhash64("pages", "total", "vector"))


def nested(tokens: DataFrame) -> DataFrame:
    """The valid classes of each host with the class that they are nested in (null for the outermost).

    A class is valid if all its elements that don't lie in one another lie in elements of one
    other class: its tokens then fill the same slot of the same part of the template.
    """
    elements = tokens.where("element").select("host", "token", "parent", "class")
    above = elements.select("host", F.col("token").alias("parent"), F.col("class").alias("outer"))
    edges = elements.join(above, ["host", "parent"], "left")
    outer = F.when(F.col("outer") != F.col("class"), F.col("outer"))
    return (
        edges.groupBy("host", "class")
        .agg(F.min(outer).alias("within"), F.max(outer).alias("last"), F.count("*").alias("elements"))
        .where(F.col("within").isNull() | (F.col("within") == F.col("last")))
        .select("host", "class", "within", "elements")
    )


def _lasting(table: pa.Table) -> pa.Table:
    """The texts of one host that are in one class with an element that they stand in, at any depth."""
    columns = [table.column(name).to_pylist() for name in ("parent", "token", "element", "class")]
    rows = list(zip(*columns, strict=True))
    above = {token: (parent, kind) for parent, token, element, kind in rows if element}

    def brought(at: int, kind: int) -> bool:
        while at in above:
            at, own = above[at]
            if own == kind:
                return True
        return False

    return table.filter(pa.array([not element and brought(parent, kind) for parent, _, element, kind in rows], pa.bool_()))


def templates(found: DataFrame) -> DataFrame:
    """Per host the constant texts: those in one valid class with an element that they stand in."""
    tokens = with_class(found)
    sizes = found.groupBy("host").agg(F.max("pages").alias("host_pages"))
    kinds = tokens.where("element").select("host", "class").distinct()
    return (
        tokens.join(sizes, "host")
        .where(F.col("pages") >= F.col("host_pages") * SHARE)
        .join(kinds, ["host", "class"], "left_semi")
        .select("host", "parent", "token", "element", "class")
        .groupBy("host")
        .applyInArrow(_lasting, "host string, parent long, token long, element boolean, class long")
        .join(nested(tokens), ["host", "class"], "left_semi")
        .groupBy("host")
        .agg(F.collect_list("token").alias("constant"))
    )


def _extracted(constant: pd.Series, sources: pd.Series) -> pd.Series:
    return pd.Series(
        [
            main_text(read(source)[0], frozenset(() if tokens is None else (int(t) for t in tokens))) if source else ""
            for tokens, source in zip(constant, sources, strict=True)
        ],
        dtype=object,
    )


def extracted(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """The input with the main ``text`` of each page and its ``n_chars``.

    Templates are read back from a written table, so Spark knows their size: it broadcasts
    them if they are small, and joins by host, splitting large ones, if they are not.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for constant, sources in batches:
            yield _extracted(constant, sources)

    names = [name for name in without(pages, "text", "n_chars").columns]
    table = written(templates(written(occurrences(pages, url, source))))
    rows = pages.select(F.struct("*").alias("row"), host_of(F.col(f"`{url}`")).alias("host"))
    joined = rows.join(table, "host", "left").select("row", text("constant", F.col(f"row.`{source}`")).alias("text"))
    return joined.select(*[F.col(f"row.`{name}`").alias(name) for name in names], "text", F.length("text").cast("long").alias("n_chars"))


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
