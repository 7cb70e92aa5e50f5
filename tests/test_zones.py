"""Zone columns and Bloom filters: the same rows as the predicates, and what the scan leaves out."""

import random

import pytest
from pyspark.sql import functions as F

from entitylake import schema as SC
from entitylake.operators import predicates as P
from entitylake.operators import search as S
from entitylake.sources import zones as Z

ZONES = {"date": "date", "total": "double"}


@pytest.fixture(scope="module")
def corpus(entity):
    draw = random.Random(9)
    dates = ["2001", "2001-02", "1999-12-31", "2010-05-05", "soon", "0001-01-01", "9999-12-31"]
    objects = [
        {
            "id": f"e{i}",
            "schema": draw.choice(["Order", "Event"]),
            "collection_id": f"c{i % 5}",
            "properties": {"date": draw.sample(dates, draw.randrange(0, 3)), "total": draw.choice([[], ["12", "x"], ["-1e3"], ["99.5", "NaN"]])},
        }
        for i in range(150)
    ]
    return entity(*objects, {"id": "none"}).cache()


@pytest.fixture(scope="module")
def stored(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zoned") / "t")
    Z.write_zoned(corpus, path, ZONES)
    return Z.read_zoned(spark, path, ZONES)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize(
    ("zoned", "plain"),
    [
        (lambda: Z.date_between("date", "2001", "2001"), lambda: P.prop_date_between("date", "2001", "2001")),
        (lambda: Z.date_between("date", "1999-12-31", "2001-02"), lambda: P.prop_date_between("date", "1999-12-31", "2001-02")),
        (lambda: Z.date_between("date", "2011-01-01", "2012-01-01"), lambda: P.prop_date_between("date", "2011-01-01", "2012-01-01")),
        *[(lambda op=op: Z.date_cmp("date", op, "2001-02-01"), lambda op=op: P.prop_date_cmp("date", op, "2001-02-01")) for op in (">", ">=", "<", "<=", "=")],
        *[(lambda op=op: Z.num_cmp("total", op, 12), lambda op=op: P.prop_num_cmp("total", op, 12)) for op in (">", ">=", "<", "<=", "=")],
    ],
)
def test_same_rows_as_the_predicates(corpus, stored, zoned, plain):
    assert ids(S.matching(stored, zoned())) == ids(S.matching(corpus, plain()))


def test_the_table_is_the_same(corpus, stored):
    assert stored.columns[: len(SC.COLUMNS)] == SC.COLUMNS and stored.columns[len(SC.COLUMNS) :] == [n for k in ZONES for n in Z._names(k)]
    assert ids(stored) == ids(corpus)
    assert ids(Z.lookup(stored, ["e3", " e4 ", "absent", "e3"])) == ["e3", "e4"] and Z.lookup(stored, []).count() == 0
    with pytest.raises(ValueError):
        Z.zone_columns({"x": "text"})


def test_curve_takes_bits_in_turn(spark):
    pairs = spark.range(8).crossJoin(spark.range(8).withColumnRenamed("id", "b"))
    rows = pairs.select("id", "b", Z.curve(F.col("id"), F.col("b")).alias("z")).collect()
    assert sorted(r.z for r in rows) == list(range(64))
    assert {(r.id, r.b) for r in rows if r.z < 4} == {(0, 0), (1, 0), (0, 1), (1, 1)}


def scanned(df):
    """Rows that the scan of the executed plan gave out."""
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    plan = query.executedPlan()
    df._jdf.queryExecution().executedPlan().executeCollect()
    final = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = final.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_scans_leave_out_row_groups(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.concat(F.lit("k"), F.md5(F.col("id").cast("string"))).alias("id"),
        F.lit("Event").alias("schema"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("collection_id"),
        F.create_map(F.lit("date"), F.array(F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 9000).cast("int")).cast("string"))).alias("props"),
    )
    path = str(tmp_path / "many")
    Z.write_zoned(rows.coalesce(1), path, {"date": "date"}, row_group_bytes=200_000)
    table = Z.read_zoned(spark, path, {"date": "date"})
    total = scanned(table.select("id", "props"))
    assert total == 60_000
    wanted = table.filter(Z.date_between("date", "1995", "1995-03")).select("id")
    assert wanted.count() == table.filter(P.prop_date_between("date", "1995", "1995-03")).count() > 0
    assert scanned(wanted) < total / 3
    assert scanned(Z.lookup(table, ["kabsent", "k0"]).select("id", "props")) == 0
    one = table.select("id").first().id
    assert 0 < scanned(Z.lookup(table, [one]).select("id", "props")) < total / 2


def test_wide_rows_are_written_where_they_are(spark, corpus, tmp_path):
    parts = corpus.repartition(3).cache()
    Z.write_zoned(parts, f"{tmp_path}/t", ZONES)
    written = spark.read.parquet(f"{tmp_path}/t").filter("id IS NOT NULL")
    by_file = {frozenset(r.ids) for r in written.groupBy(F.input_file_name(), "schema_dir").agg(F.collect_set("id").alias("ids")).collect()}
    by_task = {frozenset(r.ids) for r in parts.groupBy(F.spark_partition_id(), "schema").agg(F.collect_set("id").alias("ids")).collect()}
    assert by_file == by_task
