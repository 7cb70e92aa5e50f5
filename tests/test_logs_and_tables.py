import json

from pyspark.sql import functions as F

from entitylake import schema as S
from entitylake.operators import search as SE
from entitylake.sources import logs as L
from entitylake.sources import tables as TA
from entitylake.sources import testbed as TB
from entitylake.streaming import response_log as RL

API = "https://h/api/2"


def rows(spark):
    hits = {"results": [{"id": "b", "schema": "X"}, {"id": "a", "schema": "X"}]}
    mail = {"id": "m", "schema": "Email", "properties": {"bodyHtml": ["<p>" + "word " * 300 + "</p>"]}}
    data = [
        ("1", f"{API}/search?q=x", 200, json.dumps(hits)),
        ("2", f"{API}/search?q=none", 200, '{"results": []}'),
        ("3", f"{API}/entities/m", 200, json.dumps(mail)),
        ("4", f"{API}/entities/m", 200, '["no object"]'),
        ("5", f"{API}/entities/m", 500, json.dumps(mail)),
        ("6", f"{API}/other", 200, "x" * 12_001),
        ("7", f"{API}/search?q=y", 200, "not json"),
    ]
    return spark.createDataFrame(data, S.RESPONSES)


def test_shape_log(spark):
    log = {r.response_id: r for r in L.shape_log(rows(spark), console=True).collect()}
    assert len(log) == 7
    assert [h["id"] for h in json.loads(log["1"].body)] == ["b", "a"]
    assert log["2"].body == "[]"
    assert json.loads(log["3"].body)["truncatedBody"] is False
    assert log["4"].body == '["no object"]' and log["5"].kind == "other" and log["7"].body == "not json"
    assert log["6"].body.startswith("x" * 12_000 + "\n… [truncated for console, 12001 chars total")


def test_redacted_headers(spark):
    df = spark.createDataFrame([({"Authorization": " ApiKey abc", "a": "b"}, {"authorization": "Bearer x"})], "h map<string,string>, g map<string,string>")
    row = df.select(L.redact_headers(F.col("h")).alias("h"), L.redact_headers(F.col("g")).alias("g")).first()
    assert row.h == {"Authorization": "ApiKey ***", "a": "b"} and row.g == {"authorization": "***"}


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows(spark).write.parquet(source)
    stream = RL.read_responses(spark, source)
    RL.write_records(RL.shape_entities(stream), out, state).awaitTermination()
    batch = RL.shape_entities(rows(spark))
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())
    assert batch.count() == 1 and RL.shape_hits(rows(spark)).count() == 2
    RL.write_records(RL.shape_entities(RL.read_responses(spark, source)), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_table_round_trip(spark, sf, tmp_path):
    path = str(tmp_path / "entities")
    corpus = TB.entities(spark, sf, TB.documents, TB.people, TB.conversation_pages)
    TA.write_entities(corpus, path)
    stored = TA.read_entities(spark, path)
    assert stored.count() == corpus.count() and stored.columns == S.COLUMNS
    from entitylake.operators import bodies as B

    for rows in (B.page_bodies(stored), stored.filter("schema = 'Page'")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "schema_dir" in plan.split("PartitionFilters")[1][:120]
    assert sorted(r.id for r in B.full_body(stored).collect()) == sorted(r.id for r in B.full_body(corpus).collect())
    people = TA.read_entities(spark, path, ["Person"])
    assert people.count() == TB.people(spark, sf).count()
    plan = people._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "schema_dir" in plan.split("PartitionFilters")[1][:80]
    found = SE.matching(stored, collection_id="src3").select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(collection_id), EqualTo(collection_id,src3)]" in plan
    assert "texts" not in plan.split("ReadSchema")[1]


def test_write_json(spark, tmp_path):
    path = str(tmp_path / "json")
    TA.write_json(spark.createDataFrame([('{"a":1}',)], "json string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ['{"a":1}']


def test_shared_folder_comes_from_the_session(spark):
    from entitylake.session import CHECKPOINT_SETTING, shared_folder, written

    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second and first.startswith(spark.conf.get(CHECKPOINT_SETTING))
    assert [r.id for r in written(spark.range(2)).orderBy("id").collect()] == [0, 1]


def test_logged_rows_stay_rows(spark):
    import json

    from entitylake.sources import logs as L

    def search(*names):
        return json.dumps({"results": [{"id": n, "schema": "Person"} for n in names]})

    url = "https://search.example.org/api/2/search?q=1"
    rows = [
        ("r1", url, 200, search("a", "b")), ("r1", url, 200, search("a", "b")), ("r1", url, 200, search("c")),
        (None, url, 200, search("d")), (None, url, 200, search()), (None, url, 200, search()), ("x", url, 500, "down"),
    ]
    log = spark.createDataFrame(rows, "response_id string, url string, status int, body string")
    shaped = [(r.response_id, r.kind, [h["id"] for h in json.loads(r.body)] if r.kind == "search" else r.body) for r in L.shape_log(log).collect()]
    assert sorted(shaped, key=str) == sorted(
        [("r1", "search", ["a", "b"]), ("r1", "search", ["a", "b"]), ("r1", "search", ["c"]), (None, "search", ["d"]),
         (None, "search", []), (None, "search", []), ("x", "other", "down")], key=str)
    plain = [json.loads(r.json) for r in L.search_output(log).collect()]
    assert sorted([h["id"] for h in hits] for hits in plain) == [[], [], ["a", "b"], ["a", "b"], ["c"], ["d"]]
    both = [json.loads(r.json) for r in L.search_output(log, include_raw=True).collect()]
    assert all([h["id"] for h in x["results"]] == [h["id"] for h in x["raw"]["results"]] for x in both) and len(both) == 6
