import json

from claimlake import cli
from claimlake.operators import runs
from claimlake.sources import files
from claimlake.streaming import ingest as stream

FIELDS = {"agency_name": "A", "published_at": "2026-01-01", "title": "T"}


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")


def test_stream_keeps_history_across_restarts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "arrival long, spider string, agency_id string, agency_name string, source_url string, title string, published_at string"
    read = lambda: spark.readStream.schema(schema).json(str(tmp_path / "in"))
    run = lambda: stream.start_ingest(read(), str(tmp_path / "out"), str(tmp_path / "cp"), run_id="r").awaitTermination()
    base = {"spider": "a", "agency_id": "a", **FIELDS}
    lines(tmp_path / "in" / "1.json", [base | {"arrival": 1, "source_url": "https://e.com/1"}, base | {"arrival": 2, "source_url": "https://e.com/1?utm_a=1"}, base | {"arrival": 3, "source_url": "https://e.com/2", "title": None}])
    run()
    lines(tmp_path / "in" / "2.json", [base | {"arrival": 1, "source_url": "https://e.com/1"}, base | {"arrival": 2, "source_url": "https://e.com/3"}])
    run()
    assert {r["source_url"] for r in spark.read.json(str(tmp_path / "out" / "items")).collect()} == {"https://e.com/1", "https://e.com/3"}
    totals = spark.read.parquet(str(tmp_path / "out" / "counts")).groupBy().sum("items_seen", "items_stored", "items_deduped", "items_invalid").first()
    assert tuple(totals) == (5, 2, 2, 1)
    batch = spark.read.schema(schema).json(str(tmp_path / "in" / "2.json"))
    stream.process_batch(batch, 1, str(tmp_path / "out"), run_id="r")
    assert spark.read.json(str(tmp_path / "out" / "items")).count() == 2


def test_windowed_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines(tmp_path / "in" / "1.json", [{"spider": "a", "collected_at": "2026-01-01T10:15:00+00:00"}, {"spider": "a", "collected_at": "2026-01-01T10:45:00+00:00"}, {"spider": "a", "collected_at": "bad"}])
    source = spark.readStream.schema("spider string, collected_at string").json(str(tmp_path / "in"))
    q = stream.counts_by_hour(source).writeStream.outputMode("complete").format("memory").queryName("by_hour").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["items"] for r in spark.sql("SELECT items FROM by_hour").collect()] == [2]


def data_folder(tmp_path):
    run = tmp_path / "data" / "runs" / "20260101T000000Z-0000000a"
    run.mkdir(parents=True)
    lines(run / "items.jsonl", [{"spider": "a", "title": "T", "topics": "x", "verdict": 3}, "", "broken", {"spider": "b", "topics": ["y"]}, "[1]"])
    stats = {"items_seen": 2, "items_stored": 2}
    (run / "run.json").write_text(json.dumps({"run_id": run.name, "spiders": {"a": stats}}), encoding="utf-8")
    for name, text in (("20260102T000000Z-0000000b", "{"), ("20260103T000000Z-0000000c", "")):
        (tmp_path / "data" / "runs" / name).mkdir()
        (tmp_path / "data" / "runs" / name / "run.json").write_text(text)
    return tmp_path / "data"


def test_items_and_runs(spark, tmp_path):
    home = data_folder(tmp_path)
    got = {r["spider"]: r for r in files.read_items(spark, f"{home}/runs/*/items.jsonl").collect()}
    assert set(got) == {"a", "b"} and got["a"]["topics"] is None and got["a"]["verdict"] == "3" and got["b"]["topics"] == ["y"]
    assert files.read_items(spark, f"{home}/runs/*/items.jsonl", "b").count() == 1
    assert [r["run_id"] for r in files.read_runs(spark, str(home)).collect()] == ["20260101T000000Z-0000000a"]
    assert files.list_runs(spark, str(home)).filter("has_metadata").count() == 3
    assert runs.run_spiders(files.read_runs(spark, str(home))).first()["items_stored"] == 2


def test_response_source_and_sql(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "p.html").write_text("<script type='application/ld+json'>{\"@type\": \"A\"}</script>")
    (tmp_path / "r" / "one.json").write_text(json.dumps([{"url": "https://e.com", "spider": "x", "file": "p.html"}, {"url": "https://f.com", "body": "t", "status": 404, "meta": {"page": 1}}]))
    files.register(spark)
    got = {r["url"]: r for r in spark.read.format("responses").option("path", str(tmp_path / "r")).load().collect()}
    assert got["https://e.com"]["status"] == 200 and got["https://f.com"]["meta"] == {"page": "1"}
    assert spark.sql("SELECT canonical_url('https://E.com/?utm_a=1') AS u").first()["u"] == "https://e.com/"
    page = (tmp_path / "r" / "p.html").read_text().replace('"', '\\"')
    assert spark.sql(f'SELECT * FROM jsonld_nodes("{page}")').first()["type"] == "A"


def test_schedule_and_cli(tmp_path, capsys):
    (tmp_path / "s.yaml").write_text("timezone: America/Sao_Paulo\njobs:\n- {name: n, spider: a, cron: '0 1 * * *'}\n- {spider: b}\n- {spider: c, cron: x, enabled: false}\n")
    jobs, warnings = files.due_jobs(files.load_schedule(str(tmp_path / "s.yaml")))
    assert [j["spider"] for j in jobs] == ["a"] and len(warnings) == 1
    (tmp_path / "e.yaml").write_text("")
    assert files.load_schedule(str(tmp_path / "e.yaml")) == {"timezone": "UTC", "jobs": []}
    assert cli.main(["list"]) == 0 and "uol_confere" in capsys.readouterr().out
    assert cli.main(["extract", "--responses", "x", "--spider", "nope"]) == 2
    assert cli.main(["schedule", "--config", str(tmp_path / "s.yaml")]) == 0
