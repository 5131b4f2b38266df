import json

import pytest
from pyspark.sql import functions as F

from claimlake import schema
from claimlake.functions import urls
from claimlake.operators import ingest


def item(arrival, **fields):
    base = {f: f"{f}{arrival}" for f in schema.REQUIRED} | {"arrival": arrival, "agency_id": "a", "spider": "a", "run_id": "r", "item_id": "", "source_url": f"https://e.com/{arrival}", "canonical_url": ""}
    return base | fields


def table(spark, rows):
    names = ["arrival", *schema.FIELDS]
    kinds = {"arrival": "long"} | {f: "array<string>" if f in schema.LISTS else "string" for f in schema.FIELDS}
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} {kinds[n]}" for n in names))


def decided(spark, rows, seen=None):
    out = ingest.decide(ingest.default_items(table(spark, rows), run_id="r"), seen)
    return {r["arrival"]: r for r in out.collect()}


def test_first_arrival_wins_and_invalid_rows_take_no_key(spark):
    same = {"source_url": "https://e.com/x?utm_source=1"}
    rows = [item(3, **same), item(1, **same, title=" "), item(2, **same), item(4, source_url="https://e.com/x")]
    got = decided(spark, rows)
    assert {k: v["status"] for k, v in got.items()} == {1: "invalid", 2: "stored", 3: "deduped", 4: "deduped"}
    assert got[1]["errors"] == ["title: required"]


def test_history_and_ignoring_it(spark):
    key = urls.canonical("https://e.com/1")
    import hashlib

    seen = spark.createDataFrame([("a", hashlib.sha256(f"a|{key}".encode()).hexdigest())] * 2, "agency_id string, item_id string")
    assert decided(spark, [item(1), item(2)], seen)[1]["status"] == "deduped"
    assert decided(spark, [item(1), item(2)])[1]["status"] == "stored"


@pytest.mark.parametrize(
    ("fields", "errors"),
    [
        ({"title": "https://e.com/1?utm_x=2"}, ["title: the article's address"]), ({"published_at": "–"}, ["published_at: placeholder"]), ({"agency_name": None}, ["agency_name: required"]),
        ({"published_at": None, "title": None}, ["published_at: required", "title: required"]), ({"title": "https://other.com"}, []), ({}, []),
    ],
)
def test_errors(spark, fields, errors):
    assert decided(spark, [item(1, **fields)])[1]["errors"] == errors


def test_defaults_keep_what_was_given(spark):
    rows = [item(1, canonical_url="https://e.com/Keep/?utm_a=1", source_url="", item_id="own", collected_at="")]
    got = ingest.default_items(table(spark, rows), spider="s", collected_at="now").first()
    assert (got["canonical_url"], got["source_url"], got["item_id"], got["collected_at"], got["spider"]) == ("https://e.com/Keep/?utm_a=1", "https://e.com/Keep/?utm_a=1", "own", "now", "a")


def test_counts_hold_the_invariant(spark):
    rows = [item(i, source_url=f"https://e.com/{i % 3}", title=None if i % 5 == 0 else "t") for i in range(20)]
    counts = ingest.run_counts(ingest.decide(ingest.default_items(table(spark, rows)), None)).first()
    assert counts["items_seen"] == 20 == counts["items_stored"] + counts["items_deduped"] + counts["items_invalid"]
    assert counts["items_invalid"] == 4 and counts["items_stored"] == 3


def test_empty_table_and_clashing_columns(spark):
    assert ingest.decide(ingest.default_items(table(spark, [])), None).count() == 0
    df = ingest.default_items(table(spark, [item(1)])).withColumns({"status": F.lit("x"), "_first": F.lit(1), "errors": F.lit(2)})
    assert ingest.decide(df, None).first()["status"] == "stored"


def test_clean_and_normalise(spark):
    df = spark.createDataFrame([("caf&eacute;", ["a ", None, "a "], "u")], "title string, tags array<string>, other string")
    got = schema.normalise(ingest.clean_items(df)).first()
    assert got["title"] == "café" and got["tags"] == ["a", "a"] and got["topics"] == [] and "other" not in got.asDict()


def test_legacy_history(spark):
    lines = [json.dumps({"item_id": "1", "canonical_url": "a"}), "", "broken", json.dumps({"item_id": "1", "canonical_url": "b"}), json.dumps({"canonical_url": "c"}), json.dumps({"item_id": "2", "source_url": "s"})]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    got = {r["item_id"]: r for r in ingest.migrate_seen(df, order="n").collect()}
    assert got["1"]["canonical_url"] == "a" and got["2"]["source_url"] == "s" and got["2"]["seen_at"] == ""
    have = spark.createDataFrame([("1",)], "item_id string")
    assert [r["item_id"] for r in ingest.migrate_seen(df, have, "n").collect()] == ["2"]


def test_merge_runs(spark):
    stats = spark.createDataFrame(
        [("r", "a", "a", "A", "2", "5", 10, 8, 2, 0), ("r", "b", "b", "B", "1", "4", 20, 15, 3, 2)],
        "run_id string, spider string, agency_id string, agency_name string, started_at string, finished_at string, items_seen long, items_stored long, items_deduped long, items_invalid long",
    )
    got = ingest.merge_runs(stats).first()
    assert (got["started_at"], got["finished_at"], got["totals"].asDict()) == ("1", "5", {"items_seen": 30, "items_stored": 23, "items_deduped": 5, "items_invalid": 2})
    assert got["spiders"]["b"]["items_invalid"] == 2


def test_json_schema():
    made = schema.json_schema()
    assert made["additionalProperties"] is False and made["required"] == sorted(schema.REQUIRED) and made["properties"]["claim"]["type"] == ["string", "null"]
    assert made["properties"]["source_url"]["format"] == "uri" and set(made["properties"]) == set(schema.required_fields() + schema.optional_fields())


def test_write_items(spark, tmp_path):
    out = ingest.decide(ingest.default_items(table(spark, [item(1), item(2, title=None)])), None)
    ingest.write_items(out, f"{tmp_path}/items")
    assert spark.read.json(f"{tmp_path}/items").count() == 1
