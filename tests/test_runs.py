import pytest
from pyspark.sql import functions as F

from claimlake.operators import processing, quality, runs
from claimlake.schema import RUN


def stats(seen, stored, invalid=0, **texts):
    return {"agency_id": texts.get("agency_id"), "agency_name": None, "started_at": None, "finished_at": None, "items_seen": seen, "items_stored": stored, "items_deduped": None, "items_invalid": invalid}


@pytest.fixture
def flat(spark):
    rows = [
        ("r1", None, "2", {"a": stats(10, 5), "b": stats(3, 0, 3), "u": stats(906, 19)}, None), ("r2", "1", "", {"a": stats(2, 2), "u": stats(0, 0)}, None),
        ("r1", None, "2", {"a": stats(10, 5), "b": stats(3, 0, 3), "u": stats(906, 19)}, None), ("r3", None, None, {}, None), ("r4", None, None, None, None),
    ]
    return runs.run_spiders(spark.createDataFrame(rows, RUN))


def test_selection_with_fallback(flat):
    got = {r["spider"]: r for r in runs.select_runs(flat).collect()}
    assert (got["a"]["selected_run_id"], got["a"]["selection_reason"]) == ("r2", "latest_valid_run")
    assert (got["u"]["selected_run_id"], got["u"]["fallback_applied"]) == ("r1", True)
    assert (got["b"]["selected_run_id"], got["b"]["latest_valid_run_id"], got["b"]["selection_reason"]) == ("r1", None, "latest_run_without_valid_items")


def test_defaults_and_repeated_rows(flat):
    assert flat.count() == 5 and flat.filter("spider = 'b'").first()["agency_id"] == "b" and flat.filter("spider = 'u' AND run_id = 'r1'").first()["items_deduped"] == 0


def test_report(flat):
    rates = {(r["run_id"], r["spider"]): r["store_rate"] for r in runs.run_report(flat).collect()}
    assert rates[("r2", "u")] == 0.0 and rates[("r1", "a")] == 0.5
    assert {r["alert"] for r in runs.alerts(flat).collect()} == {"b: 0 items stored (seen=3, invalid=3)", "u: 0 items stored (seen=0, invalid=0)"}
    totals = {r["run_id"]: r for r in runs.run_totals(flat).collect()}
    assert totals["r1"]["items_seen"] == 919 and totals["r1"]["zero_spiders"] == 1
    text = runs.format_report(flat)
    assert "Run r2" in text and "(!)" in text and text.index("Run r2") < text.index("Run r1") and "50%" in text
    assert runs.format_report(flat.limit(0)) == "No runs found."


def test_latest(spark, flat):
    assert [r[0] for r in runs.latest_runs(flat, 1).collect()] == ["r2"]
    listing = spark.createDataFrame([("r9", False), ("r8", True), ("r7", True)], "run_id string, has_metadata boolean")
    assert [r[0] for r in runs.latest_complete_runs(listing, 2).collect()] == ["r8"]


def test_standing_order(spark):
    df = spark.createDataFrame([("zeta",), ("uol_confere",), ("alpha",), ("afp_checamos",)], "spider string")
    assert [r[0] for r in runs.ordered(df).collect()] == ["afp_checamos", "uol_confere", "alpha", "zeta"]


ITEMS = "spider string, run_id string, item_id string, source_url string, title string, claim string, summary string, verdict string, rating string, published_at string, language string, author string, source_type string, topics array<string>, tags array<string>"


def items(spark, *rows):
    names = [c.split()[0] for c in ITEMS.split(", ")]
    base = {"spider": "a", "run_id": "r2", "item_id": "1", "title": "T", "topics": [], "tags": []}
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], ITEMS)


def test_processed_records(spark, flat):
    df = items(
        spark,
        {"title": "Título &amp;amp; x", "claim": "Título &amp;amp; x", "summary": "Resumo", "verdict": "", "rating": "Falso", "topics": ["Saúde", "saúde", "-"], "published_at": "2026-01-01"},
        {"item_id": None, "verdict": "-", "rating": "Falso", "tags": ["b"]}, {"run_id": "r1"}, {"spider": "none"},
    )
    got = {r["source_record_id"]: r for r in processing.processed_records(df, runs.select_runs(flat)).collect()}
    one, none = got["1"], got["None"]
    assert len(got) == 2 and one["title"] == "Título &amp; x" and one["analysis_text"] == "título & x resumo" and one["body_text"] == "Resumo"
    assert one["standard_label"] == "false" and one["category"] == "Saúde" and one["metadata"]["source_topics"] == ["Saúde"] and one["published_at"] == "2026-01-01T00:00:00+00:00"
    assert none["standard_label"] == "missing" and none["category"] == "b" and none["record_id"] == "claims_a:None"


def test_profile_rules(spark):
    sel = spark.createDataFrame(
        [("observador", "r", "o", "O", "r", False), ("afp_checamos", "r", "f", "F", "r", False), ("projeto_comprova", "r", "p", "P", "r", True)],
        "spider string, selected_run_id string, agency_id string, agency_name string, latest_run_id string, fallback_applied boolean",
    )
    df = items(
        spark, {"spider": "observador", "run_id": "r", "title": "OBSERVADOR", "claim": "c", "summary": "s"}, {"spider": "afp_checamos", "run_id": "r", "title": "Como trabalhamos"},
        {"spider": "projeto_comprova", "run_id": "r", "item_id": "2", "verdict": "Enganoso: é assim", "title": "x"},
    )
    got = {r["metadata"]["spider"]: r for r in processing.processed_records(df, sel).collect()}
    assert set(got) == {"observador", "projeto_comprova"} and got["observador"]["analysis_text"] == "c s" and got["projeto_comprova"]["standard_label"] == "misleading"


def model():
    """A stub of a language model, made where it runs."""

    class Token:
        def __init__(self, text, lemma, stop, punct):
            self.text, self.lemma_, self.is_stop, self.is_punct, self.is_space = text, lemma, stop, punct, False

    class Doc(list):
        ents: list = []

    class Model:
        def pipe(self, texts, batch_size):
            for t in texts:
                yield Doc([Token(w, "-" if w == "x" else w.upper(), w == "t", w == ".") for w in t.split()])

    return Model()


def test_language_model_and_snapshot(spark, flat, tmp_path):
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__))
    factory = model
    df = items(spark, {"title": "t x .", "verdict": "Falso"}, {"spider": "u", "run_id": "r1", "title": "y"})
    records = processing.with_language_model(processing.processed_records(df, runs.select_runs(flat)), factory)
    one = records.filter("dataset_id = 'claims_a'").first()
    assert one["text_without_stopwords"] == "x" and one["lemmatized_text"] == "t x" and records.filter("size(entities) > 0").count() == 0
    manifest = processing.build_snapshot(df, flat, str(tmp_path), "s1")
    assert manifest["total_records"] == 2 and list(manifest["spiders"]) == ["a", "b", "u"] and (tmp_path / "s1" / "manifest.json").exists()
    assert "fallback_to_latest_valid_run" in manifest["spiders"]["u"]["cleaning_flags"] and manifest["spiders"]["b"]["record_count"] == 0
    assert processing.snapshot_counts(processing.processed_records(df, runs.select_runs(flat))).filter("spider is null").first()["records"] == 2


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", "12345", None, " ", ["x"]), ("a", "  123456789012345 ", "v", None, []), (None, "", None, None, None)], "spider string, summary string, verdict string, claim string, tags array<string>"
    )
    got = {r["spider"]: r for r in quality.quality_profile(df).collect()}
    assert got["a"]["avg_summary_length"] == 10.0 and got["a"]["filled_verdict"] == 1 and got["a"]["null_verdict"] == 1 and got["a"]["filled_claim"] == 0 and got["a"]["filled_tags"] == 1
    assert got[None]["avg_summary_length"] == 0.0 and got[None]["verdict_fill_rate"] == 0.0
    rates = {(r["spider"], r["field"]): r["fill_rate"] for r in quality.fill_rates(quality.quality_profile(df)).collect()}
    assert rates == {("a", "summary"): 1.0, ("a", "verdict"): 0.5, ("a", "tags"): 0.5}
    assert quality.quality_profile(df.drop("spider")).first()["spider"] == "unknown"
    assert quality.format_quality(quality.quality_profile(df.limit(0))) == "No items to analyze."
    assert "10.0" in quality.format_quality(quality.quality_profile(df))


def test_language_model_keeps_rows_that_share_an_id(spark, flat):
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__))
    factory = model
    df = items(spark, {"title": "t x ."}, {"title": "t x ."})
    records = processing.processed_records(df, runs.select_runs(flat))
    records = records.withColumn("record_id", F.lit("None"))
    assert processing.with_language_model(records, factory).count() == records.count() == 2


def test_records_that_break_the_contract_stop_the_export(spark, flat, tmp_path, monkeypatch):
    df = items(spark, {"title": "t"})
    whole = processing.processed_records
    monkeypatch.setattr(processing, "processed_records", lambda *a: whole(*a).withColumn("variant", F.lit("other")))
    with pytest.raises(ValueError, match="contract"):
        processing.build_snapshot(df, flat, str(tmp_path), "s1")
    assert not (tmp_path / "s1" / "manifest.json").exists()
