"""Processed records: cleaned, dated, labelled items of the selected runs, with optional language processing."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions import dates, labels, text
from claimlake.operators import profiles, runs
from claimlake.session import materialise

ENTITIES = "array<struct<text:string,label:string,start_char:int,end_char:int>>"

#: The columns of a processed record; the last is a struct.
RECORD_FIELDS = (
    "record_id", "source_record_id", "dataset_id", "source_url", "published_at", "language", "title", "author", "subtitle", "claim_text", "body_text",
    "analysis_text", "text_for_ner", "text_without_stopwords", "lemmatized_text", "original_label", "standard_label", "category", "entities", "variant", "metadata",
)


def drop_titles(items: DataFrame) -> DataFrame:
    """Without the rows whose title is an editorial page of their agency.  Needs the profile's columns."""
    title = text.casefold(text.clean_analysis(F.col("title")))
    return items.filter(~F.coalesce(F.array_contains("dropped_titles", title), F.lit(False)))


def compose(title: Column, claim: Column, summary: Column, order: Column, ignored: Column) -> Column:
    """The analysis text: cleaned once more, in the profile's order, without ignored titles and repeats, in lower case."""

    @F.pandas_udf(T.StringType())
    def join(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for titles, claims, summaries, orders, skips in batches:
            out = []
            for t, c, s, fields, skip in zip(titles, claims, summaries, orders, skips, strict=True):
                parts: dict[str, str] = {}
                for name in fields:
                    value = text.analysis_text({"title": t, "claim": c, "summary": s}[name])
                    if value and not (name == "title" and value.casefold() in skip):
                        parts.setdefault(value.casefold(), value.lower())
                out.append(" ".join(parts.values()))
            yield pd.Series(out, dtype=object)

    return join(title, claim, summary, order, ignored)


def processed_records(items: DataFrame, selections: DataFrame, dataset: str = "claims") -> DataFrame:
    """The records of the selected runs.

    Items join their selection on run and spider (a small table: one row per
    spider).  ``body_text`` is the summary; the label is the verdict, or the rating
    where the verdict is null or empty; a null id is the text ``None``.
    """
    chosen = selections.select("spider", F.col("selected_run_id").alias("run_id"), F.col("agency_id").alias("_agency_id"), F.col("agency_name").alias("_agency_name"), "latest_run_id", "fallback_applied")
    rows = drop_titles(profiles.with_profile(items.join(chosen, ["spider", "run_id"])))
    cleaned = {f"_{c}": text.clean_analysis(F.col(c)) for c in ("title", "claim", "summary", "source_url", "language", "author", "source_type", "rating")}
    raw_label = F.coalesce(F.nullif("verdict", F.lit("")), F.col("rating"))
    lists = {f"_{c}": text.clean_analysis_list(F.col(c)) for c in ("topics", "tags")}
    rows = rows.withColumns({**cleaned, **lists, "_label": text.clean_analysis(raw_label), "_published": dates.normalize_published_at(F.col("published_at"))})
    prefix = F.when(F.col("prefix_labels") & F.contains("_label", F.lit(":")), F.coalesce(text.squeeze(F.substring_index("_label", ":", 1)), F.col("_label"))).otherwise(F.col("_label"))
    rows = rows.withColumns({"_prefix": prefix, "_analysis": compose(F.col("_title"), F.col("_claim"), F.col("_summary"), F.col("field_order"), F.col("ignored_titles"))})
    rows = rows.withColumns({"_key": text.label_key_of(F.col("_label")), "_prefix_key": text.label_key_of(F.col("_prefix"))})
    dataset_id = F.concat(F.lit(f"{dataset}_"), F.col("spider"))
    item_id = F.coalesce("item_id", F.lit("None"))
    metadata = F.struct(
        F.length("_analysis").alias("analysis_text_length"), F.lit(0).alias("entity_count"), "spider", F.col("_agency_id").alias("agency_id"),
        F.col("_agency_name").alias("agency_name"), "run_id", "latest_run_id", "fallback_applied", F.col("_source_type").alias("source_type"),
        F.col("_topics").alias("source_topics"), F.col("_tags").alias("source_tags"), F.col("_rating").alias("source_rating"),
    )
    return rows.select(
        F.concat(dataset_id, F.lit(":"), item_id).alias("record_id"), item_id.alias("source_record_id"), dataset_id.alias("dataset_id"), F.col("_source_url").alias("source_url"),
        F.col("_published").alias("published_at"), F.col("_language").alias("language"), F.col("_title").alias("title"), F.col("_author").alias("author"),
        F.lit(None).cast("string").alias("subtitle"), F.col("_claim").alias("claim_text"), F.col("_summary").alias("body_text"), F.col("_analysis").alias("analysis_text"),
        F.col("_analysis").alias("text_for_ner"), F.lit("").alias("text_without_stopwords"), F.col("_analysis").alias("lemmatized_text"), F.col("_label").alias("original_label"),
        labels.standard_label(F.col("_label"), F.col("_key"), F.col("_prefix"), F.col("_prefix_key")).alias("standard_label"),
        F.coalesce(F.try_element_at("_topics", F.lit(1)), F.try_element_at("_tags", F.lit(1))).alias("category"),
        F.array().cast(ENTITIES).alias("entities"), F.lit("claim_summary").alias("variant"), metadata.alias("metadata"),
    )


def record_errors() -> Column:
    """What breaks the contract of a processed record; empty for a sound one."""
    checks = F.array(
        F.when(F.col("variant") != "claim_summary", "variant"),
        F.when(F.col("entities").isNull(), "entities"),
        F.when(F.col("metadata").isNull(), "metadata"),
        F.when(F.col("metadata.analysis_text_length") != F.length("analysis_text"), "analysis_text_length"),
        F.when(F.col("metadata.entity_count") != F.size("entities"), "entity_count"),
        F.when(~F.col("standard_label").isin("true", "false", "misleading", "unverified", "satire", "other", "missing"), "standard_label"),
    )
    return F.filter(checks, lambda e: e.isNotNull())


def with_language_model(records: DataFrame, factory: Callable, batch_size: int = 64) -> DataFrame:
    """Adds lemmas, text without stop words and entities by a model with ``pipe``; ``factory`` makes it once per worker.

    Tokens need ``text, lemma_, is_space, is_punct, is_stop``; entities ``text, label_,
    start_char, end_char``.  A lemma that cleans to nothing falls back to its token.
    Each row is read where it lies, so rows of one id, or of none, stay as many as they are.
    """

    made = f"struct<plain:string,lemmas:string,entities:{ENTITIES}>"

    @F.pandas_udf(made)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for texts in batches:
            plain, lemmas, entities = [], [], []
            for doc in model.pipe(["" if t is None else t for t in texts], batch_size=batch_size):
                words = [t for t in doc if not t.is_space and not t.is_punct]
                clean = lambda x: (text.analysis_text(x) or "").lower()
                plain.append(" ".join(w for t in words if not t.is_stop and (w := clean(t.text))))
                lemmas.append(" ".join(w for t in words if (w := clean(t.lemma_) or clean(t.text))))
                entities.append([{"text": n, "label": e.label_, "start_char": e.start_char, "end_char": e.end_char} for e in doc.ents if (n := text.analysis_text(e.text))])
            yield pd.DataFrame({"plain": plain, "lemmas": lemmas, "entities": entities})

    read = records.withColumn("_read", run("text_for_ner"))
    metadata = F.col("metadata").withField("entity_count", F.size("_read.entities"))
    return read.withColumns(
        {"text_without_stopwords": F.col("_read.plain"), "lemmatized_text": F.col("_read.lemmas"), "entities": F.col("_read.entities"), "metadata": metadata}
    ).select(*RECORD_FIELDS)


def load_model(name: str) -> Callable:
    """A factory of the named model, for ``with_language_model``; the library must be installed on the workers."""

    def factory():  # noqa: ANN202
        try:
            import spacy
        except ImportError as e:
            raise RuntimeError("the language library is not installed; pass a factory of your own") from e
        try:
            return spacy.load(name)
        except OSError as e:
            raise RuntimeError(f"the model {name!r} is not installed") from e

    return factory


def snapshot_counts(records: DataFrame) -> DataFrame:
    """Records per spider, and in all (``spider`` null)."""
    return records.select(F.col("metadata.spider").alias("spider")).rollup("spider").agg(F.count("*").alias("records"))


def build_snapshot(items: DataFrame, run_rows: DataFrame, path: str, snapshot_id: str, *, spiders: list[str] | None = None, factory: Callable | None = None, dataset: str = "claims") -> dict:
    """Writes the records of all spiders in one job, partitioned by spider, and the manifest; returns the manifest.

    Records that break the contract stop the export before the manifest is written.
    Only the manifest's one row per spider comes to the driver.
    """
    selections = runs.select_runs(run_rows)
    if spiders is not None:
        selections = selections.filter(F.col("spider").isin(spiders))
    selections = materialise(selections, "selections")
    records = processed_records(items, selections, dataset)
    if factory is not None:
        records = with_language_model(records, factory)
    home = f"{path.rstrip('/')}/{snapshot_id}"
    out = records.withColumn("spider", F.col("metadata.spider"))
    out.write.mode("overwrite").partitionBy("spider").option("ignoreNullFields", "false").json(f"{home}/records")
    written = items.sparkSession.read.schema(out.schema).json(f"{home}/records")
    bad = written.select("record_id", record_errors().alias("errors")).filter(F.size("errors") > 0).limit(5).collect()
    if bad:
        raise ValueError("records break the contract: " + "; ".join(f"{r['record_id']}: {', '.join(r['errors'])}" for r in bad))
    counts = written.groupBy("spider").agg(F.count("*").alias("records"))
    entries = [json.loads(r[0]) for r in runs.ordered(runs.manifest_entries(selections, counts)).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    manifest = {"snapshot_id": snapshot_id, "records_path": f"{home}/records", "total_records": sum(e["record_count"] for e in entries), "spiders": {e["spider"]: e for e in entries}}
    target = home.removeprefix("file://")
    if "://" not in target:
        Path(target).mkdir(parents=True, exist_ok=True)
        (Path(target) / "manifest.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    else:
        items.sparkSession.createDataFrame([(json.dumps(manifest, ensure_ascii=False, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(f"{home}/manifest")
    return manifest
