"""From extracted records to stored items: clean, default, validate, deduplicate, write.

Status and errors are columns; a rejected row stays in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake import schema
from claimlake.functions import text, urls

#: Text fields that are cleaned at ingest; addresses, ids, dates and names are not.
CLEANED = ("title", "claim", "summary", "verdict", "rating", "author", "body", "language", "country", "source_type")


def clean_items(df: DataFrame) -> DataFrame:
    """Stored-text cleaning of the text fields and lists that are present; lists keep their repeats."""
    out = {f: text.clean_stored(F.col(f)) for f in CLEANED if f in df.columns}
    out |= {f: text.clean_stored_list(F.col(f)) for f in schema.LISTS if f in df.columns}
    return df.withColumns(out)


def default_items(df: DataFrame, *, spider: str | None = None, agency_id: str | None = None, agency_name: str | None = None, run_id: str | None = None, collected_at: str | None = None) -> DataFrame:
    """Empty spider, agency, run and collection time are filled in; source and canonical address default to each other.

    A supplied canonical address isn't made canonical again; the id is made only where it is missing.
    """
    have = lambda c: F.nullif(F.col(c), F.lit(""))
    given = {"spider": spider, "agency_id": agency_id, "agency_name": agency_name, "run_id": run_id, "collected_at": collected_at or urls.utc_now_iso()}
    df = df.withColumns({c: F.coalesce(have(c), F.lit(v)) for c, v in given.items()})
    df = df.withColumn("source_url", F.coalesce(have("source_url"), have("canonical_url")))
    df = df.withColumn("canonical_url", F.coalesce(have("canonical_url"), urls.canonicalize_url(F.col("source_url"))))
    return df.withColumn("item_id", F.coalesce(have("item_id"), urls.make_item_id(F.col("agency_id"), F.col("canonical_url"))))


def item_errors(kinds: dict[str, str] | None = None) -> Column:
    """All that is wrong with an item, as an array of messages in field order; ``kinds`` are the columns' types, if known.

    A null or blank required field, a list that isn't one, a title that is the
    article's own address, a placeholder for the date.
    """
    kinds = kinds or {}
    checks = [F.when(~text.is_filled(F.col(f)), F.lit(f"{f}: required")) for f in sorted(schema.REQUIRED)]
    checks += [F.lit(f"{f}: not an array of strings") for f in schema.LISTS if kinds.get(f, "array<string>") != "array<string>"]
    own = urls.canonicalize_url(F.col("title"))
    same = own.eqNullSafe(urls.canonicalize_url(F.col("source_url"))) | own.eqNullSafe(urls.canonicalize_url(F.col("canonical_url")))
    checks.append(F.when(text.is_probable_url(F.col("title")) & same, F.lit("title: the article's address")))
    checks.append(F.when(text.is_date_placeholder(F.col("published_at")), F.lit("published_at: placeholder")))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def decide(df: DataFrame, seen: DataFrame | None, *, arrival: str = "arrival", agency: str = "agency_id", canonicaliser: Column | None = None) -> DataFrame:
    """Adds ``errors``, ``dedupe_key`` and ``status`` (invalid, deduped, stored) to items in order of arrival.

    The key is agency and canonical address, whatever id was supplied; the first
    valid row of a key is stored unless ``seen`` (agency_id, item_id) has it.
    Invalid rows never take a key.  ``seen=None`` ignores history.  Rows of equal
    arrival are told apart by their id.  A key's rows meet in one task, but only
    their ids and arrivals do, and a hot agency's rows are of many keys.
    """
    df = df.drop("errors", "dedupe_key", "status", "_first", "_known")
    address = canonicaliser if canonicaliser is not None else F.col("canonical_url")
    df = df.withColumn("errors", item_errors(dict(df.dtypes))).withColumn("dedupe_key", urls.make_item_id(F.col(agency), address))
    valid = F.size("errors") == 0
    # Invalid rows get a key of their own, so that they don't stand in a window with valid ones.
    slot = F.when(valid, F.col("dedupe_key")).otherwise(F.concat(F.lit("!"), F.col(arrival).cast("string")))
    first = F.row_number().over(Window.partitionBy(slot).orderBy(F.col(arrival), F.col("item_id"))) == 1
    df = df.withColumn("_first", first)
    known = F.lit(False)
    if seen is not None:
        ids = seen.select(F.col("item_id").alias("dedupe_key")).distinct().withColumn("_known", F.lit(True))
        df = df.join(ids, "dedupe_key", "left")
        known = F.coalesce("_known", F.lit(False))
    status = F.when(~valid, "invalid").when(known | ~F.col("_first"), "deduped").otherwise("stored")
    return df.withColumn("status", status).drop("_first", "_known")


def run_counts(decided: DataFrame) -> DataFrame:
    """Per run and spider: rows seen, stored, deduped, invalid."""
    count = lambda s: F.count_if(F.col("status") == s)
    return decided.groupBy("run_id", "spider").agg(
        F.count("*").alias("items_seen"), count("stored").alias("items_stored"), count("deduped").alias("items_deduped"), count("invalid").alias("items_invalid")
    )


def new_seen(decided: DataFrame, seen_at: str | None = None) -> DataFrame:
    """The rows that history gains: one per stored key."""
    return decided.filter("status = 'stored'").select(
        "agency_id", F.col("dedupe_key").alias("item_id"), "canonical_url", "source_url", F.lit(seen_at or urls.utc_now_iso()).alias("seen_at")
    )


def migrate_seen(lines: DataFrame, existing: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Legacy history (JSON lines in ``value``) as ``item_id, canonical_url, source_url, seen_at``.

    Blank and broken lines and those without an id are skipped, absent texts are
    empty, the first line of an id wins, ids that exist already stay as they are.
    """
    parsed = lines.select("*", F.from_json("value", schema.SEEN).alias("r")).filter(F.col("r.item_id").isNotNull() & (F.col("r.item_id") != ""))
    key = F.col(order) if order else F.monotonically_increasing_id()
    ranked = parsed.select("r.*", key.alias("_o"))
    fields = F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in schema.SEEN.fieldNames()[1:]])
    first = ranked.groupBy("item_id").agg(F.min(F.struct("_o", fields.alias("f")))["f"].alias("f")).select("item_id", "f.*")
    return first if existing is None else first.join(existing.select("item_id"), "item_id", "left_anti")


def write_items(decided: DataFrame, path: str, fmt: str = "json") -> None:
    """Appends the stored rows, partitioned by run and spider; nulls are written."""
    rows = decided.filter("status = 'stored'").select(*schema.FIELDS)
    rows.write.mode("append").partitionBy("run_id", "spider").format(fmt).option("ignoreNullFields", "false").save(path)


def merge_runs(stats: DataFrame) -> DataFrame:
    """Run records from rows of ``run_id, spider, agency_id, agency_name, started_at, finished_at`` and counters.

    Recomputed from all rows, so that jobs that share a run lose no update.
    """
    spider = F.struct(*[F.col(c) for c in ("agency_id", "agency_name", "started_at", "finished_at", *schema.COUNTERS)])
    return stats.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("spider", spider.alias("value"))))).alias("spiders"),
        F.struct(*[F.sum(c).alias(c) for c in schema.COUNTERS]).alias("totals"),
    )


def ingest(candidates: DataFrame, seen: DataFrame | None, **defaults: str | None) -> DataFrame:
    """The whole chain up to the decision."""
    order = F.col("arrival") if "arrival" in candidates.columns else F.monotonically_increasing_id()
    framed = candidates.withColumn("_order", order.cast("long"))
    items = schema.normalise(framed, "_order").withColumnRenamed("_order", "arrival")
    return decide(default_items(clean_items(items), **defaults), seen)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """The history table; an empty one where there is none yet."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], "agency_id string, item_id string, canonical_url string, source_url string, seen_at string")
