"""Runs: exploded to one row per spider, reported, and the best one per spider selected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.operators import profiles
from claimlake.schema import COUNTERS


def run_spiders(runs: DataFrame) -> DataFrame:
    """One row per run and spider, repeated rows once; absent texts are empty (agency: the spider), counters 0."""
    flat = runs.select("run_id", F.col("started_at").alias("run_started_at"), F.col("finished_at").alias("run_finished_at"), F.explode("spiders").alias("spider", "s"))
    texts = {c: F.coalesce(F.col(f"s.{c}"), F.lit("")) for c in ("started_at", "finished_at")}
    names = {c: F.coalesce(F.col(f"s.{c}"), F.col("spider")) for c in ("agency_id", "agency_name")}
    counters = {c: F.coalesce(F.col(f"s.{c}"), F.lit(0)).cast("long") for c in COUNTERS}
    return flat.select("run_id", "spider", *[c.alias(n) for n, c in (names | texts | counters).items()], "run_started_at", "run_finished_at").distinct()


def store_rate(stored: Column, seen: Column) -> Column:
    return F.when(seen == 0, F.lit(0.0)).otherwise(stored / seen)


def run_report(spiders: DataFrame) -> DataFrame:
    """Per run and spider: counters, share stored (not rounded), whether nothing was stored."""
    rate = store_rate(F.col("items_stored"), F.col("items_seen")).alias("store_rate")
    return spiders.select("run_id", "spider", "agency_id", *COUNTERS, rate, (F.col("items_stored") == 0).alias("zero_items"))


def run_totals(spiders: DataFrame) -> DataFrame:
    """Per run: sums of the counters, earliest start and latest finish (as strings), spiders, spiders that stored nothing."""
    return spiders.groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in COUNTERS],
        F.min(F.nullif("started_at", F.lit(""))).alias("started_at"),
        F.max(F.nullif("finished_at", F.lit(""))).alias("finished_at"),
        F.count("*").alias("spiders"),
        F.count_if(F.col("items_stored") == 0).alias("zero_spiders"),
    )


def alerts(spiders: DataFrame) -> DataFrame:
    """``run_id, spider, alert`` for each spider of a run that stored nothing."""
    message = F.format_string("%s: 0 items stored (seen=%d, invalid=%d)", "spider", "items_seen", "items_invalid")
    return spiders.filter("items_stored = 0").select("run_id", "spider", message.alias("alert"))


def latest_runs(spiders: DataFrame, count: int = 1) -> DataFrame:
    """The last ``count`` run ids, newest first; a top-k report."""
    return spiders.select("run_id").distinct().orderBy(F.desc("run_id")).limit(count)


def latest_complete_runs(listing: DataFrame, count: int = 1) -> DataFrame:
    """Of the ``count`` newest run folders (``run_id, has_metadata``) those with metadata; may be fewer."""
    return listing.orderBy(F.desc("run_id")).limit(count).filter("has_metadata")


def by_spider(spiders: DataFrame) -> DataFrame:
    """Runs numbered within their spider, oldest first."""
    return spiders.withColumn("run_no", F.row_number().over(Window.partitionBy("spider").orderBy("run_id")))


def select_runs(spiders: DataFrame, has_items: Column | None = None) -> DataFrame:
    """One row per spider: latest and latest valid run, the selected one and why.

    A run is valid for a spider that stored something (and, if given, where
    ``has_items`` holds).  One aggregate does it; run ids order as strings.
    """
    valid = F.col("items_stored") > 0
    if has_items is not None:
        valid = valid & has_items
    out = spiders.groupBy("spider").agg(
        F.max(F.struct("run_id", "agency_id", "agency_name")).alias("latest"),
        F.max(F.when(valid, F.struct("run_id", "agency_id", "agency_name"))).alias("valid"),
        F.count("*").alias("runs"),
    )
    fallback = F.col("valid.run_id").isNotNull() & (F.col("valid.run_id") < F.col("latest.run_id"))
    chosen = F.coalesce("valid", "latest")
    reason = F.when(F.col("valid").isNull(), "latest_run_without_valid_items").when(fallback, "fallback_to_latest_valid_run").otherwise("latest_valid_run")
    return out.select(
        "spider", F.col("latest.run_id").alias("latest_run_id"), F.col("valid.run_id").alias("latest_valid_run_id"), chosen["run_id"].alias("selected_run_id"),
        chosen["agency_id"].alias("agency_id"), chosen["agency_name"].alias("agency_name"), fallback.alias("fallback_applied"), reason.alias("selection_reason"), "runs",
    )


def ordered(selections: DataFrame) -> DataFrame:
    """Selections in the standing order of spiders, further ones by name."""
    order = F.array(*[F.lit(s) for s in profiles.SPIDER_ORDER])
    place = F.nullif(F.array_position(order, F.col("spider")), F.lit(0))
    return selections.orderBy(F.coalesce(place, F.lit(len(profiles.SPIDER_ORDER) + 1)), "spider")


def manifest_entries(selections: DataFrame, counts: DataFrame) -> DataFrame:
    """Selections with their profile's cleaning flags (and the fallback's) and the number of exported records."""
    flags = F.col("cleaning_flags")
    flags = F.when(F.col("fallback_applied"), F.array_union(flags, F.array(F.lit("fallback_to_latest_valid_run")))).otherwise(flags)
    joined = profiles.with_profile(selections).join(counts, "spider", "left")
    return joined.select(
        "spider", "agency_id", "agency_name", "latest_run_id", "latest_valid_run_id", "selected_run_id", "fallback_applied", "selection_reason",
        flags.alias("cleaning_flags"), "diagnostic_run_ids", F.coalesce("records", F.lit(0)).cast("long").alias("record_count"),
    )


def format_report(spiders: DataFrame) -> str:
    """Text report per run, newest first; one row per run and spider comes to the driver."""
    rows = sorted(run_report(spiders).collect(), key=lambda r: r["spider"])
    if not rows:
        return "No runs found."
    lines: list[str] = []
    for run in sorted({r["run_id"] for r in rows}, reverse=True):
        own = [r for r in rows if r["run_id"] == run]
        lines += [f"Run {run}", f"{'spider':<24}{'seen':>8}{'stored':>8}{'deduped':>9}{'invalid':>9}{'rate':>7}"]
        for r in own:
            mark = " (!)" if r["zero_items"] else ""
            lines.append(f"{r['spider']:<24}{r['items_seen']:>8}{r['items_stored']:>8}{r['items_deduped']:>9}{r['items_invalid']:>9}{r['store_rate']:>7.0%}{mark}")
        bad = [f"  {r['spider']}: 0 items stored (seen={r['items_seen']}, invalid={r['items_invalid']})" for r in own if r["zero_items"]]
        lines += (["Alerts:", *bad] if bad else []) + [""]
    return "\n".join(lines).rstrip()
