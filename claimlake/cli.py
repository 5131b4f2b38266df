"""``python -m claimlake.cli list | extract | quality | report | snapshot | schedule``"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="claimlake")
    top.add_argument("--master", default="local[*]")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="known agencies")
    run = sub.add_parser("extract", help="stored responses to items")
    run.add_argument("--responses", required=True)
    run.add_argument("--data-dir", default="data")
    run.add_argument("--spider", default="all")
    run.add_argument("--ignore-existing-seen-state", action="store_true")
    for name in ("quality", "report"):
        one = sub.add_parser(name)
        one.add_argument("--data-dir", default="data")
        one.add_argument("--runs", type=int, default=1)
        one.add_argument("--run-id")
        one.add_argument("--format", choices=("text", "json"), default="text")
    snap = sub.add_parser("snapshot")
    snap.add_argument("--data-dir", default="data")
    snap.add_argument("--out", default="data/processed")
    snap.add_argument("--snapshot-id")
    plan = sub.add_parser("schedule", help="jobs of a schedule, for an external scheduler")
    plan.add_argument("--config", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from claimlake.operators import extraction, ingest, processing, quality, runs
    from claimlake.sources import files

    if args.command == "list":
        print("\n".join(sorted(extraction.RULES)))
        return 0
    if args.command == "schedule":
        jobs, warnings = files.due_jobs(files.load_schedule(args.config))
        print("\n".join(warnings), file=sys.stderr)
        print(json.dumps(jobs, ensure_ascii=False, indent=2))
        return 0
    if args.command == "extract" and args.spider != "all" and args.spider not in extraction.RULES:
        print(f"unknown spider {args.spider!r}; known: {', '.join(sorted(extraction.RULES))}", file=sys.stderr)
        return 2

    from claimlake.functions import urls
    from claimlake.session import build_session

    spark = build_session(args.master)
    spark.sparkContext.setLogLevel("ERROR")
    if args.command == "extract":
        files.register(spark)
        pages = extraction.normalised_responses(spark.read.format("responses").option("path", args.responses).load())
        pages = pages if args.spider == "all" else pages.filter(F.col("spider") == args.spider)
        articles = extraction.extract_articles(pages.filter("NOT needs_refetch")).filter(F.size("errors") == 0)
        run_id, started = urls.generate_run_id(), urls.utc_now_iso()
        seen = None if args.ignore_existing_seen_state else ingest.read_seen(spark, f"{args.data_dir}/state/seen")
        decided = ingest.ingest(articles, seen, run_id=run_id).persist()
        ingest.write_items(decided, f"{args.data_dir}/items")
        ingest.new_seen(decided).write.mode("append").parquet(f"{args.data_dir}/state/seen")
        stats = ingest.run_counts(decided).withColumns({"agency_id": F.col("spider"), "agency_name": F.col("spider"), "started_at": F.lit(started), "finished_at": F.lit(urls.utc_now_iso())})
        ingest.merge_runs(stats).coalesce(1).write.mode("append").json(f"{args.data_dir}/run_log")
        print(runs.format_report(runs.run_spiders(ingest.merge_runs(stats))))
        return 0
    if args.command in ("quality", "report"):
        flat = runs.run_spiders(files.read_runs(spark, args.data_dir))
        ids = [args.run_id] if args.run_id else [r[0] for r in runs.latest_complete_runs(files.list_runs(spark, args.data_dir), args.runs).collect()]
        if args.command == "report":
            chosen = flat.filter(F.col("run_id").isin(ids))
            print(runs.format_report(chosen) if args.format == "text" else "\n".join(runs.run_report(chosen).toJSON().collect()))
            return 0
        for run_id in ids:
            profile = quality.quality_profile(files.read_items(spark, f"{args.data_dir}/runs/{run_id}/items.jsonl"))
            print(quality.format_quality(profile) if args.format == "text" else "\n".join(profile.toJSON().collect()))
        return 0
    items = files.read_items(spark, f"{args.data_dir}/runs/*/items.jsonl")
    manifest = processing.build_snapshot(items, runs.run_spiders(files.read_runs(spark, args.data_dir)), args.out, args.snapshot_id or urls.default_snapshot_id())
    print(json.dumps(manifest, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
