"""The files of a data folder: items, runs, legacy history, schedule; and fetched responses as a data source."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from claimlake import schema


def read_items(spark: SparkSession, path: str, spider: str | None = None) -> DataFrame:
    """JSON lines as items; lines that aren't JSON objects are passed over, fields of the wrong type are null.

    Reading as text first keeps well-formed lines that a typed reader would drop.
    """
    lines = spark.read.text(path)
    rows = lines.select(F.try_parse_json("value").alias("v")).filter(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
    kind = lambda f: "array<string>" if f in schema.LISTS else "string"
    items = rows.select(*[F.try_variant_get("v", f"$.{f}", kind(f)).alias(f) for f in schema.FIELDS])
    return items.filter(F.col("spider") == spider) if spider else items


def read_runs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every run's metadata with its folder; broken or empty files are passed over, a missing id is the folder's name."""
    files = spark.read.text(f"{data_dir}/runs/*/run.json", wholetext=True).withColumn("folder", F.element_at(F.split("_metadata.file_path", "/"), -2))
    parsed = files.select("folder", F.from_json("value", schema.RUN).alias("r")).filter("r is not null AND (r.run_id is not null OR r.spiders is not null)")
    return parsed.select(F.coalesce(F.nullif("r.run_id", F.lit("")), F.col("folder")).alias("run_id"), "r.started_at", "r.finished_at", "r.spiders", "r.totals", "folder")


def list_runs(spark: SparkSession, data_dir: str) -> DataFrame:
    """``run_id, has_metadata`` of every run folder; a listing of names, so the driver does it."""
    hadoop = spark._jvm.org.apache.hadoop.fs

    def names(pattern: str, up: bool) -> set[str]:
        path = hadoop.Path(f"{data_dir}/runs/{pattern}")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return {(s.getPath().getParent() if up else s.getPath()).getName() for s in found if up or s.isDirectory()}

    full = names("*/run.json", up=True)
    return spark.createDataFrame([(n, n in full) for n in sorted(names("*", up=False))], "run_id string, has_metadata boolean")


def read_legacy_seen(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a legacy history with their place, for ``ingest.migrate_seen``."""
    return spark.read.text(path).withColumn("place", F.monotonically_increasing_id())


def load_schedule(path: str) -> dict:
    """Time zone and jobs of a schedule file; an empty one has no jobs and is in UTC."""
    import yaml

    with open(path, encoding="utf-8") as f:
        loaded = yaml.safe_load(f) or {}
    return {"timezone": loaded.get("timezone", "UTC"), "jobs": loaded.get("jobs") or []}


def due_jobs(schedule: dict) -> tuple[list[dict], list[str]]:
    """Enabled jobs, and warnings about those without a spider or a time."""
    jobs, warnings = [], []
    for job in schedule["jobs"]:
        if not job.get("enabled", True):
            continue
        if job.get("spider") and job.get("cron"):
            jobs.append({"name": job.get("name") or job["spider"], "spider": job["spider"], "cron": job["cron"]})
        else:
            warnings.append(f"{job.get('name', '?')}: spider or cron is missing")
    return jobs, warnings


RESPONSE = T.StructType(
    [
        T.StructField("spider", T.StringType()), T.StructField("url", T.StringType()), T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("body", T.BinaryType()), T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)


class ResponseSource(DataSource):
    """``spark.read.format("responses")``: stored answers, one JSON file of requests per partition.

    Option ``path`` is a folder; each ``*.json`` file in it lists objects with ``url``,
    ``spider``, ``status``, ``headers``, ``meta`` and ``file`` (the body beside it).  A live
    fetcher would yield the same rows; it must obey robots rules and keep polite delays.
    """

    @classmethod
    def name(cls) -> str:
        return "responses"

    def schema(self) -> T.StructType:
        return RESPONSE

    def reader(self, schema: T.StructType) -> DataSourceReader:  # noqa: ARG002
        return _ResponseReader(self.options["path"])


class _ResponseReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        from pathlib import Path

        return [InputPartition(str(p)) for p in sorted(Path(self.path).glob("*.json"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pathlib import Path

        at = Path(partition.value)
        for r in json.loads(at.read_text(encoding="utf-8")):
            body = (at.parent / r["file"]).read_bytes() if r.get("file") else (r.get("body") or "").encode()
            yield r.get("spider"), r["url"], int(r.get("status", 200)), r.get("headers") or {}, body, {k: str(v) for k, v in (r.get("meta") or {}).items()}


def register(spark: SparkSession) -> None:
    """Makes the functions, table functions and sources available to SQL."""
    from claimlake.functions import dates, jsonld, text, urls

    spark.dataSource.register(ResponseSource)
    spark.udtf.register("jsonld_nodes", jsonld.JsonLdNodes)
    for name, function in {
        "clean_stored": text.stored_text, "clean_analysis": text.analysis_text, "label_key": text.label_key, "canonical_url": urls.canonical, "published_iso": dates.published_iso,
    }.items():
        spark.udf.register(name, _batched(function))


def _batched(function):  # noqa: ANN001, ANN202
    @F.pandas_udf(T.StringType())
    def apply(values: pd.Series) -> pd.Series:
        return pd.Series([function(v) for v in values], dtype=object)

    return apply
