"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that make results independent of the machine and let Spark re-plan at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "claimlake", **conf: str) -> SparkSession:
    """A session for tests, the command line and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package, once per application.

    Nothing is sent where they find it anyhow: by ``PYTHONPATH`` or in the working folder.
    """
    context, home = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_claimlake_shipped", False):
        return
    context._claimlake_shipped = True
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home.parent in (*known, Path.cwd()):
        return
    # Made on the driver; Spark's own file server hands it to the executors.
    folder = tempfile.mkdtemp(prefix="claimlake-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/claimlake", "zip", home.parent, home.name))


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below the cluster's shared folder.

    The folder is ``spark.checkpoint.dir``; only where that is unset (tests, a
    laptop) is a local one made and set, once per session.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = context._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="claimlake-")
        context.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/claimlake-{uuid.uuid4().hex}"
    # What lies there serves this application alone; its file system removes it at the end.
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and survives lost executors, as a replicated table does.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._claimlake_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Removes tables that ``materialise`` gave and nothing reads any more; others stay."""
    for table in tables:
        path = getattr(table, "_claimlake_path", None)
        if path:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
