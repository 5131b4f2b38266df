"""The ingest chain over a stream: the same decisions per micro-batch, history kept in a table.

Data is written before history, and both under the batch's own folder, so that a
batch that is run again after a crash replaces what it wrote and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimlake import schema
from claimlake.operators import ingest


def _history(spark: SparkSession, home: str, before: int) -> DataFrame | None:
    """What earlier batches accepted; what a later or this batch left behind isn't history."""
    seen = ingest.read_seen(spark, f"{home}/seen")
    return seen.filter(F.col("batch") < before).drop("batch") if "batch" in seen.columns else seen


def process_batch(batch: DataFrame, batch_id: int, home: str, **defaults: str | None) -> None:
    """One micro-batch: decide, write items, then counters, then history; idempotent by ``batch_id``."""
    spark = batch.sparkSession
    items = _with_arrival(batch)
    decided = ingest.decide(ingest.default_items(ingest.clean_items(items), **defaults), _history(spark, home, batch_id)).persist()
    try:
        stored = decided.filter("status = 'stored'")
        stored.select(*schema.FIELDS).write.mode("overwrite").json(f"{home}/items/batch={batch_id}")
        ingest.run_counts(decided).write.mode("overwrite").parquet(f"{home}/counts/batch={batch_id}")
        ingest.new_seen(decided).write.mode("overwrite").parquet(f"{home}/seen/batch={batch_id}")
    finally:
        decided.unpersist()


def _with_arrival(batch: DataFrame) -> DataFrame:
    """The item's columns and the order of arrival, made up where the stream brings none."""
    order = F.col("arrival") if "arrival" in batch.columns else F.monotonically_increasing_id()
    return schema.normalise(batch.withColumn("_order", order.cast("long")), "_order").withColumnRenamed("_order", "arrival")


def start_ingest(stream: DataFrame, home: str, checkpoint: str, *, once: bool = True, **defaults: str | None) -> StreamingQuery:
    """Starts the ingest of a stream of candidate records; ``once`` takes what is there and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: process_batch(df, n, home, **defaults))
    return (writer.trigger(availableNow=True) if once else writer).start()


def counts_by_hour(stream: DataFrame, moment: str = "collected_at", late: str = "1 day") -> DataFrame:
    """Items per spider and hour of collection; rows later than ``late`` are left out."""
    at = F.try_to_timestamp(F.col(moment))
    return stream.withColumn("_at", at).withWatermark("_at", late).groupBy(F.window("_at", "1 hour").alias("hour"), "spider").agg(F.count("*").alias("items"))
