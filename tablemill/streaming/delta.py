"""Incremental runs as available-now streams (STR-1, STR-2, STR-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.operators.sync import merge
from tablemill.plans.store import TableStore


def merge_stream(spark: SparkSession, path: str, schema, store: TableStore, table: str, checkpoint: str, *, keys: list[str], order: list[str], strategy: str = "upsert", files: int = 100) -> None:
    """Reads what is new under the path in micro-batches and merges each into the table. The batch's number is committed
    with the rows, under the checkpoint's name; a batch whose number is not above it was merged before and is left out.
    So a batch repeated after a failure changes nothing, whatever the strategy."""

    def one(batch: DataFrame, number: int) -> None:
        done = store.watermark(table)
        name, _, last = (done or "").rpartition("#")
        if name == checkpoint and number <= int(last):
            return
        target = store.read(table)
        base = batch.limit(0) if target is None else target
        store.commit(table, merge(base, batch, strategy, keys, [F.col(c) for c in order]), watermark=f"{checkpoint}#{number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def dedup_stream(spark: SparkSession, path: str, schema, out: str, checkpoint: str, *, keys: list[str], ts: str, delay: str = "30 minutes") -> DataFrame:
    """Copies within the delay are dropped; state older than that is let go. Rows that come later than the delay behind
    the latest time seen in earlier batches are dropped as well, copies or not: choose a delay beyond the lateness of the source."""
    typed = spark.readStream.schema(schema).parquet(path).withColumn("__at", F.col(ts).cast("timestamp"))
    fresh = typed.withWatermark("__at", delay).dropDuplicatesWithinWatermark(keys).drop("__at")
    fresh.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)
