"""Stacks that grow with new frames: sums per pixel are mergeable, so a stream keeps them as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sums(samples: DataFrame, by: str, value: str = "v", weight: str = "w") -> DataFrame:
    """(by, n, sw, swv, swv2): what a weighted mean and spread need. Batch and streaming frames alike."""
    v, w = F.col(value), F.col(weight)
    return samples.groupBy(by).agg(F.count("*").alias("n"), F.sum(w).alias("sw"), F.sum(w * v).alias("swv"), F.sum(w * v * v).alias("swv2"))


def stack_new_files(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, by: str, prepare=None, files_per_trigger: int = 1) -> StreamingQuery:
    """Add the Parquet files that are new under source to the stack in sink, and stop when there are no more.

    Each micro-batch writes its sums to a folder of its own number, so a batch that is run again replaces itself.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    rows = prepare(stream) if prepare else stream

    def add(batch: DataFrame, number: int) -> None:
        sums(batch, by).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stacked(spark: SparkSession, sink: str, by: str) -> DataFrame:
    """(by, n, sw, mean) over all batches so far."""
    total = spark.read.parquet(sink).groupBy(by).agg(F.sum("n").alias("n"), F.sum("sw").alias("sw"), F.sum("swv").alias("swv"))
    return total.select(by, "n", "sw", (F.col("swv") / F.col("sw")).alias("mean"))
