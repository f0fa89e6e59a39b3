"""Settings that the library reads from the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode a temporary folder where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="skyloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint, so that iterations keep a short lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder. Unlike a checkpoint's its size is known to the planner, which broadcasts it only where it is small."""
    path = f"{shared_base(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Four tasks a core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt over so many tasks, by keys if there are any. For few rows that each take long: a small file would be one task, and adaptive execution would join small partitions to one."""
    return df.repartition(tasks(df.sparkSession), *keys)
