"""Session settings and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on; all can be changed at run time.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a skewed side even where that costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and
    all work is done on one machine, as in tests, a fresh temporary folder is used
    instead; elsewhere executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="patronage-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path for this application; everything it leaves is under one folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{label}-{uuid.uuid4().hex}"


#: Called with every result that is about to be copied; for tests of plans.
WATCHERS: list[Callable[[DataFrame], None]] = []


def durable(df: DataFrame) -> DataFrame:
    """Write a result that several later steps read, and go on from the copy.

    The copy is a Parquet table in shared storage: a lost executor costs a re-read
    and never a re-run of what came before, readers fetch only their columns, and
    the planner knows its true size.
    """
    for watch in WATCHERS:
        watch(df)
    path = scratch(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete this application's copies, once no result that reads them is needed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
