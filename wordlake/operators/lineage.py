"""The folder that driver and executors share, and tables stored in it."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where the session names no shared folder.
OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and Spark runs on one machine, a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = OWN_FOLDER.setdefault("path", os.path.join(tempfile.mkdtemp(prefix="spark-"), "shared"))
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder: for tables of which several steps read some columns each."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder, without its lineage."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Have the shuffle files deleted that no table of the job refers to any more.

    Spark deletes them when the driver collects its garbage; the driver of a loop of many small jobs
    may have none to collect until the end, and the files of every round would stay that long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """``cut_lineage`` of ``df``; then the files that it was made from go."""
    spark, out = df.sparkSession, cut_lineage(df)
    del df
    release(spark)
    return out
