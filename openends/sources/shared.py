"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, as `spark.checkpoint.dir` names it.

    Where that is unset, as in tests, a folder beside the warehouse is used; on a
    cluster an unset folder is an error, since executors could not read each other's files.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/_openends"
    context.setCheckpointDir(configured)
    folder = context.getCheckpointDir()
    _delete_on_exit(spark, folder)
    return folder


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder when the session's JVM ends: results are lazy and may read it until then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A fresh path in the shared folder, removed when the session ends."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    return path


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a DataFrame as Parquet in the shared folder and read it back.

    Later reads prune columns, a retry after a lost executor reads the files, and
    the plan before the table is not run again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a DataFrame in the shared folder, so lost executors cost nothing."""
    return stored(df, "step")
