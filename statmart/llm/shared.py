"""What several operators need: the cluster's shared folder, and small helpers around it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Where it is unset a local session (tests) gets a folder of its own; a cluster without
    the setting is an error, as its executors could not read each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that :func:`stored` gave, once nothing reads it any more."""
    spark = df.sparkSession
    root = shared_folder(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root.removeprefix("file:").lstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
