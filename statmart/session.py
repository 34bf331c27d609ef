"""Session helpers: a local session for tests and benches, and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The JVM leaves methods above 8000 bytes uncompiled; wide marts run faster unfused.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def local_session(app: str = "statmart", cores: str = "*", **conf: str) -> SparkSession:
    """Session for tests and benches. A cluster brings its own session instead."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        METHOD_LIMIT: COMPILED_BYTES,
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def limit_methods(spark: SparkSession) -> None:
    """Unfuse what Spark would fuse into a method that the JVM only interprets, for this session.

    Typing a wide text row makes such methods, under Spark's own limit of 65,535 bytes. The limit is
    read when a plan is made, which for a lazy result is after the caller has it, so it stays set.
    A limit that the session was given is kept.
    """
    if METHOD_LIMIT not in spark.conf.getAll:
        spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local session (tests) that names none gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="statmart-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use where three or more consumers share a result. Unlike a cached or locally
    checkpointed frame the files survive the loss of any executor, keep column
    pruning, and give the optimizer exact sizes for its join choices.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/statmart/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that :func:`materialise` gave, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/statmart/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
