"""New raw files arriving become keyed upserts into a stored raw table.

The stream remembers the latest version of every natural key, so files may come in any order and
more than once: a row older than what its key has already shown is dropped, an exact replay changes
nothing, and the table ends as one batch upsert of the newest rows would leave it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from statmart.functions.casts import all_text, any_null, lower_columns
from statmart.operators.upsert import dedupe
from statmart.sources.daily import placed_by_log, upsert_days
from statmart.sources.writers import upsert_table

ARRIVED = "__arrived"


def prepare_batch(batch: DataFrame, keys: list[str], newest: list[str] | None = None) -> DataFrame:
    """Make a micro-batch safe to replay: drop rows with a NULL key, keep the newest per key.

    A NULL key matches nothing and would be added again on every replay; a repeated key
    would leave several rows.
    """
    batch = lower_columns(batch)
    return dedupe(batch.filter(~any_null(keys)), keys, newest)


def latest_versions(arriving: DataFrame, keys: list[str], version: str = ARRIVED) -> DataFrame:
    """Of a stream of rows the newest that each key of a batch has shown so far, in update mode one a key and batch.

    ``version`` orders the rows of a key as text; of rows with the same version the one with the greatest
    values stays, whatever the order in which they come. A missing version is older than
    any; rows with a NULL key are dropped. All columns are text. A key that shows nothing new gives its
    newest row once more, which an upsert replaces by itself. It is an aggregation in the JVM, combined
    before the shuffle. The store grows with the keys, not with the rows; on a cluster let it be RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    text = all_text(lower_columns(arriving))
    keyed = text.filter(~any_null(keys)).withColumn(ARRIVED, F.coalesce(F.col(version), F.lit("")))
    values = [c for c in text.columns if c != ARRIVED]
    told = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x00")) for c in values])
    newest = F.max(F.struct(ARRIVED, told.alias("told"), F.struct(*values).alias("row"))).alias("newest")
    return keyed.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(newest).select("newest.row.*")


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    target: str,
    keys: list[str],
    schema: T.StructType,
    checkpoint: str,
    buckets: int = 64,
    max_files: int = 1000,
    version: str | None = None,
    log: DataFrame | None = None,
) -> StreamingQuery:
    """Upsert every file not seen before into ``target``, then stop.

    The file source with its checkpoint decides what is new; the trigger works through the backlog in
    batches of ``max_files``. ``version`` is the column that says which of a key's rows is the newest
    (default: when its file was written). A batch that fails half way is replayed and gives the same
    table, because the upsert replaces by key. With ``log`` rows go into the day of their game
    (:func:`sources.daily.upsert_days`), else into hash buckets.
    """
    keys = [k.lower() for k in keys]
    arriving = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(in_dir)
        .withColumn(ARRIVED, F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    newest = latest_versions(arriving, keys, version.lower() if version else ARRIVED)

    def upsert(batch: DataFrame, _: int) -> None:
        if log is not None:
            upsert_days(placed_by_log(batch, log, keys[0]), target, keys)
        else:
            upsert_table(batch, target, keys, buckets)

    return (
        newest.writeStream.foreachBatch(upsert)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
