"""Incremental ingest of raw feed files with Structured Streaming.

Replaces the reference's scheduled "read everything newer than the target's
high-water mark" loads: the file source's checkpoint remembers which files
were processed, so a rerun reads only new files (late rows inside new files
are kept, unlike an event-time filter).  Each micro-batch is transformed and
merged into the target with a partition-limited upsert, which is
idempotent, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_feed
from ..operators.incremental import since
from ..sources.files import FEEDS, bronze_stamp, read_raw_feed
from ..sources.sinks import CatalogTable, merge_into_table, read_table, table_exists


def merge_files(
    spark: SparkSession,
    landing: str,
    feed: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    key: Sequence[str] = ("job_posting_id",),
    order: Sequence[str] | None = None,
    partitions: Sequence[str] = ("year", "month", "day"),
    max_files_per_trigger: int | None = None,
    late_filter: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    rescue: bool = True,
    check: Callable[[DataFrame], None] | None = None,
    fmt: str = "parquet",
    table: CatalogTable | None = None,
) -> str:
    """Run an ``availableNow`` stream over the raw files of ``feed`` under
    ``landing``: each micro-batch (with its rows' source file) goes through
    ``transform`` and is merged into the table at ``target``.

    ``late_filter(batch, current_target)`` may drop rows before the
    transform (used for the reference's event-time high-water mark);
    With ``table`` the target is a catalog table whose folders are below it.
    ``check(batch)`` may refuse a batch by raising.  With ``rescue`` the files
    of a micro-batch are read with their own schemas, and what does not fit
    the feed's schema is kept in ``_rescued_data``.  The call returns when all
    files present at its start are merged, and raises if the stream fails.
    """
    # a rescuing stream only tells which files are new: it reads a column that no file has
    reader = spark.readStream.schema("__none string" if rescue else FEEDS[feed])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(landing).withColumn("source_file", F.col("_metadata.file_path"))

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        if rescue:  # the batch's files are read with their own schemas
            files = [r[0] for r in batch.select("source_file").distinct().collect()]
            if not files:
                return
            batch = read_raw_feed(session, files, feed)
        if check is not None:
            check(batch)
        if late_filter is not None:
            if table is not None and table.exists(session):
                batch = late_filter(batch, table.read(session))
            elif table is None and table_exists(session, target):
                batch = late_filter(batch, read_table(session, target, fmt))
        merge_into_table(session, target, transform(batch), key, partitions, order=order, fmt=fmt, table=table)

    query = (
        raw.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target


def ingest_files(
    spark: SparkSession,
    landing: str,
    feed: str,
    target: str,
    checkpoint: str,
    as_of,
    key: Sequence[str] = ("job_posting_id",),
    order: Sequence[str] = ("scraped_dts",),
    max_files_per_trigger: int | None = None,
    drop_late: bool = False,
) -> str:
    """Raw feed files straight into the cleaned table (stamp + clean + merge).

    ``drop_late=True`` is the reference's behaviour: rows whose event time
    is not newer than the latest already loaded are dropped (a high-water
    mark on ``timestamp``); by default every row of a new file is kept.
    """

    def transform(batch: DataFrame) -> DataFrame:
        return clean_feed(bronze_stamp(batch, as_of, with_file_path=False), feed, as_of)

    late = (lambda batch, current: since(batch, current, "timestamp", "scraped_dts")) if drop_late else None
    return merge_files(spark, landing, feed, transform, target, checkpoint, key, order,
                       max_files_per_trigger=max_files_per_trigger, late_filter=late)


def ingest_bronze(
    spark: SparkSession,
    landing: str,
    feed: str,
    target: str,
    checkpoint: str,
    as_of,
    key: Sequence[str] = ("job_posting_id",),
    drop_late: bool = False,
    rescue: bool = True,
    check: Callable[[DataFrame], None] | None = None,
    fmt: str = "parquet",
    table: CatalogTable | None = None,
) -> str:
    """Raw feed files into the bronze table: raw columns, load stamps and the
    source file of every row; only files not seen before are read."""

    def transform(batch: DataFrame) -> DataFrame:
        return bronze_stamp(batch, as_of, with_file_path=False)

    late = (lambda batch, current: since(batch, current, "timestamp")) if drop_late else None
    return merge_files(spark, landing, feed, transform, target, checkpoint, key, order=("timestamp",),
                       late_filter=late, rescue=rescue, check=check, fmt=fmt, table=table)
