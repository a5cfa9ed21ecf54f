"""Keep-latest ingest with keyed stream state.

A stateful stream remembers, for every posting, the event time of the newest
row it has passed on.  A newer row goes on to the merge; the same row again
(a repeat, in whatever file or run) goes nowhere; an older one goes to a side
table, so a late delivery neither overwrites a newer row nor is lost.  State
is kept in the stream's checkpoint, survives restarts and expires.

This is the one operator of the job-market part that runs Python: Spark's
keyed state is only reachable from Python as a processor over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.clean import clean_feed
from ..sources.files import FEEDS, bronze_stamp
from ..sources.sinks import CatalogTable, merge_into_table

NEW, LATE = "new", "late"
#: rows travel through the state as text that gives them back exactly
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: groups that the postings are dealt to; part of a checkpoint's state, so fixed for its life
BUCKETS = 4096


class LatestOfKey(StatefulProcessor):
    """Per key: the newest event time passed on.  Of one batch's rows of a key
    the newest newer one is new and the others that are newer are superseded;
    rows of the known time are repeats, older ones late.

    Keys are handled in buckets: one call, one read and one update of state
    for all keys of a bucket, as calls for every single key cost more than the
    work they do.  A key's entry expires ``keep_days`` after its last update."""

    def __init__(self, keep_days: int):
        self._keep = keep_days * 24 * 3600 * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._latest = handle.getValueState("latest", "names array<string>, events array<long>, until array<long>", self._keep)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = {}
        if self._latest.exists():
            known = {name: (time, until) for name, time, until in zip(*self._latest.get()) if until > now}
        newest: dict[str, tuple[int, str]] = {}
        for frame in rows:
            late = []
            for name, time, text in zip(frame["name"].tolist(), frame["event"].tolist(), frame["payload"].tolist()):
                seen = known.get(name)
                if seen is None or time > seen[0]:
                    best = newest.get(name)
                    if best is None or (time, text) > best:  # of equal times the largest row, as keep-latest has it
                        newest[name] = (time, text)
                elif time < seen[0]:
                    late.append(text)
            if late:
                yield pd.DataFrame({"payload": late, "arrival": LATE})
        if newest:
            known.update((name, (time, now + self._keep)) for name, (time, _) in newest.items())
            self._latest.update((list(known), [time for time, _ in known.values()], [until for _, until in known.values()]))
            yield pd.DataFrame({"payload": [text for _, text in newest.values()], "arrival": NEW})

    def close(self) -> None:
        pass


def ingest_latest(
    spark: SparkSession,
    landing: str,
    feed: str,
    target: str,
    checkpoint: str,
    as_of,
    late: str,
    key: str = "job_posting_id",
    partitions: Sequence[str] = ("year", "month", "day"),
    keep_days: int = 30,
    max_files_per_trigger: int | None = None,
    table: CatalogTable | None = None,
) -> str:
    """Raw feed files into the cleaned table at ``target``; rows older than
    their posting's newest go to the path table ``late`` in the feed's schema,
    with their source file.

    State of a posting expires ``keep_days`` after its last newer row (a row
    after that is new again); it is kept in ``BUCKETS`` groups of postings.  Rows without an event time or id are late: they
    cannot be compared.  Both merges are idempotent, so a batch that is
    replayed after a failure changes nothing.  Only files not seen before are
    read; the call returns when all are merged.
    """
    schema = T.StructType([*FEEDS[feed].fields, T.StructField("source_file", T.StringType())])
    reader = spark.readStream.schema(FEEDS[feed])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(landing).withColumn("source_file", F.col("_metadata.file_path"))
    event = F.unix_micros(F.col("timestamp").cast("timestamp"))
    name = F.coalesce(F.col(key), F.lit(""))
    bucket = F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int")
    rows = raw.select(bucket.alias("bucket"), name.alias("name"), event.alias("event"), F.to_json(F.struct(*schema.names), JSON).alias("payload"))
    comparable = F.col("event").isNotNull() & (F.col("name") != "")
    kept = rows.where(comparable).groupBy("bucket").transformWithStateInPandas(
        LatestOfKey(keep_days), outputStructType=T.StructType.fromDDL("payload string, arrival string"), outputMode="Update", timeMode="ProcessingTime"
    )
    odd = rows.where(~comparable).select("payload", F.lit(LATE).alias("arrival"))

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        batch.persist()  # the state's output is read for both tables
        typed = lambda arrival: batch.where(F.col("arrival") == arrival).select(F.from_json("payload", schema, JSON).alias("row")).select("row.*")
        merge_into_table(session, late, typed(LATE).dropDuplicates(), schema.names, partitions=())
        clean = clean_feed(bronze_stamp(typed(NEW), as_of), feed, as_of)
        merge_into_table(session, target, clean, [key], partitions, order=["scraped_dts"], table=table)
        batch.unpersist()

    # a batch without data, which expiring state asks for, would come after every batch
    confs = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:  # a stream keeps the settings it started with
        query = (
            kept.unionByName(odd).writeStream.foreachBatch(merge_batch).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    query.awaitTermination()
    return target
