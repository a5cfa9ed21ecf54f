"""Tier-by-tier job: raw files -> bronze -> silver -> gold tables.

Each model is a table on shared storage, as in the reference where every
arrow between models is a persisted table.  A model reads the tables it
depends on (so lineage is cut at every tier and a lost executor only costs
the current model), filters its input by the target's high-water mark, and
merges the result by key.  Marts are rebuilt from the staged table, or, with
catalog tables, kept from partials of its partitions.

``run`` processes one load; calling it again with new raw files and a later
``as_of`` is an incremental run.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import (
    clean_feed,
    company_mart,
    descriptions,
    enrich,
    geo_mart,
    heatmap,
    load_ai_summaries,
    load_availability,
    latest_per_key,
    since,
    skills_mart,
    stage_active,
    unify,
)
from ..operators.incremental import high_water_mark
from ..operators.marts import company_from_partials, company_partials, heatmap_from_partials, heatmap_partials
from ..operators.stage import inactive_keys
from ..sources.files import bronze_stamp, read_ai_summaries, read_availability_csv, read_raw_feed
from ..sources.sinks import (
    MERGE,
    CatalogTable,
    StagedVersion,
    merge_into_table,
    partition_values,
    read_table,
    table_exists,
    write_table,
)
from ..streaming import ingest_bronze


@dataclass(frozen=True)
class RawInputs:
    """Landing folders of the four external inputs."""

    feed_a: str
    feed_b: str
    availability_csv: str
    ai_summaries: str


@dataclass(frozen=True)
class Layout:
    """Where models live.

    ``materialize="table"``: files at ``<root>/<tier>/<table>`` in ``format``,
    maintained incrementally.  ``materialize="view"``: every model is a
    session temp view named ``<view_prefix><model>`` (nothing written; each
    read recomputes from the raw files), i.e. view materialisation.
    """

    root: str = ""
    format: str = "parquet"
    materialize: str = "table"
    view_prefix: str = "hs_"
    # catalog database for the tables (None: path-only tables)
    catalog: str | None = None
    # >0: tables keyed by job_posting_id and joined on it are bucketed by it
    buckets: int = 0

    def path(self, tier: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{tier}/{table}"

    def table_name(self, name: str) -> str:
        return f"{self.catalog}.{name}"

    def view(self, name: str) -> str:
        return f"{self.view_prefix}{name}"


# model name -> (tier, table spec)
MODELS = {
    "bronze_a": ("bronze", schemas.BRONZE),
    "bronze_b": ("bronze", schemas.BRONZE),
    "cleaned_a": ("silver", schemas.CLEANED),
    "cleaned_b": ("silver", schemas.CLEANED),
    "unified": ("silver", schemas.UNIFIED),
    "descriptions": ("silver", schemas.DESCRIPTIONS),
    "availability": ("silver", schemas.AVAILABILITY),
    "ai_summaries": ("silver", schemas.SUMMARIES),
    "enriched": ("silver", schemas.ENRICHED),
    "staged": ("gold", schemas.STAGED),
}
# the enrichment joins these three on job_posting_id: bucketed alike, they
# join without a shuffle
BUCKETED = {"unified", "availability", "ai_summaries"}

MARTS = {
    "heatmap": lambda staged, as_of: heatmap(staged, as_of),
    "heatmap_v2": lambda staged, as_of: heatmap(staged, as_of, standardise=True),
    "company_hiring": lambda staged, as_of: company_mart(staged, as_of),
    "skills_demand": lambda staged, as_of: skills_mart(staged, as_of),
    "geography": lambda staged, as_of: geo_mart(staged, as_of),
}

# marts that can be kept from partials of staging's partitions: (partials, mart from partials)
INCREMENTAL_MARTS = {
    "heatmap": (heatmap_partials, heatmap_from_partials),
    "heatmap_v2": (partial(heatmap_partials, standardise=True), heatmap_from_partials),
    "company_hiring": (company_partials, company_from_partials),
}


@dataclass
class Run:
    spark: SparkSession
    layout: Layout
    load_ts: object
    written: dict[str, str] = field(default_factory=dict)
    # models that this run made whole by a merge, which leaves one row a key (a table of earlier loads may hold a key
    # twice after a merge that broke off)
    made: set[str] = field(default_factory=set)

    @property
    def as_views(self) -> bool:
        return self.layout.materialize == "view"

    def catalog_table(self, name: str) -> CatalogTable | None:
        if self.layout.catalog is None:
            return None
        buckets = self.layout.buckets if name in BUCKETED else 0
        marks = [MODELS[name][1].watermark] if name in MODELS else []
        return CatalogTable(self.layout.table_name(name), buckets, self.layout.format, marks)

    def _read(self, name: str) -> DataFrame:
        """The model's table with its storage-only partition column."""
        if self.layout.catalog is not None:
            return self.catalog_table(name).read(self.spark)
        return read_table(self.spark, self.layout.path(MODELS[name][0], name), self.layout.format)

    def exists(self, name: str) -> bool:
        if self.as_views:  # a view is always a full recompute
            return False
        if self.layout.catalog is not None:
            return self.catalog_table(name).exists(self.spark)
        return table_exists(self.spark, self.layout.path(MODELS[name][0], name))

    def existing(self, name: str):
        """What a model's high-water mark is taken from, if the model exists:
        the marks kept with a catalog table, or the table."""
        if not self.exists(name):
            return None
        if self.layout.catalog is not None:
            return self.catalog_table(name).kept_marks(self.spark)
        return self._read(name)

    def latest_ingest(self, name: str):
        """The last load's stamp in a model's table, if it exists."""
        target = self.existing(name)
        if target is None:
            return None
        mark = high_water_mark(target, "ingest_dts", floor=None)
        text = self.spark.range(1).select(F.date_format(mark, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        return text and dt.datetime.fromisoformat(text)

    def table(self, name: str) -> DataFrame:
        if self.as_views:
            return self.spark.table(self.layout.view(name))
        return self._read(name)

    def merge(self, name: str, batch: DataFrame, order: list[str] | None = None, delete_keys=None, one_row_from=()) -> None:
        """Merge ``batch``, the latest row of a key by ``order``.  A batch with
        at most one row for each row of the models ``one_row_from`` repeats no
        key if they do not: then its rows are not shuffled and sorted by key."""
        tier, spec = MODELS[name]
        if one_row_from and self.made.issuperset(one_row_from):
            order = None
        if not self.exists(name):
            self.made.add(name)
        if self.as_views:
            if order:
                batch = latest_per_key(batch, list(spec.key), order)
            batch.createOrReplaceTempView(self.layout.view(name))
            self.written[name] = self.layout.view(name)
            return
        path = self.layout.path(tier, name)
        if spec.derived:
            batch = batch.withColumns({c: F.expr(e.format(as_of=str(self.load_ts)[:10])) for c, e in spec.derived})
        merge_into_table(self.spark, path, batch, list(spec.key), list(spec.partitions), order=order,
                         delete_keys=delete_keys, table=self.catalog_table(name), fmt=self.layout.format)
        self.written[name] = path


def _wave(threads: int, steps) -> None:
    """Run independent models of one wave, as concurrent Spark jobs when
    ``threads > 1`` (Spark schedules jobs from several threads at once)."""
    if threads <= 1 or len(steps) == 1:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(steps))) as pool:
        for f in [pool.submit(step) for step in steps]:
            f.result()


def run(
    spark: SparkSession,
    raw: RawInputs,
    layout: Layout,
    as_of,
    marts: bool = True,
    reprocess_on_change: bool = False,
    remove_inactive: bool = False,
    threads: int = 4,
    bronze_mode: str = "files",
    employment_mode: str = "reference",
    rescue: bool = True,
    load_ts=None,
    filter_both: bool = False,
    incremental_marts: bool = False,
) -> dict[str, str]:
    """Run every model once; returns model -> path.

    ``as_of`` is the day that the marts look back from.  ``load_ts`` stamps
    the load (ingest, enrichment and audit times, load-date partitions) and
    must be later than that of every earlier load, else new rows would hide
    behind the marks of the tables after them: a load with new rows and a
    stamp that is not later is refused.  Its default is the midnight of
    ``as_of``; several loads a day need a time each.

    Models run in dependency waves; models inside a wave do not read each
    other and run concurrently up to ``threads``.  The defaults keep the
    reference's behaviour; ``reprocess_on_change`` re-enriches postings whose
    availability or summary changed, and ``remove_inactive`` deletes postings
    that turned inactive from staging.

    Raw feed files whose schema drifted keep what does not fit the fixed
    schema in ``_rescued_data``; ``rescue=False`` drops it.

    ``filter_both=True`` filters feed B's descriptions by the mark as well
    (the reference merges all of feed B again in every run).

    ``employment_mode="fixed"`` lower-cases feed A's employment type before
    matching the enum (the reference strips capitals first).

    ``incremental_marts=True`` (catalog tables) keeps the heatmaps and the
    company mart from partial aggregates of staging's partitions: a run reads
    the partitions that are new since the last one, and the partials.

    ``bronze_mode="files"`` re-reads every raw file and keeps rows newer
    than the bronze table's latest event time (the reference's method);
    ``"stream"`` tracks processed files in a stream checkpoint next to the
    table and reads only new files (late rows inside them are kept).
    """
    if incremental_marts and (layout.catalog is None or layout.materialize == "view"):
        raise ValueError("incremental marts need catalog tables, whose partitions never change")
    if load_ts is None:
        load_ts = dt.datetime.combine(dt.date.fromisoformat(str(as_of)[:10]), dt.time())
    # dates and stamps are read and written in one zone on every cluster; the caller's zone comes back afterwards
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return _run(spark, raw, layout, as_of, load_ts, marts, reprocess_on_change, remove_inactive, threads, bronze_mode,
                    employment_mode, rescue, filter_both, incremental_marts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _run(spark, raw: RawInputs, layout: Layout, as_of, load_ts, marts, reprocess_on_change, remove_inactive, threads, bronze_mode,
         employment_mode, rescue, filter_both, incremental_marts) -> dict[str, str]:
    r = Run(spark, layout, load_ts)
    if layout.catalog is not None:
        # tables carry their own paths; the database folder sits beside them
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.catalog} LOCATION '{layout.path('_catalog', layout.catalog)}'")
    if bronze_mode not in ("files", "stream") or (bronze_mode == "stream" and r.as_views):
        raise ValueError(f"unsupported bronze_mode {bronze_mode!r} for {layout.materialize} models")

    latest = max((m for m in map(r.latest_ingest, ("cleaned_a", "cleaned_b", "unified")) if m is not None), default=None)

    def check_stamp(batch: DataFrame) -> None:
        if latest is not None and load_ts <= latest and not batch.isEmpty():
            raise ValueError(f"load_ts {load_ts} is not later than the last load's ({latest}): its rows would never be cleaned")

    def bronze(name, feed, src):
        if bronze_mode == "stream":
            path = layout.path("bronze", name)
            ingest_bronze(spark, src, feed, path, layout.path("_checkpoints", name), load_ts, rescue=rescue,
                          check=check_stamp, fmt=layout.format, table=r.catalog_table(name))
            r.written[name] = path
            return
        # raw rows newer than the target's latest event time
        batch = since(read_raw_feed(spark, src, feed, rescue=rescue), r.existing(name), "timestamp")
        check_stamp(batch)
        r.merge(name, bronze_stamp(batch, load_ts), order=["timestamp"])

    def cleaned(name, feed):
        raw_cols = (schemas.RAW_FEED_A if feed == "a" else schemas.RAW_FEED_B).names
        src = r.table(f"bronze_{feed}").select(*raw_cols, "ingest_dts", "year", "month", "day")
        cleaned_rows = clean_feed(src, feed, load_ts, target=r.existing(name), employment_mode=employment_mode)
        r.merge(name, cleaned_rows, order=["ingest_dts", "scraped_dts"], one_row_from=[f"bronze_{feed}"])

    def availability():
        batch = load_availability(read_availability_csv(spark, raw.availability_csv), load_ts,
                                  target=r.existing("availability"))
        r.merge("availability", batch, order=["validated_dts"])

    def summaries():
        batch = load_ai_summaries(read_ai_summaries(spark, raw.ai_summaries), target=r.existing("ai_summaries"))
        r.merge("ai_summaries", batch, order=["summarized_dts"])

    def unified():
        batch = unify(r.table("cleaned_b"), r.table("cleaned_a"), target=r.existing("unified"))
        r.merge("unified", batch, order=["ingest_dts", "scraped_dts"])

    def described():
        batch = descriptions(r.table("cleaned_b"), r.table("cleaned_a"), target=r.existing("descriptions"),
                             filter_both=filter_both)
        r.merge("descriptions", batch, order=["scraped_dts"])

    def enriched():
        batch = enrich(r.table("unified"), r.table("availability"), r.table("ai_summaries"), load_ts,
                       target=r.existing("enriched"), reprocess_on_change=reprocess_on_change)
        r.merge("enriched", batch, order=["ingest_dts"], one_row_from=["unified", "availability", "ai_summaries"])

    def staged():
        target = r.existing("staged")
        gone = inactive_keys(r.table("enriched"), target) if remove_inactive else None
        r.merge("staged", stage_active(r.table("enriched"), load_ts, target=target), order=["enriched_dts"],
                delete_keys=gone, one_row_from=["enriched"])

    def mart(name, build):
        def step():
            if incremental_marts and name in INCREMENTAL_MARTS:
                make, finish = INCREMENTAL_MARTS[name]
                kept = CatalogTable(layout.table_name(f"{name}_partials"), fmt=layout.format)
                out = finish(refresh_partials(spark, r.catalog_table("staged"), kept, layout.path("gold", f"{name}_partials"), make), as_of)
            else:
                out = build(r.table("staged"), as_of)
            if r.as_views:
                out.createOrReplaceTempView(layout.view(name))
                r.written[name] = layout.view(name)
                return
            path = layout.path("gold", name)
            write_table(out, path, layout.format)
            r.written[name] = path

        return step

    _wave(threads, [lambda: bronze("bronze_a", "a", raw.feed_a), lambda: bronze("bronze_b", "b", raw.feed_b),
                    availability, summaries])
    _wave(threads, [lambda: cleaned("cleaned_a", "a"), lambda: cleaned("cleaned_b", "b")])
    _wave(threads, [unified, described])
    _wave(threads, [enriched])
    _wave(threads, [staged])
    if marts:
        _wave(threads, [mart(name, build) for name, build in MARTS.items()])
    return r.written


PART = "part"


def refresh_partials(spark: SparkSession, source: CatalogTable, kept: CatalogTable, path: str, build) -> DataFrame:
    """Partials of every partition of ``source``'s current version, kept in a
    table of their own.

    A partition's files never change, so partials that are there are right:
    only partitions without partials are read, and partials of partitions that
    the version has no more (rewritten or emptied by a merge) are left out.
    ``build(rows, by)`` makes the partials, grouped by ``by`` first."""
    number = source.versions(spark)[-1]
    name = lambda values: "|".join(v if v is not None else "" for v in values.values())
    live = {name(partition_values(spec)): partition_values(spec) for spec in source.partitions(spark, number)}
    version = StagedVersion(kept, spark, path, [PART], [])
    there = {partition_values(spec)[PART]: spec for spec in kept.partitions(spark, version.base)} if version.base else {}
    new, gone = live.keys() - there.keys(), {spec for part, spec in there.items() if part not in live}
    if new or gone or not version.base:
        # the merges' tags are literals: the scan lists their folders and no others
        rows = spark.table(source.version_name(number)).where(F.col(MERGE).isin(sorted({live[n][MERGE] for n in new})))
        columns = list(next(iter(live.values()))) if live else [MERGE]
        part = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
        version.add(build(rows.withColumn(PART, part).where(F.col(PART).isin(sorted(new))), [PART]))
        version.publish(gone)
    return kept.read(spark)
