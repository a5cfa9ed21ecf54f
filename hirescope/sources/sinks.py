"""Sinks: full rebuild, load-date partitioned tables, merges, and reading back.

Path tables are files that Spark's own writers put at a path (Parquet by
default; the format is a parameter).  Reading one never changes it.  A change
of several partitions is several commits there, so a reader that lists files
in between can see a key twice, and a lost driver can leave it so until the
same merge is repeated.  Where tables are read while they are merged, use
``CatalogTable``: the catalog switches it from one whole version to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

DONE = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was completely created at ``path`` (a driver lost
    during the first write leaves a folder without Spark's success marker)."""
    return path_exists(spark, f"{path}/{DONE}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _delete_folder_of(spark: SparkSession, uri: str) -> None:
    """Delete a folder given as the URI that file metadata shows (encoded)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Create-or-replace a whole table (``materialized='table'``).  ``df`` must
    not read the table itself."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("year", "month", "day"),
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> str:
    """Partitioned write.

    No repartition by the partition columns happens here on purpose: every
    row of one load shares one load date, so hashing on it would funnel the
    whole load into one task.  Each task writes its own file per partition.
    With ``partitionOverwriteMode=dynamic`` only the partitions present in
    ``df`` are replaced.
    """
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*partitions)
        .save(path)
    )
    return path


# ------------------------------------------------------------ catalog tables

#: storage-only first partition column of catalog tables: the merge that wrote the row
MERGE = "hs_merge"


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_values(spec: str) -> dict[str, str | None]:
    """Partition values of a spec like ``a=1/b=x%3A2``, as text."""
    pairs = [part.split("=", 1) for part in spec.split("/")]
    return {unquote(k): None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for k, v in pairs}


class CatalogTable:
    """A table that the catalog switches from one whole version to the next.

    ``name`` is a view of the current version, itself a catalog table
    ``<name>__v<n>``.  A version's partitions are folders: those that its merge
    wrote, and, by their location only, all older ones that the merge did not
    touch.  Files are never changed or moved.

    A merge writes its rows to a fresh folder, registers a version nobody
    knows yet, and commits by renaming it to the next number, which the catalog
    refuses to the second of two writers.  Then the view is pointed at it.
    Readers change nothing: a query reads the version its view pointed to when
    it was analysed.  A merge broken off before the rename leaves the old
    version, and a folder that the next merge deletes.  ``keep`` older versions stay for
    queries that still read them; what only older ones refer to is deleted.

    With ``buckets`` every version is bucketed by the key: tables bucketed
    alike join on it without a shuffle.  ``marks`` are date or timestamp columns whose maximum
    over everything ever merged is observed while rows are written, and kept
    as a property of the version, so no mark needs the table read.
    """

    def __init__(self, name: str, buckets: int = 0, fmt: str = "parquet", marks: Sequence[str] = (), keep: int = 2):
        self.name = name
        self.buckets = buckets
        self.format = fmt
        self.marks = list(marks)
        self.keep = keep

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    def _named(self, spark: SparkSession, kind: str) -> list[str]:
        database, _, short = self.name.rpartition(".")
        place = f" IN {database}" if database else ""
        start = f"{short}__{kind}"
        return [r["tableName"][len(start) :] for r in spark.sql(f"SHOW TABLES{place} LIKE '{start}*'").collect()]

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in self._named(spark, "v") if n.isdigit())

    def unpublished(self, spark: SparkSession) -> list[str]:
        """Tags of versions that are being written, or were left."""
        return self._named(spark, "new_")

    def version_name(self, number: int) -> str:
        return f"{self.name}__v{number}"

    def current(self, spark: SparkSession) -> str:
        """The current version's own name (with the storage-only column)."""
        return self.version_name(self.versions(spark)[-1])

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def partitions(self, spark: SparkSession, number: int) -> set[str]:
        return {r[0] for r in spark.sql(f"SHOW PARTITIONS {self.version_name(number)}").collect()}

    def kept_marks(self, spark: SparkSession) -> dict[str, Column]:
        """The marks as literals: what is newer is known when a query is
        planned, without reading this table, so its scan lists only new
        partitions and its small size is known to joins."""
        schema = spark.table(self.name).schema
        stored = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {self.current(spark)}").collect()}
        return {c: F.lit(stored.get(f"mark.{c}")).cast(schema[c].dataType) for c in self.marks}

    def create(self, df: DataFrame, path: str, partitions: Sequence[str], key: Sequence[str]) -> None:
        spark = df.sparkSession
        staged = StagedVersion(self, spark, path, partitions, key)
        staged.add(df)
        staged.publish(set())

    def drop(self, spark: SparkSession) -> None:
        """Forget the table and all its versions; files stay."""
        spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for number in self.versions(spark):
            spark.sql(f"DROP TABLE IF EXISTS {self.version_name(number)}")


class StagedVersion:
    """The next version of a catalog table while it is being written: rows are
    added in a fresh folder, then ``publish`` makes it the current one."""

    def __init__(self, table: CatalogTable, spark: SparkSession, path: str, partitions: Sequence[str], key: Sequence[str]):
        self.table, self.spark, self.path = table, spark, path.rstrip("/")
        self.columns_by, self.key = [MERGE, *partitions], list(key)
        self.base = (table.versions(spark) or [0])[-1]
        self.tag = f"m{self.base + 1}_{uuid.uuid4().hex[:8]}"
        self.name = f"{table.name}__new_{self.tag}"
        self.marks: dict[str, str] = {}
        self.written = False

    def add(self, df: DataFrame) -> None:
        marks, observed = self.table.marks, Observation()
        df = df.withColumn(MERGE, F.lit(self.tag))
        if marks:
            df = df.observe(observed, *(F.max(c).cast("string").alias(c) for c in marks))
        if not self.written:
            writer = df.write.format(self.table.format).option("path", f"{self.path}/{self.tag}").partitionBy(*self.columns_by)
            if self.table.buckets:
                writer = writer.bucketBy(self.table.buckets, *self.key).sortBy(*self.key)
            writer.saveAsTable(self.name)
            self.written = True
        else:
            df.select(*self.spark.table(self.name).columns).write.insertInto(self.name, overwrite=False)
        for c, value in (observed.get if marks else {}).items():
            self.marks[c] = max(filter(None, [value, self.marks.get(c)]), default=None)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def publish(self, gone: Iterable[str]) -> None:
        """Commit: the folders written, and all of the base version's but those of ``gone``."""
        number = self.base + 1
        try:
            self._register(gone)
            # refused if another writer has committed this number
            self.spark.sql(f"ALTER TABLE {self.name} RENAME TO {self.table.version_name(number)}")
        except AnalysisException as error:
            if number not in self.table.versions(self.spark):
                raise
            self.discard()
            raise RuntimeError(f"another merge of {self.table.name} was committed first; repeat this one") from error
        self.point_view(number)
        self.clean_up(number)

    def _register(self, gone: Iterable[str]) -> None:
        """The partitions that stay, by their locations, and the marks."""
        spark, table = self.spark, self.table
        if self.base:
            stay = sorted(table.partitions(spark, self.base) - set(gone))
            for start in range(0, len(stay), 500):
                spark.sql(f"ALTER TABLE {self.name} ADD " + " ".join(self._located(spec) for spec in stay[start : start + 500]))
            old = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table.version_name(self.base)}").collect()}
            for c in table.marks:
                self.marks[c] = max(filter(None, [self.marks.get(c), old.get(f"mark.{c}")]), default=None)
        marks = ", ".join(f"'mark.{c}' = {_quoted(v)}" for c, v in self.marks.items() if v is not None)
        if marks:
            spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({marks})")

    def discard(self) -> None:
        """Forget this version and what was written for it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        _delete(self.spark, f"{self.path}/{self.tag}")

    def point_view(self, number: int) -> None:
        name = self.table.version_name(number)
        columns = ", ".join(f"`{c}`" for c in self.spark.table(name).columns if c != MERGE)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table.name} AS SELECT {columns} FROM {name}")

    def _located(self, spec: str) -> str:
        values = ", ".join(f"`{k}`={_quoted(v)}" for k, v in partition_values(spec).items())
        return f"PARTITION ({values}) LOCATION {_quoted(self._folder(spec))}"

    def _folder(self, spec: str) -> str:
        return f"{self.path}/{partition_values(spec)[MERGE]}/{spec}"

    def clean_up(self, number: int) -> None:
        """Drop versions beyond those that are kept, and the folders that only
        they refer to; and what merges left that can be committed no more,
        as their number is taken."""
        spark, table = self.spark, self.table
        for tag in table.unpublished(spark):
            if int(tag[1:].split("_")[0]) <= number:
                spark.sql(f"DROP TABLE IF EXISTS {table.name}__new_{tag}")
                _delete(spark, f"{self.path}/{tag}")
        numbers = table.versions(spark)
        old = [n for n in numbers if n < number - table.keep]
        if not old:
            return
        kept = set().union(*(table.partitions(spark, n) for n in numbers if n not in old))
        for n in old:
            gone = table.partitions(spark, n) - kept
            spark.sql(f"DROP TABLE IF EXISTS {table.version_name(n)}")
            for spec in gone:
                _delete(spark, self._folder(spec))


# -------------------------------------------------------------------- merges


def merge_into_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: Sequence[str],
    partitions: Sequence[str] = ("year", "month", "day"),
    order: Sequence[str] | None = None,
    delete_keys: DataFrame | None = None,
    table: CatalogTable | None = None,
    fmt: str = "parquet",
) -> str:
    """Upsert ``batch`` into the table at ``path``, rewriting only the
    partitions that hold a row whose key the batch replaces.  Rows whose key
    is in ``delete_keys`` are removed as well.  With ``table`` the data lives
    in a catalog table whose folders are below ``path``.

    Without ``order`` the batch must not repeat a key; with it the latest row
    of a key counts.  An append-only batch rewrites nothing.  Replaying a batch
    changes nothing.  Only the list of touched partitions (one row per load
    date) reaches the driver.
    """
    from ..operators.incremental import latest_per_key

    key, partitions = list(key), list(partitions)
    if order:
        batch = latest_per_key(batch, key, order)
    if table is not None:
        stage_merge(spark, path, batch, key, partitions, bool(order), delete_keys, table)()
    elif not table_exists(spark, path):
        # static overwrite: clears what a broken-off first write left, and marks success at the table's root
        batch.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static").partitionBy(*partitions).save(path)
    else:
        _merge_into_path(spark, path, batch, key, partitions, bool(order), delete_keys, fmt)
    return path


def _keys(batch: DataFrame, key: list[str], unique: bool, delete_keys: DataFrame | None) -> DataFrame:
    keys = batch.select(*key)
    if delete_keys is not None:
        keys = keys.unionByName(delete_keys.select(*key))
    if delete_keys is not None or not unique:  # repeated keys collapse map-side
        keys = keys.dropDuplicates()
    return keys


def stage_merge(spark, path: str, batch: DataFrame, key: list[str], partitions: list[str], unique: bool, delete_keys: DataFrame | None, table: CatalogTable):
    """Write the next version of a catalog table; what it returns publishes it.

    The batch is written once, to the version's own folder, and probed from
    there; of the partitions that hold a replaced key the rows that stay are
    added to the same folder."""
    from ..operators.incremental import matching

    staged = StagedVersion(table, spark, path, partitions, key)
    staged.add(batch)
    if not staged.base:
        return lambda: staged.publish(set())
    target = spark.table(table.version_name(staged.base))
    keys = _keys(staged.rows().where(F.col(MERGE) == staged.tag), key, unique, delete_keys)
    by = [MERGE, *partitions]
    hits = matching(target.select(*dict.fromkeys([*key, *by])), keys, key, "left_semi")
    touched = hits.select(*by).distinct().collect()
    if not touched:
        return lambda: staged.publish(set())
    # one row a load date: joined by shuffle, a load would meet in the one task of its date
    touched_rows = F.broadcast(spark.createDataFrame(touched, target.select(*by).schema))
    # the merges' tags prune folders, the join tells their partitions apart (null-safely)
    inside = matching(target.where(F.col(MERGE).isin(sorted({r[MERGE] for r in touched}))), touched_rows, by, "left_semi")
    staged.add(matching(inside, keys, key, "left_anti"))
    as_text = touched_rows.select(*(F.col(c).cast("string") for c in by)).collect()
    lost = [tuple(r) for r in as_text]
    gone = {spec for spec in table.partitions(spark, staged.base) if tuple(partition_values(spec).values()) in lost}
    return lambda: staged.publish(gone)


def _merge_into_path(spark, path: str, batch: DataFrame, key: list[str], partitions: list[str], unique: bool, delete_keys: DataFrame | None, fmt: str) -> None:
    """Merge by Spark's own writers.  New rows of other partitions are appended
    first, then the touched partitions are overwritten, then emptied ones
    removed: broken off in between, no row is missing, and repeating the merge
    makes it whole."""
    from ..operators.incremental import matching

    target = spark.read.format(fmt).load(path)
    scratch = work_path(spark, "merge")
    # the batch may read the table: fixed before the table changes (with the table's types:
    # partition values that are read back from folder names may be dates or numbers)
    typed = batch.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields))
    typed.write.format(fmt).save(f"{scratch}/batch")
    batch = spark.read.format(fmt).schema(target.schema).load(f"{scratch}/batch").select(*target.columns)
    keys = _keys(batch, key, unique, delete_keys)
    append = lambda df: (df.write.partitionBy(*partitions) if partitions else df.write).format(fmt).mode("append").save(path)
    if not partitions:
        if matching(target, keys, key, "left_semi").isEmpty():
            append(batch)
        else:
            whole = f"{scratch}/whole"
            matching(target, keys, key, "left_anti").unionByName(batch).write.format(fmt).save(whole)
            write_table(spark.read.format(fmt).schema(target.schema).load(whole), path, fmt)
    else:
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("__folder")
        hits = matching(target.select(*dict.fromkeys([*key, *partitions]), folder), keys, key, "left_semi")
        touched = hits.select(*partitions, "__folder").distinct().collect()
        appended = batch
        if touched:
            # one row a load date: joined by shuffle, a load would meet in the one task of its date
            touched_df = F.broadcast(spark.createDataFrame(sorted({tuple(r)[:-1] for r in touched}, key=repr), target.select(*partitions).schema))
            # partition values are matched null-safely: a row of the NULL partition is in it
            kept = matching(matching(target, touched_df, partitions, "left_semi"), keys, key, "left_anti")
            arriving = matching(batch, touched_df, partitions, "left_semi")
            appended = matching(batch, touched_df, partitions, "left_anti")
            new = kept.unionByName(arriving)
            present = {tuple(r) for r in new.select(*partitions).distinct().collect()}
        append(appended)
        if touched:
            new.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).save(path)
            for values, uri in {(tuple(r)[:-1], r["__folder"]) for r in touched}:
                if values not in present:
                    _delete_folder_of(spark, uri)
    _delete(spark, scratch)
