"""Raw file readers (explicit schemas) and bronze load stamping."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

FEEDS = {"a": schemas.RAW_FEED_A, "b": schemas.RAW_FEED_B}


def read_raw_feed(spark: SparkSession, path: str | list[str], feed: str, rescue: bool = True) -> DataFrame:
    """Parquet scan of one raw feed (a folder or a list of files), fitted to
    its fixed schema, with each row's ``source_file``.

    Files whose own schemas (footers) agree are read as one group, so files
    may differ in columns and in their types.  In each group a column of
    another type is converted with ``try_cast``, and every value that does not
    convert, plus every column or struct field that the schema does not know,
    is kept as JSON in ``_rescued_data`` (``{"column": "value", ...}``), so
    nothing a producer adds is lost.  ``rescue=False`` reads the fixed schema
    only, without a look at the footers, and drops unknown columns.
    """
    schema = FEEDS[feed]
    paths = [path] if isinstance(path, str) else list(path)
    file = F.col("_metadata.file_path").alias("source_file")
    if not rescue:
        return spark.read.schema(schema).parquet(*paths).select(*schema.names, file)
    groups = _agreeing(spark, paths)
    return reduce(DataFrame.unionByName, (_fitted(group, schema, file) for group in groups))


def _merged(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The files under one merged schema, or None if their types contradict each other."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    except (PySparkException, Py4JError) as error:  # which of the two depends on the client
        if "CANNOT_MERGE" not in str(error):
            raise
        return None


def _agreeing(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One frame for each set of files whose schemas merge: usually one.

    Spark merges footers in parallel.  Where that fails, the files are halved
    until it does not (a producer changes its types from some file on), and
    halves that fit together are put together again: as many frames as there
    are schemas that contradict each other."""
    whole = _merged(spark, paths)
    if whole is not None:
        return [whole]
    halves = [sorted(spark.read.schema("__none string").parquet(*paths).inputFiles())]
    groups: list[tuple[dict, list[str]]] = []
    while halves:
        names = halves.pop()
        found = _merged(spark, names)
        if found is None:
            halves += [names[len(names) // 2 :], names[: len(names) // 2]]
            continue
        types = {f.name: f.dataType for f in found.schema.fields}
        for known, members in groups:
            if all(known.get(c, t) == t for c, t in types.items()):
                known.update(types)
                members += names
                break
        else:
            groups.append((types, names))
    return [spark.read.option("mergeSchema", True).parquet(*names) for _, names in groups]


def _fitted(raw: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    have = {f.name: f.dataType for f in raw.schema.fields}
    own = [f for f in schema.fields if f.name != "_rescued_data"]
    cols, rescued = _fit_fields(own, have, lambda name: F.col(f"`{name}`"), "")
    rescued = [pair for pair in rescued if pair[0] != "_rescued_data"]
    found = F.map_filter(F.create_map(*(x for name, text in rescued for x in (F.lit(name), text))), lambda k, v: v.isNotNull()) if rescued else None
    new = F.when(F.size(found) > 0, F.to_json(found)) if found is not None else F.lit(None).cast("string")
    old = F.col("_rescued_data").cast("string") if "_rescued_data" in have else F.lit(None).cast("string")
    return raw.select(*(c.alias(f.name) for c, f in zip(cols, own)), F.coalesce(old, new).alias("_rescued_data"), *more)


def _fit_fields(fields, have: dict, value, prefix: str) -> tuple[list[Column], list[tuple[str, Column]]]:
    """``fields`` taken from a row or struct whose fields are ``have``, and
    (name, text) of what does not fit or is not known (null where all fits)."""
    cols, rescued = [], []
    for field in fields:
        if field.name not in have:
            cols.append(F.lit(None).cast(field.dataType))
            continue
        src, dtype = value(field.name), have[field.name]
        if dtype == field.dataType:
            cols.append(src)
        elif isinstance(dtype, T.StructType) and isinstance(field.dataType, T.StructType):
            inner, more = _fit_fields(field.dataType.fields, {f.name: f.dataType for f in dtype.fields}, lambda n, s=src: s.getField(n), f"{prefix}{field.name}.")
            fitted = F.struct(*(c.alias(f.name) for c, f in zip(inner, field.dataType.fields)))
            cols.append(F.when(src.isNotNull(), fitted))
            rescued += more
        elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) or isinstance(field.dataType, T.StructType):
            cols.append(F.lit(None).cast(field.dataType))  # no cast leads from one to the other
            rescued.append((prefix + field.name, _as_text(src, dtype)))
        else:
            fitted = src.try_cast(field.dataType)
            cols.append(fitted)
            rescued.append((prefix + field.name, F.when(src.isNotNull() & fitted.isNull(), _as_text(src, dtype))))
    known = {f.name for f in fields}
    rescued += [(prefix + name, _as_text(value(name), dtype)) for name, dtype in have.items() if name not in known]
    return cols, rescued


def _as_text(col: Column, dtype) -> Column:
    complex_type = isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(col) if complex_type else col.cast("string")


def read_availability_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV directory scan of the availability pool.

    ``is_active`` is read as text (``load_availability`` converts ``true``,
    ``1``, ``false``, ``0`` and the like), so odd values are not lost here.
    Rows that do not fit the schema keep their text in ``_corrupt_record``
    (PERMISSIVE mode) instead of failing the load.
    """
    return (
        spark.read.schema(schemas.AVAILABILITY_CSV)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )


def read_ai_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AI_SUMMARIES).parquet(path)


def as_of_timestamp(as_of: dt.datetime | dt.date | str) -> Column:
    """A load-time literal in the session zone (the reference's current_timestamp)."""
    if isinstance(as_of, dt.datetime):
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    else:
        text = f"{as_of} 00:00:00" if len(str(as_of)) == 10 else str(as_of)
    return F.to_timestamp(F.lit(text))


def load_date_parts(as_of: dt.date | str) -> dict[str, Column]:
    """``year``/``month``/``day`` of the load date (partition columns)."""
    d = F.lit(str(as_of)[:10]).cast("date")
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def bronze_stamp(raw: DataFrame, as_of, with_file_path: bool = True) -> DataFrame:
    """Bronze tier: raw columns + ingest time, source file and load-date parts."""
    cols = {"ingest_dts": as_of_timestamp(as_of)}
    if with_file_path and "source_file" not in raw.columns:
        cols["source_file"] = F.col("_metadata.file_path")
    cols.update(load_date_parts(as_of))
    return raw.withColumns(cols)
