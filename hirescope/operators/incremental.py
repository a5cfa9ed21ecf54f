"""Incremental maintenance: high-water-mark filters, keep-latest, upsert.

All of these stay declarative.  The high-water mark is a scalar subquery
inside the plan (never collected to the driver); keep-latest is a grouped
``max`` over a struct, which Spark aggregates map-side first, so a hot key
is reduced inside each task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FLOOR = "1900-01-01 00:00:00"


def high_water_mark(target: DataFrame | Mapping[str, Column], column: str, floor: str | None = DEFAULT_FLOOR) -> Column:
    """``(SELECT COALESCE(MAX(column), floor) FROM target)`` as a scalar column,
    or, if ``target`` is the marks kept with a table, the kept one.

    With ``floor=None`` an empty target yields NULL, so nothing passes a
    ``>`` comparison against it (the unified-table behaviour).
    """
    if isinstance(target, Mapping):
        mark = target[column]
        return mark if floor is None else F.coalesce(mark, F.lit(floor).cast("timestamp"))
    mx = F.max(F.col(column))
    if floor is not None:
        dtype = target.schema[column].dataType.simpleString()
        mx = F.coalesce(mx, F.lit(floor).cast(dtype))
    return target.agg(mx.alias("hwm")).scalar()


def since(
    batch: DataFrame,
    target: DataFrame | Mapping[str, Column] | None,
    source_col: str,
    target_col: str | None = None,
    floor: str | None = DEFAULT_FLOOR,
    partition: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``batch`` newer than the target's high-water mark.

    ``target=None`` means a first (full) load; the marks kept with a catalog
    table serve as well as the table itself.  ``target_col`` may differ from
    ``source_col`` (e.g. postings' ingest time against enrichment time).

    ``partition`` names the partition column of ``batch`` that holds the day
    of ``source_col``, or its year, month and day columns: days before the
    mark's day cannot hold newer rows, so their files are not opened.  It is
    ignored where ``batch`` has no such columns (a view, say).
    """
    if target is None:
        return batch
    hwm = high_water_mark(target, target_col or source_col, floor)
    names = [partition] if isinstance(partition, str) else list(partition or [])
    if names and set(names) <= set(batch.columns):
        day = F.col(names[0]).cast("date") if len(names) == 1 else F.make_date(*(F.col(c) for c in names))
        batch = batch.where(day >= high_water_mark(target, target_col or source_col, floor).cast("date"))
    return batch.where(F.col(source_col) > hwm)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order``, ties by the whole row.

    ``max`` over a struct compares field by field, so the row with the
    greatest ``order`` wins and equal orders fall back to the remaining
    columns: deterministic without a window (a window would pull every row
    of a hot key into one task).  NULL keys form their own group.
    """
    key = list(key)
    order = list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    return df.groupBy(*key).agg(F.max(packed).alias("_row")).select(*key, "_row.*").select(*df.columns)


def key_match(key: Sequence[str], left: str = "t", right: str = "b") -> Column:
    """Null-safe equality of ``key`` between two aliased sides (planned as an
    equi-join on hashed keys, not a nested loop)."""
    return F.expr(" AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in key))


def matching(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """``df`` semi- or anti-joined (``how``) to ``keys`` on a null-safe key.

    Rows whose key is complete join by plain equality, which bucketed tables
    answer without a shuffle; only rows with a NULL in the key, if any, join
    null-safely."""
    key = list(key)
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    keys = keys.select(*key)
    plain = df.where(complete).join(keys.where(complete), key, how).select(*df.columns)
    rest = df.where(~complete).alias("t").join(keys.where(~complete).alias("b"), key_match(key), how)
    return plain.unionByName(rest.select(*df.columns))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str] = ("job_posting_id",),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``batch`` into ``target``: update all columns on a null-safe key
    match, insert the rest.

    If ``order`` is given the batch is first reduced to its latest row per
    key (a merge source may not repeat a key).  The result is
    ``target ANTI JOIN batch-keys UNION ALL batch``, broadcast by AQE only
    when the batch keys are measured small.
    """
    key = list(key)
    if order:
        batch = latest_per_key(batch, key, order)
    batch = batch.select(*target.columns)
    keys = batch.select(*key)
    if not order:  # a key repeated by a third of the batch collapses map-side
        keys = keys.dropDuplicates()
    return matching(target, keys, key, "left_anti").unionByName(batch)
