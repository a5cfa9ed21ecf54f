"""Exact deduplication with a heavy-hitter split.

Texts are compared by SHA-256.  A Misra-Gries summary (Spark's frequent-items
sketch: a fixed number of counters, all lowered when they run out) finds the
digests that may be frequent.  Their groups are counted exactly; the verified
winners, at most as many as the summary has counters, are broadcast, so the
copies of a frequent text are decided map-side and never meet in one task.
All other digests go through an ordinary aggregation and join.

Everything is DataFrame functions.  The digests are written once, as a narrow
table beside which the texts need not be read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialize

#: counters of the summary, and so the most digests that are broadcast (64 characters each)
COUNTERS = 4096
#: summaries that are combined at once: those of the tasks are combined in so many groups first
SHARDS = 256


def unchanged(text: Column) -> Column:
    return text


def _digest(text: Column, normalise: Callable[[Column], Column]) -> Column:
    return F.sha2(normalise(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def digest_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """(id, digest, row) of every row of ``df``, written to the shared folder;
    ``row`` is a number that no other row has."""
    keyed = df.select(F.col(id_col).alias("id"), _digest(F.col(text_col), normalise).alias("digest"), F.monotonically_increasing_id().alias("row"))
    return materialize(keyed, "exact-digests")


def frequent(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests of ``table``, among them every one that
    holds more than a few ``counters``-ths of the rows."""
    shards = table.select("digest", (F.spark_partition_id() % SHARDS).alias("shard"))
    partial = shards.groupBy("shard").agg(F.expr(f"approx_top_k_accumulate(digest, {counters})").alias("summary"))
    # grouped by a constant: no rows, no summary
    whole = partial.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(summary, {counters})").alias("summary"))
    return whole.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {counters})")).alias("x")).where("x.count > 1").select(F.col("x.item").alias("digest"))


def _winners(rows: DataFrame) -> DataFrame:
    """The group of each digest that has copies: its size and the row that
    stays (rows without an id come last)."""
    return rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("stays"), F.count("*").alias("group_size")).where("group_size > 1")


def split(table: DataFrame, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """``table`` with ``stays`` and ``group_size`` (null without copies), and
    the verified winners among the frequent digests."""
    likely = F.broadcast(frequent(table, counters))  # at most ``counters`` digests
    heavy = materialize(_winners(table.join(likely, "digest", "left_semi")), "exact-heavy")
    decided = table.join(F.broadcast(heavy), "digest")
    rest = table.join(F.broadcast(heavy), "digest", "left_anti")
    return decided.unionByName(rest.join(_winners(rest), "digest", "left")), heavy


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = unchanged, counters: int = COUNTERS) -> DataFrame:
    """For every row of ``df`` its id, ``keep_id`` (the largest id among rows
    of equal text), ``group_size``, ``kept`` and ``text_sha256``.

    ``normalise`` maps a text column to the text that is compared and hashed.
    Null texts are empty ones, and empty texts are equal.  Of rows that share
    the largest id as well, repeated rows included, one stays.  A null id
    comes after all others, so ``keep_id`` is null only where a whole group
    has none.  Texts of any length are hashed whole; other columns are not
    read, whatever their names.  An empty table gives an empty result.
    """
    rows, _ = split(digest_table(df, id_col, text_col, normalise), counters)
    alone = F.col("stays").isNull()
    return rows.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = unchanged, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``df`` that stay, one of each group, with all their columns.

    Copies of frequent texts are left out map-side, before their texts are
    shuffled.  Of rows that share id and text but differ elsewhere any one
    stays.  ``copies`` states the other cases.
    """
    rows, heavy = split(digest_table(df, id_col, text_col, normalise), counters)
    names = ["__digest", "__id"]
    keyed = df.withColumns({"__digest": _digest(F.col(text_col), normalise), "__id": F.col(id_col)})
    winners = F.broadcast(heavy.select(F.col("digest").alias("__digest"), "stays"))
    left = keyed.join(winners, "__digest", "left").where(F.col("stays").isNull() | F.col("stays.id").eqNullSafe(F.col("__id"))).drop("stays")
    stay = rows.where("stays IS NULL OR stays.row = row").select(F.col("digest").alias("__d"), F.col("id").alias("__i"))
    match = (F.col("__digest") == F.col("__d")) & F.col("__id").eqNullSafe(F.col("__i"))
    return left.join(stay, match, "left_semi").dropDuplicates(names).drop(*names)
