"""The corpus pipeline: quality rules, near-duplicates, repeated passages,
personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the shared folder and reads it back as the next stage's
documents, so a stage starts from files and a lost executor costs one stage.
All stages but the last return the columns of ``documents`` and no others;
extra columns of their input are dropped.  Null texts are empty ones.  Empty
tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.llm import packing, pii, quality, simhash, substring_dedup
from hirescope.llm.common import materialize, read_table
from hirescope.llm.queries import WORD_TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _row() -> Column:
    """A document's id and its text's hash: tells rows that share an id apart."""
    return F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the list learned from the labels
    of this input's documents."""
    judged = quality.judge(docs, read_table(spark, sf_dir, "labels"), columns=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 or fewer bits:
    the one of the smallest id; exactly repeated rows leave one."""
    keyed = docs.select(*COLUMNS, _row().alias("__row"))
    found = simhash.near_duplicates(keyed.select("doc_id", F.col("__row.key").alias("key"), "text"), id_cols=("doc_id", "key"), words=4, radius=4)
    stay = found.select(F.struct("representative.doc_id", "representative.key").alias("__row")).distinct()
    once = Window.partitionBy("__row").orderBy("lang", "source", "n_chars")
    return keyed.join(stay, "__row", "left_semi").withColumn("__n", F.row_number().over(once)).where("__n = 1").select(*COLUMNS)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that occur more
    than once; a changed text is its kept words joined by spaces.  No document
    goes, though a text may end empty."""
    found = substring_dedup.remove_repeats(docs, columns=COLUMNS, window=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return found.withColumn("text", text).withColumn("n_chars", _n_chars(docs)).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by the kind's name."""
    found = pii.find(docs)
    spans = found.where(F.size("spans") > 0).select(F.struct("doc_id", F.col("__key").alias("key")).alias("__row"), "spans").dropDuplicates(["__row"])
    joined = docs.select(*COLUMNS, _row().alias("__row")).join(spans, "__row", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii.redact(F.col("text"), F.col("spans")))
    return joined.withColumn("text", text).withColumn("n_chars", _n_chars(docs)).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), capacity=2048, special=True)


def _n_chars(docs: DataFrame) -> Column:
    return F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: none of the stages' iterative searches and tokenisers can be said in SQL; tests hold every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
