"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import ann, bpe, exact_dedup, hard_negatives, html_extract, merkle, packing, pii, quality, simhash, substring_dedup, token_counts, url_filter
from hirescope.llm.common import read_table

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
#: the word tokenizer's end-of-text id, which no text encodes to
END_OF_TEXT = 49407


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(read_table(spark, sf_dir, "documents")))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    base = [F.col("__stats")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *base, "base_failed", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), capacity=2048, special=True)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(ids, ranks))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_counts.token_blocks(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), END_OF_TEXT)
    return token_counts.count_tokens(blocks, END_OF_TEXT, "doc_id").select("doc_id", "n_tokens")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("representative.doc_id").alias("component_id"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    altered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_hash(*altered))
    made = merkle.manifest(read_table(spark, sf_dir, "documents"), fields, extra={"tampered": tampered})
    root = F.lit(made.root).cast("string")
    proved = merkle.proofs(made).withColumn("folded_root", merkle.fold(F.coalesce("tampered", "node"), F.col("proof")))
    proof = F.sha2(F.concat_ws("", merkle.siblings(F.col("proof"))).cast("binary"), 256)
    return proved.select(F.col("order").alias("doc_id"), F.col("node").alias("leaf"), "subroot", root.alias("root"), proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(read_table(spark, sf_dir, "documents"))


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_nearest": op3_nearest,
    "op4_html_extract": op4_html_extract,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_counts": op9_token_counts,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle": op12_merkle,
    "op13_exact_dedup": op13_exact_dedup,
}

HARD_NEGATIVES_SQL = """
WITH rows_ AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector) WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', {0}) END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + "))"
_PARENTS = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(concat(nodes[i], nodes[i + 1])))"

#: trees as lists of nodes, one row a level; a step of a proof is the sibling's side and hash;
#: the checksum takes eight bits of each digit, one an element
MERKLE_SQL = f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf, {_LEAF.format(n="(n_chars + 1)")} AS altered,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
           list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
               lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
               lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))) AS crc
    FROM documents),
trees AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY doc_id) AS nodes FROM rows_ GROUP BY lang
    UNION ALL SELECT lang, level + 1, {_PARENTS} FROM trees WHERE len(nodes) > 1),
tops AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place FROM trees WHERE len(nodes) = 1),
over_ AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM tops
    UNION ALL SELECT level + 1, {_PARENTS} FROM over_ WHERE len(nodes) > 1),
steps AS (
    SELECT doc_id, 0 AS tier, level, place >> level AS spot, nodes
    FROM rows_ JOIN trees ON rows_.lang IS NOT DISTINCT FROM trees.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT doc_id, 1, level, tops.place >> level, nodes
    FROM rows_ JOIN tops ON rows_.lang IS NOT DISTINCT FROM tops.lang CROSS JOIN over_ WHERE len(nodes) > 1),
proofs AS (
    SELECT doc_id, list(concat(spot & 1, nodes[xor(spot, 1) + 1]) ORDER BY tier, level) AS steps FROM steps GROUP BY doc_id),
folded AS (
    SELECT rows_.doc_id, leaf, subroot, (SELECT nodes[1] FROM over_ WHERE len(nodes) = 1) AS root,
           sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256,
           list_reduce(list_prepend(CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN altered ELSE leaf END, coalesce(steps, [])),
               lambda own, s: CASE WHEN s[1] = '1' THEN sha256(concat(s[2:], own)) ELSE sha256(concat(own, s[2:])) END) AS folded_root
    FROM rows_ JOIN tops ON rows_.lang IS NOT DISTINCT FROM tops.lang JOIN documents USING (doc_id) LEFT JOIN proofs USING (doc_id))
SELECT *, folded_root = root AS verified FROM folded
"""

EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE: dict[str, str] = {
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_merkle": MERKLE_SQL,
    "op13_exact_dedup": EXACT_DEDUP_SQL,
}
