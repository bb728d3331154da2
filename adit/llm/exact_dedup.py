"""Exact duplicates, found by skew-safe combining with full content compared at each step.

Rows first combine inside each task (Spark's map-side aggregation), then in salted groups, then
the salted winners combine into one row per text. The grouping key always holds the whole text
beside its digest, so a digest collision can never merge two texts; a text that fills a third of
the table arrives at the last step as at most ``salts`` rows.

Defined results: a null text counts as empty; a null id loses against any id, and a group with
null ids alone keeps a row with a null id; rows that repeat both id and text are one document
seen several times, of which one row is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, free_name, table, text_of

SALTS = 16


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256_hex
) -> DataFrame:
    """One row per distinct text: ``digest, text, keep_id, group_size``."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("salt"),
    ).withColumn("digest", digest(F.col("text")))
    salted = rows.groupBy("digest", "text", "salt").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256_hex
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest``.

    A row finds its group by digest where one text has that digest, and by digest and whole text
    where several have it.
    """
    groups = duplicate_groups(docs, id_col, text_col, salts, digest)
    # one small row per text; text itself only where a digest stands for several texts
    by_digest = groups.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts")
    )
    by_digest = checkpointed(by_digest)
    # equal rows are interchangeable: they are counted before the join, so that the join stands
    # alone and Spark can split a digest that holds many rows, and written out again after it
    one_each = lambda rows: rows.groupBy("id", *[c for c in rows.columns if c != "id"]).agg(F.count(F.lit(1)).alias("n"))
    rows = one_each(docs.select(F.col(id_col).alias("id"), digest(text_of(text_col)).alias("digest")))
    plain = by_digest.where("texts = 1").drop("texts")
    found = rows.join(plain, "digest")
    shared = by_digest.where("texts > 1").select("digest")
    if not shared.isEmpty():
        whole = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        whole = whole.withColumn("digest", digest(F.col("text")))
        apart = groups.join(shared, "digest", "left_semi")
        found = found.unionByName(one_each(whole).join(apart, ["digest", "text"]).select(found.columns))
    return found.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"),
        "digest",
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = duplicate_groups(docs, id_col, text_col, salts).select("digest", F.col("keep_id"))
    digest, i = free_name(docs, "digest_of_text"), free_name(docs, "row_in_group")
    tagged = docs.withColumn(digest, sha256_hex(text_of(text_col)))
    keep = groups.select(F.col("digest").alias("group_digest"), F.col("keep_id"))
    same = (tagged[digest] == keep["group_digest"]) & tagged[id_col].eqNullSafe(keep["keep_id"])
    kept = tagged.join(keep, same, "left_semi")
    repeats = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias(i)).where(F.col(i) > 1)
    if not repeats.isEmpty():
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
