"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key divided by its quality weight; in the order of these keys
a source's documents are a weighted random sample without replacement. A source first takes
complete epochs of all its documents, then the documents with the smallest keys whose summed
sizes stay within the rest of its target, then the one document whose size closes the remaining
gap best. Draws come from a hash of the id (of the text where the id is null) and the seed, so reruns
agree.

Prefix sums never put a source into one task: keys fall into 1024 ranges, whose sums tell in
which range the budget ends; that range is split again until it holds few rows, and only those
are sorted. The table of sources (a row each) is the only thing that one task sees whole.

Defined results: a null text has size 0; a null source is a source, last in order; a source
without words has target 0; repeated rows count as documents of their own; an empty table gives
an empty result; ties of keys are broken by id and then by place in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.llm.common import WORD, checkpointed, free_name, table, text_of

MOST_EPOCHS = 3
SEED = 17
RANGES = 1024
SORT_ROWS = 50_000


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def usual_words(text: Column, size: Column) -> Column:
    """A plain quality weight: 1 where words have 3 to 10 characters on average, else 1/4."""
    per_word = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(per_word.between(4, 11), 1.0).otherwise(0.25)


def uniform(id_col: Column, seed: int) -> Column:
    """In (0, 1): 52 bits of md5(seed:id)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, source: str = "source", most: int = MOST_EPOCHS) -> DataFrame:
    """Per source: ``source, source_size, target, epochs, rest``.

    Sources by code point (null last) weigh 1, 2, 3, repeating. A target above ``most`` times its
    source's size stops there and the excess is shared again by weight: in the order of the share
    at which a source fills up, each is compared with its share of what the earlier ones leave.
    All of it is integer arithmetic, with one division for ``target``.
    """
    order = W.orderBy(F.col(source).asc_nulls_last())
    big = lambda c: F.col(c).cast("decimal(38,0)")
    s = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    s = s.withColumn("w", (F.row_number().over(order) - 1) % 3 + 1).withColumn("cap", F.col("source_size") * most)
    every = W.partitionBy()
    filling = W.orderBy(F.col("cap") / F.col("w"), F.col(source).asc_nulls_last())
    earlier = filling.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)),
            "left_w": F.sum("w").over(every) - F.coalesce(F.sum("w").over(earlier), F.lit(0)),
        }
    )
    s = s.withColumn("full", big("left") * big("w") > big("cap") * big("left_w"))
    s = s.withColumns(
        {
            "num": F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)),
            "den": F.sum(F.when(~F.col("full"), F.col("w"))).over(every),
        }
    )
    share = F.col("num") * F.col("w")
    words = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("num * w div den"))
    s = s.withColumns({"target": F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share.cast("double") / F.col("den")), "words": words})
    s = s.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)).cast("long"))
    return s.select(source, "source_size", "target", "epochs", (F.col("words") - F.col("epochs") * F.col("source_size")).alias("rest"))


def within_budget(rows: DataFrame, ranges: int = RANGES, sort_rows: int = SORT_ROWS) -> DataFrame:
    """The ``row`` of each row whose running size, in key order within its source, stays within ``rest``.

    ``rows``: source, x (the key, in [0, 1)), doc_id, row, size, rest.
    """
    chosen, scale = [], float(ranges)
    while True:
        rows = rows.withColumn("range", F.floor(F.col("x") * scale).cast("long"))
        sums = rows.groupBy("source", "range").agg(F.sum("size").alias("sum"), F.count(F.lit(1)).alias("n"), F.max("rest").alias("rest"))
        running = F.sum("sum").over(W.partitionBy("source").orderBy("range"))
        sums = checkpointed(sums.withColumn("upto", running))
        cut = sums.where(F.col("upto") > F.col("rest")).groupBy("source").agg(
            F.min_by(F.struct("range", "n", (F.col("upto") - F.col("sum")).alias("before")), "range").alias("cut")
        ).select(F.col("source").alias("cut_source"), F.col("cut.*"))
        cut = checkpointed(cut.withColumnRenamed("range", "cut_range"))
        near = rows.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        chosen.append(near.where(F.col("cut_range").isNull() | (F.col("range") < F.col("cut_range"))).select("row"))
        rows = near.where(F.col("range") == F.col("cut_range")).select("source", "x", "doc_id", "row", "size", (F.col("rest") - F.col("before")).alias("rest"))
        if cut.where(F.col("n") > sort_rows).isEmpty() or scale * ranges > 2.0**52:
            break
        rows, scale = checkpointed(rows), scale * ranges
    by_key = W.partitionBy("source").orderBy("x", "doc_id", "row").rowsBetween(W.unboundedPreceding, 0)
    chosen.append(rows.withColumn("upto", F.sum("size").over(by_key)).where("upto <= rest").select("row"))
    out = chosen[0]
    for more in chosen[1:]:
        out = out.union(more)
    return out


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    seed: int = SEED,
    most: int = MOST_EPOCHS,
    keep: str | None = None,
) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, copies, taken``, and ``keep``, a column of ``docs``.

    ``weight`` is a quality weight (null or not positive: the smallest there is, 1e-6).
    """
    more = [keep] if keep else []
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_of(text_col).alias("text"), *more, *([weight.alias("weight")] if weight is not None else [])
    ).withColumn("size", words_in(F.col("text")))
    if weight is None:
        sized = sized.withColumn("weight", usual_words(F.col("text"), F.col("size")))
    # without an id the text draws: one draw for all of them would keep or drop them as a block
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.col("text").cast("binary"), 256))
    key = -F.log(uniform(drawn, seed)) / F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(1e-6))
    rows = sized.select("doc_id", "source", "size", (key / (key + 1)).alias("x"), F.monotonically_increasing_id().alias("row"), *more)
    rows = checkpointed(rows)
    targets = checkpointed(source_targets(rows, "source", most))
    aimed = rows.join(F.broadcast(targets.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))) if _few(targets) else rows.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    aimed = aimed.drop("of")
    chosen = within_budget(aimed.where("rest > 0").select("source", "x", "doc_id", "row", "size", "rest"))
    marked = checkpointed(aimed.join(chosen.withColumn("chosen", F.lit(1)), "row", "left").withColumn("chosen", F.coalesce("chosen", F.lit(0))))
    # one document more where it closes the gap better than none
    sums = marked.groupBy("source").agg((F.max("rest") - F.sum(F.col("size") * F.col("chosen"))).alias("gap")).where("gap > 0")
    sums = sums.withColumnRenamed("source", "of")
    off = F.abs(F.col("gap") - F.col("size"))
    last = marked.where("chosen = 0 AND size > 0").join(sums, F.col("source").eqNullSafe(F.col("of"))).where(off < F.col("gap"))
    last = last.groupBy("source").agg(F.min(F.struct(off.alias("off"), "x", "doc_id", "row")).alias("best")).select(F.col("best.row"), F.lit(1).alias("closing"))
    copies = F.col("epochs") + F.col("chosen") + F.coalesce("closing", F.lit(0))
    return marked.join(last, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *more
    )


def _few(targets: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to broadcast."""
    return targets.limit(most + 1).count() <= most


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Ids may be null or repeat: a row is known by its id and the digest of its text. Rows that
    repeat both count once.
    """
    digest, copies, of, of_digest = (free_name(docs, x) for x in ("mix_digest", "mix_copies", "mix_id", "mix_of_digest"))
    docs, columns = docs.withColumn(digest, F.sha2(text_of(options.get("text_col", "text")).cast("binary"), 256)), docs.columns
    if not docs.groupBy(id_col, digest).count().where("count > 1").isEmpty():
        docs = checkpointed(docs.dropDuplicates([id_col, digest]))  # which row stays is settled here
    taken = mix(docs, id_col, keep=digest, **options).where("copies > 0").select(F.col("doc_id").alias(of), F.col(digest).alias(of_digest), F.col("copies").cast("int").alias(copies))
    out = docs.join(taken, (docs[digest] == F.col(of_digest)) & docs[id_col].eqNullSafe(F.col(of)))
    return out.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('17:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
           / CASE WHEN length(text)::DOUBLE / greatest(size, 1) BETWEEN 4 AND 11 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS k
  FROM sized),
s0 AS (SELECT source, sum(size)::HUGEINT AS source_size FROM keyed GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0) AS rest_words,
              sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS rest_w
       FROM s1
       WINDOW f AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, rest_words * w > cap * rest_w AS filled FROM s2),
s4 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(CASE WHEN filled THEN cap END) OVER (), 0) AS num,
              sum(CASE WHEN NOT filled THEN w END) OVER () AS den FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN filled THEN cap::DOUBLE ELSE (num * w)::DOUBLE / den::DOUBLE END AS target,
              CASE WHEN filled THEN cap ELSE (num * w) // den END AS words FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS epochs FROM s5),
aimed AS (
  SELECT keyed.*, source_size, target, epochs, words - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed JOIN s6 ON keyed.source IS NOT DISTINCT FROM s6.source),
chosen AS (SELECT *, upto <= rest AND rest > 0 AS chosen FROM aimed),
gaps AS (SELECT *, rest - coalesce(sum(CASE WHEN chosen THEN size END) OVER (PARTITION BY source), 0) AS gap FROM chosen),
best AS (SELECT *, row_number() OVER (PARTITION BY source, NOT chosen AND size > 0 AND abs(gap - size) < gap
                                      ORDER BY abs(gap - size), k, doc_id) = 1
                   AND NOT chosen AND size > 0 AND abs(gap - size) < gap AS closing FROM gaps)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       ((epochs + chosen::INT + closing::INT) * size)::BIGINT AS taken
FROM best
"""
