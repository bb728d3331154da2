"""Documents drawn by importance towards the word distribution of a target corpus.

Texts become hashed n-gram counts, a sparse matrix of documents by buckets. It is laid out once, as
blocks in compressed sparse rows (one table row holds some thousand documents: their ids, row
bounds, bucket numbers and counts), in a table of the shared folder; texts are not read again. Column
sums of the blocks give the distributions of source and target; each bucket's gain is the floored
scaled logarithm of their smoothed ratio, and the product of the matrix with the gains, divided by
the rows' sums, gives the weights. A Gumbel draw from the hash of each id makes the highest scores a
sample in proportion to the weights.

Each task keeps one block and one array of ``buckets`` sums in Python, and a file has few blocks, as Spark's
reader takes up to 4,096 rows of a file at once: memory depends neither on the input nor on how much of
it a task reads. Gains (one number a bucket) are all that goes to every task. Ranks come without a sort of all
rows: documents are counted by score, a running sum over the scores gives each score's first rank, and only
rows that tie in score are ordered, by id. Scores are whole numbers; at scale 1000 64-bit counts leave
gains within 45,000 of zero and the draw between -3,200 and 22,900, so there are some 100,000 of them
at most, however many rows there are. Rows equal in all they return are counted, not listed, until ranks are given out.

Defined results: a null text has no words; a document without features weighs 0; a null id counts as
an empty one in the draw and comes last among ties; repeated rows take ranks one after the other;
without documents of enough words no rank is given; an empty target leaves gains to smoothing.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adit.llm.common import arrow_batches, checkpointed, removed, shared_folder, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # bytes: those of longer code points are all above 7F
BUCKETS = 10_000
LONGEST = 1
SCALE = 1000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
BLOCK = 262_144  # a block is closed at so many counts (a document adding 16 for its own numbers)
PER_FILE = 4  # blocks, some 13 MB when read; a file of 128 MB of texts would have some 60
BATCH = "8m"  # of texts or blocks sent to Python at once: Spark's 64 MB would be held twice in each task
_BLOCK = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("n_words", pa.list_(pa.int64())),
        ("row_ends", pa.list_(pa.int64())),
        ("buckets", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_DDL = "doc_ids array<long>, n_words array<long>, row_ends array<long>, buckets array<int>, counts array<long>"


def features(text: str | None, longest: int = LONGEST) -> tuple[int, list[bytes]]:
    """The number of words, and all runs of 1 to ``longest`` of them joined by a space, as UTF-8."""
    words = WORD.findall((text or "").encode().lower())  # bytes: A-Z only
    found = list(words)
    for n in range(2, longest + 1):
        found += map(b" ".join, zip(*[words[k:] for k in range(n)], strict=False))
    return len(words), found


def _blocks(longest: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def closed(ids: list, words: list, rows: list) -> pa.RecordBatch:
        ends = np.cumsum([len(b) for b, _ in rows])
        columns = [ids, words, ends, np.concatenate([b for b, _ in rows]), np.concatenate([c for _, c in rows])]
        return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(columns, _BLOCK, strict=True)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, rows, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                n, found = features(text.as_py(), longest)
                at = np.fromiter(map(crc32, found), np.uint32, len(found)) % buckets
                number, count = np.unique(at.astype(np.int32), return_counts=True)
                ids.append(doc_id.as_py())
                words.append(n)
                rows.append((number, count))
                held += len(number) + 16
                if held >= BLOCK:
                    yield closed(ids, words, rows)
                    ids, words, rows, held = [], [], [], 0
        if ids:
            yield closed(ids, words, rows)

    return run


@dataclass
class CountMatrix:
    """Counts of documents by buckets, as a table of blocks in compressed sparse rows."""

    blocks: DataFrame
    buckets: int
    path: str | None = None

    @classmethod
    def of(cls, docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, path: str | None = None) -> CountMatrix:
        """The matrix of ``docs``, written to ``path`` if one is given (and otherwise made anew wherever it is used)."""
        rows = docs.select((F.col(id_col) if id_col else F.lit(None)).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        blocks = rows.mapInArrow(_blocks(longest, buckets), _DDL)
        if path:
            blocks.write.option("maxRecordsPerFile", PER_FILE).parquet(path)
            blocks = docs.sparkSession.read.schema(_DDL).parquet(path)
        return cls(blocks, buckets, path)

    def column_sums(self) -> DataFrame:
        """``bucket, n`` of every bucket that occurs: each task adds up its blocks before anything moves."""
        width = self.buckets
        schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(width, np.int64)
            for batch in batches:
                at, n = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
                np.add.at(sums, at, n)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], schema=schema)

        parts = self.blocks.select("buckets", "counts").mapInArrow(run, "bucket int, n long")
        return parts.groupBy("bucket").agg(F.sum("n").alias("n"))

    def row_means(self, gains: np.ndarray) -> DataFrame:
        """``doc_id, n_words, n_features, weight``: the matrix times ``gains``, over each row's sum, floored."""
        shared = self.blocks.sparkSession.sparkContext.broadcast(gains)  # one number a bucket
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows)):
                ids, words, ends, at, n = (c.flatten() for c in block.columns)
                counts = n.to_numpy(zero_copy_only=False)
                stops = np.concatenate([[0], ends.to_numpy(zero_copy_only=False)])
                totals = np.concatenate([[0], np.cumsum(counts)])
                products = np.concatenate([[0], np.cumsum(counts * shared.value[at.to_numpy(zero_copy_only=False)])])
                size, sums = (x[stops[1:]] - x[stops[:-1]] for x in (totals, products))
                weight = sums // np.maximum(size, 1)  # floors down
                yield pa.RecordBatch.from_arrays([ids, words, pa.array(size), pa.array(weight)], schema=schema)

        return self.blocks.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gains_of(source: CountMatrix, target: CountMatrix, scale: int = SCALE) -> np.ndarray:
    """Of each bucket floor(scale * ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))."""
    width = source.buckets

    def sums(matrix: CountMatrix) -> np.ndarray:
        found = matrix.column_sums().toArrow()  # at most one row a bucket
        out = np.zeros(width, np.int64)
        out[found["bucket"].to_numpy()] = found["n"].to_numpy()
        return out

    s, t = sums(source), sums(target)
    a, b = int(s.sum()) + width, int(t.sum()) + width
    ratios = [(int(y) + 1) * a / ((int(x) + 1) * b) for x, y in zip(s, t, strict=True)]
    return np.array([math.floor(scale * math.log(r)) for r in ratios], np.int64)


def drawn_number(seed: str) -> Column:
    """The first 8 hex digits of sha256(``seed:doc_id``), as a number."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long")


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` (doc_id, n_words, n_features, weight, score) with ``rank``, null for what is not drawn."""
    one = F.count(F.lit(1))
    enough = F.col("n_words") >= least_words
    by_score = rows.where(enough).groupBy("score").agg(one.alias("n"))
    by_score = checkpointed(by_score)  # some 100,000 rows at most, see above
    higher = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    draws = by_score.agg(F.floor(F.sum("n") * percent / 100).alias("draws"))
    starts = by_score.select("score", higher.alias("higher")).crossJoin(draws)  # one row
    starts = starts.where(F.col("higher") < F.col("draws"))
    starts = starts.select(F.col("score").alias("of_score"), "higher", "draws")
    met = rows.join(F.broadcast(starts), enough & (F.col("score") == F.col("of_score")), "left")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    out = met.where(F.col("higher").isNull()).select(*columns, F.lit(None).cast("long").alias("rank"))
    alike = met.where(F.col("higher").isNotNull()).groupBy(*columns, "higher", "draws").agg(one.alias("n"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_words", "n_features", "weight")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = alike.withColumn("first", F.col("higher") + before + 1)
    listed = listed.select(*columns, "draws", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("rank"))
    return out.unionByName(listed.select(*columns, F.when(F.col("rank") <= F.col("draws"), F.col("rank")).alias("rank")))


def importance_resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    scale: int = SCALE,
    seed: str = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    The table of blocks is removed once weights (some numbers a document) are written.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/counts-{uuid.uuid4().hex}"
    draw = F.floor(-F.lit(float(scale)) * F.log(-F.log((drawn_number(seed) + F.lit(0.5)) / F.lit(4294967296.0))))
    with arrow_batches(spark, BATCH):
        source = CountMatrix.of(docs, id_col, text_col, longest, buckets, path)
        gains = gains_of(source, CountMatrix.of(target, None, target_col, longest, buckets), scale)
        rows = checkpointed(source.row_means(gains).withColumn("score", F.col("weight") + draw))
    removed(spark, path)
    return ranked(rows, percent, least_words)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 as a sum by bytes; its table of 256 follows from the polynomial
OP11_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS of_byte
  FROM range(256) r(i)
),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
w AS (SELECT doc_id, unnest(words) AS word FROM d),
v AS (SELECT unnest(words) AS word FROM b),
known AS (
  SELECT word, hex(encode(word)) AS h, (SELECT of_byte FROM crc) AS of_byte FROM (SELECT word FROM w UNION SELECT word FROM v)
),
buckets AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, of_byte[(xor(c, x) & 255) + 1])
  ), 4294967295) % 10000 AS bucket
  FROM known
),
s AS (SELECT bucket, count(*) AS s FROM w JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM v JOIN buckets USING (word) GROUP BY bucket),
total AS (SELECT (SELECT count(*) FROM w) AS s_all, (SELECT count(*) FROM v) AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), total
),
weights AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM w JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)
),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN k <= floor(10 * n / 100) THEN k END::BIGINT AS rank
FROM scored LEFT JOIN ordered USING (doc_id)
"""
