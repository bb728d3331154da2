"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put in another order.

Where to cut is found relationally. ``posexplode`` makes a row of every run of up to ``RUN`` units (a
unit is a match of a pattern, here a code point); window running sums over a document's runs give each
run the units and code points that precede it; cut requests, one row a cut, join the run by the ordinal
of their unit; what the cuts' offsets are is aggregated into one row a document, and ``substring`` cuts
the text there. Runs keep the rows few (one for ``RUN`` units); the lengths of their units stay with them
only where they differ.

Texts themselves move once, to meet their offsets; a document is known by a digest of its id and
text, so rows that repeat both share one set of offsets, and a hot one may be split by adaptive
execution. The placed runs (some 70 bytes for ``RUN`` units) are checkpointed. No Python runs.

Defined results: a null text counts as empty; an empty text, or one that contains a marker, stays
plain, and so does a share of the others; a null id counts as an empty one in the hash; repeated rows
give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, table, text_of

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
UNIT = "."
RUN = 4096
SEED = 1
PLAIN_FROM = 90  # h3 % 100 at or above this: plain
SPM_BELOW = 20  # h4 % 100 below this: suffix first


def numbers(seed: int, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex sha256 of ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(count)]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, text``: the key is the same for the same id and text only."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    named = F.concat(F.coalesce(F.concat(F.lit("#"), F.col("doc_id").cast("string")), F.lit("")), F.lit("\n"), F.col("text"))
    return rows.select(F.unhex(F.md5(named.cast("binary"))).alias("key"), "doc_id", "text")


def runs_of_units(rows: DataFrame, unit: str = UNIT, run: int = RUN) -> DataFrame:
    """``key, doc_id, run, units, chars, lengths``: each document's runs of units, in order.

    ``unit`` is a pattern whose matches follow one another from the start of a text; what is left
    after the last match belongs to no unit. ``lengths`` is null where all units are one code point.
    """
    matched = F.regexp_extract_all("text", F.lit(rf"(?s)(?:{unit}){{1,{run}}}+"), F.lit(0))
    runs = rows.select("key", "doc_id", F.posexplode(matched).alias("run", "of"))
    if unit == UNIT:
        counted = runs.select("key", "doc_id", "run", F.length("of").alias("units"), F.length("of").alias("chars"), F.lit(None).cast("array<int>").alias("lengths"))
    else:
        lengths = F.transform(F.regexp_extract_all("of", F.lit(f"(?s){unit}"), F.lit(0)), F.length)
        counted = runs.select("key", "doc_id", "run", F.size(lengths).alias("units"), F.length("of").alias("chars"), lengths.alias("lengths"))
    return counted.distinct()  # rows that repeat whole, dropped in each task before they move


def placed_runs(runs: DataFrame) -> DataFrame:
    """``runs`` and the units and code points before each, and in the whole document."""
    each = Window.partitionBy("key")
    before = each.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("units", "chars")}
    return runs.withColumns({**sums, "of_document": F.sum("units").over(each)})


def cut_requests(placed: DataFrame, seed: int = SEED) -> DataFrame:
    """``key, n, which, cut``: after how many units to cut each document."""
    n = placed.where("run = 0").select("key", "doc_id", F.col("of_document").alias("n"))
    h1, h2, _, _ = numbers(seed)
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    cuts = F.array(F.struct(F.lit("first").alias("which"), F.least(a, b).alias("cut")), F.struct(F.lit("second").alias("which"), F.greatest(a, b).alias("cut")))
    return n.select("key", "n", F.inline(cuts))


def offsets(rows: DataFrame, unit: str = UNIT, run: int = RUN, seed: int = SEED) -> DataFrame:
    """``key, n, first, second``: units of each document with any, and where to cut it, in code points."""
    placed = checkpointed(placed_runs(runs_of_units(rows, unit, run)))
    asked = cut_requests(placed, seed).withColumn("run", F.floor((F.greatest("cut", F.lit(1)) - 1) / run).cast("int"))
    met = asked.join(placed, ["key", "run"])
    inside = (F.col("cut") - F.col("units_before")).cast("int")
    some = F.aggregate(F.slice("lengths", F.lit(1), inside), F.lit(0), lambda total, x: total + x)
    at = F.col("chars_before") + F.when(F.col("lengths").isNull(), inside).otherwise(some)
    return met.groupBy("key").agg(
        F.max("n").alias("n"), F.max(F.when(F.col("which") == "first", at)).alias("first"), F.max(F.when(F.col("which") == "second", at)).alias("second")
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. No text holds a marker, so each marker's first place is its own."""
    p, s, m = (F.instr(output, marker) for marker in MARKERS)
    between = lambda start, end: F.substring(output, start + 3, end - start - 3)
    middle = F.substring(output, m + 3, F.length(output))
    return F.when(form == "psm", F.concat(between(p, s), middle, between(s, m))).when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = UNIT, run: int = RUN, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW
) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output`` of every row."""
    rows = keyed(docs, id_col, text_col)
    met = rows.join(offsets(rows, unit, run, seed), "key", "left")
    _, _, h3, h4 = numbers(seed)
    stays = F.col("n").isNull() | (h3 % 100 >= plain_from)
    for marker in MARKERS:
        stays = stays | F.contains(F.col("text"), F.lit(marker))
    form = F.when(stays, "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm")
    moved = F.col("form") != "plain"
    first, second = F.col("first").cast("int"), F.col("second").cast("int")
    met = met.select("doc_id", "text", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"), form.alias("form"), first.alias("first"), second.alias("second"))
    prefix, middle, suffix = F.substring("text", F.lit(1), first), F.substring("text", first + 1, second - first), F.substring("text", second + 1, F.length("text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return met.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.when(moved, first.cast("long")).alias("prefix_chars"),
        F.when(moved, (second - first).cast("long")).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")).alias("output"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
hs AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
    ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS e
  FROM d
),
f AS (
  SELECT doc_id, text, n, least(a, b) AS i, greatest(a, b) AS j,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
      WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hs
),
parts AS (SELECT *, text[1:i] AS p, text[i + 1:j] AS m, text[j + 1:n] AS s FROM f),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
  FROM parts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN i END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN j - i END::BIGINT AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 1) || regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 3) || regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 2)
    ELSE regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 2) || regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 3) || regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 1)
  END) AS restored_sha256
FROM made
"""
