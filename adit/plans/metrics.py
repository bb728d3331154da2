"""Metric queries on a long frame of samples (labels, ts, value), as DataFrame plans.

Rates and increases follow the rule without extrapolation: the sum of rises between samples in
the window, a fall counting as a reset to zero. Every function takes the label columns, so that
windows and joins are partitioned by series, never by time alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.functions.scalar import bucket
from adit.plans import Registry
from adit.sources import binding

R = Registry()
SERIES = ["job", "pod"]


def seconds(ts: Column | str = "ts") -> Column:
    """Seconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col(ts) if isinstance(ts, str) else ts)


def rises(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Each sample with ``rise``, how much its counter grew since the one before; 0 for the first."""
    before = F.lag("value").over(W.partitionBy(*labels).orderBy("ts"))
    rise = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return samples.withColumn("rise", rise)


def over_range(labels: list[str], window_s: int):
    """The window of the last ``window_s`` seconds of a series, its left end open."""
    return W.partitionBy(*labels).orderBy(seconds()).rangeBetween(-window_s + 1, 0)


def increase(samples: DataFrame, labels: list[str], window_s: int) -> DataFrame:
    return rises(samples, labels).withColumn("value", F.sum("rise").over(over_range(labels, window_s))).drop("rise")


def rate(samples: DataFrame, labels: list[str], window_s: int) -> DataFrame:
    return increase(samples, labels, window_s).withColumn("value", F.col("value") / window_s)


def delta(samples: DataFrame, labels: list[str], window_s: int) -> DataFrame:
    w = over_range(labels, window_s)
    return samples.withColumn("value", F.last("value").over(w) - F.first("value").over(w))


def changes(samples: DataFrame, labels: list[str], window_s: int) -> DataFrame:
    before = F.lag("value").over(W.partitionBy(*labels).orderBy("ts"))
    changed = samples.withColumn("_c", F.when(before.isNotNull() & (before != F.col("value")), 1).otherwise(0))
    return changed.withColumn("value", F.sum("_c").over(over_range(labels, window_s)).cast("double")).drop("_c")


def offset(samples: DataFrame, by_s: int) -> DataFrame:
    """The samples as they were ``by_s`` seconds ago."""
    return samples.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(by_s).cast("decimal(18,6)")))


def by(samples: DataFrame, labels: list[str], how=F.sum) -> DataFrame:
    return samples.groupBy("ts", *labels).agg(how("value").alias("value"))


def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``value`` and ``other`` of samples with equal labels at one time."""
    return left.join(right.select("ts", *on, F.col("value").alias("other")), ["ts", *on])


def either(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left samples, and right ones that no left one matches."""
    return left.unionByName(right.join(left.select("ts", *on).distinct(), ["ts", *on], "left_anti"))


def unless(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select("ts", *on).distinct(), ["ts", *on], "left_anti")


def topk(samples: DataFrame, k: int, tie: list[str]) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("ts").orderBy(F.desc("value"), *tie))
    return samples.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def histogram_quantile(q: float, buckets: DataFrame, labels: list[str]) -> DataFrame:
    """Quantile from cumulative buckets (le: upper bound, infinity last), linear inside a bucket."""
    w = W.partitionBy(*labels).orderBy("le")
    rows = buckets.withColumns({"_n": F.max("value").over(W.partitionBy(*labels)), "_lo": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "_below": F.coalesce(F.lag("value").over(w), F.lit(0.0))})
    rank = F.lit(q) * F.col("_n")
    hit = rows.where((F.col("value") >= rank) & (F.col("_n") > 0))
    inside = F.col("_lo") + (F.col("le") - F.col("_lo")) * (rank - F.col("_below")) / (F.col("value") - F.col("_below"))
    value = F.when(F.col("le") == float("inf"), F.col("_lo")).otherwise(inside)
    return hit.groupBy(*labels).agg(F.min_by(value, "le").alias("value"))


def alert_for(condition: DataFrame, labels: list[str], for_s: int) -> DataFrame:
    """State of an alert at each evaluation: inactive, pending, or firing once it held ``for_s`` seconds.

    ``condition`` has ``ts`` and ``holds``; runs of true evaluations are islands between false ones.
    """
    series = W.partitionBy(*labels).orderBy("ts")
    island = F.sum(F.when(~F.col("holds"), 1).otherwise(0)).over(series.rowsBetween(W.unboundedPreceding, 0))
    rows = condition.withColumn("_i", island)
    since = F.min(F.when(F.col("holds"), seconds())).over(W.partitionBy(*labels, "_i"))
    state = F.when(~F.col("holds"), "inactive").when(seconds() - since >= for_s, "firing").otherwise("pending")
    return rows.withColumn("state", state).drop("_i")


def keep(samples: DataFrame, label: str, pattern: str, negate: bool = False) -> DataFrame:
    """Samples whose label matches the whole pattern (or does not)."""
    hit = F.coalesce(F.col(label), F.lit("")).rlike(f"^(?:{pattern})$")
    return samples.where(~hit if negate else hit)


def relabel(samples: DataFrame, source: list[str], pattern: str, target: str, replacement: str, separator: str = ";") -> DataFrame:
    """Set a label from others where they match the whole pattern; ``$1`` names a group."""
    joined = F.concat_ws(separator, *[F.coalesce(F.col(c), F.lit("")) for c in source])
    new = F.when(joined.rlike(f"^(?:{pattern})$"), F.regexp_replace(joined, f"^(?:{pattern})$", replacement))
    return samples.withColumn(target, F.coalesce(new, F.col(target) if target in samples.columns else F.lit(None).cast("string")))


def log_filter(logs: DataFrame, message: str, words: list[str], **fields: list[str]) -> DataFrame:
    """Logs with any of the words (without case, as words of their own) and field values in the lists."""
    out = logs.where(F.lower(F.col(message)).rlike("(?:^|\\W)(?:" + "|".join(w.lower() for w in words) + ")(?:\\W|$)"))
    for name, values in fields.items():
        out = out.where(F.col(name).isin(*values))
    return out


_RISES = "r AS (SELECT *, CASE WHEN lag(value) OVER s IS NULL THEN 0 WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS rise FROM metrics WINDOW s AS (PARTITION BY job, pod ORDER BY ts))"
_WINDOW = "OVER (PARTITION BY job, pod ORDER BY epoch(ts)::BIGINT RANGE BETWEEN {} PRECEDING AND CURRENT ROW)"
_INC = f"i AS (SELECT job, pod, ts, sum(rise) {_WINDOW.format(6 * 3600 - 1)} AS value FROM r)"


def m(spark, d) -> DataFrame:
    return binding.metrics(spark, d)


@R.add("pq_increase", f"WITH {_RISES}, {_INC} SELECT job, pod, ts, value FROM i")
def pq_increase(spark, d):
    return increase(m(spark, d), SERIES, 6 * 3600)


@R.add("pq_rate", f"WITH {_RISES}, {_INC} SELECT job, pod, ts, round(value / 21600, 9) AS value FROM i")
def pq_rate(spark, d):
    return rate(m(spark, d), SERIES, 6 * 3600).withColumn("value", F.round("value", 9))


@R.add("pq_delta", f"SELECT job, pod, ts, last(value) {_WINDOW.format(3 * 3600 - 1)} - first(value) {_WINDOW.format(3 * 3600 - 1)} AS value FROM metrics")
def pq_delta(spark, d):
    return delta(m(spark, d), SERIES, 3 * 3600)


@R.add("pq_changes", f"SELECT job, pod, ts, sum(c) {_WINDOW.format(6 * 3600 - 1)}::DOUBLE AS value FROM (SELECT *, CASE WHEN lag(value) OVER (PARTITION BY job, pod ORDER BY ts) <> value THEN 1 ELSE 0 END AS c FROM metrics)")
def pq_changes(spark, d):
    return changes(m(spark, d), SERIES, 6 * 3600)


for _name, _how, _sql in (("sum", F.sum, "sum"), ("max", F.max, "max"), ("min", F.min, "min"), ("count", F.count, "count"), ("avg", F.avg, "avg")):

    @R.add(f"pq_{_name}_by", f"SELECT ts, job, round({_sql}(value)::DOUBLE, 6) AS value FROM metrics GROUP BY 1, 2")
    def _by(spark, d, how=_how):
        return by(m(spark, d), ["job"], how).withColumn("value", F.round(F.col("value").cast("double"), 6))


@R.add("pq_clamp_min", "SELECT job, pod, ts, greatest(value, 5) AS value FROM metrics")
def pq_clamp_min(spark, d):
    return m(spark, d).withColumn("value", F.greatest("value", F.lit(5.0)))


@R.add("pq_topk", "SELECT job, pod, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY value DESC, job, pod) AS r FROM metrics) WHERE r <= 3")
def pq_topk(spark, d):
    return topk(m(spark, d), 3, SERIES)


@R.add("pq_subquery_max", f"WITH {_RISES}, i AS (SELECT job, pod, ts, sum(rise) {_WINDOW.format(2 * 3600 - 1)} AS value FROM r) SELECT job, pod, ts, max(value) {_WINDOW.format(12 * 3600 - 1)} AS value FROM i")
def pq_subquery_max(spark, d):
    inner = increase(m(spark, d), SERIES, 2 * 3600)
    return inner.withColumn("value", F.max("value").over(over_range(SERIES, 12 * 3600)))


@R.add("pq_offset", "SELECT a.job, a.pod, a.ts, a.value - b.value AS value FROM metrics a JOIN metrics b ON a.job = b.job AND a.pod = b.pod AND a.ts = b.ts + INTERVAL 1 DAY")
def pq_offset(spark, d):
    now = m(spark, d)
    return matched(now, offset(now, 86_400), SERIES).select(*SERIES, "ts", (F.col("value") - F.col("other")).alias("value"))


@R.add("pq_bool_filter", "SELECT job, pod, ts, value FROM metrics WHERE value > 8")
def pq_bool_filter(spark, d):
    return m(spark, d).where("value > 8")


@R.add("pq_and_on", "SELECT a.job, a.pod, a.ts, a.value FROM metrics a WHERE a.job = 'click' AND EXISTS (SELECT 1 FROM metrics b WHERE b.job = 'view' AND b.value > 5 AND a.pod = b.pod AND a.ts = b.ts)")
def pq_and_on(spark, d):
    s = m(spark, d)
    return s.where("job = 'click'").join(s.where("job = 'view' AND value > 5").select("ts", "pod"), ["ts", "pod"], "left_semi").select("job", "pod", "ts", "value")


@R.add("join_vector_match", "SELECT a.pod, a.ts, a.value + b.value AS value FROM metrics a JOIN metrics b ON a.job = 'click' AND b.job = 'view' AND a.pod = b.pod AND a.ts = b.ts")
def join_vector_match(spark, d):
    s = m(spark, d)
    return matched(s.where("job = 'click'"), s.where("job = 'view'"), ["pod"]).select("pod", "ts", (F.col("value") + F.col("other")).alias("value"))


@R.add("pq_or", "SELECT pod, ts, value FROM metrics WHERE job = 'click' UNION ALL SELECT pod, ts, value FROM metrics b WHERE job = 'error' AND NOT EXISTS (SELECT 1 FROM metrics a WHERE a.job = 'click' AND a.pod = b.pod AND a.ts = b.ts)")
def pq_or(spark, d):
    s = m(spark, d)
    of = lambda j: s.where(F.col("job") == j).select("pod", "ts", "value")
    return either(of("click"), of("error"), ["pod"])


@R.add("set_or_vector", "SELECT ts, sum(v) AS value FROM (SELECT ts, value AS v FROM metrics WHERE job = 'error' AND value > 6 UNION ALL SELECT DISTINCT ts, 0.0 FROM metrics) GROUP BY 1")
def set_or_vector(spark, d):
    s = m(spark, d)
    summed = by(s.where("job = 'error' AND value > 6"), [])
    return either(summed, s.select("ts").distinct().withColumn("value", F.lit(0.0)), [])


@R.add("pq_unless", "SELECT pod, ts, value FROM metrics a WHERE job = 'click' AND NOT EXISTS (SELECT 1 FROM metrics b WHERE b.job = 'error' AND a.pod = b.pod AND a.ts = b.ts)")
def pq_unless(spark, d):
    s = m(spark, d)
    return unless(s.where("job = 'click'").select("pod", "ts", "value"), s.where("job = 'error'"), ["pod"])


R.queries["set_unless"], R.sql["set_unless"] = pq_unless, R.sql["pq_unless"]


@R.add("pq_absent", "SELECT ts, 1.0::DOUBLE AS value FROM (SELECT DISTINCT ts FROM metrics) t WHERE NOT EXISTS (SELECT 1 FROM metrics a WHERE a.job = 'signup' AND a.pod = '1' AND a.ts = t.ts)")
def pq_absent(spark, d):
    s = m(spark, d)
    return unless(s.select("ts").distinct().withColumn("value", F.lit(1.0)), s.where("job = 'signup' AND pod = '1'"), [])


@R.add("pq_time_timestamp", "SELECT job, pod, (epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)))::BIGINT AS age_s FROM metrics GROUP BY 1, 2")
def pq_time(spark, d):
    return m(spark, d).groupBy(*SERIES).agg((seconds(F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00"))) - seconds(F.max("ts"))).alias("age_s"))


@R.add("pq_label_regex", "SELECT job, pod, ts, value FROM metrics WHERE regexp_full_match(job, 'cl.*|err.r') AND NOT regexp_full_match(pod, '[2-9]')")
def pq_label_regex(spark, d):
    return keep(keep(m(spark, d), "job", "cl.*|err.r"), "pod", "[2-9]", negate=True)


@R.add("pq_ratio", "WITH s AS (SELECT ts, job, sum(value) AS v FROM metrics GROUP BY 1, 2) SELECT a.ts, round(1000 * a.v / greatest(b.v, 1), 6) AS value FROM s a JOIN s b ON a.ts = b.ts AND a.job = 'error' AND b.job = 'view'")
def pq_ratio(spark, d):
    s = by(m(spark, d), ["job"])
    both = matched(s.where("job = 'error'").drop("job"), s.where("job = 'view'").drop("job"), [])
    return both.select("ts", F.round(1000 * F.col("value") / F.greatest("other", F.lit(1.0)), 6).alias("value"))


_LE = (10.0, 50.0, 100.0, 250.0)


@R.add(
    "pq_histogram_quantile",
    "WITH b AS (" + " UNION ALL ".join(f"SELECT event_type, {le}::DOUBLE AS le, count(*) FILTER (value <= {le})::DOUBLE AS value FROM events GROUP BY 1" for le in _LE)
    + " UNION ALL SELECT event_type, 'Infinity'::DOUBLE, count(*)::DOUBLE FROM events GROUP BY 1), w AS (SELECT *, max(value) OVER (PARTITION BY event_type) AS n, coalesce(lag(le) OVER o, 0) AS lo, coalesce(lag(value) OVER o, 0) AS below FROM b WINDOW o AS (PARTITION BY event_type ORDER BY le)) SELECT event_type, round(arg_min(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (0.9 * n - below) / (value - below) END, le), 6) AS value FROM w WHERE value >= 0.9 * n GROUP BY 1",
)
def pq_histogram_quantile(spark, d):
    e = binding.events(spark, d)
    bounds = F.explode(F.array(*map(F.lit, (*_LE, float("inf"))))).alias("le")
    counts = e.groupBy("event_type").agg(*[F.count_if(F.col("value") <= le).cast("double").alias(f"c{k}") for k, le in enumerate((*_LE, float("inf")))])
    rows = counts.select("*", bounds)
    value = F.coalesce(*[F.when(F.col("le") == le, F.col(f"c{k}")) for k, le in enumerate((*_LE, float("inf")))])
    return histogram_quantile(0.9, rows.select("event_type", "le", value.alias("value")), ["event_type"]).withColumn("value", F.round("value", 6))


@R.add("pq_alert_for", "WITH c AS (SELECT job, pod, ts, value > 3 AS holds FROM metrics), i AS (SELECT *, sum(CASE WHEN holds THEN 0 ELSE 1 END) OVER (PARTITION BY job, pod ORDER BY ts) AS island FROM c), s AS (SELECT *, min(CASE WHEN holds THEN ts END) OVER (PARTITION BY job, pod, island) AS since FROM i) SELECT job, pod, ts, CASE WHEN NOT holds THEN 'inactive' WHEN epoch(ts) - epoch(since) >= 7200 THEN 'firing' ELSE 'pending' END AS state FROM s")
def pq_alert_for(spark, d):
    c = m(spark, d).select(*SERIES, "ts", (F.col("value") > 3).alias("holds"))
    return alert_for(c, SERIES, 7200).select(*SERIES, "ts", "state")


@R.add("pq_relabel", "SELECT job, pod, ts, value, CASE WHEN regexp_full_match(job || ';' || pod, '(c.*);([01])') THEN regexp_replace(job || ';' || pod, '^(c.*);([01])$', '\\2-\\1') END AS instance FROM metrics")
def pq_relabel(spark, d):
    return relabel(m(spark, d), ["job", "pod"], "(c.*);([01])", "instance", "$2-$1")


@R.add("lq_filter", "SELECT page_id FROM pages WHERE regexp_matches(lower(html), '(^|\\W)(error|the|exception)(\\W|$)') AND page_id % 4 IN (1, 2)")
def lq_filter(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").withColumn("part", (F.col("page_id") % 4).cast("string"))
    return log_filter(pages, "html", ["error", "the", "exception"], part=["1", "2"]).select("page_id")


@R.add("pq_resample", "SELECT job, pod, date_trunc('day', ts) AS ts, arg_max(value, ts) AS value FROM metrics GROUP BY 1, 2, 3")
def pq_resample(spark, d):
    s = m(spark, d)
    return s.groupBy(*SERIES, bucket("day", "ts").alias("day")).agg(F.max_by("value", "ts").alias("value")).withColumnRenamed("day", "ts")
