"""A quality classifier that learns from preferences (Bradley-Terry).

Each preference pair holds a good and a bad document. The good one wins with probability
sigmoid(s(good) - s(bad)), where s is linear in features of the text: statistics, and how often its
words and the three-byte runs of its lower-cased text fall into each of ``BUCKETS`` buckets of a
hash. The weights minimise the mean logistic loss on the feature differences of all pairs of a good and a
bad labelled document, with a small ridge. No document and no pair is drawn: features are sums over rows on
the cluster, and what a row meets in all its pairs is a function of its s alone, tabulated over the scores of
the other kind (see ``all_pairs``). A document is accepted if its s lies above a quantile of
the training scores, chosen on all training documents; scores are that s, shifted and scaled to
(0, 1) so that the quantile falls on ``ACCEPT``.

Defined results: a null text is an empty one and gets the score of a text without words; texts
are taken whole; repeated rows give equal rows; without labels of both kinds all scores are 0.5;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, fold, map_rows, table, text_of
from adit.llm.statistics import NAMES, statistics

ACCEPT = 0.3
FOLDS = 5
BUCKETS = 64
RIDGE = 1e-3
DAMPING = 10  # hashed features are scaled down by this, so that their ridge is a hundred times as strong
CELL = 1 / 64  # width of the grid on which scores are counted; cubics between its places are off by less than 1e-9
NODES = 128  # places between which the curvature is linear
_ONE = 1 << 24  # what a row counts in the histogram
_AT_ONCE, _ROWS, _GROUPS, _IN_TASK = 10_000, 2048, 64, 25_000


def hashed(text: str) -> np.ndarray:
    """Roots of the shares of the text's words, and of its three-byte runs, in each bucket."""
    words = text.split()
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    runs = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2_654_435_761) >> np.uint32(16)
    of_words = np.bincount(np.fromiter(map(crc32, map(str.encode, words)), np.int64, len(words)) % BUCKETS, minlength=BUCKETS)
    of_runs = np.bincount(runs % BUCKETS, minlength=BUCKETS)
    return np.sqrt(np.concatenate([of_words / max(1, len(words)), of_runs / max(1, len(runs))]))


def features(texts: list[str]) -> np.ndarray:
    """A row for each text, in four-byte floats, as rows are stored."""
    rows = np.array(list(map(statistics, texts)), dtype=np.int64).reshape(-1, len(NAMES))
    return np.column_stack([of_statistics(rows), np.array(list(map(hashed, texts))).reshape(-1, 2 * BUCKETS)]).astype(np.float32)


def of_statistics(rows: np.ndarray) -> np.ndarray:
    """Features of statistics (columns as in ``NAMES``)."""
    s = dict(zip(NAMES, rows.astype(float).T, strict=True))
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    share = lambda x, of: np.log1p(50 * x / of)
    columns = [
        share(s["n_symbols"], words),
        share(s["n_dup_lines"], lines),
        share(s["n_repeat_words"], words),
        share(s["n_equal_next"], words),
        share(s["n_upper"], chars),
        share(s["n_marks"], words),
        share(s["n_digits"], chars),
        share(s["n_same_end"], words),
        s["n_distinct"] / words,
        np.log(words),
        np.log1p(chars / words),
        np.log1p(words / lines),
    ]
    rates = [s[k] / words > 0.15 for k in ("n_symbols", "n_repeat_words", "n_equal_next", "n_marks", "n_same_end")]
    return np.column_stack(columns + [x.astype(float) for x in rates + [s["n_upper"] / chars > 0.2, s["n_words"] < 20]])


@dataclass
class Ranking:
    """A fitted model: s(x) = weights . (x - mean) / spread; scores put ``cut`` on ACCEPT."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread

    def s(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score_of(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid((self.s(x) - self.cut) / self.scale + np.log(ACCEPT / (1 - ACCEPT)))

    def score(self, texts: list[str]) -> np.ndarray:
        return self.score_of(features(texts))


def preferences(label: np.ndarray, pairs: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The good and the bad document of each pair, drawn alike."""
    rng = np.random.default_rng(seed)
    return rng.choice(np.flatnonzero(label == 1), pairs), rng.choice(np.flatnonzero(label == 0), pairs)


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w (x_better - x_worse))) and ridge |w|^2 / 2: Newton's method."""
    w, n = np.zeros(x.shape[1]), len(better)
    for _ in range(25):
        slope, bend = -ridge * w, ridge * np.eye(len(w))
        for k in range(0, n, _AT_ONCE):  # the differences of all pairs are never held at once
            d = x[better[k : k + _AT_ONCE]] - x[worse[k : k + _AT_ONCE]]
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            slope += d.T @ (1 - p) / n
            bend += (d * (p * (1 - p))[:, None]).T @ d / n
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, label: np.ndarray, pairs: int | None = None, damped: int = 2 * BUCKETS) -> Ranking | None:
    """Fit on features (the last ``damped`` of them damped) and labels that lie in memory, on all pairs or
    on ``pairs`` drawn ones; None without labels of both kinds. ``learn`` does this on the cluster."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    spread[len(spread) - damped :] *= DAMPING
    x = (x - mean) / spread
    w = bradley_terry(x, *(preferences(label, pairs) if pairs else map(np.ravel, np.meshgrid(good, bad))))
    s = x @ w
    # the quantile at which accepting what lies above it is right most often, both kinds weighing alike
    order = np.argsort(s, kind="stable")
    bad_below = np.cumsum(label[order] == 0) / len(bad)
    good_below = np.cumsum(label[order] == 1) / len(good)
    at = int(np.argmax(bad_below - good_below))
    cut = float(s[order[at]] + s[order[min(at + 1, len(s) - 1)]]) / 2
    return Ranking(mean, spread, w, cut, max(float(s.std()) / 2, 1e-6))


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, hash, x`` for every row: the hash of its text and its features, four bytes each."""
    make = lambda: lambda c: [c[0], c[1], [x.tobytes() for x in features(c[2])]]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("hash"), text_of(text_col).alias("text"))
    return map_rows(rows, "doc_id long, hash long, x binary", make)


def labelled(rows: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``label, x`` of every document with a label (0 or 1); of several texts under one id the one with the least hash counts."""
    marks = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    one = rows.join(marks, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("hash", "x")).alias("least"))
    return one.select("label", F.col("least.x").alias("x"))


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part.column(0).to_numpy(), np.frombuffer(b"".join(part.column(1).to_pylist()), np.float32).reshape(part.num_rows, -1)


def total(rows: DataFrame, work: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``work(label, x)``, one array, over all of ``rows``; None without rows.

    Tasks add up their rows, then groups of tasks their sums, in a fixed order.
    """

    def run(batches):
        found = None
        for label, x in _parts(batches):
            found = work(label, x) if found is None else found + work(label, x)
        if found is not None:
            yield _summed(TaskContext.get().partitionId(), found)

    def add(sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("task")
        return pa.Table.from_batches([_summed(sums["task"][0].as_py(), sum(map(np.frombuffer, sums["sum"].to_pylist())))])

    sums = rows.select("label", "x").mapInArrow(run, "task long, sum binary")
    if rows.rdd.getNumPartitions() > _GROUPS:
        sums = sums.groupBy(F.col("task") % _GROUPS).applyInArrow(add, "task long, sum binary")
    sums = sums.toArrow().sort_by("task")["sum"].to_pylist()
    return sum(map(np.frombuffer, sums)) if sums else None


def _summed(task: int, found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([found.astype(float).tobytes()], pa.binary())], names=["task", "sum"])


def histogram(rows: DataFrame, model: Ranking) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By label: cells of the grid, ascending, and the share of the rows there. A row counts at the four
    places around its s; sums are of whole numbers, so they do not hang on their order."""

    def run(batches):
        for label, x in _parts(batches):
            first, parts = _cubic(model.s(x))
            parts = np.rint(parts * _ONE).astype(np.int64)
            parts[:, 1] += _ONE - parts.sum(1)
            key, which = np.unique((first[:, None] + np.arange(4)) * 2 + label[:, None], return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, which.ravel(), parts.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    found = rows.select("label", "x").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")
    key, n = np.array(found["key"]), np.array(found["n"], float)
    return {y: (key[key % 2 == y] // 2, n[key % 2 == y] / n[key % 2 == y].sum()) for y in (0, 1)}


def _cubic(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the four cells around each s, and the weights of a cubic through them at s."""
    low = np.floor(s / CELL)
    t = s / CELL - low
    parts = [-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6]
    return low.astype(np.int64) - 1, np.column_stack(parts)


def _at(s: np.ndarray, cells: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The cubics through ``values`` at s; all four cells around each s are among ``cells``."""
    first, parts = _cubic(s)
    return (values[np.searchsorted(cells, first)[:, None] + np.arange(4)] * parts).sum(1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _hats(s: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each s how it lies between the nodes: a row of shares, at most two of them not zero."""
    at = np.clip(np.searchsorted(nodes, s, "right") - 1, 0, len(nodes) - 2)
    part = (s - nodes[at]) / (nodes[at + 1] - nodes[at])
    found, each = np.zeros((len(s), len(nodes))), np.arange(len(s))
    found[each, at], found[each, at + 1] = 1 - part, part
    return found


def all_pairs(rows: DataFrame, model: Ranking, n: tuple[float, float], ridge: float) -> np.ndarray:
    """Newton's step for the mean over all pairs of a good and a bad row.

    A row's share in the slope is the mean, over all rows of the other kind, of the probability that the bad
    one wins: a function of its s, tabulated over the histogram of the others. The bend sums
    p (1 - p) (x_good - x_bad)(x_good - x_bad)^T over all pairs, with p (1 - p) tabulated at ``NODES``
    scores, linear between them; that steers the steps only, not where they end.
    """
    found = histogram(rows, model)
    (bad_cells, of_bad), (good_cells, of_good) = found[0], found[1]
    bad, good = bad_cells * CELL, good_cells * CELL
    worse, better = np.zeros(len(bad)), np.zeros(len(good))
    for k in range(0, len(bad), 256):
        p = _sigmoid(bad[k : k + 256, None] - good)
        worse[k : k + 256] = p @ of_good
        better += of_bad[k : k + 256] @ p
    places = np.unique(np.concatenate([bad, good]))
    share = np.interp(places, bad, np.cumsum(of_bad * worse)) + np.interp(places, good, np.cumsum(of_good * better))
    mass = np.maximum.accumulate(share / share[-1]) + (places - places[0]) / (places[-1] - places[0])  # where the slope comes from, and evenly
    nodes = np.unique(np.append(places[np.searchsorted(mass, np.linspace(mass[0], mass[-1], NODES)).clip(0, len(places) - 1)], places[[0, -1]]))
    p = _sigmoid(nodes[:, None] - nodes)
    bends = p * (1 - p)
    bend = bends @ (of_good @ _hats(good, nodes)), bends @ (of_bad @ _hats(bad, nodes))  # of a bad row, of a good row

    def work(label, x):
        z = model.standard(x)
        s, is_good = z @ model.weights, label == 1
        pull = np.zeros(len(s))
        pull[is_good], pull[~is_good] = _at(s[is_good], good_cells, better) / n[1], -_at(s[~is_good], bad_cells, worse) / n[0]
        bent = np.where(is_good, np.interp(s, nodes, bend[1]) / n[1], np.interp(s, nodes, bend[0]) / n[0])
        hats = _hats(s, nodes)
        by_node = [hats[label == y].T @ z[label == y] / n[y] for y in (0, 1)]
        return np.concatenate([pull @ z, ((z * bent[:, None]).T @ z).ravel(), *map(np.ravel, by_node)])

    size = len(model.weights)
    slope, square, *by_node = np.split(total(rows, work), np.cumsum([size, size * size, len(nodes) * size]))
    of_bad, of_good = (b.reshape(len(nodes), size) for b in by_node)
    cross = of_good.T @ bends @ of_bad
    return np.linalg.solve(square.reshape(size, size) - cross - cross.T + ridge * np.eye(size), slope - ridge * model.weights)


def best_cut(scores: DataFrame) -> float:
    """The s (of ``scores``: label, s) at which accepting what lies above is right most often, both kinds weighing alike.

    Running counts are taken in cells of the grid; only cells in which the best may lie are opened.
    """
    counts = [F.sum((F.col("label") == y).cast("long")).alias(name) for y, name in ((0, "bad"), (1, "good"))]
    each = scores.withColumn("cell", F.floor(F.col("s") / CELL)).groupBy("cell", "s").agg(*counts)
    cells = each.groupBy("cell").agg(F.min("s").alias("least"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow().sort_by("cell")
    bad, good, least = (np.array(cells[c]) for c in ("bad", "good", "least"))
    bads, goods = int(bad.sum()), int(good.sum())
    gain = [b * goods - g * bads for b, g in zip(np.cumsum(bad).tolist(), np.cumsum(good).tolist(), strict=True)]  # whole numbers of any size
    before = [0, *gain[:-1]]
    open_ = [k for k, b in enumerate(bad.tolist()) if before[k] + b * goods >= max(gain)]
    after = [*least.tolist()[1:], None]
    known = [(cells["cell"][k].as_py(), before[k] / bads / goods, after[k]) for k in open_]
    known = scores.sparkSession.createDataFrame(known, "cell long, before double, after double")
    order = Window.partitionBy("cell").orderBy("s")
    below = lambda c: F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0))
    right = F.col("before") + below("bad") / bads - below("good") / goods
    found = each.join(F.broadcast(known), "cell").select("s", right.alias("right"), F.coalesce(F.lead("s").over(order), "after", "s").alias("next"))
    best = found.orderBy(F.desc(F.round("right", 12)), "s").first()
    return (best["s"] + best["next"]) / 2


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking | None:
    """Fit on every labelled document."""
    return learn_from(vectors(docs), labels, label)


def learn_from(vectors: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = RIDGE) -> Ranking | None:
    """Fit on every labelled row of ``vectors``, all pairs of a good and a bad one; only sums come to the driver."""
    rows = checkpointed(labelled(vectors, labels, label))
    found = total(rows, lambda label, x: np.concatenate([[len(label), label.sum()], x.sum(0, float)]))
    if found is None or not 0 < found[1] < found[0]:
        return None
    n, mean = (found[0] - found[1], found[1]), found[2:] / found[0]
    rows = rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, int(found[0]) // _IN_TASK))  # few tasks for few rows: every step reads them
    spread = np.maximum(np.sqrt(total(rows, lambda _, x: ((x - mean) ** 2).sum(0)) / found[0]), 1e-6)
    spread[-2 * BUCKETS :] *= DAMPING
    model = Ranking(mean, spread, np.zeros(len(mean)), 0.0, 1.0)
    for _ in range(25):
        step = all_pairs(rows, model, n, ridge)
        model = replace(model, weights=model.weights + step)
        if np.abs(step).max() < 1e-6:
            break

    def scoring(batches):
        for label, x in _parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(model.s(x))], names=["label", "s"])

    scores = checkpointed(rows.select("label", "x").mapInArrow(scoring, "label int, s double"))
    deviation = scores.agg(F.stddev_pop("s")).first()[0]
    return replace(model, cut=best_cut(scores), scale=max(deviation / 2, 1e-6))


def scored_vectors(vectors: DataFrame, model: Ranking | None) -> DataFrame:
    """``doc_id, score`` for every row of ``vectors``."""

    def run(batches):
        for ids, x in _parts(batches):
            scores = np.full(len(ids), 0.5) if model is None else model.score_of(x)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(scores)], names=["doc_id", "score"])

    return vectors.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def scored(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""

    def make():
        def work(columns):
            return [columns[0], [0.5] * len(columns[0]) if model is None else model.score(columns[1]).tolist()]

        return work

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), "doc_id long, score double", make)


def accepted(docs: DataFrame, model: Ranking | None, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``accept``, with all their columns, unshuffled."""
    if model is None:
        return docs

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                parts = [batch.column(text_col).slice(k, 256).to_pylist() for k in range(0, batch.num_rows, 256)]
                scores = np.concatenate([model.score([t or "" for t in part]) for part in parts])
                yield batch.filter(pa.array(scores >= accept))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(fold("doc_id", FOLDS) != 0)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = checkpointed(vectors(docs))  # made once, to learn from and to score
    return scored_vectors(known, learn_from(known, training_labels(table(spark, sf_dir, "labels")))).select(
        "doc_id",
        (fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
