"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are all words of a text (lower case, without the ASCII marks around them). A term weighs
(1 + ln tf) * ln((1 + N) / (1 + df)) * rf: document frequencies are counted over all documents, and
rf = log2(2 + a / max(1, c)) is the relevance frequency of the labelled examples, a and c being the
toxic and the other examples that have the term. No term of any example is left out.

The index holds the examples' terms as posting lists. Short lists are added up in full. A long
list knows its largest weight in each block of ``BLOCK`` examples; the sums of these (one matrix
product for ``TOGETHER`` texts) bound what the long lists can add anywhere in a block, and an example is opened (its own weights in the long lists
are read) only if short sum plus block bound reaches the worst of as many examples as are wanted. So the
``NEIGHBOURS`` nearest examples are exact. They vote with their cosine; votes are turned into
probabilities by isotonic regression on the examples, each scored without itself, equal votes
pooled.

Texts are split once: the counts of each text's terms are stored; frequencies and scores come from these.

Fitting reads at most ``LABELLED`` labelled documents, by hash of the id: index and vocabulary are
bounded by their texts. Of examples with equal text and label one stays, as copies are no evidence.

Defined results: a text without known terms (so null and empty ones) has no neighbours and gets the
share of toxic examples among those without terms, or among all where there are none such; texts
are taken whole; repeated rows give equal rows; of several texts under one labelled id the least
counts; without labels of both kinds all scores are 0; an empty table gives an empty result; ties
of cosine go to the example that comes first in the index.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, fold, map_rows, table, text_of
from adit.llm.statistics import labelled_sample

LABELLED = 20_000
NEIGHBOURS = 15
BLOCK = 4
LONG = 1 / 10  # a list is long if this share of the examples has the term
FIRST = 8  # times as many examples as are wanted, opened to find the least cosine that counts
TOGETHER = 64  # texts that are bounded at once
ACCEPT = 0.3
FOLDS, HELD = 4, 2
_MARKS = ".,;:!?\"'()[]{}#*$%&|<>/\\-_=+~`"


def distinct_terms(text: str) -> set[str]:
    """The words of the text, without the marks around them."""
    found = set(map(str.strip, set(text.lower().split()), repeat(_MARKS)))
    found.discard("")
    return found


def relevance(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Relevance frequency of terms, from the numbers of toxic and of other examples that have them."""
    return np.log2(2 + toxic / np.maximum(1, other))


class Terms:
    """The terms in the order of their numbers; the dictionary is made only where texts are read."""

    def __init__(self, terms: pa.Array):
        self.terms = terms

    @cached_property
    def number(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    @cached_property
    def of_word(self) -> "Numbers":
        return Numbers(self.number)

    def __getstate__(self):  # dictionaries are made in the workers
        return {"terms": self.terms}


class Numbers(dict):
    """The number of the term that a word (with its marks) stands for, -1 without one; found once for each
    word met, and of bounded size."""

    def __init__(self, number: dict[str, int], most: int = 200_000):
        self.number, self.most = number, most

    def __missing__(self, word: str) -> int:
        found = self.number.get(word.strip(_MARKS), -1)
        if len(self) < self.most:
            self[word] = found
        return found


def counts(text: str, of_word: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the text's terms, ascending, and how often each stands in it."""
    words = text.lower().split()
    every = np.fromiter(map(of_word.__getitem__, words), np.int32, len(words))
    every.sort()
    every = every[np.searchsorted(every, 0) :]
    first = np.flatnonzero(np.diff(every, prepend=-1))
    return every[first], np.diff(first, append=len(every))


class Weights:
    """The terms' numbers and weights; makes vectors of texts."""

    def __init__(self, terms: Terms | dict[str, int], weight: np.ndarray):
        self.terms, self.weight = terms, weight

    @property
    def of_word(self) -> Numbers:
        return Numbers(self.terms) if isinstance(self.terms, dict) else self.terms.of_word

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, ascending, and weights of length 1."""
        return self.of_counts(*counts(text, self.of_word))

    def of_stored(self, t: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The vector of the text whose counts are stored."""
        numbers = np.frombuffer(t, np.int32)
        return self.of_counts(numbers, np.frombuffer(n, f"u{len(n) // len(numbers)}" if len(numbers) else "u1"))

    def of_counts(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n, dtype=float)) * self.weight[t]
        t, w = t[w > 0], w[w > 0]
        return t, (w / max(np.sqrt((w**2).sum()), 1e-12)).astype(np.float32)


class Index:
    """Examples, sorted so that alike ones share blocks, under their terms."""

    def __init__(self, terms, weight, vectors, labels, ids, empty_score: float = 0.0):
        self.weights = Weights(terms, np.asarray(weight))
        self.labels, self.ids, self.empty_score = np.asarray(labels, float), np.asarray(ids), empty_score
        self.steps = (np.zeros(1), np.zeros(1))
        n, size = len(vectors), len(self.weights.weight)
        self.n, self.blocks = n, (n + BLOCK - 1) // BLOCK
        term = np.concatenate([np.zeros(0, np.int32), *[t for t, _ in vectors]]).astype(np.int32, copy=False)
        order = np.argsort(term, kind="stable")
        sizes = np.bincount(term, minlength=size)
        #: where each term's list begins in ``examples`` and ``values``
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int32)
        self.examples = np.repeat(np.arange(n, dtype=np.min_scalar_type(n)), [len(t) for t, _ in vectors])[order]
        self.values = np.concatenate([np.zeros(0, np.float32), *[w for _, w in vectors]]).astype(np.float32, copy=False)[order]
        long = np.flatnonzero(sizes > max(1, n * LONG))
        #: the number of each term's long list, or -1
        self.long = np.full(size, -1, np.int32)
        self.long[long] = np.arange(len(long))

    @cached_property
    def lists(self) -> np.ndarray:
        """The long lists as a matrix: a row for each example, blocks filled up."""
        long = np.flatnonzero(self.long >= 0)
        lists = np.zeros((self.blocks * BLOCK, len(long)), np.float32)
        for at, t in enumerate(long):
            one = slice(self.first[t], self.first[t + 1])
            lists[self.examples[one], at] = self.values[one]
        return lists

    @cached_property
    def postings(self) -> np.ndarray:
        """Example and value of each posting, side by side in eight bytes."""
        both = np.empty((len(self.examples), 2), np.int32)
        both[:, 0], both[:, 1] = self.examples, self.values.view(np.int32)
        return both.view(np.int64)[:, 0]

    @cached_property
    def pieces(self) -> memoryview:
        """The postings, to be cut and joined as bytes: for hundreds of short lists faster than as arrays."""
        return memoryview(self.postings)

    @cached_property
    def highest(self) -> np.ndarray:
        """By long list and block, the largest value."""
        return np.ascontiguousarray(self.lists.reshape(self.blocks, BLOCK, self.lists.shape[1]).max(1).T)

    def shared(self, spark: SparkSession):
        """The terms and the rest as broadcast variables, made once."""
        if not hasattr(self, "_shared"):
            self._shared = spark.sparkContext.broadcast(self.weights.terms), spark.sparkContext.broadcast(self)
        return self._shared

    def __getstate__(self):  # terms go apart
        return {k: v for k, v in self.__dict__.items() if k not in ("_shared", "lists", "postings", "pieces", "highest")} | {"weights": Weights({}, self.weights.weight)}

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> list[tuple[float, int]]:
        """The k nearest examples as (cosine, position), nearest first, ties by position.

        Only examples that share a term with the query count.
        """
        return next(self.nearest_of([(t, w)], k, [without]))

    def nearest_of(self, queries: list[tuple], k: int = NEIGHBOURS, without: Iterable[int] = repeat(-1)) -> Iterator[list[tuple[float, int]]]:
        """``nearest`` for each query; long lists are bounded for ``TOGETHER`` queries at once."""
        without = iter(without)
        for start in range(0, len(queries), TOGETHER):
            part = queries[start : start + TOGETHER]
            weights = np.zeros((len(part), self.lists.shape[1]), np.float32)
            for row, (t, w) in zip(weights, part, strict=True):
                at = self.long[t]
                row[at[at >= 0]] = w[at >= 0]
            bounds = (weights @ self.highest) * np.float32(1 + 1e-5) + np.float32(1e-6)  # rounding never hides a neighbour
            for query, own, bound in zip(part, weights, bounds, strict=True):
                yield self._nearest(*query, own, bound, k, next(without))

    def _nearest(self, t: np.ndarray, w: np.ndarray, query: np.ndarray, bound: np.ndarray, k: int, without: int) -> list[tuple[float, int]]:
        """``query``: the weights in the long lists; ``bound``: what these can add, by block."""
        if not len(t) or not self.n:
            return []
        starts, ends = self.first[t], self.first[t + 1]
        some = (ends > starts) & (self.long[t] < 0)
        sizes = (ends - starts)[some]
        found = np.frombuffer(b"".join(map(self.pieces.__getitem__, map(slice, starts[some].tolist(), ends[some].tolist()))), np.int32)
        sums = np.bincount(found[::2], found[1::2].view(np.float32) * np.repeat(w[some], sizes), self.n)
        most = sums + np.repeat(bound, BLOCK)[: self.n]
        if without >= 0:
            most[without] = 0
        # any examples give a worst cosine that counts; those that can be nearest give a high one
        first = np.flatnonzero(most > most.max() / 2) if self.n > FIRST * k else np.arange(self.n)
        if len(first) <= 2 * k and self.n > FIRST * k:
            first = np.arange(self.n)
        if len(first) > FIRST * k:
            first = first[np.argpartition(most[first], len(first) - FIRST * k)[-FIRST * k :]]
        first = first[first != without]
        worst = np.sort(sums[first] + self.lists[first] @ query)[-k] if len(first) > k else 0.0
        live = np.flatnonzero(most >= worst - 1e-6)  # the others stay closed
        if without >= 0:
            live = live[live != without]
        cosines = sums[live] + self.lists[live] @ query
        best = np.lexsort((live, -np.round(cosines, 7)))[:k]
        return [(float(cosines[i]), int(live[i])) for i in best if cosines[i] > 1e-7]

    def vote(self, near: list[tuple[float, int]]) -> float:
        total = sum(c for c, _ in near)
        return sum(c * self.labels[j] for c, j in near) / total if total else self.empty_score

    def scores(self, vectors: list[tuple], steps: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, list[int]]]:
        """For each vector the score calibrated by ``steps`` and the ids of the nearest examples."""
        for near in self.nearest_of(vectors):
            if near:
                yield float(np.interp(self.vote(near), *steps)), [int(self.ids[j]) for _, j in near[:3]]
            else:
                yield self.empty_score, []


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the increasing function nearest to y at x, between which it is linear: equal x are
    one point, then adjacent violators are pooled, each pool being one point at its mean x."""
    at, which = np.unique(x, return_inverse=True)
    size = np.bincount(which, minlength=len(at))
    mean = np.bincount(which, y, len(at)) / np.maximum(size, 1)
    pools: list[list[float]] = []  # mean of y, weight, mean of x
    for a, b, n in zip(at.tolist(), mean.tolist(), size.tolist(), strict=True):
        pools.append([b, n, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            s, n, a = pools.pop()
            p = pools[-1]
            both = p[1] + n
            p[0], p[1], p[2] = (p[0] * p[1] + s * n) / both, both, (p[2] * p[1] + a * n) / both
    return np.array([a for _, _, a in pools]), np.array([s for s, _, _ in pools])


def examples(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, label, text``: the labelled sample, each text once for each label."""
    sample = labelled_sample(docs, labels, label, most).select("doc_id", F.col("label").cast("int").alias("label"), text_of("text").alias("text"))
    once = sample.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.col("label").alias("as")).agg(F.min_by(F.struct("doc_id"), F.struct("doc_id")).alias("first"))
    once = once.select("as", F.col("first.doc_id").alias("id"))  # an id has one text here
    return sample.join(F.broadcast(once), (F.col("doc_id") == F.col("id")) & (F.col("label") == F.col("as"))).select("doc_id", "label", "text")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = LABELLED) -> Index | None:
    """Fit on at most ``most`` labelled documents; document frequencies over all of ``docs``."""
    return learn_and_count(docs, labels, label, most)[0]


def learn_and_count(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = LABELLED) -> tuple[Index | None, DataFrame | None]:
    """As ``learn``; with the index the stored counts of all ``docs``, which ``scored_counts`` takes."""
    context = docs.sparkSession.sparkContext
    rows = checkpointed(examples(docs, labels, label, most))  # at most ``most`` texts
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return None, None

    def counting():
        def work(columns):
            n = (Counter(), Counter())
            for text, y in zip(*columns, strict=True):
                n[y].update(distinct_terms(text))
            found = list(n[0] | n[1])
            return [found, [n[0][t] for t in found], [n[1][t] for t in found]]

        return work

    counted = map_rows(rows.select("text", "label"), "term string, d0 long, d1 long", counting)
    counted = counted.groupBy("term").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1")).toArrow().sort_by("term")  # the sample's terms
    numbers = Terms(counted["term"].combine_chunks())  # sorted: numbers do not hang on the order of rows
    d0, d1 = (np.array(counted[c], float) for c in ("d0", "d1"))
    terms = context.broadcast(numbers)
    stored = checkpointed(counted_terms(docs, terms))
    df, total = document_frequencies(stored, len(d0))
    weight = np.log((1 + total) / (1 + df)) * relevance(d1, d0)
    weights = context.broadcast(weight)

    def vectors():
        make = Weights(terms.value, weights.value).vector

        def work(columns):
            found = [make(t) for t in columns[2]]
            return [columns[0], columns[1], [t.tobytes() for t, _ in found], [w.tobytes() for _, w in found]]

        return work

    made = map_rows(rows, "doc_id long, label int, t binary, w binary", vectors).toArrow()
    made = [
        (np.frombuffer(t.as_buffer(), np.int32), np.frombuffer(w.as_buffer(), np.float32), y.as_py(), i.as_py())
        for t, w, y, i in zip(*[made[c] for c in ("t", "w", "label", "doc_id")], strict=True)
    ]
    full = sorted((r for r in made if len(r[0])), key=lambda r: _place(r, weight, df))
    empty = [r[2] for r in made if not len(r[0])] or [r[2] for r in made]
    index = Index(numbers, weight, [r[:2] for r in full], [r[2] for r in full], [r[3] for r in full], float(np.mean(empty)))
    del made, full
    index._shared = terms, context.broadcast(index)
    index.steps = isotonic(*_votes(rows, index))
    return index, stored


def _place(r: tuple, weight: np.ndarray, df: np.ndarray) -> tuple:
    """Sort key of an example: its heaviest terms among those that many documents have."""
    common = r[0][df[r[0]] >= 50]
    return tuple(common[np.argsort(-weight[common], kind="stable")[:3]].tolist()), r[3], r[2]


def _opened(index: Index):
    """In a task: the index that the driver has sent, with its terms."""
    terms, rest = index.shared(SparkSession.active())

    def make() -> Index:
        rest.value.weights.terms = terms.value
        return rest.value

    return make


def _votes(rows: DataFrame, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """The vote of each example without itself, and its label; computed on the cluster."""
    opened = _opened(index)

    def voting():
        index = opened()
        at = {key: j for j, key in enumerate(zip(index.ids.tolist(), index.labels.tolist(), strict=True))}

        def work(columns):
            own = [at.get((i, y), -1) for i, y in zip(*columns[:2], strict=True)]  # -1: without terms, so not in the index
            return [own, list(map(index.vote, index.nearest_of(list(map(index.weights.vector, columns[2])), without=own)))]

        return work

    found = map_rows(rows, "at long, vote double", voting).where("at >= 0").toArrow()
    return np.array(found["vote"], float), index.labels[np.array(found["at"])]


def counted_terms(docs: DataFrame, terms) -> DataFrame:
    """``doc_id, t, n`` for every row: the numbers of its (broadcast) terms as four bytes each, and how often each
    stands in the text, in as few bytes each as the most frequent takes."""

    def counting():
        of_word = terms.value.of_word

        def work(columns):
            found = [counts(text, of_word) for text in columns[1]]
            return [columns[0], [t.tobytes() for t, _ in found], [n.astype(np.min_scalar_type(n.max(initial=0))).tobytes() for _, n in found]]

        return work

    return map_rows(docs.select("doc_id", text_of("text").alias("text")), "doc_id long, t binary, n binary", counting)


def document_frequencies(stored: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each of the ``size`` terms stands, and their number."""

    def run(batches):
        seen, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = batch.column(0).slice(start, 512).to_pylist()
                seen += np.bincount(np.frombuffer(b"".join(found), np.int32), minlength=size)
                rows += len(found)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(rows, seen[at]))], names=["term", "n"])

    counted = stored.select("t").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(size + 1)
    found[np.array(counted["term"])] = np.array(counted["n"])
    return found[:-1], int(found[-1])


def scored(docs: DataFrame, index: Index | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, evidence`` (ids of the nearest examples) for every row."""
    return _scored(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), index, Weights.vector)


def scored_counts(stored: DataFrame, index: Index) -> DataFrame:
    """As ``scored``, from the counts of ``learn_and_count``."""
    return _scored(stored, index, Weights.of_stored)


def _scored(rows: DataFrame, index: Index | None, vector: Callable) -> DataFrame:
    """``vector`` makes a vector of what stands behind the id in a row."""
    opened, steps = (None, None) if index is None else (_opened(index), index.steps)

    def make():
        index = opened and opened()

        def work(columns):
            if index is None:
                found = [(0.0, [])] * len(columns[0])
            else:
                every = list(zip(*columns[1:], strict=True))
                once = list(set(every))
                known = dict(zip(once, index.scores([vector(index.weights, *x) for x in once], steps), strict=True))
                found = list(map(known.__getitem__, every))
            return [columns[0], [min(1.0, max(0.0, s)) for s, _ in found], [e for _, e in found]]

        return work

    return map_rows(rows, "doc_id long, score double, evidence array<long>", make)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index, stored = learn_and_count(docs, table(spark, sf_dir, "labels").where(fold("doc_id", FOLDS) != HELD))
    return (scored_counts(stored, index) if index else scored(docs, None)).select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        "evidence",
    )
