"""Toxicity scores against a plain version: all terms, all examples, no index."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adit.llm import toxicity

SF = "/root/testdata/sf0.001"
MARKS = ".,;:!?\"'()[]{}#*$%&|<>/\\-_=+~`"


def plain_terms(text):
    return Counter(w for w in (x.strip(MARKS) for x in (text or "").lower().split()) if w)


def plain_isotonic(x, y):
    """By the max-min formula over distinct x; runs of equal values stand at their mean x."""
    at = sorted(set(x))
    by = [[b for a, b in zip(x, y, strict=True) if a == v] for v in at]
    mean = lambda i, j: sum(map(sum, by[i : j + 1])) / sum(map(len, by[i : j + 1]))
    value = [max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))]
    points = []
    for i, v in enumerate(value):
        if points and abs(points[-1][1] - v) < 1e-12:
            points[-1][0].append(i)
        else:
            points.append(([i], v))
    return [(sum(at[i] * len(by[i]) for i in run) / sum(len(by[i]) for i in run), v) for run, v in points]


def plain_scores(texts, examples):
    """Scores of all texts, and the cosines of their neighbours."""
    n, df = len(texts), Counter()
    for t in texts:
        df.update(plain_terms(t).keys())
    counts = {0: Counter(), 1: Counter()}
    for t, y in examples:
        counts[y].update(plain_terms(t).keys())
    weight = {t: math.log((1 + n) / (1 + df[t])) * math.log2(2 + counts[1][t] / max(1, counts[0][t])) for t in counts[0] | counts[1]}

    def vector(text):
        v = {t: (1 + math.log(k)) * weight[t] for t, k in plain_terms(text).items() if weight.get(t, 0) > 0}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    vectors = [(vector(t), y) for t, y in examples]
    blank = [y for v, y in vectors if not v] or [y for _, y in vectors]
    vectors = [(v, y) for v, y in vectors if v]

    def near(v, without=None):
        cosines = [(sum(w * u.get(t, 0) for t, w in v.items()), y) for j, (u, y) in enumerate(vectors) if j != without]
        return sorted((c for c in cosines if c[0] > 1e-9), key=lambda c: -c[0])[: toxicity.NEIGHBOURS]

    vote = lambda found: sum(c * y for c, y in found) / sum(c for c, _ in found) if found else np.mean(blank)
    steps = plain_isotonic([round(vote(near(v, j)), 12) for j, (v, _) in enumerate(vectors)], [y for _, y in vectors])
    out = []
    for t in texts:
        found = near(vector(t))
        out.append((np.interp(vote(found), *zip(*steps, strict=True)) if found else np.mean(blank), [c for c, _ in found]))
    return out


def test_scores_and_neighbours_are_those_of_all_terms(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    index = toxicity.learn(documents, labels)
    rows = documents.select("doc_id", "text").collect()
    marked = {r["doc_id"]: int(r["toxic"]) for r in labels.collect() if r["toxic"] is not None}
    examples = sorted({(r["text"] or "", marked[r["doc_id"]]) for r in rows if r["doc_id"] in marked})
    assert 0 < sum(y for _, y in examples) < len(examples)
    expected = plain_scores([r["text"] for r in rows], examples)
    found = {r["doc_id"]: r["score"] for r in toxicity.scored(documents, index).collect()}
    for r, (score, cosines) in zip(rows, expected, strict=True):
        assert found[r["doc_id"]] == pytest.approx(score, abs=1e-4)
        near = index.nearest(*index.weights.vector(r["text"] or ""))
        assert np.allclose([c for c, _ in near], cosines, atol=1e-5)


def test_equal_votes_are_pooled():
    for y in ([0, 0, 1, 1], [1, 1, 0, 0]):
        x, v = toxicity.isotonic(np.ones(4), np.array(y, float))
        assert (x.tolist(), v.tolist()) == ([1.0], [0.5])
    rng = np.random.default_rng(1)
    for _ in range(30):
        x, y = rng.integers(0, 6, 25) / 5, rng.integers(0, 2, 25)
        assert np.allclose(np.array(plain_isotonic(x.tolist(), y.tolist())).T, toxicity.isotonic(x, y.astype(float)))


def test_ties_go_to_the_first_examples():
    vectors = [(np.array([0], np.int32), np.array([1], np.float32))] * 300 + [(np.array([1], np.int32), np.array([1], np.float32))] * 3
    index = toxicity.Index({"a": 0, "b": 1}, np.ones(2), vectors, np.zeros(303), np.arange(303))
    one = np.array([1], np.float32)
    assert [j for _, j in index.nearest(np.array([0]), one, 5)] == [0, 1, 2, 3, 4]
    assert [j for _, j in index.nearest(np.array([0]), one, 5, without=1)] == [0, 2, 3, 4, 5]
    assert [j for _, j in index.nearest(np.array([1]), one, 5)] == [300, 301, 302]
    assert index.nearest(np.array([], np.int32), np.array([], np.float32)) == []


def test_long_lists_are_bounded_by_block():
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(1500):
        t = np.unique(np.concatenate([rng.choice(5, 2), 5 + rng.choice(400, 8)])).astype(np.int32)
        w = rng.random(len(t)) ** 3
        vectors.append((t, (w / np.sqrt((w**2).sum())).astype(np.float32)))
    index = toxicity.Index({str(i): i for i in range(405)}, np.ones(405), vectors, np.zeros(1500), np.arange(1500))
    assert (index.long[:5] >= 0).all() and (index.long < 0).sum() > 300  # both kinds of lists
    dense = np.zeros((1500, 405), np.float32)
    for j, (t, w) in enumerate(vectors):
        dense[j, t] = w
    for j, (t, w) in enumerate(vectors[:80]):
        cosines = dense[:, t] @ w
        cosines[j] = 0
        assert np.allclose([c for c, _ in index.nearest(t, w, without=j)], np.sort(cosines)[::-1][:15], atol=1e-6)
    # queries together give what each gives alone; an index of few examples opens all of them
    alone = [index.nearest(t, w, without=j) for j, (t, w) in enumerate(vectors[:200])]
    assert list(index.nearest_of(vectors[:200], without=range(200))) == alone
    few = toxicity.Index({str(i): i for i in range(405)}, np.ones(405), vectors[:40], np.zeros(40), np.arange(40))
    for j, (t, w) in enumerate(vectors[:40]):
        cosines = dense[:40, t] @ w
        cosines[j] = 0
        assert np.allclose([c for c, _ in few.nearest(t, w, 3, without=j)], [c for c in np.sort(cosines)[::-1][:3] if c > 1e-7], atol=1e-6)


def test_texts_without_terms_and_repeated_ids(spark):
    rows = [(1, "you idiot", 1), (2, "a fine day", 0), (3, None, 0), (4, "", 0), (5, " .,! ", 1), (5, "--", 1), (None, "you idiot", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame(sorted({(r[0], r[2]) for r in rows if r[2] is not None}), "doc_id long, toxic int")
    index = toxicity.learn(docs, labels)
    assert index.n == 2  # id 5 counts once, whichever of its texts
    scores = [(r["doc_id"], r["score"]) for r in toxicity.scored(docs, index).collect()]
    assert [s for i, s in scores if i in (3, 4, 5)] == [0.5] * 4  # null and empty are one example, id 5 the other
    assert toxicity.scored(docs, None).agg(F.max("score")).first()[0] == 0.0


def test_words_are_numbered_once_and_found_without_marks():
    numbers = toxicity.Numbers({"a": 0, "b": 1}, most=3)
    assert [numbers[w] for w in ("a", "(a)", "c", "b!", "b!", "--")] == [0, 0, -1, 1, 1, -1]
    assert dict(numbers) == {"a": 0, "(a)": 0, "c": -1}  # bounded; further words are looked up each time
    weights = toxicity.Weights({"a": 0, "b": 1, "c": 2}, np.array([1.0, 2.0, 0.0]))
    t, w = weights.vector("b (A) x c a, B. b")
    expected = np.array([1 + math.log(2), 2 * (1 + math.log(3))])
    assert t.tolist() == [0, 1] and np.allclose(w, expected / np.sqrt((expected**2).sum()))
    assert [len(v) for v in weights.vector("x -- y")] == [0, 0]


def test_few_examples_that_stand_out_do_not_hide_the_others():
    vectors = [(np.array([0], np.int32), np.array([1.0 if j < 20 else 0.01], np.float32)) for j in range(400)]
    index = toxicity.Index({"a": 0}, np.ones(1), vectors, np.zeros(400), np.arange(400))
    assert [j for _, j in index.nearest(np.array([0]), np.array([1], np.float32), 25)] == list(range(25))


def test_texts_are_split_once_and_scored_from_their_counts(spark, documents, awkward):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = documents.select("doc_id", "text").union(awkward.select(F.col("doc_id") + 1_000_000, "text"))
    docs = docs.union(spark.createDataFrame([(2_000_000, "the " * 70_000 + "(day) day! DAY of")], "doc_id long, text string"))
    index, stored = toxicity.learn_and_count(docs, labels)
    columns = ["doc_id", "score", F.array_sort("evidence").alias("evidence")]
    expected, found = (sorted(map(repr, x.select(columns).collect())) for x in (toxicity.scored(docs, index), toxicity.scored_counts(stored, index)))
    assert found == expected and len(found) == docs.count()
    terms = index.weights.terms.terms.to_pylist()
    every = set(terms)
    kept = {r["doc_id"]: (r["t"], r["n"]) for r in stored.collect()}  # rows of one id have one text here
    for r in docs.collect():
        t, n = kept[r["doc_id"]]
        assert all(map(np.array_equal, index.weights.of_stored(t, n), index.weights.vector(r["text"] or "")))
        known, size = np.frombuffer(t, np.int32), 4 * len(n) // max(1, len(t))
        plain = plain_terms(r["text"])
        assert [int.from_bytes(n[i : i + size], "little") for i in range(0, len(n), size or 1)] == [plain[terms[i]] for i in known]
        assert (np.diff(known) > 0).all() and set(plain) & every == {terms[i] for i in known}
    plan = toxicity.op7_toxicity(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()  # scores come from the stored counts, not from the texts again
