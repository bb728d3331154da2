"""Fits of the learned operators against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adit.llm import decision_list, language, preference
from adit.llm.statistics import NAMES


def test_preferences_are_fitted_to_the_optimum():
    rng = np.random.default_rng(2)
    x, label = rng.normal(size=(300, 6)), rng.integers(0, 2, 300)
    x[label == 1] += [1, 0.5, 0, 0, 0, -0.3]
    better, worse = preference.preferences(label, 700)
    assert (label[better] == 1).all() and (label[worse] == 0).all()
    w = preference.bradley_terry(x, better, worse, ridge=0.01)

    def loss(v):
        return np.mean([math.log1p(math.exp(-float(v @ (x[a] - x[b])))) for a, b in zip(better, worse, strict=True)]) + 0.005 * float(v @ v)

    plain = np.zeros(6)
    for _ in range(3000):  # plain gradient descent
        d = x[better] - x[worse]
        plain += 0.5 * ((d * (1 / (1 + np.exp(d @ plain)))[:, None]).mean(0) - 0.01 * plain)
    assert np.allclose(w, plain, atol=1e-4)
    assert all(loss(w) <= loss(w + e) for e in 0.01 * np.vstack([np.eye(6), -np.eye(6)]))


def test_the_threshold_is_the_best_quantile():
    rng = np.random.default_rng(4)
    x, label = rng.normal(size=(200, 3)), rng.integers(0, 2, 200)
    x[:, 0] += label
    model = preference.fit(x, label, pairs=2000, damped=0)
    s = (x - model.mean) / model.spread @ model.weights
    right = lambda cut: ((s > cut) & (label == 1)).sum() / (label == 1).sum() + ((s <= cut) & (label == 0)).sum() / (label == 0).sum()
    assert right(model.cut) == pytest.approx(max(right(c) for c in s))


def test_hashed_features_are_shares():
    text = "Aa bb aa " * 50
    found = preference.hashed(text) ** 2
    assert found[: preference.BUCKETS].sum() == pytest.approx(1) and found[preference.BUCKETS :].sum() == pytest.approx(1)
    assert (preference.hashed("") == 0).all() and preference.hashed("é").shape == (2 * preference.BUCKETS,)
    assert preference.features(["", "x", "a b"]).shape[0] == 3


def test_scores_of_empty_texts_are_those_of_texts_without_words(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = preference.learn(documents, labels)
    rows = spark.createDataFrame([(1, None), (2, ""), (3, None)], "doc_id long, text string")
    scores = {r["score"] for r in preference.scored(rows, model).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_one_row_of_each_labelled_id_is_fitted_on(spark):
    from adit.llm.statistics import labelled_sample

    rows = [(1, f"text {k}") for k in range(40)] + [(2, "a"), (3, "b"), (3, "b"), (None, "c"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, 1), (2, 0)], "doc_id long, quality int")
    found = sorted((r["doc_id"], r["label"]) for r in labelled_sample(docs, labels, "quality", 100).collect())
    assert found == [(1, 1), (2, 0), (3, 1), (4, 0)]
    assert labelled_sample(docs, labels, "quality", 2).count() <= 2


def plain_grow(x, bad):
    """The conjunction of a rule, by trying every threshold of every measure."""
    rule, here = [], np.ones(len(bad), bool)
    while len(rule) < decision_list.MOST_CONDITIONS and (~bad & here).any():
        p0, n0 = (bad & here).sum(), (~bad & here).sum()
        best = None
        for name, values in x.items():
            cuts = sorted(set(values[here].tolist()))
            for low, high in zip(cuts, cuts[1:], strict=False):
                for above in (False, True):
                    c = decision_list.Condition(name, above, (low + high) / 2)
                    held = c.holds(x) & here
                    p, n = (bad & held).sum(), (~bad & held).sum()
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = gain, c
        if best is None:
            break
        rule.append(best[1])
        here &= best[1].holds(x)
    return rule


def test_rules_grow_by_the_best_gain():
    rng = np.random.default_rng(6)
    x = {"symbols_per_word": rng.integers(0, 9, 120) / 4, "upper_share": rng.integers(0, 7, 120) / 8, "words": rng.integers(1, 50, 120).astype(float)}
    bad = (x["symbols_per_word"] > 1) & (x["upper_share"] > 0.4) | (rng.random(120) < 0.05)
    grown, plain = decision_list._grow(x, bad), plain_grow(x, bad)
    gain = lambda rule: [round(float(decision_list.covers(tuple(rule[: k + 1]), x)[bad].mean()), 9) for k in range(len(rule))]
    assert len(grown) == len(plain) and gain(grown) == gain(list(plain))
    assert (decision_list.covers(grown, x) == decision_list.covers(tuple(plain), x)).all()


def plain_prune(rule, x, bad):
    """The shortest of the best beginnings of a rule, counted row by row."""
    best = None
    for k in range(1, len(rule) + 1):
        held = [i for i in range(len(bad)) if all(bool(c.holds({c.measure: x[c.measure][i]})) for c in rule[:k])]
        p = sum(bool(bad[i]) for i in held)
        worth = (2 * p - len(held)) / len(held) if held else -1.0
        if best is None or worth > best[0]:
            best = worth, rule[:k]
    return best[1] if best else []


def plain_list(rows, label):
    """The whole decision list, by sets of row numbers."""
    x, bad = decision_list.measures(rows), {i for i, y in enumerate(label) if y == 0}
    left, growing, rules = set(range(len(label))), {i for i in range(len(label)) if i % 3 != 2}, []
    at = lambda rows: ({k: v[sorted(rows)] for k, v in x.items()}, np.array([i in bad for i in sorted(rows)], bool))
    while len(rules) < decision_list.MOST_RULES and len(bad & growing) >= decision_list.MIN_COVERED:
        rule = plain_grow(*at(growing))
        rule = plain_prune(rule, *at({i for i in left if i % 3 == 2}))
        covered = {i for i in left if all(bool(c.holds({c.measure: x[c.measure][i]})) for c in rule)}
        held = {i for i in covered if i % 3 == 2}
        if not covered & bad & growing:
            break
        good = len(covered & bad) >= max(decision_list.MIN_COVERED, decision_list.MIN_PRECISION * len(covered))
        if good and held and len(held & bad) >= decision_list.MIN_PRECISION * len(held):
            rules.append(rule)
            left, growing = left - covered, growing - covered
        else:
            growing = growing - (covered & bad)
    return rules


@pytest.mark.parametrize("seed", range(4))
def test_the_whole_list_is_that_of_plain_covering(seed):
    rng = np.random.default_rng(seed)
    n = 240
    symbols, upper, lines = rng.integers(0, 40, n), rng.integers(0, 400, n), rng.integers(0, 10, n)
    bad = (upper > 320) | (symbols > 30) & (lines > 4) | (rng.random(n) < 0.03)
    rows, label = numbers(n, n_symbols=symbols, n_upper=upper, n_dup_lines=lines), (~bad).astype(int)
    found, plain = decision_list.learn_rules(rows, label), plain_list(rows, label)
    x = decision_list.measures(rows)
    covered = lambda rules: [decision_list.covers(tuple(r), x).tolist() for r in rules]
    assert found and covered(found) == covered(plain)


def test_a_rule_is_cut_to_its_best_beginning():
    rng = np.random.default_rng(12)
    x = {m: rng.random(60) for m in ("symbols_per_word", "upper_share", "words")}
    for _ in range(30):
        bad = (x["upper_share"] > rng.random()) ^ (rng.random(60) < 0.2)
        rule = tuple(decision_list.Condition(m, bool(rng.random() < 0.5), float(rng.random())) for m in x)
        assert decision_list._prune(rule, x, bad) == tuple(plain_prune(rule, x, bad))


def numbers(n, **columns):
    rows = np.zeros((n, len(NAMES)), np.int64)
    for name, values in {"n_words": 100, "n_lines": 10, "word_chars": 500, **columns}.items():
        rows[:, NAMES.index(name)] = values
    return rows


def test_a_rule_needs_evidence_it_did_not_grow_on():
    at = np.arange(90)
    symbols = np.where(at % 3 == 2, 0, np.where(at % 3 == 0, 60, 0))  # none in the third that prunes
    assert decision_list.learn_rules(numbers(90, n_symbols=symbols), (symbols == 0).astype(int)) == []


def test_a_poor_rule_does_not_end_the_list():
    rng = np.random.default_rng(9)
    n = 900
    symbols, upper = rng.integers(0, 40, n), rng.integers(0, 400, n)
    bad = upper > 300
    noise = (rng.random(n) < 0.3) & (np.arange(n) % 3 != 2) & (symbols > 30) & ~bad  # bad only where rules grow
    rules = decision_list.learn_rules(numbers(n, n_symbols=symbols, n_upper=upper), (~(bad | noise)).astype(int))
    held = np.zeros(n, bool)
    for rule in rules:
        held |= decision_list.covers(rule, decision_list.measures(numbers(n, n_symbols=symbols, n_upper=upper)))
    assert held[bad].mean() > 0.95 and held[~bad & ~noise].mean() < 0.05


def plain_kernel(a, b):
    grams = lambda t, n: {d[i : i + n] for d in [t.lower().encode().translate(language._TO_SPACE)] for i in range(len(d) - n + 1)}
    return np.mean([len(grams(a, n) & grams(b, n)) / math.sqrt(max(1, len(grams(a, n))) * max(1, len(grams(b, n)))) for n in (1, 2, 3)])


def tongues(count, each, seed):
    rng = np.random.default_rng(seed)
    letters = [[chr(int(c)) for c in rng.choice(np.r_[97:123, 0xE0:0xF6, 0x3B1:0x3C1], 6, replace=False)] for _ in range(count)]
    word = lambda k: "".join(rng.choice(letters[k], rng.integers(2, 5)))
    return [(k * each + i, " ".join(word(k) for _ in range(25)), f"l{k:03d}") for k in range(count) for i in range(each)]


def test_ridge_and_nystroem_are_those_of_the_whole_kernel(spark):
    rows = tongues(3, 8, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, landmarks=1000)  # all texts are landmarks, so features hold the kernel exactly
    texts, langs = [r[1] for r in rows], [r[2] for r in rows]
    k = np.array([[plain_kernel(a, b) for b in texts] for a in texts])
    values, vectors = np.linalg.eigh(k)
    phi = np.column_stack([k @ vectors @ np.diag(values**-0.5), np.ones(len(k))])  # K K^(-1/2)
    y = np.array([[1.0 if x == name else -1.0 for name in sorted(set(langs))] for x in langs]) / 8
    gram = phi.T @ phi / 8
    plain = phi @ np.linalg.solve(gram + language.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), phi.T @ y)
    got = model.landmarks.kernel(texts) @ model.weights[:-1] + model.weights[-1]
    assert model.languages == sorted(set(langs)) and np.allclose(got, plain, atol=2e-3)


def test_no_language_is_left_out(spark):
    rows = tongues(60, 5, 3) + [(1000, "абв абг", "rare"), (1001, "12 34", "digits"), (None, "абв где", "rare"), (1002, None, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, landmarks=48)
    assert set(model.languages) == {r[2] for r in rows} - {"digits", "null"}
    assert model.landmarks.present[0].shape[1] <= 48
    found = language.identified(docs, model).where("doc_id < 300").collect()
    assert np.mean([r["lang_pred"] == f"l{r['doc_id'] // 5:03d}" for r in found]) > 0.8
    assert {r["lang_pred"] for r in language.identified(docs, model).where("doc_id IN (1001, 1002)").collect()} == {"und"}


def test_every_labelled_document_and_every_pair_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = preference.training_labels(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    model = preference.learn(docs, labels)
    rows = docs.join(labels.where("quality in (0, 1)"), "doc_id").select("text", "quality").collect()
    x, label = preference.features([r["text"] or "" for r in rows]).astype(float), np.array([r["quality"] for r in rows])
    plain = preference.fit(x, label)  # all pairs one by one
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.spread, plain.spread)
    assert np.allclose(model.weights, plain.weights, atol=1e-4)
    assert model.cut == pytest.approx(plain.cut, abs=1e-3) and model.scale == pytest.approx(plain.scale, abs=1e-3)
    # added documents that say the opposite move the fit
    more = docs.join(labels.where("quality = 1"), "doc_id").select((-F.col("doc_id") - 1).alias("doc_id"), "text")
    wrong = more.select("doc_id", F.lit(0).alias("quality"))
    moved = preference.learn(docs.select("doc_id", "text").unionByName(more), labels.select("doc_id", "quality").unionByName(wrong))
    assert np.abs(moved.weights - model.weights).max() > 0.1


def test_the_cut_over_all_scores_is_exact(spark):
    rng = np.random.default_rng(6)
    for width in (0.01, 3.0):  # within one cell and over many
        label = rng.integers(0, 2, 400)
        s = np.round(rng.normal(size=400) + label, 2) * width
        found = preference.best_cut(spark.createDataFrame([(int(y), float(v)) for y, v in zip(label, s, strict=True)], "label int, s double"))
        right = lambda c: ((s > c) & (label == 1)).sum() / (label == 1).sum() + ((s <= c) & (label == 0)).sum() / (label == 0).sum()
        assert right(found) == pytest.approx(max(right(c) for c in s)) and found not in s
