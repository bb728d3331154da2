"""Learned operators: held-out accuracy, exactness of their searches, and awkward rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adit.llm import decision_list, language, preference, toxicity
from adit.llm.common import fold
from adit.llm.queries import QUERIES
from adit.llm.statistics import NAMES, statistics

SF = "/root/testdata/sf0.01"


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, k in Counter(windows).items() if k > 1}
    marked = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(marked)]


def test_statistics_match_a_plain_version(documents, awkward):
    for docs in (documents, awkward):
        for r in docs.select("text").collect():
            text = r["text"] or ""
            assert statistics(text)[:5] == plain_statistics(text)
    for text in ("a b c a b c", "a a a a", "x\n x\nx\n\nx ", "a b c", "\x0b a \x1c b"):
        assert statistics(text)[:5] == plain_statistics(text)


def test_quality_classifier_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op9_quality_classifier"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([(r["predicted"] == 1) == (r["quality"] == 1) for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_rules_keep_clean_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op5_quality_rules"](spark, SF).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_rules_are_ordered_and_readable():
    rng = np.random.default_rng(0)
    rows = np.zeros((600, len(NAMES)), np.int64)
    rows[:, NAMES.index("n_words")] = 100
    rows[:, NAMES.index("n_symbols")] = rng.integers(0, 100, 600)
    rows[:, NAMES.index("n_lines")] = 10
    label = (rows[:, NAMES.index("n_symbols")] <= 60).astype(int)
    rules = decision_list.learn_rules(rows, label)
    held = np.zeros(600, bool)
    for rule in rules:
        held |= decision_list.covers(rule, decision_list.measures(rows))
    assert ((label == 0) == held).mean() > 0.98
    assert "symbols_per_word > 0.6" in str(rules[0][0])
    assert decision_list.learn_rules(rows, np.ones(600, int)) == []


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op7_toxicity"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    found = sum(r["predicted"] for r in rows if r["toxic"] == 1)
    assert found >= 0.5 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.05 * len(rows)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(t))
        vectors.append((t, (w / np.sqrt((w**2).sum())).astype(np.float32)))
    index = toxicity.Index({str(i): i for i in range(40)}, np.ones(40), vectors, np.zeros(700), np.arange(700))
    dense = np.zeros((700, 40), np.float32)
    for j, (t, w) in enumerate(vectors):
        dense[j, t] = w
    for t, w in vectors[:60]:
        cosines = dense[:, t] @ w
        order = sorted((-float(c), j) for j, c in enumerate(cosines) if c > 0)[:15]
        near = index.nearest(t, w)
        assert np.allclose([c for c, _ in near], [-c for c, _ in order], atol=1e-6)
        assert len(near) == len(order)


def test_isotonic_increases():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.9]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]))
    assert all(a <= b for a, b in zip(y, y[1:], strict=False)) and all(a <= b for a, b in zip(x, x[1:], strict=False))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language_id"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


@pytest.mark.parametrize("doc_id", [None, 7])
def test_languages_whose_rows_share_an_id_are_learned(spark, doc_id):
    turkish = [(doc_id, f"bugün hava çok güzel ve {i} kişi şehirde yürüyor, sonra eve döndüler", "tr") for i in range(3000)]
    english = [(i, f"the weather is fine today and {i} people walk in the town, then went home", "en") for i in range(3000)]
    docs = spark.createDataFrame(turkish + english, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["en", "tr"]
    assert model.predict(["hava güzel, eve döndüler", "they went home today"])[0] == ["tr", "en"]
    kept = docs.where((language._draw() < 1500 / 3000) & (F.col("lang") == "tr")).count()
    assert 1200 < kept < 1800  # the sample is bounded


def test_kernel_matches_sets():
    texts = ["the cat", "ein Hund", "", "aaa", "Été à 5 heures"]
    marks = language.Landmarks.of(texts[:4])

    def grams(text, n):
        data = text.lower().encode().translate(language._TO_SPACE)
        return {data[i : i + n] for i in range(len(data) - n + 1)}

    got = marks.kernel(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:4]):
            want = np.mean([len(grams(a, n) & grams(b, n)) / np.sqrt(max(1, len(grams(a, n))) * max(1, len(grams(b, n)))) for n in (1, 2, 3)])
            assert got[i, j] == pytest.approx(want, abs=1e-6)


def test_grams_of_chunks_are_those_of_the_whole(monkeypatch):
    text = "abc défg " * 50
    whole = language.ngrams(text)
    monkeypatch.setattr(language, "_CHUNK", 17)
    assert all((a == b).all() for a, b in zip(whole, language.ngrams(text), strict=True))


def test_awkward_rows(spark, awkward, empty, no_labels, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = preference.learn(documents, labels)
    index = toxicity.learn(documents, labels)
    tongue = language.fit(documents.where(fold("doc_id", 4) != 2))
    rules = decision_list.learn(documents, labels)
    for docs in (awkward, empty):
        n = docs.count()
        assert preference.scored(docs, model).count() == n
        assert preference.scored(docs, None).count() == n
        assert preference.accepted(docs, model).columns == docs.columns
        assert toxicity.scored(docs, index).count() == n
        assert toxicity.scored(docs, None).count() == n
        assert decision_list.judged(docs, rules).count() == n
        assert decision_list.judged(docs, []).count() == n
        assert language.identified(docs, None).count() == n
        found = language.identified(docs, tongue).collect()
        assert len(found) == n
        assert {r["lang_pred"] for r in found if r["doc_id"] in (0, 1, 2, 11)} <= {"und"}
    assert preference.learn(awkward, no_labels) is None
    assert toxicity.learn(awkward, no_labels) is None
    assert decision_list.learn(awkward, no_labels) == []
    assert language.fit(empty) is None
