"""The mix against its budgets and a plain version of the targets."""

import pytest
from pyspark.sql import functions as F

from adit.llm import mixing


def plain_targets(sizes):
    """Water filling by repeated sharing: sizes in source order."""
    weights = [k % 3 + 1 for k in range(len(sizes))]
    total, full = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[k] for k in full)
        w = sum(weights[k] for k in range(len(sizes)) if k not in full)
        over = {k for k in range(len(sizes)) if k not in full and left * weights[k] > 3 * sizes[k] * w}
        if not over:
            return [3.0 * s if k in full else left * weights[k] / w for k, s in enumerate(sizes)]
        full |= over


@pytest.mark.parametrize("sizes", [[100, 1, 50, 7], [5], [1, 1, 1, 1000, 2, 3], [0, 10, 0, 3], [0, 0]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{k}" if k < len(sizes) - 1 else None, s) for k, s in enumerate(sizes)], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    for k, t in enumerate(plain_targets(sizes)):
        assert found[f"s{k}" if k < len(sizes) - 1 else None] == pytest.approx(t)


def test_taken_words_come_near_targets(documents):
    rows = mixing.mix(documents).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(documents.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    by = {}
    for r in rows:
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for of in by.values():
        target, smallest = of[0]["target"], min(r["size"] for r in of if r["size"])
        assert abs(sum(r["taken"] for r in of) - target) <= max(smallest, 0.2 * target)
        epochs = int(target // of[0]["source_size"])
        assert all(r["copies"] in (epochs, epochs + 1) for r in of)


def test_splitting_ranges_changes_nothing(spark):
    rows = spark.createDataFrame([(str(i % 3), ((i * 7919) % 3001) / 300100, i, i, i % 7 + 1, 1234) for i in range(3000)], "source string, x double, doc_id long, row long, size long, rest long")
    one = sorted(r["row"] for r in mixing.within_budget(rows).collect())
    assert one == sorted(r["row"] for r in mixing.within_budget(rows, ranges=4, sort_rows=5).collect())
    left = {}
    for r in sorted(rows.collect(), key=lambda r: (r["x"], r["doc_id"])):
        left.setdefault(r["source"], [0, True])
        upto, open_ = left[r["source"]]
        open_ = open_ and upto + r["size"] <= 1234
        left[r["source"]] = [upto + r["size"], open_]
        assert (r["row"] in set(one)) == open_


def test_likelier_by_weight(spark):
    docs = spark.createDataFrame([(i, "a b c d e", "x" if i % 2 else "y") for i in range(4000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, weight=F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)).where("source = 'x'").collect()
    # weight 2 for y, 1 for x ("x" comes first): x takes two thirds of its words
    heavy = sum(r["copies"] for r in rows if r["doc_id"] % 4 < 2)
    assert heavy > 1.3 * sum(r["copies"] for r in rows if r["doc_id"] % 4 >= 2)


def test_awkward_rows(awkward, empty):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(empty).count() == 0
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns and out.count() > 0
    assert mixing.mixed_documents(empty).count() == 0
