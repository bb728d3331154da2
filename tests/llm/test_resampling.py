"""Importance resampling against a plain version."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from adit.llm import common, resampling


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, targets, longest=1, buckets=10_000, percent=10, least=20):
    def counts(text):
        words = words_of(text)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), Counter(crc32(r.encode()) % buckets for r in runs)

    source, target = Counter(), Counter()
    per_doc = [(doc_id, *counts(text)) for doc_id, text in docs]
    for _, _, c in per_doc:
        source.update(c)
    for text in targets:
        target.update(counts(text)[1])
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
    out = []
    for doc_id, n, c in per_doc:
        size = sum(c.values())
        weight = sum(gain(b) * k for b, k in c.items()) // size if size else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, size, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1:4]))
    drawn = Counter()
    for k, r in enumerate(enough[: len(enough) * percent // 100], 1):
        drawn[(r, k)] += 1
    ranks = sorted(((*r, k) for r, k in drawn), key=str)
    return out, ranks


def held_to_plain(found, docs, targets, **kw):
    rows = [tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    out, ranks = plain(docs, targets, **kw)
    assert sorted((r[:5] for r in rows), key=str) == sorted(out, key=str)
    assert sorted((r for r in rows if r[5] is not None), key=str) == ranks


@pytest.mark.parametrize("kw", [{}, {"longest": 3, "buckets": 97, "percent": 37}, {"percent": 100}, {"percent": 0}])
def test_matches_a_plain_version(spark, documents, awkward, kw):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    targets = [r["text"] for r in target.collect()]
    for docs in (documents, awkward):
        pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
        held_to_plain(resampling.importance_resampled(docs, target, **kw), pairs, targets, **kw)


def test_ties_and_rows_that_repeat_take_ranks_in_turn(spark):
    text = " ".join(f"w{i}" for i in range(30))
    pairs = [(7, text)] * 400 + [(None, text)] * 300 + [(i, text + " Extra") for i in range(50)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("w1 w2",), (None,)], "text string")
    found = resampling.importance_resampled(docs, target, percent=60)
    held_to_plain(found, pairs, ["w1 w2", None], percent=60)
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == list(range(1, 451))


def test_empty_tables(spark, documents, empty):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.importance_resampled(empty, nothing).count() == 0
    docs = documents.select("doc_id", "text")
    held_to_plain(resampling.importance_resampled(docs, nothing), [tuple(r) for r in docs.collect()], [])


def test_blocks_do_not_change_the_result(spark, documents, monkeypatch, tmp_path):
    whole = resampling.CountMatrix.of(documents)
    monkeypatch.setattr(resampling, "BLOCK", 500)
    cut = resampling.CountMatrix.of(documents, path=str(tmp_path / "blocks"))
    assert cut.blocks.count() > whole.blocks.count()
    assert sorted(whole.column_sums().collect()) == sorted(cut.column_sums().collect())
    gains = resampling.gains_of(cut, whole)
    assert sorted(whole.row_means(gains).collect()) == sorted(cut.row_means(gains).collect())


def test_a_file_has_few_blocks_however_many_a_task_makes(spark, documents, monkeypatch, tmp_path):
    """A reader of 4,096 rows at once then never holds more of them."""
    whole = resampling.CountMatrix.of(documents)
    monkeypatch.setattr(resampling, "BLOCK", 500)
    cut = resampling.CountMatrix.of(documents.coalesce(1), path=str(tmp_path / "blocks"))
    held = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "blocks").glob("*.parquet")]
    assert sum(held) > 10 and max(held) <= 4
    gains = resampling.gains_of(cut, whole)
    assert sorted(whole.row_means(gains).collect()) == sorted(cut.row_means(gains).collect())


@pytest.mark.parametrize("before", [None, "32m"])
def test_batches_of_blocks_are_small_and_the_session_keeps_its_setting(spark, documents, before, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["s"])

    docs = spark.range(30).crossJoin(documents.select("text")).selectExpr("id AS doc_id", "text").coalesce(1)
    blocks = resampling.CountMatrix.of(docs, path=str(tmp_path / "blocks")).blocks.coalesce(1)
    if before:
        spark.conf.set(key, before)
    try:
        with common.arrow_batches(spark, resampling.BATCH):
            small = [r["s"] for r in blocks.mapInArrow(sizes, "s long").collect()]
        assert spark.conf.get(key, None) == before
        assert resampling.importance_resampled(documents, documents).count() == documents.count()
        assert spark.conf.get(key, None) == before
    finally:
        spark.conf.unset(key)
    assert sum(small) > 16_000_000 and max(small) < 16_000_000


def test_the_table_of_blocks_is_removed(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(resampling, "shared_folder", lambda _: str(tmp_path))
    assert resampling.importance_resampled(documents, documents).count() == documents.count()
    assert list(tmp_path.iterdir()) == []


def test_a_target_draws_its_own_kind(spark):
    pairs = [(i, " ".join((f"red{(i + k) % 40}" if i % 2 else f"blue{(i + k) % 40}") for k in range(40))) for i in range(400)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(f"red{k}" for k in range(40)),)] * 20, "text string")
    drawn = resampling.importance_resampled(docs, target).where("rank IS NOT NULL").collect()
    assert len(drawn) == 40 and sum(r["doc_id"] % 2 for r in drawn) >= 38
