"""Fill-in-the-middle against a plain version, and exact round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from adit.llm import fill_middle

SPLITS = ["<P", "P>", "<", "a<S", "><M", "<<P>", "a<S>b", "<M>", "😀é́x" * 700, "é" * 1024, "é" * 1025, "\n\r\n", "x" * 3000, "\U0001f600" * 2048]


def plain(doc_id, text, units):
    """n, form, first and second cut in code points, output."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    ends = [0]
    for length in units(text):
        ends.append(ends[-1] + length)
    n = len(ends) - 1
    i, j = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    if n == 0 or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:i], text[i:j], text[j:]
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}"


def held_to_plain(docs, units=lambda t: [1] * len(t), **kw):
    found = fill_middle.fill_in_middle(docs, **kw).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == docs.count()
    wanted = sorted(((r["doc_id"], *plain(r["doc_id"], r["text"], units)) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found), key=str) == wanted
    assert all(r["back"] == r["text"] for r in found)
    return found


@pytest.mark.parametrize("run", [1, 7, 1024, 4096])
def test_matches_a_plain_version(spark, documents, awkward, empty, run):
    pairs = [(i if i % 5 else None, t) for i, t in enumerate(SPLITS * 5)]
    tricky = spark.createDataFrame(pairs, "doc_id long, text string")
    forms = {r["form"] for docs in (documents if run > 1 else documents.limit(20), awkward, tricky, empty) for r in held_to_plain(docs, run=run)}
    assert forms == {"plain", "psm", "spm"}


def test_other_units(spark, documents):
    pattern = r"\s*\S+(?:\s+$)?"
    lengths = lambda text: [len(m[0]) for m in re.finditer(r"\s*\S+(?:\s+\Z)?", text, re.A)]
    docs = documents.where(F.col("text").rlike(r"\S"))
    found = held_to_plain(docs, lengths, unit=pattern.replace("$", r"\z"), run=16)
    assert max(r["n"] for r in found) > 100


def test_rows_that_repeat_share_their_cuts(spark):
    docs = spark.createDataFrame([(1, "one text")] * 500 + [(1, "another text"), (None, "one text"), (None, None)], "doc_id long, text string")
    held_to_plain(docs)


def test_whole_query(spark):
    found = fill_middle.op13_fill_in_middle(spark, "/root/testdata/sf0.001")
    texts = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    for r in found.collect():
        assert r["restored_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
