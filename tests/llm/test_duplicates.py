"""Exact and near duplicates against plain versions."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adit.llm import exact_dedup, simhash


def plain_groups(rows):
    by = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    return by


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda t: F.substring(exact_dedup.sha256_hex(t), 1, 1)], ids=["sha256", "colliding"])
def test_exact_dedup_matches_a_plain_version(spark, documents, awkward, digest):
    for docs in (documents, awkward):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        by = plain_groups(rows)
        found = exact_dedup.exact_dedup(docs, salts=3, digest=digest).collect()
        assert sorted((str(r["id"]) for r in found)) == sorted(str(i) for i, _ in rows)
        text_of = {}
        for i, t in rows:
            text_of.setdefault(i, t or "")
        for r in found:
            group = by[text_of[r["id"]]]
            assert r["group_size"] == len(group)
            assert r["keep_id"] == max((i for i in group if i is not None), default=None)
        assert sum(r["kept"] for r in found) == len(by)


def test_one_row_of_each_text_stays(awkward, empty):
    kept = exact_dedup.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len(plain_groups([(r["doc_id"], r["text"]) for r in awkward.collect()]))
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.keep_one_of_each(empty).count() == 0


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, fps, radius=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return [least[find(k)] for k in range(len(ids))]


def test_simhash_matches_a_plain_version(documents, awkward, empty):
    for docs in (documents, awkward):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        fps = [plain_fingerprint(t) for _, t in rows]
        expected = sorted(map(str, zip([i for i, _ in rows], ["%016x" % f for f in fps], plain_components([i for i, _ in rows], fps), strict=True)))
        found = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex("fp").alias("f"), "component_id").collect()
        assert sorted(map(str, map(tuple, found))) == expected
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one_of_each(empty).count() == 0


@pytest.mark.parametrize("max_bucket", [4096, 12], ids=["one level", "split buckets"])
@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_find_every_component(spark, radius, max_bucket):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set()
    for c in centres.tolist():
        fps.add(c)
        for _ in range(25):
            flipped = c
            for b in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                flipped ^= 1 << b
            fps.add(flipped)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = simhash.links(df, radius, max_bucket)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    groups, expected = {}, {}
    for s, c in zip(signed, plain_components(list(range(len(fps))), fps, radius), strict=True):
        groups.setdefault(roots.get(s, s), set()).add(s)
        expected.setdefault(c, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    for r in edges.collect():  # every link is real
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 3 * 64


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([((i * 7919) % n, ((i + 1) * 7919) % n) for i in range(n - 1)], "a long, b long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_masks_cover_all_ways_to_differ():
    rng = np.random.default_rng(1)
    for level in (1, 2, 3):
        ms = [m & (1 << 64) - 1 for m in simhash.masks(level)]
        for _ in range(200):
            x = sum(1 << b for b in rng.choice(64, 3, replace=False).tolist())
            assert any(not x & m for m in ms)


def test_one_of_each_component_stays(spark):
    base = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(5, base), (3, base + " end"), (9, "other words stand here"), (9, "other words stand here")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()) == [3, 9]


def test_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c", 1, "x", "y"), (2, "a b c", 2, "x", "y")], "doc_id long, text string, staying long, staying_digest string, Digest_of_text string")
    assert [tuple(r) for r in simhash.keep_one_of_each(docs).collect()] == [(1, "a b c", 1, "x", "y")]


def test_digest_is_of_the_whole_text(awkward):
    found = {r["id"]: r["digest"] for r in exact_dedup.exact_dedup(awkward).collect()}
    assert found[0] == hashlib.sha256(b"").hexdigest()
    assert found[10] == hashlib.sha256(b"x" * 50_000).hexdigest()
