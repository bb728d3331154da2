"""Texts with alike shingles against all pairs, and the near-dedup stage's recall."""

import random

import numpy as np
import pytest

from adit.llm import resemblance, simhash


def signed(text):
    return resemblance.signature(np.frombuffer(simhash.shingle_hashes(text), ">u8").astype(np.uint64))


def shingles(text, k=5):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / max(1, len(a | b))


def originals(rng, n, words=300):
    return [[f"w{rng.randrange(3000)}" for _ in range(words)] for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**6)}"
    return words


def partition(pairs, n):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def test_signatures_estimate_jaccard():
    rng = random.Random(1)
    for words, edits in [(w, e) for w in originals(rng, 10) for e in (0, 3, 6, 15, 40)]:
        a, b = " ".join(words), " ".join(edited(rng, words, edits))
        same = np.mean(np.frombuffer(signed(a), np.uint16) == np.frombuffer(signed(b), np.uint16))
        assert abs(same - jaccard(a, b)) < 0.18
    assert signed("") is None and signed(" \n") is None
    assert signed("One two") == signed("one  TWO") != signed("one three")
    assert signed("one two three four") != signed("one two three five")


@pytest.mark.parametrize("max_block", [4096, 4], ids=["whole", "cut"])
def test_links_are_those_of_all_pairs(spark, max_block):
    rng = random.Random(2)
    texts = [" ".join(edited(rng, w, e)) for w in originals(rng, 12, 200) for e in (0, 1, 2, 4, 5, 6, 8, 10, 14)]
    texts += [texts[0], "", "a b", "a b", None]
    found = [signed(t or "") for t in texts]
    pairs = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if found[i] and found[j] and np.count_nonzero(np.frombuffer(found[i], np.uint16) == np.frombuffer(found[j], np.uint16)) >= resemblance.AGREE
    ]
    rows = spark.createDataFrame(list(enumerate(found)), "node long, signature binary")
    linked = [(r["a"], r["b"]) for r in resemblance.links(rows, max_block).collect()]
    assert len(pairs) > 50 and partition(linked, len(texts)) == partition(pairs, len(texts))
    assert len(linked) < 4 * len(pairs)


def test_one_of_each_group_of_near_copies_stays(spark, awkward, empty):
    """Recall of at least 0.9 over planted copies of similarity 0.8 or more; no clean document goes."""
    rng = random.Random(3)
    bases, copies = originals(rng, 150), []
    for k, words in enumerate(bases):
        text = " ".join(words)
        copy = next(c for e in (6, 5, 4, 3, 2, 1) if jaccard(text, c := " ".join(edited(rng, words, e))) >= 0.8)
        copies.append((1000 + k, copy, "s"))
    clean = [(2000 + k, " ".join(w), "s") for k, w in enumerate(originals(rng, 100))]
    passage = [f"law{i}" for i in range(100)]  # a third of each of these
    clean += [(3000 + k, " ".join(w + passage), "s") for k, w in enumerate(originals(rng, 50, 200))]
    docs = spark.createDataFrame([(k, " ".join(w), "s") for k, w in enumerate(bases)] + copies + clean, "doc_id long, text string, source string")
    kept = simhash.keep_one_of_each(docs, alike=True)
    left = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and set(range(150)) | {i for i, *_ in clean} <= left
    assert sum(i in left for i, *_ in copies) <= 0.1 * len(copies)
    assert simhash.keep_one_of_each(empty, alike=True).count() == 0
    texts = {(r["text"] or "").strip() for r in simhash.keep_one_of_each(awkward, alike=True).collect()}
    assert {"a", "one two", "one two three", "same text"} <= texts
