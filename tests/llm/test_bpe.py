"""Byte-level BPE against the public library, and exact round trips."""

import hashlib
import random
import tracemalloc

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from adit.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = bpe.MergeReplay(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x3FFF), max_size=200))
def test_ids_are_those_of_the_library(text):
    (ids,) = CODER.encode([text])
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


def test_more_ranks_than_two_bytes_can_number():
    moved = {token: rank if rank < 256 else rank + 2**18 for token, rank in RANKS.items()}
    coder, texts = bpe.MergeReplay(moved), ["a text of several words, élan", "ab" * 500, ""]
    for ids, known in zip(coder.encode(texts), CODER.encode(texts), strict=True):
        assert ids == [rank if rank < 256 else rank + 2**18 for rank in known]


def test_words_that_repeat_and_long_words():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab étz\n 'sll09!?🙂漢") for _ in range(rng.randrange(300))) for _ in range(300)]
    texts += ["", " ", "a" * 20_000, "ab" * 5_000, " \n\n x", "\x1c\x85 a"]
    for text, ids in zip(texts, CODER.encode(texts), strict=True):
        if len(text) < 10_000:
            assert ids == LIBRARY.encode_ordinary(text)
        assert CODER.decode(ids) == text.encode()


def test_merges_in_rank_order_when_a_later_merge_ranks_lower():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 290, b"bc": 310, b"aa": 295}
    coder = bpe.MergeReplay(ranks)
    one = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in ("abcabcab", "aaabcbca", "aaaaab", "bcbcabcc"):
        assert coder.encode([word]) == [one.encode_ordinary(word)]


def test_ranks_in_any_order():
    alone = 0
    for seed in range(20):
        rng = random.Random(seed)
        longer = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))) for _ in range(90)})
        rng.shuffle(longer)
        ranks = {t: i for i, t in enumerate([bytes([b]) for b in range(256)] + longer)}
        coder = bpe.MergeReplay(ranks)
        one = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        merge_alone = coder.merge_alone

        def counted(word, merge_alone=merge_alone):
            nonlocal alone
            alone += 1
            return merge_alone(word)

        coder.merge_alone = counted
        texts = ["".join(rng.choice("abc ") for _ in range(60)) for _ in range(60)]
        assert coder.encode(texts) == list(map(one.encode_ordinary, texts))
    assert alone


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    coder = bpe.MergeReplay(RANKS)
    for k in range(6):
        texts = [" ".join(f"w{k}x{i}" for i in range(40)) + " " + "y" * 100]
        assert coder.encode(texts) == [LIBRARY.encode_ordinary(texts[0])]
        assert len(coder.cache) <= 50


def test_documents(awkward, empty, documents):
    for docs in (awkward, documents):
        texts = {}
        for r in docs.collect():
            texts.setdefault(r["doc_id"], r["text"] or "")
        found = bpe.encode_documents(docs, RANKS).collect()
        assert len(found) == docs.count()
        for r in found:
            text = texts[r["doc_id"]]
            assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert r["n_tokens"] == len(r["ids"])
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
            if len(text) < 10_000:
                assert r["ids"] == LIBRARY.encode_ordinary(text)
    assert bpe.encode_documents(empty, RANKS).count() == 0


def test_repeated_words_and_ids_are_held_once():
    coder = bpe.MergeReplay(RANKS)
    text = " caterpillarish" * 200_000
    coder.encode([text[:1500]])
    tracemalloc.start()
    ids = coder.encode([text])[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80 * 200_000  # lists of references; each word apart took 63 bytes more
    big = [i for i in ids if i > 256]
    assert big and len(set(map(id, big))) == len(set(big))
    words = [f" zq{a}{b}xj" for a in "abcdefgh" for b in "abcdefgh"]
    coder.encode(words)
    held = [i for w in words for i in coder.cache[w] if i > 256]
    assert len(set(map(id, held))) == len(set(held))
