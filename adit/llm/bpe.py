"""Byte-level BPE by corpus-level merge replay, and its inverse.

The words of many documents are laid out once, each distinct word once. An inverted index maps
every pair of neighbouring tokens (by the rank of what they merge into) to the positions where
it stands; merges are applied in rank order at all listed positions at once, by array operations,
and each merge touches only its two neighbours. A word of any length so costs about its length, not
its square. Where a merge makes a pair of lower rank (which trained ranks hardly ever do) the word
is merged alone, by a queue of its pairs.

Defined results: a null text is an empty one and has no tokens; texts are taken whole; repeated
rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import map_rows, table, text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_WORDS = 200_000  # some 60 MB in each worker; the words met first are most of what follows
REPLAY_WORDS = 200_000  # laid out at once: many, as each rank costs some array operations


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a rank file: one base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def splitter(pattern: str):
    r"""The pattern, with white space as Unicode defines it (Python's ``\s`` takes four controls more)."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class MergeReplay:
    """Encodes words by replaying the merges of ``ranks`` over all of them at once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.end = max(ranks.values(), default=0) + 1  # stands beside the first and the last token of each word; merges with nothing
        self.token = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        self.words = splitter(pattern).findall
        self.numbers = list(range(self.end))  # one object for each id: the cache holds many
        self.one = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: what two neighbouring bytes merge into, or -1
        self.pairs = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int64)
        split = [(a, b, r) for t, r in ranks.items() for k in range(1, len(t)) if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None]
        merges = np.array(split, np.int64).reshape(-1, 3)
        #: by left token: where its merges begin, their right tokens in order, what they give; and by right token
        self.after = self._partners(merges[:, 0], merges[:, 1], merges[:, 2])
        self.before = self._partners(merges[:, 1], merges[:, 0], merges[:, 2])
        self.cache: dict[str, tuple[int, ...]] = {}

    def _partners(self, key: np.ndarray, partner: np.ndarray, rank: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        order = np.lexsort((partner, key))
        return np.searchsorted(key[order], np.arange(max(self.token, default=0) + 2)).tolist(), partner[order], rank[order]

    @staticmethod
    def _found(partners: tuple[list[int], np.ndarray, np.ndarray], token: int, other: np.ndarray) -> np.ndarray | None:
        """What ``token`` and each of ``other`` merge into, or -1; None if the token merges with nothing."""
        low, high = partners[0][token], partners[0][token + 1]
        if low == high:
            return None
        known = partners[1][low:high]
        i = known.searchsorted(other)
        i[i == high - low] = 0
        return np.where(known[i] == other, partners[2][low:high][i], -1)

    def index(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, dict[int, list[int]]]:
        """For each place the rank of what its byte and the next one merge into, or -1; and the
        inverted index: for each rank the places where it stands."""
        rank = np.full(len(data) + 1, -1)
        rank[: len(data) - 1] = self.pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
        rank[ends - 1] = -1  # not across words
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        ranks, first = np.unique(rank[at], return_index=True)
        upto, places = np.append(first, len(at)).tolist()[1:], at.tolist()
        return rank, {r: places[i:j] for r, i, j in zip(ranks.tolist(), first.tolist(), upto, strict=True)}

    def replay(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The tokens of each word. Words that are tokens themselves stay whole."""
        whole = list(map(self.ranks.get, words))
        parts = [w for w, rank in zip(words, whole, strict=True) if rank is None]
        if not parts:
            return [(rank,) for rank in whole]
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        n, nowhere = len(data), -1
        tokens = np.append(self.one[data], self.end)
        after, before = np.append(np.arange(1, n + 1), n), np.arange(-1, n)  # place n lies beside all words
        after[ends - 1] = n
        before[ends] = n
        before[0] = n
        rank, places = self.index(data, ends)
        queue, apart = list(places), set()
        heapq.heapify(queue)
        while queue:
            r = heapq.heappop(queue)
            at = np.array(places.pop(r))
            at = at[rank[at] == r]  # else a neighbour has changed since
            if not len(at):
                continue
            at.sort()
            right = after[at]
            shared = right[:-1] == at[1:]
            if shared.any():  # of a run of overlapping pairs every other one, from the left
                each = np.arange(len(at))
                first = np.maximum.accumulate(np.where(np.append(True, ~shared), each, 0))
                chosen = (each - first) % 2 == 0
                at, right = at[chosen], right[chosen]
            far = after[right]
            beside = tokens[far]
            tokens[at] = r
            after[at] = far
            before[far] = at
            left = before[at]
            tokens[right] = nowhere
            rank[right] = rank[at] = rank[left] = nowhere
            touched, made = [], []
            follow = self._found(self.after, r, tokens[far])
            if follow is not None:
                rank[at] = follow
                touched, made = at[follow >= 0].tolist(), follow[follow >= 0].tolist()
                if len(at) > 1:  # the neighbour as it was when this pair merged
                    then = self._found(self.after, r, beside)
                    early = at[(then >= 0) & (then <= r)]
                    touched, made = touched + early.tolist(), made + then[(then >= 0) & (then <= r)].tolist()
            lead = self._found(self.before, r, tokens[left])
            if lead is not None:
                new = (lead >= 0) & (tokens[left] != r)  # two new neighbours: found above
                rank[left[new]] = lead[new]
                touched, made = touched + left[new].tolist(), made + lead[new].tolist()
            for place, becomes in zip(touched, made, strict=True):
                if becomes <= r:  # that merge comes before the rest of these: such words are merged alone
                    word = int(np.searchsorted(ends, place, "right"))
                    apart.add(word)
                    rank[ends[word - 1] if word else 0 : ends[word]] = nowhere
                elif becomes in places:
                    places[becomes].append(place)
                else:
                    places[becomes] = [place]
                    heapq.heappush(queue, becomes)
        alive = tokens[:n] >= 0
        ids, upto = list(map(self.numbers.__getitem__, tokens[:n][alive].tolist())), np.concatenate(([0], np.cumsum(alive)[ends - 1])).tolist()
        merged = [tuple(ids[i:j]) for i, j in zip(upto, upto[1:], strict=False)]
        for word in apart:
            merged[word] = self.merge_alone(parts[word])
        rest = iter(merged)
        return [(r,) if r is not None else next(rest) for r in whole]

    def merge_alone(self, word: bytes) -> tuple[int, ...]:
        """The tokens of one word: always the pair of lowest rank, then the leftmost, by a queue of pairs."""
        n = len(word)
        parts, after, before = [word[i : i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n and (r := self.ranks.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(queue, (r, i, parts[i], parts[after[i]]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            if parts[i] != a or after[i] >= n or parts[after[i]] != b:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = a + b, b"", after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return tuple(self.ranks[p] for p in parts if p)

    def encode(self, texts: Iterable[str]) -> list[list[int]]:
        """The ids of every text. Words met before come from a cache of bounded size."""
        seen, cache = {}, self.cache
        split = [list(map(seen.setdefault, words, words)) for words in map(self.words, texts)]  # one string for each word
        new = [word for word in seen if word not in cache]
        for start in range(0, len(new), REPLAY_WORDS):
            part = new[start : start + REPLAY_WORDS]
            cache.update(zip(part, self.replay([w.encode() for w in part]), strict=True))
        ids = [list(chain.from_iterable(map(cache.__getitem__, words))) for words in split]
        if len(cache) > CACHE_WORDS:  # the words met first are the frequent ones
            for word in new:
                del cache[word]
        else:
            for word in new:
                if len(word) > 64:
                    del cache[word]
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Vocabulary:
    """Ranks as they are sent to executors; a worker keeps one coder, and its cache, between tasks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._coder: MergeReplay | None = None

    def coder(self) -> MergeReplay:
        if self._coder is None:
            self._coder = MergeReplay(self.ranks)
        return self._coder


def encode_documents(
    docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", ids: bool = True
) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``.

    The ranks (a vocabulary file of some MB) go to each executor once, as a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def make():
        coder = shared.value.coder()
        decimal = coder.decimal.__getitem__
        sha = lambda b: hashlib.sha256(b).hexdigest()

        def work(columns):
            encoded = coder.encode(columns[1])
            out = [
                columns[0],
                list(map(len, encoded)),
                [sha(",".join(map(decimal, x)).encode()) for x in encoded],
                [sha(coder.decode(x)) for x in encoded],
            ]
            return out + [encoded] * ids

        return work

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), schema, make)


def op1_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = public_tokenizers.path(VOCABULARY)) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), read_ranks(vocabulary), ids=False)
