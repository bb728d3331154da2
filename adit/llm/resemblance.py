"""Texts whose sets of five-word shingles are alike, found from signatures of minima.

A signature keeps, for each of ``SIZE`` = 128 orders of all shingles, 16 bits of the text's first
shingle. Two texts agree in each place with the probability of their Jaccard similarity; they link
where at least ``AGREE`` = 97 places agree. So a pair of similarity 0.8 links with probability 0.90, one
of 0.85 with 0.99 and one of 0.6 with less than 1 in 1,000: the rule is an estimate, the search for
pairs that meet it is exact. Signatures with 31 differing places or fewer agree on all four places of one of the 32
pieces, so linked ones meet under that piece. A piece that more than ``MAX_BLOCK`` signatures share is
cut into blocks, and each two blocks meet in a task of their own: no task holds more than two.
Sets of signatures that meet under several pieces are compared once. A task sends out links
to the roots of what it finds linked, never all pairs.

Defined results: fewer than five words are one shingle; a text without words has no signature and no
links here; equal signatures are one from the start.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, map_rows

SIZE, PLACES = 128, 4
PIECES = SIZE // PLACES
AGREE = SIZE - PIECES + 1
MAX_BLOCK = 4096
_DRAWN = np.random.default_rng(5).integers(0, 1 << 64, (2, SIZE, 1), dtype=np.uint64)
_TIMES, _PLUS = _DRAWN[0] | np.uint64(1), _DRAWN[1]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(48)


def signature(threes: np.ndarray) -> bytes | None:
    """The signature of a text, from the 64-bit hashes of its three-word shingles in order.

    The shingles at i and at i + 2 are the five words from i on; of a text of three or four words
    there is one or two, of a shorter one that of the whole.
    """
    if not len(threes):
        return None
    apart = min(2, len(threes) - 1)
    fives = threes[: len(threes) - apart] * _MIX ^ np.roll(threes, -apart)[: len(threes) - apart]
    fives = (fives ^ fives >> np.uint64(32)) * _MIX
    least = np.full(SIZE, ~np.uint64(0))
    for start in range(0, len(fives), 1024):
        np.minimum(least, (fives[None, start : start + 1024] * _TIMES + _PLUS).min(1), out=least)
    return ((least * _MIX) >> _TOP).astype(np.uint16).tobytes()


def linked_to(signatures: np.ndarray, agree: int = AGREE) -> np.ndarray:
    """For each row the first row of its component; a row that is reached is not compared again."""
    root, left = np.full(len(signatures), -1), np.arange(len(signatures))
    while len(left):
        first, left = left[0], left[1:]
        root[first], queue = first, [first]
        while queue and len(left):
            near = (signatures[left] == signatures[queue.pop()]).sum(1) >= agree
            root[left[near]] = first
            queue += left[near].tolist()
            left = left[~near]
    return root


def _block_links():
    def work(columns):
        found = ([], [])
        for packed in columns[0]:
            rows = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 8 + 2 * SIZE)
            nodes = np.ascontiguousarray(rows[:, :8]).view(">i8")[:, 0]
            root = nodes[linked_to(np.ascontiguousarray(rows[:, 8:]).view(np.uint16))]
            other = nodes != root
            found[0].extend(nodes[other].tolist())
            found[1].extend(root[other].tolist())
        return found

    return work


def _keys():
    def work(columns):
        ids = np.repeat(np.array(columns[0], np.int64), PIECES)
        pieces = np.frombuffer(b"".join(columns[1]), np.uint64).reshape(-1, PIECES)
        keys = (pieces + np.arange(PIECES, dtype=np.uint64) * _MIX) * _MIX
        return [ids, (keys ^ keys >> np.uint64(29)).view(np.int64).ravel()]

    return work


def links(rows: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """Links ``a, b`` that connect the nodes of all texts that are alike.

    ``rows``: node (long), signature (binary or null). Texts of one node count as connected.
    """
    rows = rows.where("signature is not null").withColumn("sid", F.xxhash64("signature"))
    named = checkpointed(rows.groupBy("sid").agg(F.min("node").alias("node"), F.max("node").alias("last"), F.first("signature").alias("signature")))
    same = rows.join(named.where("node < last").select("sid", F.col("node").alias("b")), "sid").where("node <> b").select(F.col("node").alias("a"), "b")
    keyed = map_rows(named.select("sid", "signature"), "sid long, key long", lambda: _keys()).repartition("key")  # counted and joined where it lies
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keyed.join(shared, "key").withColumn("blocks", F.ceil(F.col("n") / max_block).cast("int"))
    own = F.pmod(F.xxhash64("sid", F.lit(1)), F.col("blocks")).cast("int")
    members = members.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = members.groupBy("key", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high")).agg(F.array_sort(F.collect_list("sid")).alias("sids"))
    met = met.where(F.size("sids") > 1).groupBy(F.xxhash64("sids").alias("block")).agg(F.first("sids").alias("sids"))
    met = checkpointed(met).select("block", F.explode("sids").alias("sid"))
    packed = F.concat(F.unhex(F.lpad(F.hex("node"), 16, "0")), "signature").alias("packed")
    sets = met.join(named.select("sid", packed), "sid").groupBy("block").agg(F.collect_list("packed").alias("packed")).select("packed")
    return map_rows(sets, "a long, b long", lambda: _block_links()).unionByName(same).distinct()
