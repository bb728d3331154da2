"""Near duplicates by SimHash, compared as bit planes.

Fingerprints that differ in at most three bits link. Equal texts share one fingerprint and are
carried as one from there on. Candidates meet without a cross join: the 64 bits fall into four
blocks, and two linked fingerprints agree on one block at least; the other 48 bits fall into
four again, so they agree on one of 16 masks of 28 bits. A bucket of a mask with more than
``MAX_BUCKET`` distinct fingerprints is split by the same rule as often as needed (to 37, 44, 49
and 53 bits, where 2**12 fingerprints are all there can be), so no link is lost. Inside a bucket, fingerprints lie
vertically, one machine word holding one bit of 64 of them; carry-save counters add up the
differences of 64 fingerprints at a time, and a block is abandoned once all its lanes exceed the
radius. A bucket sends out links to its local roots only, never all pairs; components are then
found by alternating star contraction on the cluster.

Defined results: null and empty texts have fingerprint zero, linked like any other; repeated
rows give equal rows; a null id never becomes a component id unless no other id is there; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm import resemblance
from adit.llm.common import checkpointed, free_name, map_rows, table, text_of

RADIUS = 3
SHINGLE = 3
SEED = 42
MAX_BUCKET = 4096
MOST_LEVELS = 6  # leaves 12 bits free at most, so 4096 distinct fingerprints in a bucket
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = (np.arange(8) * 256)[None, :]
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, shingle: int = SHINGLE, seed: int = SEED) -> bytes:
    """The hashes of a text's shingles in order, eight bytes each (big-endian)."""
    words = text.encode().lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return b""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    return b"".join([xxhash.xxh64_digest(joined[s:e], seed) for s, e in zip(starts.tolist(), last, strict=False)])


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text, as a signed integer."""
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprint_of(hashes: bytes) -> int:
    """The SimHash of shingles with these hashes."""
    octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = np.packbits(counts.ravel() * 2 > len(octets))  # none set without shingles
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` for every row."""

    def make():
        return lambda columns: [columns[0], list(map(fingerprint, columns[1]))]

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return map_rows(rows, "doc_id long, fp long", make)


def masks(level: int) -> list[int]:
    """The 4**level masks: at each level one of four pieces of the bits that are still free."""
    found = [0]
    for _ in range(level):
        deeper = []
        for mask in found:
            free = [b for b in range(64) if not mask >> b & 1]
            for piece in np.array_split(free, 4):
                deeper.append(mask | sum(1 << int(b) for b in piece))
        found = deeper
    return [m - (1 << 64) if m >> 63 else m for m in found]


def linked_lanes(fps: np.ndarray, first: np.ndarray, end: np.ndarray, radius: int = RADIUS, items: int = 1 << 15):
    """Yield index pairs (i, j), i < j < end[i], of fingerprints at most ``radius`` <= 3 bits apart.

    ``fps`` holds buckets one after another; ``first`` and ``end`` give each lane's bucket.
    """
    n = len(fps)
    words = (n + 63) // 64
    lanes = np.zeros(words * 64, np.uint64)
    lanes[:n] = fps
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)  # (64, words)
    own = np.where(bits[:n].T.astype(bool), _ALL, np.uint64(0))  # (64, n): a query's bit in all lanes
    word_from, word_to = (np.arange(n) + 1) // 64, (end - 1) // 64
    each = np.where(end > np.arange(n) + 1, word_to - word_from + 1, 0)
    upto = np.cumsum(each)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + items, "right")))
        count = each[start:stop]
        q = np.repeat(np.arange(start, stop), count)
        w = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(word_from[start:stop], count)
        start = stop
        if not len(q):
            continue
        low = np.clip(q + 1 - w * 64, 0, 63).astype(np.uint64)
        high = np.clip(end[q] - w * 64, 1, 64).astype(np.uint64)
        over = ~((_ALL << low) & (_ALL >> (np.uint64(64) - high)))  # lanes that don't count have exceeded already
        ones = np.zeros(len(q), np.uint64)
        twos = np.zeros(len(q), np.uint64)
        for p in range(64):
            x = planes[p, w] ^ own[p, q]
            carry = ones & x
            ones ^= x
            over |= twos & carry
            twos ^= carry
            if radius < 3:
                over |= twos if radius == 1 else twos & ones if radius == 2 else ones | twos
            if p % 8 == 7 and p < 63:
                live = over != _ALL
                if not live.all():
                    q, w, ones, twos, over = q[live], w[live], ones[live], twos[live], over[live]
                    if not len(q):
                        break
        if len(q):
            hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            item, lane = np.nonzero(hit)
            yield q[item], w[item] * 64 + lane


def local_roots(n: int, pairs) -> np.ndarray:
    """The smallest index of each index's component."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            low, high = np.minimum(ra, rb)[differ], np.maximum(ra, rb)[differ]
            np.minimum.at(root, high, low)
            while True:
                deeper = root[root]
                if (deeper == root).all():
                    break
                root = deeper
    return root


def _bucket_links(radius: int):
    def make():
        def work(columns):
            sizes = np.fromiter(map(len, columns[0]), np.int64, len(columns[0]))
            signed = np.fromiter((x for bucket in columns[0] for x in sorted(bucket)), np.int64, sizes.sum())
            ends = np.repeat(np.cumsum(sizes), sizes)
            firsts = np.repeat(np.cumsum(sizes) - sizes, sizes)
            root = local_roots(len(signed), linked_lanes(signed.view(np.uint64), firsts, ends, radius))
            other = root != np.arange(len(root))
            return [signed[other].tolist(), signed[root[other]].tolist()]

        return work

    return make


def links(distinct: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET, fp: str = "fp") -> DataFrame:
    """Links ``a, b`` (a != b) that connect all distinct fingerprints within ``radius`` of each other."""
    found, level = None, 2
    keyed = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("path"), F.col(fp).bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks(2))])).alias("k"),
        F.col(fp).alias("fp"),
    ).select("k.path", "k.bits", "fp")
    while True:
        shared = keyed.groupBy("path", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = checkpointed(keyed.join(shared, ["path", "bits"]))
        small = F.lit(level >= MOST_LEVELS) | (F.col("n") <= max_bucket)
        cold = members.where(small).groupBy("path", "bits").agg(F.collect_list("fp").alias("fps"))
        here = map_rows(cold.select("fps"), "a long, b long", _bucket_links(radius), chars=400_000)
        found = here if found is None else found.unionByName(here)
        hot = members.where(~small)
        if hot.isEmpty():
            return found.distinct()
        level += 1
        deeper = F.array(*map(F.lit, masks(level)))
        keyed = hot.select(F.col("path"), "fp", F.explode(F.array(*map(F.lit, range(4)))).alias("piece")).select(
            (F.col("path") * 4 + F.col("piece")).alias("path"), "fp"
        )
        keyed = keyed.select("path", F.col("fp").bitwiseAND(F.element_at(deeper, F.col("path") + 1)).alias("bits"), "fp")
        keyed = keyed.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); the root is the component's smallest node.

    Alternating large-star and small-star contraction: each round is two aggregations and two
    joins over the links that are left, and the number of rounds grows with the logarithm of
    the longest chain.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        out = both.join(low, "a")
        if large:
            out = out.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    summary = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    edges, before = checkpointed(edges.select("a", "b")), None
    while True:
        now = tuple(edges.agg(*summary).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges, before = checkpointed(star(star(edges, True), False)), now


def classes_of(rows: DataFrame, radius: int = RADIUS, more: DataFrame | None = None) -> DataFrame:
    """``fp, least, root`` for every fingerprint of ``rows`` (doc_id, fp); least is its smallest id.

    ``more``: further links ``a, b`` between fingerprints.
    """
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = links(distinct.select("fp"), radius)
    roots = components(found if more is None else found.unionByName(more))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return checkpointed(classes.select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row: ``doc_id, fp, component_id``, the smallest id reachable over links."""
    rows = checkpointed(fingerprints(docs, id_col, text_col))
    classes = classes_of(rows, radius)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = classes.join(least, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, alike: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (null last).

    With ``alike``, texts also link where their five-word shingles are alike by 0.8 (see ``resemblance``).
    Ids may be null or repeat: a row is known by its id and the digest of its text, and of one id's
    texts in a component the one with the smallest digest stays. Rows that repeat both are one
    document seen again; one of them stays.
    """
    keyed = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    keyed = keyed.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))

    def make():
        def work(columns):
            hashes = list(map(shingle_hashes, columns[1]))
            signed = [resemblance.signature(np.frombuffer(h, ">u8").astype(np.uint64)) if alike else None for h in hashes]
            return [columns[0], columns[2], list(map(fingerprint_of, hashes)), signed]

        return work

    rows = checkpointed(map_rows(keyed, "doc_id long, digest string, fp long, signature binary", make))
    more = resemblance.links(rows.select(F.col("fp").alias("node"), "signature")) if alike else None
    classes = classes_of(rows.select("doc_id", "fp"), radius, more)
    # one candidate a fingerprint, then one a component: both combine in each task
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    of_fp = rows.groupBy("fp").agg(F.min(first).alias("first"))
    stay = of_fp.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
    digest, of_id, of_digest = (free_name(docs, n) for n in ("digest_of_text", "staying", "staying_digest"))
    stay = checkpointed(stay.select(F.col("first.doc_id").alias(of_id), F.col("first.digest").alias(of_digest)))
    tagged = docs.withColumn(digest, F.sha2(text_of(text_col).cast("binary"), 256))
    kept = tagged.join(stay, (tagged[digest] == stay[of_digest]) & tagged[id_col].eqNullSafe(stay[of_id]), "left_semi")
    if not rows.groupBy("doc_id", "digest").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)


def as_hex(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp) if isinstance(fp, str) else fp), 16, "0"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")
