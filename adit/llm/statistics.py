"""Statistics of whole texts that quality rules and the quality classifier read."""

from __future__ import annotations

from collections import Counter
from itertools import repeat
from operator import eq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.llm.common import map_rows, text_of

WINDOW = 3
SYMBOLS = b"#*$%&|<>"
NAMES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_equal_next",
    "n_upper",
    "n_marks",
    "n_digits",
    "n_same_end",
)
SCHEMA = "doc_id long, " + ", ".join(f"{n} long" for n in NAMES)
_UPPER, _DIGITS, _MARKS, _LETTERS = bytes(range(65, 91)), bytes(range(48, 58)), b"!?|", bytes([*range(65, 91), *range(97, 123)])


def _count(data: bytes, kinds: bytes) -> int:
    return len(data) - len(data.translate(None, kinds))


def statistics(text: str) -> list[int]:
    """The values of ``NAMES``. Words are runs without ASCII white space; lines split at newlines.

    ``n_repeat_words`` counts words inside 3-word windows that stand twice or more in the text;
    ``n_same_end`` counts the commonest last character of words, unless it is a letter.
    """
    data = text.encode()
    words = data.split()
    n = len(words)
    spaces = _count(data, b" \t\n\r\x0b\x0c")
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        marked = bytearray(n)
        for at, window in enumerate(windows):
            if times[window] > 1:
                marked[at : at + WINDOW] = b"\1\1\1"
        repeated = sum(marked)
    ends = Counter(w[-1] for w in words)
    tail = max((c for b, c in ends.items() if b < 128 and b not in _LETTERS), default=0)
    return [
        n,
        len(text) - spaces,
        _count(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(set(words)),
        sum(map(eq, words, words[1:])),
        _count(data, _UPPER),
        _count(data, _MARKS),
        _count(data, _DIGITS),
        tail,
    ]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """``doc_id``, ``NAMES`` and, if named, an integer column for every row; a null text counts as empty."""

    def make():
        def work(columns):
            rows = list(map(statistics, columns[1]))
            return [columns[0], *(map(list, zip(*rows, strict=True)) if rows else repeat([], len(NAMES))), *columns[2:]]

        return work

    more = [F.col(keep).cast("int").alias(keep)] if keep else []
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), *more), SCHEMA + (f", {keep} int" if keep else ""), make)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` documents with a label (0 or 1), by hash of the id.

    ``most`` bounds the rows that are fitted on: of several texts under one id the one with the least
    hash counts. The ids of the sample (at most ``most`` rows) are broadcast.
    """
    chosen = labels.where(F.col(label).isin(0, 1)).groupBy(id_col).agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(most).select(F.col(id_col).alias("labelled_id"), F.col("label").alias("labelled_as"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("text"))
    joined = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).withColumn("hash", F.xxhash64("text"))
    # ids and hashes alone are grouped; texts move only where rows repeat
    each = joined.groupBy("doc_id").agg(F.min("hash").alias("least"), F.count(F.lit(1)).alias("n"))
    repeated = each.where("n > 1").select(F.col("doc_id").alias("again"), "least")
    if repeated.isEmpty():
        return joined.select("doc_id", "text", F.col("labelled_as").alias("label"))
    apart = joined.join(F.broadcast(repeated), F.col("doc_id") == F.col("again"), "left")
    one = apart.where(F.col("hash") == F.col("least")).groupBy("doc_id", "labelled_as").agg(F.min("text").alias("text"))
    return apart.where(F.col("least").isNull()).select("doc_id", "text", "labelled_as").unionByName(one).withColumnRenamed("labelled_as", "label").select("doc_id", "text", "label")
