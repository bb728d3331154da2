"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only on a single machine (as in tests) may it be unset; a temporary folder then takes its place.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="adit-checkpoint-")
    return folder


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, wherever it is stored."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs run within it send rows to Python in Arrow batches of about ``size`` (one row at least)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)  # None: not set, Spark's own 64 MB
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(
    df: DataFrame, schema: str, make: Callable[[], Callable[[list[list]], Iterable[list]]], chars: int = 4_000_000
) -> DataFrame:
    """Run Python over batches of ``df`` that hold about ``chars`` characters of strings.

    ``make()`` builds, once in each task, a function from columns (lists) to the output columns
    (lists of equal length). One very long text makes a batch of its own.
    """
    arrow = pa.schema([_field(x) for x in schema.split(",")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in _slices(batch, chars):
                out = work([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``chars`` bytes, by its mean row size."""
    rows = batch.num_rows
    if rows:
        step = max(1, int(chars * rows / max(1, batch.nbytes)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def _field(declared: str) -> pa.Field:
    name, kind = declared.split()
    return pa.field(name, _ARROW[kind])
