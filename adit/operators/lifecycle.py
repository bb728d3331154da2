"""Keeping stored tables in shape: pruning, dimension snapshots, partitions that age, schema state."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.operators.alerts import dimension
from adit.operators.versions import Store


def pruned(facts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rows of configured tunnels."""
    return facts.join(dimension(profiles.select("tunnel_id").distinct()), "tunnel_id", "left_semi")


def prune_counts(facts: DataFrame, profiles: DataFrame) -> DataFrame:
    known = dimension(profiles.select("tunnel_id").distinct().withColumn("_known", F.lit(True)))
    rows = facts.join(known, "tunnel_id", "left")
    return rows.agg(F.count_if(F.col("_known").isNotNull()).alias("keep"), F.count_if(F.col("_known").isNull()).alias("purge"))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exchange(spark: SparkSession, kept: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``kept``: written aside, then swapped by two renames."""
    fs, target = _fs(spark, path)
    _, aside = _fs(spark, f"{path}__keep")
    _, old = _fs(spark, f"{path}__old")
    kept.write.mode("overwrite").parquet(f"{path}__keep")
    fs.rename(target, old)
    fs.rename(aside, target)
    fs.delete(old, True)


def pruned_store(store: Store, part: str, schema: str, profiles: DataFrame, time: str) -> int:
    """Keep rows of configured tunnels only, in one commit: readers see the table before it or after it."""
    number, manifest, _ = store.current()
    kept = pruned(store.read(part, schema, manifest=manifest), profiles)
    return store.commit({part: kept.withColumn("day", F.date_format(time, "yyyy-MM-dd"))}, whole=True, after=number)


def synced(stored: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """A dimension after loading ``given``: its rows as they are now; rows of others are gone."""
    before = stored.join(given.select(*keys), keys, "left_semi")
    if "updated_at" not in given.columns:
        return given
    both = before.select(*given.columns).unionByName(given)
    rest = [c for c in given.columns if c not in keys]
    newest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "updated_at").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*given.columns)


def partitions(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The day partitions of a stored table: (day, path), from the folder alone."""
    fs, root = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted((n[4:], f"{path}/{n}") for n in names if n.startswith("day="))


def age(spark: SparkSession, path: str, cold: str, today: str, move_after: int, delete_after: int) -> tuple[list[str], list[str]]:
    """Move day partitions older than ``move_after`` days to ``cold``; delete those beyond ``delete_after``."""
    from datetime import date

    now, moved, deleted = date.fromisoformat(today), [], []
    for where in (path, cold):
        fs, root = _fs(spark, where)
        if not fs.exists(root):
            fs.mkdirs(root)
        for day, folder in partitions(spark, where):
            days = (now - date.fromisoformat(day)).days
            _, source = _fs(spark, folder)
            if days > delete_after:
                fs.delete(source, True)
                deleted.append(day)
            elif where == path and days > move_after:
                _, target = _fs(spark, cold)
                fs.mkdirs(target)
                _, goal = _fs(spark, f"{cold}/day={day}")
                fs.rename(source, goal)
                moved.append(day)
    return moved, deleted


def checksum(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def to_apply(state: DataFrame, files: dict[str, str]) -> list[str]:
    """Names of the files whose content differs from what was applied last."""
    newest = {r["name"]: r["checksum"] for r in state.groupBy("name").agg(F.max_by("checksum", "applied_at").alias("checksum")).collect()}
    return [name for name, text in files.items() if newest.get(name) != checksum(text)]
