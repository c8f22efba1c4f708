"""Lineage of derived tables: fingerprints of inputs, stale tables, and rows to invalidate."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of the names, lengths and times of a path's files, from the file system alone."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop):
        return "absent"
    files, found = system.listFiles(hadoop, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def stale(graph: dict[str, list[str]], stamps: dict[str, dict[str, str]], now: dict[str, str]) -> list[str]:
    """Tables never stamped, built from inputs that have changed since, or below such a table; in graph order."""
    out: list[str] = []
    for table, inputs in graph.items():
        stamp = stamps.get(table)
        if inputs and (stamp is None or any(stamp.get(i) != now.get(i) for i in inputs) or any(i in out for i in inputs)):
            out.append(table)
    return out


def invalidate(df: DataFrame, since: str, time: str = "date") -> DataFrame:
    """The rows that stay when everything from `since` on is to be rebuilt."""
    return df.where(F.col(time) < F.lit(since).cast("timestamp_ntz"))
