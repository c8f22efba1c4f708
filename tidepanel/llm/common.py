"""What the operators share: table access, the shared folder, and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .groups import sorted_groups


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, a new one in local mode, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-shared-"))
    return sc.getCheckpointDir()


_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)  # tables of the innermost intermediates()


@contextmanager
def intermediates() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written inside, so that their owner can drop them, and no others, once nothing reads them."""
    token = _made.set([])
    try:
        yield _made.get()
    finally:
        _made.reset(token)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write df as Parquet into the shared folder and read it back, which cuts its lineage.

    Returns the reread frame and its path, for drop_written once nothing needs it any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _made.get() is not None:
        _made.get().append(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, *paths: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        p = hadoop(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """name, or with as many underscores behind it as make it differ from the columns of df."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def membership_place(column: str, log_bits: int = 24) -> Column:
    """The bit of a value in a bit map of membership_bits."""
    return F.pmod(F.xxhash64(column), F.lit(1 << log_bits))


def bit_map(places: DataFrame, column: str, log_bits: int) -> np.ndarray:
    """A map of 2**log_bits bits that has the bits named in a column of places; tasks fill 64 Ki bits each."""

    def fill(batches):
        for group in sorted_groups(batches, 1):
            bits = np.zeros(1 << 16, np.uint8)
            bits[group["bit"].to_numpy()] = 1
            yield pa.record_batch([pa.array([group["shard"][0].as_py()]), pa.array([np.packbits(bits, bitorder="little").tobytes()])], names=["shard", "bits"])

    place = F.col(column)
    rows = places.select(F.shiftright(place, 16).alias("shard"), place.bitwiseAND(0xFFFF).alias("bit")).distinct()
    out = np.zeros((1 << log_bits) // 8, np.uint8)
    for row in rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(fill, "shard long, bits binary").toLocalIterator():
        out[row["shard"] << 13 : (row["shard"] + 1) << 13] = np.frombuffer(row["bits"], np.uint8)
    return out


def membership_bits(ids: DataFrame, column: str, log_bits: int = 24) -> np.ndarray:
    """A bit map of 2**log_bits bits, 2 MiB by default whatever the table's size, that has the bit of every value.

    Other values may share a bit, so the map only rules out.
    """
    return bit_map(ids.select(membership_place(column, log_bits).alias("place")), "place", log_bits)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(divisor))
