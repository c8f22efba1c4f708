"""Table maintenance: reading with a declared schema, keep-last upserts, merging and promotion, writing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table, or no rows of the declared schema where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or one without a file
            raise
        return spark.createDataFrame([], schema)


def keep_last(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of frames with one row per key: the one of the latest frame, within it the largest row."""
    tagged = [f.withColumn("_order", F.lit(i)) for i, f in enumerate(frames)]
    rows = tagged[0]
    for f in tagged[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in keys and c != "_order"]
    last = Window.partitionBy(*keys).orderBy(F.col("_order").desc(), *[F.col(c).desc() for c in rest])
    return rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_order", "_rank")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, a new one in local mode, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-shared-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """df written into the shared folder and read again, which cuts its lineage, and its path."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _filesystem(spark, path)
        fs.delete(p, True)


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_bytes(spark: SparkSession, path: str) -> int:
    """The size of the files at path."""
    fs, target = _filesystem(spark, path)
    return fs.getContentSummary(target).getLength()


def replace_table(df: DataFrame, path: str) -> None:
    """Write df beside the table at path and move it into place, so that no reader finds half a table.

    Between the two moves there is no table at path for a moment. A run that ends then leaves the whole new
    table beside the path; recover_table finishes it.
    """
    spark = df.sparkSession
    fs, target = _filesystem(spark, path)
    new, old = target.suffix(f".new-{uuid.uuid4().hex}"), target.suffix(f".old-{uuid.uuid4().hex}")
    df.write.parquet(new.toString())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(new, target):
        raise OSError(f"can't move the new table to {path}")
    fs.delete(old, True)


def recover_table(spark: SparkSession, path: str) -> bool:
    """Move a whole table that replace_table left beside a missing path into its place; whether there was one."""
    fs, target = _filesystem(spark, path)
    if fs.exists(target) or not fs.exists(target.getParent()):
        return False
    success = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(target.getParent()):
        p = status.getPath()
        if p.getName().startswith(f"{target.getName()}.new-") and fs.exists(success(p, "_SUCCESS")):
            return bool(fs.rename(p, target))
    return False


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], declared: StructType | None = None) -> None:
    """Replace the table at path by its keep-last union with new rows; with a declared schema, by its columns only."""
    recover_table(spark, path)
    old = read_or_empty(spark, path, new.schema)
    if declared is not None:
        old, new = (conform(f, declared) for f in (old, new))
    replace_table(keep_last([old, new], keys), path)


def conform(df: DataFrame, declared: StructType) -> DataFrame:
    """The declared columns in order and type; those that df lacks are null, others go."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared.fields])


def upsert_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """A writer that upserts each micro-batch: late and repeated rows replace the earlier ones of their keys, so a batch may run twice."""
    return stream.writeStream.foreachBatch(lambda batch, _: upsert(batch.sparkSession, path, batch, keys)).option("checkpointLocation", checkpoint)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, timestamps: str = "yyyy-MM-dd") -> DataFrame:
    """A CSV with a header; what cannot be read as its type is null."""
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", timestamps).option("dateFormat", timestamps).option("mode", "PERMISSIVE").csv(path)


def shared_columns(spark: SparkSession, paths: list[str]) -> list[str]:
    """The columns that all the tables have, with one type, in the order of the first; only footers are read."""
    schemas = [{f.name: f.dataType for f in spark.read.parquet(p).schema.fields} for p in paths]
    return [name for name, kind in schemas[0].items() if all(s.get(name) == kind for s in schemas[1:])] if schemas else []


def write_zstd(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def oversized(spark: SparkSession, path: str, file_bytes: int, total_bytes: int) -> list[str]:
    """The files above file_bytes, and the path itself where all together are above total_bytes."""
    fs, target = _filesystem(spark, path)
    files, found, total = fs.listFiles(target, True), [], 0
    while files.hasNext():
        status = files.next()
        total += status.getLen()
        if status.getLen() > file_bytes:
            found.append(status.getPath().getName())
    return sorted(found) + ([path] if total > total_bytes else [])


def promote(rows: DataFrame, universe: DataFrame | None, columns: list[str], always: str | None = None) -> DataFrame:
    """The declared columns of rows in the universe, and of the one id that always stays; missing columns are an error."""
    missing = set(columns) - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    if universe is not None:
        inside = rows.join(universe, "stock_id", "left_semi")
        rows = inside if always is None else inside.unionByName(rows.where(F.col("stock_id").cast("string") == always).join(universe, "stock_id", "left_anti"))
    return rows.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
