"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written
from .components import connected_components
from .groups import Union, sorted_groups


def _planes(dimensions: int, n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, dimensions])).standard_normal((dimensions, n))


def near_duplicate_vectors(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = 0.95,
    bits: int | None = None,
    tables: int | None = None,
    miss: float = 1 / 600,
    block: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """One row per id: n_links (other vectors of cosine >= threshold), component_id, kept.

    Two vectors meet where the signs of their products with `bits` random hyperplanes agree in one of
    `tables` tables. By default bits grow with the logarithm of the number of vectors, so that the buckets
    of unlike vectors stay small, and the tables are as many as miss a pair at the threshold with
    probability `miss`, closer pairs far less (50,000 vectors at 0.95: 16 bits, 32 tables). Every pair that meets is verified in double precision,
    and counted in the first table where it meets. Equal vectors are one class with a weight. Buckets of
    more than `block` vectors are cut into blocks and verified by pairs of blocks in tasks of their own;
    a task gives sums and a spanning forest, not pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
    of different length are not compared. Rows that repeat an id are one vector, the first by value;
    rows without an id are left out; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    number = "float" if embeddings.schema[vector_column].dataType.simpleString() == "array<float>" else "double"  # floats move as they are
    rows = embeddings.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("id")).agg(F.min(F.col(vector_column).cast(f"array<{number}>")).alias("v"))
    sound = F.size("v") > 0
    sound = sound & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    valid = rows.where(F.coalesce(sound, F.lit(False)))
    classes, _ = written(valid.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    members = valid.join(classes, "v").select("id", "rep", "n")
    bits = bits or min(31, max(8, (classes.count() - 1).bit_length()))
    tables = tables or int(np.ceil(np.log(miss) / np.log1p(-((1 - np.arccos(threshold) / np.pi) ** bits))))

    def codes(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            out = np.zeros((len(vectors), tables), np.int64)
            lengths = np.array([len(v) for v in vectors])
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                signs = np.array([vectors[i] for i in at]) @ _planes(int(d), bits * tables, seed) > 0
                out[at] = signs.reshape(len(at), tables, bits) @ (1 << np.arange(bits)) + (int(d) << bits)
            marks = [row.tobytes() for row in (out & ((1 << bits) - 1)).astype(np.uint32)]
            yield pa.record_batch([batch.column(0), pa.array(out.tolist(), pa.list_(pa.int64())), pa.array(marks, pa.binary())], names=["rep", "codes", "marks"])

    coded, codes_path = written(classes.select("rep", "v").mapInArrow(codes, "rep long, codes array<long>, marks binary"), "codes")
    placed = coded.select("rep", F.posexplode("codes").alias("tab", "code"))
    buckets = placed.groupBy("tab", "code").agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    met = placed.join(buckets.hint("merge"), ["tab", "code"]).withColumn("own", F.pmod(F.xxhash64("rep", "tab"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.withColumn("other", other).select("tab", "code", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "rep")
    # exploded rows look small to the planner: the hints keep them from being broadcast
    full = met.hint("merge").join(coded.select("rep", "marks"), "rep").join(classes, "rep").select("tab", "code", "a", "b", "own", "rep", "n", "marks", "v")
    keys = ["tab", "code", "a", "b"]

    def verify(batches):
        for group in sorted_groups(batches, 4):
            if group.num_rows < 2:
                continue
            tab, a, b = group["tab"][0].as_py(), group["a"][0].as_py(), group["b"][0].as_py()
            own, rep, weight = (group[c].to_numpy() for c in ("own", "rep", "n"))
            x = group["v"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1).astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            marks = np.frombuffer(b"".join(group["marks"].to_pylist()), np.uint32).reshape(group.num_rows, -1)[:, :tab]
            linked = x @ x.T >= threshold
            linked &= (own[:, None] != own[None, :]) if a != b else ~np.eye(len(own), dtype=bool)
            i, j = np.nonzero(np.triu(linked, 1))
            if len(i) and tab:
                new = np.ones(len(i), bool)
                for t in range(tab):
                    new &= marks[i, t] != marks[j, t]
                i, j = i[new], j[new]
            if len(i) == 0:
                continue
            degree = np.bincount(i, weight[j], len(rep)) + np.bincount(j, weight[i], len(rep))
            union = Union(len(rep))
            for p, q in zip(i.tolist(), j.tolist()):
                union.join(p, q)
            touched = np.flatnonzero(degree)
            yield pa.record_batch(
                [pa.array(rep[touched]), pa.array(degree[touched].astype(np.int64)), pa.array(rep[union.roots()[touched]])], names=["rep", "degree", "root"]
            )

    links = full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "rep long, degree long, root long")
    links, _ = written(links, "links")
    drop_written(spark, codes_path)
    degrees = links.groupBy("rep").agg(F.sum("degree").alias("degree"))
    parts = connected_components(links, "rep", "root").toDF("rep", "component")
    told = members.join(degrees, "rep", "left").join(parts, "rep", "left").select(
        F.col("id"), (F.col("n") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    return rows.select("id").join(told, "id", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        (F.coalesce("component", "id") == F.col("id")).alias("kept"),
    )
