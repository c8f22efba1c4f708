"""Importance resampling towards a target distribution: hashed n-gram features, exact integer weights by bit planes.

A document's counts of 10,000 buckets are kept as bit planes: plane j has the j-th bit of every
count. The buckets' gains, signed integers, are planes too, of magnitudes above and below zero. The
sum of counts times gains is the sum over pairs of planes of the population count of their AND times
a power of two, which is exact.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written
from .words import text_blocks, text_bytes

_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
ORDER = 3  # words of the longest feature
_ONES = np.uint32(0xFFFFFFFF)
_LONG = 63  # bytes; n-grams with longer words are read one by one


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The table of one byte, and for n = 0.._LONG + 1 the four tables of n zero bytes appended to a state."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & np.uint32(1), (byte >> np.uint32(1)) ^ np.uint32(0xEDB88320), byte >> np.uint32(1))
    state = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    zeros = [state]
    for _ in range(_LONG + 1):
        state = byte[state & np.uint32(255)] ^ (state >> np.uint32(8))
        zeros.append(state)
    return byte, np.concatenate(zeros)


_BYTE, _ZEROS = _crc_tables()


def _append_zeros(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    base = n.astype(np.int32) << 10
    out = _ZEROS[base + (state & np.uint32(255)).astype(np.int32)]
    for k in (1, 2, 3):
        out ^= _ZEROS[base + (((state >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int32) + 256 * k)]
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of all words; rows begin new words. data is lower-case."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_APART[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def ngram_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For n = 1..ORDER the crc32 of the n-gram that begins at each word, as if all words were one row.

    A state after appended bytes is the state after as many zeros, XOR the bytes' own; so the words'
    own values are computed once, by byte positions, and joined by table look-ups.
    """
    size = ends - starts
    long = np.flatnonzero(size > _LONG)
    n = np.where(size > _LONG, 0, size)
    own = np.zeros(len(starts), np.uint32)
    at = np.flatnonzero(n > 0)
    step = 0
    while len(at):
        state = own[at]
        own[at] = _BYTE[(state & np.uint32(255)) ^ data[starts[at] + step]] ^ (state >> np.uint32(8))
        step += 1
        at = at[n[at] > step]
    spaced = own ^ _append_zeros(np.full(len(n), _BYTE[32], np.uint32), n)
    state = own ^ _append_zeros(np.full(len(n), _ONES), n)
    out = [state ^ _ONES]
    for k in range(1, ORDER):
        state = _append_zeros(state[:-1], n[k:] + 1) ^ spaced[k:] if len(n) > k else state[:0]
        out.append(state ^ _ONES)
    for i in long.tolist():
        for k in range(ORDER):
            for first in range(max(0, i - k), min(i, len(n) - k - 1) + 1):
                value = 0
                for w in range(first, first + k + 1):
                    value = zlib.crc32((b" " if w > first else b"") + data[starts[w] : ends[w]].tobytes(), value)
                out[k][first] = value
    return out


def feature_blocks(column: pa.Array, buckets: int, block: int = 1 << 18):
    """(first row, end row, words of each row, row and bucket of each feature) for the texts of a column."""
    data, offsets = text_bytes(column)
    for i, j, piece, at, seen in text_blocks(data, offsets, _APART & _APART[_LOWER], ORDER - 1, block):
        piece = _LOWER[piece]
        starts, ends, row = word_bounds(piece, at)
        rows, found = [], []
        for k, crc in enumerate(ngram_crcs(piece, starts, ends)):
            same = row[: len(crc)] == row[k:]
            same[: max(0, seen - k)] = False  # wholly in the words seen before
            rows.append(row[: len(crc)][same])
            found.append((crc % np.uint32(buckets))[same])
        yield i, j, np.bincount(row[seen:], minlength=j - i), np.concatenate(rows), np.concatenate(found)


def bucket_counts(df: DataFrame, text: str, buckets: int) -> list[int]:
    """How many features of all rows fall into each bucket; a task sends a row for each bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in feature_blocks(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = [0] * buckets
    for r in df.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of the smoothed ratio of frequencies, rounded down, for each bucket."""
    s, t, n = sum(source), sum(target), len(source)
    return [math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source, target)]


def _planes(values: np.ndarray, width: int) -> np.ndarray:
    """Bit planes of non-negative integers as rows of 64-bit words."""
    deep = max(1, int(values.max(initial=0)).bit_length())
    bits = np.zeros((deep, width * 64), np.uint8)
    for k in range(deep):
        bits[k, : len(values)] = (values >> k) & 1
    return np.packbits(bits, axis=1).view(np.uint64)


def gain_planes(gains: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The planes of the gains above and below zero, and the signed power of two of each."""
    values, width = np.array(gains, np.int64), (len(gains) + 63) // 64
    up, down = _planes(np.maximum(values, 0), width), _planes(np.maximum(-values, 0), width)
    return np.concatenate((up, down)), np.concatenate((1 << np.arange(len(up)), -(1 << np.arange(len(down)))))


def sliced_sums(counts: np.ndarray, planes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """For each row of counts the sum of counts times gains, by AND and population counts of planes."""
    rows, buckets = counts.shape
    width = planes.shape[1]
    out = np.zeros(rows, np.int64)
    at_row, at_bucket = np.nonzero(counts)
    values = counts[at_row, at_bucket]
    k = 0
    while len(values):
        used, local = np.unique(at_row, return_inverse=True)
        bits = np.zeros((len(used), width * 64), np.uint8)
        odd = (values >> k) & 1 == 1
        bits[local[odd], at_bucket[odd]] = 1
        plane = np.packbits(bits, axis=1).view(np.uint64)
        ones = np.bitwise_count(plane[:, None, :] & planes[None]).sum(axis=2, dtype=np.int64)
        out[used] += (ones @ powers) << k
        k += 1
        more = values >= 1 << k
        at_row, at_bucket, values = at_row[more], at_bucket[more], values[more]
    return out


def weighted_documents(docs: DataFrame, gains: list[int], text: str = "text", rows: int = 64) -> DataFrame:
    """The documents without their texts, with _words, _features and _weight; null texts have none."""
    planes, powers = gain_planes(gains)
    shared, buckets = docs.sparkSession.sparkContext.broadcast((planes, powers)), len(gains)  # 40 KiB of bits
    kept = [c for c in docs.columns if c != text]
    added = [fresh(docs, c) for c in ("_words", "_features", "_weight")]
    schema = docs.select(*kept).schema
    for name in added:
        schema = schema.add(name, "long")

    def weigh(batches):
        planes, powers = shared.value
        for batch in batches:
            words, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, j, n, row, found in feature_blocks(batch.column(text), buckets):
                words[i:j] += n
                order = np.argsort(row, kind="stable") if j - i > rows else None
                row, found = (row, found) if order is None else (row[order], found[order])
                for first in range(0, j - i, rows):
                    last = min(first + rows, j - i)
                    a, b = (0, len(row)) if order is None else np.searchsorted(row, (first, last))
                    counts = np.bincount((row[a:b] - first) * buckets + found[a:b], minlength=(last - first) * buckets)
                    weight[i + first : i + last] += sliced_sums(counts.reshape(last - first, buckets), planes, powers)
            features = sum(np.maximum(words - k, 0) for k in range(ORDER))
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(words), pa.array(features), pa.array(weight)], names=[*kept, *added])

    return docs.select(*kept, text).mapInArrow(weigh, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate, rounded down, drawn by the first 32 bits of sha256('seed:key')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = 5, least_words: int = 20, buckets: int = 10000, seed: int = 42) -> DataFrame:
    """Every document with its n_features, weight, score and rank; drawn documents alone have a rank.

    Weights are exact sums of integer gains. Scores add seeded Gumbel noise, so that the highest scores
    are a sample without replacement in proportion to the exponentials of the weights. Of the N rows
    with enough words floor(percent * N / 100) are drawn, ties to the smaller key, null keys last; rows
    of one key are ranked in turn. Null texts have no features and weight 0; an empty table gives no
    rows, and with an empty target all gains come from the smoothing. The bucket counts, 10,000 numbers
    of each side, are all that the driver and the tasks get. Ranks are offsets of sorted ranges, so no
    task sees more than its range.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    weighed = weighted_documents(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), gains)
    scored, _ = written(weighed.select("key", "_words", "_features", "_weight", (F.col("_weight") + gumbel(F.col("key"), seed)).alias("score")), "resampled")
    able = F.col("_words") >= least_words
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("key")]
    ranges = scored.withColumn("able", able).repartitionByRange(*order).sortWithinPartitions(*order)
    placed, _ = written(ranges.withColumn("place", F.monotonically_increasing_id()), "ranges")  # the range and the row in it
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.where("able").groupBy(part.alias("part")).count()  # a row for each range
    offsets = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"), F.sum("count").over(Window.partitionBy()).alias("all"))
    rank = F.col("before") + row + 1
    drawn = F.col("able") & (rank <= F.expr(f"({percent} * `all`) div 100"))
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part", "left").select(
        F.col("key").alias(key), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"), "score", F.when(drawn, rank).alias("rank")
    )
