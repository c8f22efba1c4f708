"""Language-model scoring from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .groups import byte_slices, sorted_groups
from .words import mix, text_bytes, word_hashes

END = np.uint64(0x2545F4914F6CDD1D)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class LogFrequencyFilter:
    """Membership bits of (n-gram, level) for each level up to the n-gram's: level = 1 + floor(log_base count).

    The filter is cut into 2**shard_log shards of shard_bits bits by the n-gram's leading bits, so that each is
    filled from its own n-grams; all probes of an n-gram fall into its shard. `bits` are the bytes of the
    shards from `first` on, and no n-gram has a level above `top`.
    """

    def __init__(self, bits: np.ndarray, shard_log: int, base: float, probes: int, shard_bits: int = 1 << 20, top: int = 64, first: int = 0):
        self.bits, self.shard_log, self.base, self.probes, self.shard_bits, self.top, self.first = bits, shard_log, base, probes, shard_bits, top, first

    @staticmethod
    def places(grams: np.ndarray, level: int, probes: int, shard_bits: int) -> list[np.ndarray]:
        """Bit places within the n-grams' shards."""
        h = mix(grams + np.uint64(level * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
        one, two = h & low, (h >> half) | np.uint64(1)
        return [(((one + np.uint64(i) * two) & low) * np.uint64(shard_bits) >> half).astype(np.int64) for i in range(probes)]

    @staticmethod
    def fill(grams: np.ndarray, levels: np.ndarray, probes: int, shard_bits: int = 1 << 20) -> np.ndarray:
        """The bytes of one shard."""
        bits = np.zeros(shard_bits, np.uint8)
        for level in range(1, int(levels.max()) + 1):
            for at in LogFrequencyFilter.places(grams[levels >= level], level, probes, shard_bits):
                bits[at] = 1
        return np.packbits(bits, bitorder="little")

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The highest level found by probing level after level; 0 if not even the first is."""
        level, alive = np.zeros(len(grams), np.int64), np.arange(len(grams))
        shard = (leading_bits(grams, self.shard_log) - self.first) * (self.shard_bits >> 3)
        for at_level in range(1, self.top + 1):
            ok = np.ones(len(alive), bool)
            for at in self.places(grams[alive], at_level, self.probes, self.shard_bits):
                ok &= (self.bits[shard[alive] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
            alive = alive[ok]
            if len(alive) == 0:
                break
            level[alive] = at_level
        return level

    def counts(self, grams: np.ndarray) -> np.ndarray:
        return level_counts(self.levels(grams), self.base)


def leading_bits(grams: np.ndarray, n: int) -> np.ndarray:
    return (grams >> np.uint64(64 - n)).astype(np.int64) if n else np.zeros(len(grams), np.int64)


def level_counts(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the range of counts of each level; 0 of level 0."""
    low = np.ceil(base ** (level - 1.0))
    return np.where(level == 0, 0.0, (low + np.maximum(low, np.ceil(base**level) - 1)) / 2)


def _bigrams(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * _STEP ^ (words[1:] >> np.uint64(7)) ^ words[1:])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a text column, each row ended by END, and the rows' offsets."""
    words, offsets = word_hashes(*text_bytes(column))
    rows = np.arange(len(offsets) - 1)
    out = np.full(len(words) + len(rows), END, np.uint64)
    at = np.arange(len(words)) + np.repeat(rows, np.diff(offsets))
    out[at] = words
    return out, offsets + np.arange(len(offsets))


def count_ngrams(texts: DataFrame, text_column: str = "text", shard_log: int = 0) -> DataFrame:
    """(shard, gram, count) over all rows: word unigrams with an even hash, bigrams with an odd one; each text ends with the end token.

    Tasks add up the n-grams of about 16 MiB of text at a time before they move to their shards.
    """

    def count(batches):
        for batch in byte_slices(batches, text_column, 1 << 24):
            words, offsets = _tokens(batch.column(0))
            pairs = _bigrams(words)
            inner = np.ones(len(words), bool)
            inner[offsets[1:] - 1] = False
            pairs = pairs[inner[:-1]] if len(pairs) else pairs
            for grams in (words & ~np.uint64(1), pairs | np.uint64(1)):
                found, n = np.unique(grams, return_counts=True)
                for i in range(0, len(found), 1 << 18):
                    part = found[i : i + (1 << 18)]
                    yield pa.record_batch([pa.array(leading_bits(part, shard_log)), pa.array(part.view(np.int64)), pa.array(n[i : i + (1 << 18)].astype(np.int64))], names=["shard", "gram", "count"])

    rows = texts.select(text_column).mapInArrow(count, "shard long, gram long, count long")
    return rows.repartition("shard").groupBy("shard", "gram").agg(F.sum("count").alias("count"))


def is_unigram() -> Column:
    return F.col("gram").bitwiseAND(1) == 0


class _Answers:
    """What score asks for the levels of n-grams, here from a table of them."""

    def __init__(self, grams: np.ndarray, levels: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.found = grams[order], levels[order]

    def levels(self, grams: np.ndarray) -> np.ndarray:
        if len(self.grams) == 0:
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.found[at], 0)


def score_documents(
    documents: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    base: float = 2.0,
    probes: int = 4,
    bits_per_entry: int = 6,
    weight: float = 0.6,
    frequent: int = 1 << 19,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per input row: id, held_out (not training), n_tokens, n_known, train_tokens, base_score, score.

    Unigrams and bigrams are counted over all rows where `training` holds, and all of them enter the
    filter, whose size follows them: bits_per_entry bits or more for each level of each n-gram. score sums log10 of
    weight * c(u,v)/c(u) + (1 - weight) * (c(v)+1)/(N+V+1), the second part alone where u is unknown, with
    counts read back from the filter by probing. A filter of up to broadcast_bytes is broadcast. A larger
    one stays a table of shards: blocks of documents send their distinct n-grams to the shards, which
    answer with levels. Both ways probe the same bits and give the same scores.

    base_score sums log10 of (c(v)+1)/(N+V+1) with exact counts: those of the `frequent` most frequent words (8 MiB at most) are broadcast
    as well, and the words beyond them meet their counts in a join.

    A null text is empty and has its end token; repeated rows and null ids each keep their row; with no
    training text N and V are 0 and base_score is 0 for each token; an empty table gives no rows.
    """
    spark = documents.sparkSession
    trained = documents.where(training)
    text_bytes_ = trained.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    shard_log = max(0, (text_bytes_ >> 18).bit_length())
    grams, _ = written(count_ngrams(trained, text_column, shard_log).sortWithinPartitions("shard"), "grams")
    level = (F.floor(F.log2(F.col("count").cast("double")) / float(np.log2(base)) + 1e-9) + 1).cast("int")
    summary = grams.groupBy(is_unigram().alias("single"), level.alias("level")).agg(F.count("*").alias("n"), F.sum("count").alias("total")).collect()
    n_words, n_types = (sum(r[k] for r in summary if r["single"]) for k in ("total", "n"))
    top_level = max((r["level"] for r in summary), default=0)
    shard_bits = 64 * (1 + (sum(r["n"] * r["level"] for r in summary) * bits_per_entry >> shard_log + 6))
    lowest = np.log10(n_words + n_types + 1.0)

    def fill(batches):
        for group in sorted_groups(batches, 1):
            bits = LogFrequencyFilter.fill(group["gram"].to_numpy().view(np.uint64), group["level"].to_numpy(), probes, shard_bits)
            yield pa.record_batch([group["shard"].combine_chunks().slice(0, 1), pa.array([bits.tobytes()])], names=["shard", "bits"])

    def unite(batches):
        for group in sorted_groups(batches, 1):  # the table's files may be cut within a shard
            bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group["bits"].to_pylist()])
            yield pa.record_batch([group["shard"].combine_chunks().slice(0, 1), pa.array([bits.tobytes()])], names=["shard", "bits"])

    filled = grams.select("shard", "gram", level.alias("level")).mapInArrow(fill, "shard long, bits binary")
    shards, _ = written(filled.repartition("shard").sortWithinPartitions("shard").mapInArrow(unite, "shard long, bits binary"), "filter")
    singles = grams.where(is_unigram())
    top = singles.orderBy(F.col("count").desc(), "gram").limit(frequent).toArrow()
    top_grams, top_counts = top["gram"].to_numpy().view(np.uint64), top["count"].to_numpy()
    order = np.argsort(top_grams)
    whole, size = None, shard_bits << shard_log >> 3
    if size <= broadcast_bytes:
        whole = np.zeros(size, np.uint8)
        for row in shards.repartition(-(-size // (2 << 20))).toLocalIterator():
            at = row["shard"] * (shard_bits >> 3)
            whole[at : at + (shard_bits >> 3)] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast((whole, top_grams[order], top_counts[order]))

    def scored_batch(batch: pa.RecordBatch, model) -> pa.RecordBatch:
        """Of (row, id, held_out, text)."""
        _, words_known, words_counts = shared.value
        words, offsets = _tokens(batch.column(3))
        starts = offsets[:-1]
        types, at = np.unique(words & ~np.uint64(1), return_inverse=True)
        c1 = level_counts(model.levels(types), base)[at]
        single = (c1 + 1) / (n_words + n_types + 1)
        p = single.copy()
        c2 = level_counts(model.levels(_bigrams(words) | np.uint64(1)), base)
        before = c1[:-1]
        mixed = np.where(before > 0, weight * np.minimum(c2 / np.maximum(before, 1.0), 1.0) + (1 - weight) * single[1:], single[1:])
        follows = np.ones(len(words), bool)
        follows[starts] = False
        p[1:] = np.where(follows[1:], mixed, p[1:])
        found = np.minimum(np.searchsorted(words_known, types), max(len(words_known) - 1, 0))
        exact = np.where(words_known[found] == types, words_counts[found], 0) if len(words_known) else np.zeros(len(types), np.int64)
        hot = exact[at]
        logs = np.where(hot > 0, np.log10(hot + 1.0) - lowest, 0.0)
        rest = hot == 0
        ends = np.concatenate(([0], np.cumsum(rest)))[offsets]
        return pa.record_batch(
            [
                batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets)), pa.array(np.add.reduceat(hot > 0, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(np.log10(p), starts)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((words[rest] & ~np.uint64(1)).view(np.int64))),
            ],
            names=["row", "id", "held_out", "n_tokens", "known", "logs", "score", "rest"],
        )

    def score(batches):
        model = LogFrequencyFilter(shared.value[0], shard_log, base, probes, shard_bits, top_level)
        for batch in byte_slices(batches, "text"):
            yield scored_batch(batch, model)

    def questions(batches):
        """(shard, block, gram): the distinct n-grams of a block of documents."""
        for group in sorted_groups(batches, 1):
            words, _ = _tokens(group["text"])
            asked = np.unique(np.concatenate((words & ~np.uint64(1), _bigrams(words) | np.uint64(1))))
            yield pa.record_batch([pa.array(leading_bits(asked, shard_log)), pa.array(np.full(len(asked), group["block"][0].as_py())), pa.array(asked.view(np.int64)), pa.nulls(len(asked), pa.binary())], names=["shard", "block", "gram", "bits"])

    def answers(batches):
        """(block, gram, level) where the level isn't 0; a shard's bits come before its questions."""
        bits, first = None, None
        for batch in batches:
            at = batch.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]))
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(start, stop - start)
                if part.num_rows and part.column(3)[0].is_valid:
                    bits, first, part = np.frombuffer(part.column(3)[0].as_py(), np.uint8), int(at[start]), part.slice(1)
                if part.num_rows and first == at[start]:  # no shard, no n-gram
                    levels = LogFrequencyFilter(bits, shard_log, base, probes, shard_bits, top_level, first).levels(part.column(2).to_numpy().view(np.uint64))
                    hit = pa.array(levels > 0)
                    yield pa.record_batch([part.column(1).filter(hit), part.column(2).filter(hit), pa.array(levels).filter(hit)], names=["block", "gram", "level"])

    def score_blocks(batches):
        """A block's (gram, level) rows, then its documents."""
        for group in sorted_groups(batches, 1):
            known = pc.is_valid(group["gram"])
            answer = group.filter(known)
            model = _Answers(answer["gram"].to_numpy().view(np.uint64), answer["level"].to_numpy())
            rows = group.filter(pc.invert(known)).select(["row", "id", "held_out", "text"]).combine_chunks()
            for batch in byte_slices(rows.to_batches(), "text"):
                yield scored_batch(batch, model)

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), (~training).alias("held_out"), F.col(text_column).alias("text"))
    schema = f"row long, id {kind}, held_out boolean, n_tokens long, known long, logs double, score double, rest array<long>"
    if whole is not None:
        found = rows.mapInArrow(score, schema)
    else:
        rows, _ = written(rows.withColumn("block", F.xxhash64("row")), "rows")  # row numbers stay as they are
        blocks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (1 << 22)))
        rows = rows.withColumn("block", F.pmod("block", F.lit(blocks)))
        asked = rows.select("block", "text").repartition("block").sortWithinPartitions("block").mapInArrow(questions, "shard long, block long, gram long, bits binary")
        stored = shards.select("shard", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("gram"), "bits")
        told = asked.union(stored).repartition("shard").sortWithinPartitions("shard", F.col("bits").isNull()).mapInArrow(answers, "block long, gram long, level long")
        both = told.unionByName(rows, allowMissingColumns=True).select("block", "gram", "level", "row", "id", "held_out", "text")
        found = both.repartition("block").sortWithinPartitions("block").mapInArrow(score_blocks, schema)
    scored, _ = written(found, "scored")
    tail = scored.select("row", F.explode("rest").alias("gram")).groupBy("row", "gram").agg(F.count("*").alias("n"))
    tail = tail.join(singles, "gram", "left").groupBy("row").agg(
        F.sum(F.col("n") * (F.log10(F.coalesce("count", F.lit(0)) + 1.0) - F.lit(float(lowest)))).alias("more_logs"),
        F.sum(F.when(F.col("count") > 0, F.col("n"))).alias("more_known"),
    )
    none = F.lit(0)
    return scored.drop("rest").join(tail, "row", "left").select(
        F.col("id").alias(id_column), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(int(n_words)).cast("long").alias("train_tokens"), (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("base_score"), "score",
    )
