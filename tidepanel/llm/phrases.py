"""Phrase collocations by best-first branch-and-bound: a frontier of bigrams whose bounds reach a threshold grows into trigrams.

Words and bigrams are counted in one pass. The count of a phrase's first two words, over that of its
first word, bounds the score of every longer phrase which begins so, and the same holds from its end.
Trigrams are counted only where both bounds reach the threshold of their language, or where they
extend a bigram whose own score does, since they can drop it. The threshold starts at the score of
some 4000th bigram and falls until 2000 phrases at or above it survive; all ties of the last are then
above it too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_map, drop_written, written
from .words import hashed_words, mix, text_blocks, text_bytes

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
HELD = 1 << 19  # n-grams that a task holds before it counts them
#: What a bigram of the frontier can be: one that may be in the result, or whose extensions may be.
KINDS = ["contender", "prefix", "suffix"]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PROBES = np.array([[0xD6E8FEB86659FD93, 0xA0761D6478BD642F], [0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], [0x589965CC75374CC3, 0x1D8E4E27C47D124F]], np.uint64)


def _salts(langs: list[str], seed: int) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _blocks(batch: pa.RecordBatch, seed: int):
    """(languages, row of each word, bytes, starts, keys, joined, words seen before) of pieces of the batch.

    Keys are 64-bit hashes of language and word; joined tells that a word and the next stand in one piece.
    """
    langs = batch.column(1).fill_null("und").to_pylist()
    salts = _salts(langs, seed)
    data, offsets = text_bytes(batch.column(0))
    for i, _, piece, at, seen in text_blocks(data, offsets, _APART, 2, 1 << 18):
        starts, rows, hashes = hashed_words(piece, at, _APART)
        if len(starts):
            row = np.repeat(np.arange(len(at) - 1), np.diff(rows)) + i
            part = np.cumsum(_BREAK[piece])[starts]
            joined = (part[1:] == part[:-1]) & (row[1:] == row[:-1])
            yield langs, row, piece, starts, mix(hashes ^ salts[row]), joined, seen


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of the columns and how often each occurs; a row may come twice, never with another's count."""
    key = columns[0].copy()
    for c in columns[1:]:
        key = key * _FACTOR + (c ^ (key >> np.uint64(31)))
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    first = np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))
    return [c[first].view(np.int64) for c in columns], np.diff(np.append(first, len(order)))


class _Held:
    """N-grams of a task, counted whenever HELD of them have come."""

    def __init__(self, width: int):
        self.parts, self.size, self.width = [], 0, width

    def add(self, *columns: np.ndarray) -> bool:
        self.parts.append(columns)
        self.size += len(columns[0])
        return self.size >= HELD

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        out = _counted([np.concatenate([p[k] for p in self.parts]) for k in range(self.width)])
        self.parts, self.size = [], 0
        return out


def _spelled(piece: np.ndarray, starts: np.ndarray, which: np.ndarray) -> pa.Array:
    """Some of the words that begin at starts, in lower case."""
    gaps = np.append(np.flatnonzero(_APART[piece]), len(piece))
    ends = np.minimum(gaps[np.searchsorted(gaps, starts[which])], np.append(starts, len(piece))[which + 1])
    sizes = ends - starts[which]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    data = _LOWER[piece[np.repeat(starts[which] - offsets[:-1], sizes) + np.arange(offsets[-1])]]
    return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def count_words_and_bigrams(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows (a, b, lang, word, n) for a table of text and lang: words, with b null, and bigrams, with lang and word null, by their words' keys."""
    names = ["a", "b", "lang", "word", "n"]

    def bigrams(held):
        (a, b), n = held.take()
        none = pa.nulls(len(a), pa.string())
        return pa.record_batch([pa.array(a), pa.array(b), none, none, pa.array(n)], names=names)

    def count(batches):
        held = _Held(2)
        for batch in batches:
            for langs, row, piece, starts, keys, joined, seen in _blocks(batch, seed):
                used, first, n = np.unique(keys[seen:], return_index=True, return_counts=True)
                first += seen
                of = pa.array([langs[r] for r in row[first]], pa.string())
                yield pa.record_batch([pa.array(used.view(np.int64)), pa.nulls(len(used), pa.int64()), of, _spelled(piece, starts, first), pa.array(n)], names=names)
                joined[: max(0, seen - 1)] = False
                if held.add(keys[:-1][joined], keys[1:][joined]):
                    yield bigrams(held)
        if held.size:
            yield bigrams(held)

    counted = docs.select("text", "lang").mapInArrow(count, "a long, b long, lang string, word string, n long")
    return counted.groupBy("a", "b", "lang", "word").agg(F.sum("n").alias("n"))


def _places(a: np.ndarray, b: np.ndarray, kind: int, log_bits: int) -> list[np.ndarray]:
    base = a * _FACTOR + (b ^ (a >> np.uint64(29)))
    return [((base ^ (base >> np.uint64(32))) * p) >> np.uint64(64 - log_bits) for p in _PROBES[kind]]


def frontier_filter(frontier: DataFrame) -> np.ndarray:
    """A Bloom filter of a table (a, b, contender, prefix, suffix), 16 bits or more for each entry, at most 2**29 bits, or 64 MiB.

    Beyond that it lets more trigrams be counted, never fewer.
    """
    entries = frontier.agg(*[F.coalesce(F.sum(F.col(k).cast("long")), F.lit(0)) for k in KINDS]).first()
    log_bits = min(29, max(16, (16 * sum(entries)).bit_length()))

    def place(batches):
        for batch in batches:
            a, b = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            for kind in range(len(KINDS)):
                on = batch.column(2 + kind).to_numpy(zero_copy_only=False).astype(bool)
                for p in _places(a[on], b[on], kind, log_bits):
                    yield pa.record_batch([pa.array(p.view(np.int64))], names=["place"])

    return bit_map(frontier.select("a", "b", *KINDS).mapInArrow(place, "place long"), "place", log_bits)


def count_trigrams(docs: DataFrame, bits: np.ndarray, seed: int = 0) -> DataFrame:
    """Rows (a, b, c, n) of the trigrams that extend a contender, or begin with a prefix and end with a suffix of the frontier."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # frontier_filter bounds it
    names = ["a", "b", "c", "n"]

    def count(batches):
        bits = shared.value
        log_bits = (len(bits) * 8).bit_length() - 1

        def known(a, b, kind):
            found = np.ones(len(a), bool)
            for p in _places(a, b, kind, log_bits):
                found &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return found

        def trigrams(held):
            columns, n = held.take()
            return pa.record_batch([*map(pa.array, columns), pa.array(n)], names=names)

        held = _Held(3)
        for batch in batches:
            for _, _, _, _, keys, joined, seen in _blocks(batch, seed):
                a, b = keys[:-1], keys[1:]
                contender, prefix, suffix = (known(a, b, k) for k in range(3))
                whole = joined[:-1] & joined[1:] & (contender[:-1] | contender[1:] | (prefix[:-1] & suffix[1:]))
                whole[: max(0, seen - 2)] = False
                if held.add(keys[:-2][whole], keys[1:-1][whole], keys[2:][whole]):
                    yield trigrams(held)
        if held.size:
            yield trigrams(held)

    counted = docs.select("text", "lang").mapInArrow(count, "a long, b long, c long, n long")
    return counted.groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def cut_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits, exact for counts up to 10**16."""
    return F.expr(f"(1000000BD * cast({a} as decimal(16,0)) * cast({a} as decimal(16,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def thresholds(bigrams: DataFrame, rows: int) -> DataFrame:
    """(lang, threshold): a score that at least `rows` bigrams of the language reach, 0 where there are fewer.

    Scores are counted in classes of a hundredth of their logarithm, some 1400 a language.
    """
    classes = bigrams.groupBy("lang", F.floor(100 * F.log1p("score")).alias("class")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("class")))
    return classes.select("lang", "least", (reached >= rows).alias("enough")).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("enough"), F.col("least"))), F.lit(0)).alias("threshold"))


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = 2000, least: int = 10, share: int = 50, start: int = 2) -> DataFrame:
    """Each language's first `top` phrases of 2 or 3 words: lang, rank, phrase, a, l, r, n, score, cut (words before the cut that counts).

    A phrase occurs `least` times or more and isn't part of a longer one that makes up `share` percent of
    its occurrences. The search starts at the score of the language's (start * top)-th bigram and goes
    down eightfold until enough survive; it ends at the latest when all bigrams are in the frontier.
    Null texts are empty, a null language is 'und', repeated rows count again; a language without a
    phrase gives no rows. Words are told apart by 64-bit hashes with their language; if two words share
    one, all is counted again with other hashes. Long texts are read in pieces that overlap by two words.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    for seed in range(8):
        grams, grams_path = written(count_words_and_bigrams(docs, seed).where(f"b is null or n >= {least}"), "grams")
        words = grams.where("b is null").select("a", "lang", "word", "n")
        if words.groupBy("a").count().where("count > 1").isEmpty():
            break
        drop_written(spark, grams_path)
    else:
        raise ValueError("64-bit hashes of words collide under eight seeds")
    common = words.where(f"n >= {least}")
    first, second = common.select("a", "lang", F.col("n").alias("l")), common.select(F.col("a").alias("b"), F.col("n").alias("r"))
    pairs = grams.where("b is not null").select("a", "b", "n").join(first, "a").join(second, "b")
    pairs = pairs.withColumn("score", cut_score("n", "l", "r")).withColumn("prefix_bound", F.expr("1000000 * n div l")).withColumn("suffix_bound", F.expr("1000000 * n div r"))
    bigrams, bigrams_path = written(pairs.select("lang", "a", "b", "n", "l", "r", "score", "prefix_bound", "suffix_bound"), "bigrams")
    wanted = start * top
    while True:
        limits, limits_path = written(thresholds(bigrams, wanted), "thresholds")
        marked = bigrams.join(limits, "lang").select(
            *bigrams.columns, "threshold", (F.col("score") >= F.col("threshold")).alias("contender"),
            (F.col("prefix_bound") >= F.col("threshold")).alias("prefix"), (F.col("suffix_bound") >= F.col("threshold")).alias("suffix"),
        )
        frontier, frontier_path = written(marked.where("contender or prefix or suffix"), "frontier")
        counted = count_trigrams(docs, frontier_filter(frontier), seed).where(f"n >= {least}")
        begin = bigrams.select("a", "b", "lang", F.col("n").alias("ab"), F.col("l").alias("a1"))
        end = bigrams.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("bc"), F.col("r").alias("c1"))
        both = counted.join(begin, ["a", "b"]).join(end, ["b", "c"]).withColumn("s1", cut_score("n", "a1", "bc")).withColumn("s2", cut_score("n", "ab", "c1"))
        early = F.col("s1") <= F.col("s2")
        trigrams, trigrams_path = written(
            both.select("lang", "a", "b", "c", "n", F.when(early, F.col("a1")).otherwise(F.col("ab")).alias("l"), F.when(early, F.col("bc")).otherwise(F.col("c1")).alias("r"),
                        F.least("s1", "s2").alias("score"), F.when(early, 1).otherwise(2).alias("cut")), "trigrams",
        )
        longer = trigrams.select("a", "b", "n").union(trigrams.select("b", "c", "n")).groupBy("a", "b").agg(F.max("n").alias("longer"))
        kept = frontier.where("contender").join(longer, ["a", "b"], "left").where(f"longer is null or 100 * longer < {share} * n")
        reach = trigrams.join(limits, "lang").where("score >= threshold")
        found = ["lang", "a", "b", "c", "n", "l", "r", "score", "cut"]
        survivors, survivors_path = written(kept.withColumn("c", F.lit(None).cast("long")).withColumn("cut", F.lit(1)).select(*found).unionByName(reach.select(*found)), "survivors")
        open_ = limits.where("threshold > 0").join(survivors.groupBy("lang").count(), "lang", "left").where(f"coalesce(count, 0) < {top}")
        settled = open_.isEmpty()
        drop_written(spark, limits_path, frontier_path, trigrams_path)
        if settled:
            break
        drop_written(spark, survivors_path)
        wanted *= 8
    drop_written(spark, bigrams_path)
    spelled = survivors
    for name, how in (("a", "inner"), ("b", "inner"), ("c", "left")):
        spelled = spelled.join(common.select(F.col("a").alias(name), F.col("word").alias(f"word_{name}")), name, how)
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", "word_a", "word_b", "word_c")).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("n"), F.asc("phrase")]
    best = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score", "cut")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3)) AS sizes(k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p, array_to_string(w[cut + 1:], ' ') AS q
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.k = c.cut AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.k = c.k - c.cut AND y.phrase = c.q),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' ') AS phrase, a FROM candidates WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM parts GROUP BY ALL),
kept AS (SELECT s.* FROM worst s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase WHERE s.k = 3 OR g.longer IS NULL OR 100 * g.longer < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n::BIGINT AS n, r.score::BIGINT AS score, r.cut::INT AS cut
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
