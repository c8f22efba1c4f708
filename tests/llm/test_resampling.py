"""Importance resampling against plain sums, and the parts that make it fast against their definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidepanel.llm import resampling

DOCS = "doc_id long, text string, _words long, key string, score long, able boolean, n_features long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text, buckets=10000):
    w = words(text)
    return Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1))


def plain(docs, target, percent, least, seed=42):
    found = [features(t) for _, t in docs]
    source, other = sum(found, Counter()), sum((features(t) for t in target), Counter())
    s, t = source.total(), other.total()
    gain = [math.floor(1000 * math.log((other[b] + 1) * (s + 10000) / ((source[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for (i, text), f in zip(docs, found):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in f.items())
        rows.append([i, f.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r, (_, text) in zip(rows, docs) if len(words(text)) >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return rows


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(13)
    vocabulary = ["the", "Quick", "brown-fox", "über", "naïve", "日本語", "x1", "7", "Ärger", "it's", "L" * 70, "é" * 40]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    made = [None, "", " .-\n", "one", text(2), text(3), *(text(rng.randint(10, 60)) for _ in range(90)), text(5000), "a" * 5000, "x " * 3000]
    return [*enumerate(made), (None, text(30)), (7, made[7]), (7, made[7])]


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_weights_scores_and_ranks(spark, docs, percent):
    target = [docs[10][1], "the quick brown fox", None, docs[20][1], "x1 x1"]
    table = spark.createDataFrame([(i, t, 1, "k", 2, True, 3) for i, t in docs], DOCS)
    other = spark.createDataFrame([(t, 5) for t in target], "text string, doc_id long")
    got = resampling.resample(table, other, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(list, got.collect()), key=order) == sorted(plain(docs, target, percent, 20), key=order)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(docs[:12], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    got = {tuple(r) for r in resampling.resample(some, none, percent=100).collect()}
    assert got == {tuple(r) for r in plain(docs[:12], [], 100, 20)}


def test_crcs_of_ngrams():
    rng = random.Random(2)
    w = ["".join(rng.choice("ab1é") for _ in range(rng.choice([1, 2, 5, 31, 62, 63, 64, 90]))).encode() for _ in range(300)]
    data = np.frombuffer(b" - ".join(w), np.uint8)
    starts, ends, row = resampling.word_bounds(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == w
    for k, crcs in enumerate(resampling.ngram_crcs(data, starts, ends)):
        assert crcs.tolist() == [zlib.crc32(b" ".join(w[i : i + k + 1])) for i in range(len(w) - k)]


def test_rows_begin_new_words_and_pieces_lose_nothing(docs):
    column = pa.array([t for _, t in docs])
    for block in (50, 3000, 1 << 20):
        counts, n = [Counter() for _ in docs], np.zeros(len(docs), int)
        for i, j, k, row, found in resampling.feature_blocks(column, 10000, block):
            n[i:j] += k
            for r, b in zip(row.tolist(), found.tolist()):
                counts[i + r][b] += 1
        assert counts == [features(t) for _, t in docs] and n.tolist() == [len(words(t)) for _, t in docs]


def test_sliced_sums():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (7, 1000)) * rng.integers(0, 2, (7, 1000))
    counts[3, 17], counts[5] = 10**6 + 1, 0
    for low, high in ((-9000, 9000), (0, 1), (-3, 0), (5, 6)):
        gains = rng.integers(low, high, 1000)
        assert resampling.sliced_sums(counts, *resampling.gain_planes(gains.tolist())).tolist() == (counts @ gains).tolist()
