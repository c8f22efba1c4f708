"""Phrase collocations against counting everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidepanel.llm import phrases
from tidepanel.llm.words import hashed_words, text_blocks, text_bytes

DOCS = "doc_id long, text string, lang string, n long, a long, word string"


def plain(rows, top, least, share=50):
    """rank, phrase, a, l, r, n, score and cut of each language, from the counts of all phrases."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        found = []
        for p, n in candidates.items():
            if len(p) == 2 and any(100 * m >= share * n for q, m in candidates.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, cut = min((1000000 * n * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -n, " ".join(p).encode(), n, f[p[:cut]], f[p[cut:]], totals[lang], score, cut))
        out += [(lang, i + 1, p.decode(), *rest) for i, (_, _, p, *rest) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["the", "Old", "red", "house", "stands", "über", "日本", "x1", "new", "york", "city", "-", "of", "is"]
    made = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        w[5:5] = rng.choice([["New", "York", "City"], ["new", "york"], ["über", "red", "house", "stands"], []])
        made.append(("".join(x + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  ", "!?"]) for x in w), ["en", "de", None][i % 3]))
    return [*made, (None, "en"), ("", None), (" . ", "fr"), ("a b. a b; a b\rA B", "und"), made[0], made[0]]


@pytest.mark.parametrize(("top", "least", "start"), [(1, 3, 1), (3, 3, 1), (12, 2, 1), (2000, 2, 2)])
def test_first_phrases_of_each_language(spark, rows, top, least, start):
    """With few asked for, the frontier is narrow at first and must fall until enough survive."""
    table = spark.createDataFrame([(i, t, lang, 1, 2, "w") for i, (t, lang) in enumerate(rows)], DOCS)
    got = sorted(map(tuple, phrases.mine_phrases(table, top=top, least=least, start=start).collect()))
    assert got == plain(rows, top, least)


def test_ties_are_ranked_by_count_and_text(spark):
    rows = [(" ".join([f"{a}1 {a}2."] * n), "en") for a, n in zip("zyxwv", [10, 12, 12, 10, 10])]
    got = phrases.mine_phrases(spark.createDataFrame(rows, "text string, lang string"), top=4).collect()
    assert [(r.rank, r.phrase, r.a, r.score) for r in got] == [(1, "x1 x2", 12, 10**6), (2, "y1 y2", 12, 10**6), (3, "v1 v2", 10, 10**6), (4, "w1 w2", 10, 10**6)]
    assert phrases.mine_phrases(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(3037000500, 3037000501, 3037000502), (10**12, 10**12 + 1, 10**12 + 3), (10**15, 10**15, 10**15), (10, 10**9, 10**9)]
    got = spark.createDataFrame(cases, "a long, l long, r long").select(phrases.cut_score("a", "l", "r").alias("s")).collect()
    assert [r.s for r in got] == [10**6 * a * a // (x * y) for a, x, y in cases]


def test_long_rows_come_in_pieces_that_keep_every_word():
    rng = random.Random(3)
    texts = ["", " ".join("w" * rng.randint(1, 30) + str(rng.randint(0, 9)) for _ in range(400)), "x" * 900, None, "a b", "  " * 300, " ".join("abcdefgh")]
    data, offsets = text_bytes(pa.array(texts))
    _, rows, whole = hashed_words(data, offsets)
    apart = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    for block in (1, 7, 64, 10**6):
        found = [[] for _ in texts]
        for i, j, piece, at, seen in text_blocks(data, offsets, apart, 2, block):
            _, cut, hashes = hashed_words(piece, at)
            assert seen == 0 or (j == i + 1 and found[i][-seen:] == hashes[:seen].tolist() and seen == min(2, len(found[i])))
            for r in range(i, j):
                found[r] += hashes[cut[r - i] + seen : cut[r - i + 1]].tolist()
        assert found == [whole[rows[r] : rows[r + 1]].tolist() for r in range(len(texts))]


def test_a_very_long_text(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randint(0, 60)}" + ("." if rng.random() < 0.1 else "") for _ in range(600_000))
    assert len(text) > 1 << 19  # read in several pieces
    rows = [(text, "en"), ("w1 w2 w3", "en")]
    got = sorted(map(tuple, phrases.mine_phrases(spark.createDataFrame(rows, "text string, lang string"), top=50).collect()))
    assert got == plain(rows, 50, 10, 50)
