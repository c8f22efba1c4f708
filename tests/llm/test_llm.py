"""The operators against plain restatements on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidepanel.llm import embeddings, fingerprints, jaccard, langid, licenses, lm, mixing, packing, resampling, tokens, warc  # noqa: E402
from tidepanel.llm.components import connected_components  # noqa: E402
from tidepanel.llm.words import text_bytes, word_hashes  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, `n` long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["the", "Quick", "brown", "fox,", "jumps", "über", "naïve", "日本語", "over", "lazy", "dogs.", "x1", "Token", "licence"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    made = [None, "", "  \n\t", "one", "MIT", text(3), text(40), text(400), text(4000), "a" * 5000, "Under the MIT License under the mit license", "cc by nc\nApache License Version 2"]
    base = text(120).split(" ")
    near = base[:60] + ["changed"] + base[61:]
    return [*made, " ".join(base), " ".join(base), " ".join(near), " ".join(base).upper(), "<s> special <|endoftext|> strings"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i + 1, t, ["en", None, "de"][i % 3], ["b", None, "a"][i % 3], 7, 8, 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(docs, spark):
    """Repeated rows and a null id added."""
    return docs.unionByName(docs.where("doc_id in (3, 8)")).unionByName(docs.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_words_match_the_pattern(texts):
    data, offsets = text_bytes(pa.array(texts))
    hashes, at = word_hashes(data, offsets, block=64)
    assert np.diff(at).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 8), (5, 5), (8, 20), (20, 7), (None, 4)], "src long, dst long")
    assert {tuple(r) for r in connected_components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7), (20, 7)}
    assert connected_components(edges.limit(0)).count() == 0


def test_token_counts(docs, odd, texts):
    sp = tokens._processor(public_tokenizers.path("piece_bpe_32k.model"))
    got = by_id(tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=50, chunk=64, overlap=8))
    for i, t in enumerate(texts):
        n = len(sp.encode(t or ""))
        assert tuple(got[i + 1])[1:] == (len((t or "").encode()), n, n > 50)
    assert tokens.token_counts(odd, public_tokenizers.path("piece_bpe_32k.model")).count() == len(texts) + 3
    assert tokens.token_counts(odd.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_resynchronisation_is_exact():
    sp = tokens._processor(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    parts = ["a", "aa", " ", "  ", "ab", "the", "\n", "😀", "é", "\U0001f9ff", "<s>", "zzz"]
    for _ in range(60):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 300)))
        assert tokens.encode_resynchronised(sp, t, rng.choice([7, 20, 50]), rng.choice([1, 3, 8])) == sp.encode(t)
    assert tokens.encode_resynchronised(sp, "a" * 3000, 100, 16) == sp.encode("a" * 3000)


def test_fingerprints(docs, odd, texts):
    got = by_id(fingerprints.fingerprint_documents(docs, partitions=3))
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        n, following = len(t), plain[(i + 1) % len(plain)]
        edited = t[: n - n // 4] + following[: n // 4]
        row = got[i + 1]
        assert row.n_chars == n and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert got[13].fingerprint == got[14].fingerprint == got[16].fingerprint and got[13].near_next == 1.0
    assert got[14].near_next > 0.8 and got[1].fingerprint == "" and got[1].near_next == 1.0 and got[3].near_next == 0.0
    assert fingerprints.fingerprint_documents(odd).count() == len(texts)
    assert fingerprints.fingerprint_documents(odd.limit(0)).count() == 0
    only = fingerprints.fingerprint_documents(docs.where("doc_id = 7")).first()
    assert only.near_next == 1.0


def test_fingerprints_estimate_generalised_jaccard(spark):
    rng = random.Random(1)
    pairs, rows = [], []
    for i in range(60):
        a = Counter(rng.choice("abcdefghij") + str(rng.randint(0, 6)) for _ in range(200))
        b = a.copy()
        for w in rng.sample(sorted(a), 15):
            b[w] = rng.randint(1, 12)
        pairs.append(sum((a & b).values()) / sum((a | b).values()))
        rows += [(i, 0, " ".join(a.elements())), (i, 1, " ".join(b.elements()))]
    found = fingerprints.signatures(spark.createDataFrame(rows, "i int, side int, t string"), ["i", "side"], "t").collect()
    prints = {(r.i, r.side): r["print"] for r in found}
    near = [np.mean([prints[i, 0][k : k + 4] == prints[i, 1][k : k + 4] for k in range(0, len(prints[i, 0]), 4)]) for i in range(60)]
    assert abs(np.mean(near) - np.mean(pairs)) < 0.04


def test_archives(spark, tmp_path):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "http://a/ü", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", other), (6, "u", other), (9, "u", big), (None, "u", "gone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = warc.pages_through_archives(pages, str(tmp_path / "w"), keep_payload=True).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [
        (1, "revisit", 9), (2, "revisit", 9), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (6, "response", None), (9, "response", None)
    ]
    for r in got:
        payload = (dict((k, h) for k, _, h in rows)[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert r.record_type == "revisit" or bytes(r.payload) == payload
    assert warc.pages_through_archives(pages.limit(0)).count() == 0


def test_zip_directories(monkeypatch):
    for limit in (None, 10):
        if limit:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr("a.txt", b"A" * 50)
            with z.open("b.bin", "w", force_zip64=True) as f:
                f.write(b"B" * 70)
            z.writestr("c.txt", b"C" * 90, zipfile.ZIP_DEFLATED)
        members = warc.zip_members(out, len(out.getvalue()))
        assert set(members) == {"a.txt", "b.bin"}
        assert {k: out.getvalue()[a : a + n] for k, (a, n) in members.items()} == {"a.txt": b"A" * 50, "b.bin": b"B" * 70}
    with pytest.raises(ValueError):
        warc.zip_members(io.BytesIO(b"no archive here"), 15)


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 16))
    x[60:90] = x[:30] + rng.normal(size=(30, 16)) * 0.05
    x[90:100] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] + [1.0] * 15), (204, []), (205, [1.0, 2.0]), (206, [2.0, 4.0]), (5, rows[5][1]), (None, rows[5][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.95) & ~np.eye(120, dtype=bool)
    for block in (1024, 7):
        got = by_id(embeddings.near_duplicate_vectors(table, bits=8, tables=24, block=block), "vec_id")
        assert len(got) == 127 and [got[i].n_links for i in range(120)] == linked.sum(1).tolist()
        assert all(got[i].component_id == min([i, *np.flatnonzero(linked[i])]) or got[i].component_id < i for i in range(120))
        assert [got[i].n_links for i in (200, 201, 202, 203, 204)] == [0] * 5 and got[205].n_links == 1 and got[206].component_id == 205 and not got[206].kept
    assert embeddings.near_duplicate_vectors(table.limit(0)).count() == 0


def test_language_id(spark, docs, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    training = langid.training_rows(table)
    profiles = langid.language_profiles(table.where(training))
    held = langid.identify_languages(table.where(~training), profiles).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in held)
    got = by_id(langid.identify_languages(docs, profiles))
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[7].lang_pred != "und"
    empty = langid.language_profiles(docs.limit(0))
    assert empty[0] == [] and {r.lang_pred for r in langid.identify_languages(docs, empty).collect()} == {"und"}


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_stage_keeps_letters_whatever_the_labels(spark, lang):
    import corpus_pipeline

    rows = [(1, "plain words", lang), (2, "日本語", lang), (3, "... 123", lang), (4, "", lang), (5, None, lang), (6, "a", lang)]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6] and kept.columns == ["doc_id", "text", "lang"]


def test_trigram_vectors_keep_to_their_bound():
    small, large = langid.TrigramSpace(64, 7, held=40), langid.TrigramSpace(64, 7)
    for t in ("hello world", "über naïve 日本語 text", "x" * 500 + "abcdefghijklmnopqrstuvwxyz" * 3):
        np.testing.assert_allclose(small.bundle(t), large.bundle(t), rtol=1e-4, atol=1e-5)


def test_packing(docs, odd, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for window, shard in ((64, 4 << 20), (4096, 3000)):
        pieces = packing.pack_documents(docs, path, window=window, shard_bytes=shard).toPandas()
        for i, t in enumerate(texts):
            ids, at = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4"), 0
            for p in pieces[pieces.doc_id == i + 1].sort_values("start").itertuples():
                assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
        for _, s in pieces.groupby("sequence_id"):
            s = s.sort_values("offset")
            assert s.length.sum() <= window and (s.offset == s.length.cumsum() - s.length).all()
    assert (pieces := packing.pack_documents(docs, path, window=64).toPandas()).groupby("sequence_id").length.sum().lt(64).sum() <= 1 and len(pieces)
    assert packing.pack_documents(odd, path).groupBy("doc_id").agg(F.sum("length").alias("n")).count() == len(texts) + 1
    assert packing.pack_documents(odd.limit(0), path).count() == 0


def test_retrieval_prefers_shared_terms():
    shard = [np.array([1, 2, 3, 4] * 5), np.array([50, 51, 52] * 6), np.array([1, 2, 3, 9] * 5), np.array([60, 61] * 9)]
    assert [d for d, _, _ in packing.pack_shard(shard, 40, 64)[0]] == [0, 2]


def test_retrieval_asks_with_all_shared_terms():
    rare, common = list(range(1000, 1064)), list(range(64))
    index = packing.LexicalIndex([np.array(rare + common), np.array(common), np.array([2000, 2001])])
    assert index.scores(0)[1] > 0 == index.scores(0)[2] and index.scores(0, 64)[1] > 0


def test_shards_are_chosen_by_content(spark):
    """Pairs of documents with a vocabulary of their own meet, whatever their ids; many copies are dealt over shards."""
    rng = random.Random(9)
    rows = []
    for k in range(300):
        own = [20 * k + 100 + i for i in range(20)]
        rows += [(int(rng.random() * 1e9), k, sorted(rng.sample(own, 15) + [1, packing.END])) for _ in range(2)]
    rows += [(i, -1, [packing.END, 50, 51, 52]) for i in range(400)]
    raw = [(d, k, rng.random(), 500, np.array(t, "<u4").tobytes(), np.unique(np.array(t, "<u4")).tobytes()) for d, k, t in rows]
    tokenized = spark.createDataFrame(raw, "doc long, k int, salt double, bytes long, ids binary, terms binary")
    shards = packing.sharded(tokenized.drop("k"), 10000).toPandas().merge(tokenized.select("doc", "k").toPandas(), on="doc")
    pairs = shards[shards.k >= 0].groupby("k").shard.nunique()
    assert shards.shard.nunique() >= 40 and (pairs == 1).mean() > 0.5  # by chance 0.03
    assert shards.groupby("shard").size().max() * 500 <= 20000 and shards[shards.k < 0].shard.nunique() >= 18


def test_licenses(docs, odd, texts):
    got = by_id(licenses.scan_licenses(docs))
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        places = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        want = (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places})))
        assert tuple(got[i + 1])[1:6] == want
    assert licenses.scan_licenses(odd).count() == len(texts) and licenses.scan_licenses(odd.limit(0)).count() == 0


def test_licenses_allow_small_changes(spark):
    whole = licenses.TEMPLATES["bsd"]
    changed = whole.replace("with or without modification,", "with or without any kind of modification,")
    rows = [(1, "intro " + whole), (2, changed + " more"), (3, " ".join(whole.split()[:7])), (4, "K under the mIt license İ")]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["bsd", "bsd", "", "mit"] and got[1].score == 1.0 and 0.6 <= got[2].score < 1


def test_lm(docs, odd, texts):
    training = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    got = by_id(lm.score_documents(docs, training, frequent=4))
    held = {i + 1: zlib.crc32(str(i + 1).encode()) % 7 == 2 for i in range(len(texts))}
    parts = {i + 1: [*words(t), None] for i, t in enumerate(texts)}
    count = Counter(w for i, p in parts.items() if not held[i] for w in p)
    n, v = sum(count.values()), len(count)
    for i, p in parts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(p), sum(count[w] > 0 for w in p), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in p)) and r.score < 0
    assert lm.score_documents(odd, F.coalesce(training, F.lit(True))).count() == len(texts) + 3
    assert lm.score_documents(docs, F.lit(False)).first().base_score == 0.0
    assert lm.score_documents(odd.limit(0), training).count() == 0


def exact_lm(parts, held, base=2.0, weight=0.6):
    """log10 probabilities from exact counts, quantised as the filter does."""
    middle = lambda c: 0.0 if not c else (lo := base ** (math.frexp(c)[1] - 1), (lo + max(lo, 2 * lo - 1)) / 2)[1]
    c1 = Counter(w for i, p in parts.items() if not held[i] for w in p)
    c2 = Counter(g for i, p in parts.items() if not held[i] for g in zip(p, p[1:]))
    n, v = sum(c1.values()), len(c1)
    out = {}
    for i, p in parts.items():
        total = 0.0
        for k, w in enumerate(p):
            single = (middle(c1[w]) + 1) / (n + v + 1)
            before = middle(c1[p[k - 1]]) if k else 0.0
            total += math.log10(weight * min(middle(c2[p[k - 1], w]) / before, 1.0) + (1 - weight) * single if before else single)
        out[i] = total
    return out


def test_lm_scores_are_those_of_exact_counts(spark, docs, texts):
    """With bits enough for hardly any false hit the score is that of the exact counts, both ways of asking the filter."""
    training = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    held = {i + 1: zlib.crc32(str(i + 1).encode()) % 7 == 2 for i in range(len(texts))}
    want = exact_lm({i + 1: [*words(t), None] for i, t in enumerate(texts)}, held)
    for options in ({}, {"broadcast_bytes": 0}):
        got = by_id(lm.score_documents(docs, training, bits_per_entry=64, probes=8, **options))
        assert {i: r.score for i, r in got.items()} == pytest.approx(want)


def test_lm_keeps_every_ngram_and_asks_alike_at_every_size(spark):
    """Whether the filter is broadcast or asked shard by shard, scores are the same, and documents seen twice score above those seen once."""
    rng = random.Random(12)
    made = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(1, 300))) for _ in range(400)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(made + made[:40])] + [(None, None), (7, made[7])], "doc_id long, text string")
    ways = [sorted(map(tuple, lm.score_documents(table, F.lit(True), broadcast_bytes=n).collect()), key=str) for n in (64 << 20, 0)]
    assert ways[0] == ways[1] and len(ways[0]) == 442
    score = {r[0]: r[-1] / r[2] for r in ways[0] if r[0] is not None and r[2] > 50}
    assert np.mean([v for i, v in score.items() if i < 40 or i >= 400]) > np.mean([v for i, v in score.items() if 40 <= i < 400]) + 0.1


def test_full_filter_still_answers():
    grams = np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    model = lm.LogFrequencyFilter(np.full(1 << 17, 255, np.uint8), 0, 2.0, 4, top=9)
    assert (model.levels(grams) == 9).all()


def test_log_frequency_filter_reads_back_levels():
    rng = np.random.default_rng(4)
    grams, counts = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(1, 3000, 3000)
    levels = np.floor(np.log2(counts) + 1e-9).astype(int) + 1
    one = grams >> np.uint64(63) == 0
    model = lm.LogFrequencyFilter(lm.LogFrequencyFilter.fill(grams[one], levels[one], 4), 0, 2.0, 4)
    got = model.counts(grams)
    assert np.mean((got >= counts / 2) & (got <= counts * 2)) > 0.99 and np.mean(model.counts(rng.integers(0, 2**63, 3000, dtype=np.uint64)) == 0) > 0.97


def test_mixing_targets_and_bounds(docs, odd, texts):
    got = by_id(mixing.mix_sources(docs, block=8, shard_words=1000))
    total = sum(len(words(t)) for t in texts)
    sources = {i + 1: ["b", None, "a"][i % 3] for i in range(len(texts))}
    for s in ("a", "b", None):
        mine = [got[i] for i in got if sources[i] == s]
        assert sum(r.size for r in mine) == mine[0].source_size and mine[0].target <= 2 * mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2 * 8 * 6 and all(0 <= r.taken <= 2 * r.size for r in mine)
    assert sum({sources[i]: r.target for i, r in got.items()}.values()) == pytest.approx(1.5 * total)
    assert mixing.mix_sources(odd).count() == len(texts) and mixing.mix_sources(odd.limit(0)).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mixed_documents_meet_their_targets(spark):
    rng = random.Random(3)
    ratios = [0.2, 0.35, 1.3, 1.68]
    rows = [(10000 * s + i, s, " ".join(["w"] * n)) for s in range(4) for i, n in enumerate(rng.choices([5, 40, 300, 2500], [4, 4, 4, 1], k=500))]
    docs = spark.createDataFrame(rows, "doc_id long, source int, text string")
    sizes = {s: sum(len(t.split()) for _, x, t in rows if x == s) for s in range(4)}
    options = dict(weights=tuple(round(sizes[s] * ratios[s]) for s in range(4)), share=sum(sizes[s] * ratios[s] for s in range(4)) / sum(sizes.values()), shard_words=1 << 15)
    targets = {r.source: r.target for r in mixing.mix_sources(docs, **options).join(docs.select("doc_id", "source"), "doc_id").collect()}
    got = mixing.mixed_documents(docs, **options).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in mixing.mixed_documents(docs.repartition(7), **options).collect())
    kept = Counter()
    for r in got:
        kept[r.source, len(r.text) > 2000] += len(r.text.split())
    for s in range(4):
        assert targets[s] == pytest.approx(sizes[s] * ratios[s], rel=0.01)
        assert kept[s, False] + kept[s, True] == pytest.approx(targets[s], rel=0.05)
        long = sum(len(t.split()) for _, x, t in rows if x == s and len(t) > 2000)
        assert kept[s, True] == pytest.approx(long * ratios[s], rel=0.35)  # long documents come in as often as short ones


def test_sainte_lague_is_by_highest_quotients(spark):
    rng = random.Random(9)
    for seats in (0, 1, 3, 17, 400):
        votes = [(1, k, rng.choice([0, 1, 1, 5, 50, 333, 1000])) for k in range(9)]
        table = spark.createDataFrame(votes, "g int, k int, v long").withColumn("s", F.lit(seats).cast("long"))
        got = {r.k: r.out for r in mixing.sainte_lague(table, ["g"], "v", "s", "k", "out").collect()}
        ranked = sorted(((-v / (2 * j + 1), k, j) for _, k, v in votes if v for j in range(seats + 1)))[:seats]
        assert got == {k: sum(x[1] == k for x in ranked) for _, k, _ in votes}


def brute_groups(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = top[i], top[j]
                top = [min(a, b) if x in (a, b) else x for x in top]
    return [len(s) for s in sets], top


def test_jaccard_join(spark, docs, odd, texts):
    got = by_id(jaccard.near_duplicate_groups(docs))
    sizes, top = brute_groups(texts)
    assert [got[i + 1].n_shingles for i in range(len(texts))] == sizes and [got[i + 1].component_id - 1 for i in range(len(texts))] == top
    assert jaccard.near_duplicate_groups(odd).count() == len(texts) and jaccard.near_duplicate_groups(odd.limit(0)).count() == 0


def test_jaccard_join_with_tiny_blocks(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 90))] for _ in range(6)]
    passage, made = [rng.choice(vocabulary) for _ in range(30)], []
    for b in base:
        for _ in range(14):
            t = list(b)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            made.append(" ".join(t + (passage if rng.random() < 0.3 else [])))
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    _, top = brute_groups(made)
    for block in (1024, 4):
        got = by_id(jaccard.near_duplicate_groups(table, block=block, common_share=0.05))
        assert [got[i].component_id for i in range(len(made))] == top


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(6)
    for _ in range(50):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, n // 12, dtype=np.uint64)]))
        if len(b) < len(a):
            a, b = b, a
        if len(a) == 0:
            continue
        p, q = jaccard.point(a), jaccard.point(b)
        g = min(len(p), len(q))
        overlap = len(np.intersect1d(a, b))
        assert np.minimum(jaccard.fold([p], g)[0], jaccard.fold([q], g)[0]).sum() >= overlap
        if 100 * overlap >= 75 * (len(a) + len(b) - overlap):
            assert overlap >= jaccard.least_overlap(len(a), len(b), 75)
            assert set(a[: jaccard.prefix_length(len(a), 75)].tolist()) & set(b[: jaccard.prefix_length(len(b), 75)].tolist())


def test_pipeline(spark, sf_dir, tmp_path):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mix", "pack"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    docs = docs.unionByName(docs.limit(3).withColumn("doc_id", F.col("doc_id") + 100000)).unionByName(docs.limit(1).withColumn("text", F.lit("... 123")).withColumn("doc_id", F.lit(777777).cast("long")))
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    kept = corpus_pipeline.language(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    one = corpus_pipeline.near_duplicates(spark, kept, sf_dir)
    _, top = brute_groups([r.text for r in kept.orderBy("doc_id").collect()])
    assert one.columns == docs.columns and one.count() == len(set(top))
    mixed = corpus_pipeline.mix(spark, one, sf_dir)
    plan = {r.doc_id: r for r in mixing.mix_sources(one).join(one.select("doc_id", "source"), "doc_id").collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(copies[k] in (r.taken // r.size, -(-r.taken // r.size)) if r.size else copies[k] == 0 for k, r in plan.items())
    for source in {r.source for r in plan.values()}:  # words after the stage against what the mix takes, and that against the target
        mine = [r for r in plan.values() if r.source == source]
        taken = sum(r.taken for r in mine)
        assert abs(sum(copies[r.doc_id] * r.size for r in mine) - taken) <= max(r.size for r in mine) / 2 + 1
        assert abs(taken - mine[0].target) <= 2 * 64
    pieces = corpus_pipeline.pack(spark, mixed, sf_dir)
    assert pieces.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_related_licenses_keep_their_own_label(spark):
    t = licenses.TEMPLATES
    rows = [(1, t["cc-by"]), (2, t["cc-by-nc"]), (3, t["cc-by-nc-sa"]), (4, t["gpl"]), (5, t["lgpl"]), (6, t["bsd-2"]), (7, t["bsd-3"]), (8, t["mit"][1]), (9, t["isc"][1]), (10, t["cc-by"] + ". " + "x " * 9 + t["gpl"])]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].labels for i in range(1, 11)] == ["cc-by", "cc-by-nc", "cc-by-nc-sa", "gpl", "lgpl", "bsd-2", "bsd-3", "mit", "isc", "cc-by,gpl"]


def test_a_span_that_lost_beats_no_other(spark):
    """A loses to B alone, and B to C, which doesn't touch A: A and C stay."""
    rows = [(1, "a", 0, 10, 5, 0.9), (1, "b", 8, 30, 9, 0.9), (1, "c", 25, 60, 20, 0.9), (1, "d", 100, 110, 3, 0.7), (2, "b", 0, 5, 4, 0.8), (2, "a", 5, 9, 4, 0.8), (2, "b", 3, 9, 4, 0.8), (3, "x", 7, 9, 1, 0.6)]
    spans = spark.createDataFrame(rows, "_id long, label string, first int, last int, covered int, cover double")
    assert sorted(map(tuple, licenses.settled(spans).select("_id", "label", "first", "last").collect())) == [(1, "a", 0, 10), (1, "c", 25, 60), (1, "d", 100, 110), (2, "a", 5, 9), (3, "x", 7, 9)]


def test_licenses_by_brute_force(spark):
    """Labels against plain diagonals: every template at every place, matched positions counted, the best of overlapping spans kept."""
    rng = random.Random(4)
    parts = [x for v in licenses.TEMPLATES.values() for x in ([v] if isinstance(v, str) else v)]
    made = []
    for _ in range(60):
        w = [f"f{rng.randint(0, 99)}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            piece = licenses.template_words(rng.choice(parts))
            cut = piece[: rng.randint(len(piece) // 3, len(piece))]
            for _ in range(rng.randint(0, 2)):
                cut[rng.randrange(len(cut))] = "changed"
            w += cut + [f"g{rng.randint(0, 99)}" for _ in range(rng.randint(5, 40))]
        made.append(" ".join(w))
    templates = [(label, licenses.template_words(x)) for label, v in licenses.TEMPLATES.items() for x in ([v] if isinstance(v, str) else v)]

    def labels(text):
        w, spans, found = licenses.template_words(text), [], set()
        for number, (label, t) in enumerate(templates):
            grams, votes = len(t) - 2, {}
            for q in range(grams):
                for p in range(len(w) - 2):
                    if w[p : p + 3] == t[q : q + 3]:
                        votes.setdefault(p - q, []).append((p, q))
            island = []
            for d in [*sorted(votes), None]:
                if island and (d is None or d - island[-1] > 3):
                    hits = [h for x in island for h in votes[x]]
                    covered, first, last = len({q for _, q in hits}), min(p for p, _ in hits), max(p for p, _ in hits) + 2
                    if covered >= grams * 0.6 and last - first + 1 <= len(t) * 1.5:
                        spans.append((covered, covered / grams, label, first, last))
                    island = []
                island.append(d)
        stay = []
        for s in sorted(spans, key=lambda s: (-s[0], -s[1], s[2])):
            if not any(r[2] != s[2] and r[3] <= s[4] and s[3] <= r[4] for r in stay):
                stay.append(s)
        found |= {s[2] for s in stay}
        found |= {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in f" {' '.join(w)} "}
        return ",".join(sorted(found))

    got = by_id(licenses.scan_licenses(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")))
    assert [got[i].labels for i in range(60)] == [labels(t) for t in made] and len({r.labels for r in got.values()}) > 8


def test_very_long_text_with_licenses(spark):
    """The work is linear in a text's words."""
    text = "word " * 300000 + "under the mit license " + "word " * 100000
    row = licenses.scan_licenses(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).where("doc_id = 1").first()
    assert (row.n_words, row.n_base, row.first_word, row.labels) == (400004, 1, 300000, "mit")


def brute_links(x, threshold=0.95):
    """Number of links and smallest reachable position of every unit vector."""
    linked = (x @ x.T >= threshold) & ~np.eye(len(x), dtype=bool)
    top = list(range(len(x)))
    for i, j in zip(*np.nonzero(np.triu(linked))):
        a, b = top[i], top[j]
        if a != b:
            top = [min(a, b) if t in (a, b) else t for t in top]
    return linked.sum(1), top


def test_embedding_components_by_brute_force(spark):
    """The registered parameters on chains, clusters and pairs just above the threshold."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 24))
    for i in range(0, 600, 2):  # pairs of cosine 0.95 to 0.98
        u = x[i] / np.linalg.norm(x[i])
        v = rng.normal(size=24)
        v -= (v @ u) * u
        c = rng.uniform(0.95, 0.98)
        x[i + 1] = c * u + np.sqrt(1 - c * c) * v / np.linalg.norm(v)
    for i in range(601, 700):  # a chain: ends far apart
        x[i] = x[i - 1] / np.linalg.norm(x[i - 1]) + rng.normal(size=24) * 0.04
    x[700:760] = x[600] + rng.normal(size=(60, 24)) * 0.02
    order = rng.permutation(len(x))
    x = x[order]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = by_id(embeddings.near_duplicate_vectors(table), "vec_id")
    links, top = brute_links(x / np.linalg.norm(x, axis=1, keepdims=True))
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.995 * links.sum()
    assert np.mean([got[i].component_id == top[i] for i in range(len(x))]) > 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(x)))


def test_embedding_query_finds_all_links(spark, sf_dir):
    from tidepanel.llm import queries

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    sound = [r for r in rows if r.vec_id is not None and r.embedding and all(v is not None and math.isfinite(v) for v in r.embedding) and any(r.embedding)]
    x = np.array([r.embedding for r in sound], np.float64)
    links, top = brute_links(x / np.linalg.norm(x, axis=1, keepdims=True))
    got = by_id(queries.op4_embedding_duplicates(spark, sf_dir), "vec_id")
    assert [got[r.vec_id].n_links for r in sound] == links.tolist()
    assert [got[r.vec_id].component_id for r in sound] == [sound[t].vec_id for t in top]


def spark_hash(*parts):
    """Spark's xxhash64 of longs, ints and strings."""
    import xxhash

    h = 42
    for kind, v in parts:
        h = xxhash.xxh64_intdigest(v.encode() if kind == "s" else (v & (2 ** (64 if kind == "l" else 32) - 1)).to_bytes(8 if kind == "l" else 4, "little"), h)
    return h


def test_fingerprints_by_brute_force(spark):
    """The signature against the sampling rule written out: gamma variates per word and sample, the word of smallest rank."""
    rng = random.Random(2)
    made = [" ".join(rng.choice(["Ab", "c,", "d\té", "x1", "zz"]) for _ in range(n)) for n in (1, 2, 7, 60, 400)]
    got = {r.i: r["print"] for r in fingerprints.signatures(spark.createDataFrame(list(enumerate([*made, "", " \n"])), "i int, t string"), ["i"], "t").collect()}
    assert got[5] == got[6] == ""
    uniform = lambda h, shift, bits: (((h >> shift) & ((1 << bits) - 1)) + 0.5) / (1 << bits)
    for i, text in enumerate(made):
        count, want = Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w), ""
        for j in range(fingerprints.SAMPLES):
            best = None
            q = 2 * fingerprints.SAMPLES_A_ROW * (j // fingerprints.SAMPLES_A_ROW) + 2 * (j % fingerprints.SAMPLES_A_ROW)
            for w, n in count.items():
                x = spark_hash(("s", w))
                h, g = spark_hash(("l", x), ("i", q)), spark_hash(("l", x), ("i", q + 1))
                r, c, b = -math.log(uniform(h, 0, 21) * uniform(h, 21, 21)), -math.log(uniform(g, 0, 32) * uniform(g, 32, 32)), uniform(h, 42, 22)
                t = math.floor(math.log(n) / r + b)
                rank = int(min(c * math.exp(-r * (t - b + 1.0)) * (1 << 27), float((1 << 31) - 1)))
                mark = (x ^ (t << 16)) & 0xFFFFFFFF
                best = min(best or (rank, mark), (rank, mark))
            want += f"{best[1] >> 16:04x}"
        assert got[i] == want


def test_language_by_brute_force(spark, sf_dir):
    """Predictions against letter vectors bound, bundled and compared one by one."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    table = table.unionByName(table.limit(5)).unionByName(table.limit(1).withColumn("text", F.lit("É" * 3000 + " zß")))
    rows, dimensions, letters = table.collect(), 512, {}

    def letter(ch):
        if ch not in letters:
            letters[ch] = 2.0 * np.random.Generator(np.random.PCG64([7, ord(ch)])).integers(0, 2, dimensions, dtype=np.int8) - 1
        return letters[ch]

    def bundle(text):
        if not any(ch.isalpha() for ch in (text or "").lower()):
            return None
        plain = " " + re.sub(r"\x00+", " ", "".join(ch if ch.isalpha() else "\0" for ch in text.lower())) + " "
        plain = re.sub(" +", " ", plain)
        total = np.zeros(dimensions)
        for a, b, c in zip(plain, plain[1:], plain[2:]):
            total += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
        return total / np.linalg.norm(total)

    sums = {}
    for r in rows:
        if r.lang is not None and (v := bundle(r.text)) is not None:
            sums[r.lang] = sums.get(r.lang, 0) + v
    profiles = {lang: v / np.linalg.norm(v) for lang, v in sorted(sums.items())}
    got = langid.identify_languages(table, langid.language_profiles(table)).collect()
    assert len(got) == len(rows)
    for r in got:
        v = bundle(r.text)
        likeness = {lang: float(v @ p) for lang, p in profiles.items()} if v is not None else {}
        if not likeness:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.score == pytest.approx(max(0.0, *likeness.values()), abs=1e-4) and likeness[r.lang_pred] == pytest.approx(max(likeness.values()), abs=1e-4)


def test_more_languages_than_the_bound_are_an_error(spark):
    table = spark.createDataFrame([(i, "abc def", f"l{i}") for i in range(5)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.language_profiles(table, max_languages=4)
    assert langid.language_profiles(table)[0] == [f"l{i}" for i in range(5)]


def test_packing_fills_windows_in_order_of_bm25():
    """A seed's sequence against BM25 computed pair by pair."""
    rng = random.Random(6)
    shard = [np.array([rng.choice(range(t, t + 30)) for _ in range(rng.randint(5, 25))]) for t in [rng.randint(0, 60) for _ in range(40)]]
    df, mean = Counter(t for d in shard for t in set(d.tolist())), np.mean([len(d) for d in shard])

    def bm25(query, doc):
        tf = Counter(doc.tolist())
        idf = lambda t: math.log1p((len(shard) - df[t] + 0.5) / (df[t] + 0.5))
        return sum(idf(t) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(doc) / mean)) for t in set(query.tolist()) if df[t] > 1)

    first = packing.pack_shard(shard, 120)[0]
    order = sorted(range(1, 40), key=lambda d: (-bm25(shard[0], shard[d]), d))
    assert first[0] == (0, 0, len(shard[0])) and [d for d, _, _ in first[1:]] == order[: len(first) - 1]
    assert sum(n for _, _, n in first) == 120


def test_clashing_columns(spark, docs, odd, sf_dir):
    """Columns of the input that are named like an operator's own change nothing."""
    import corpus_pipeline

    names = ["size", "taken", "target", "_id", "_mix_key", "_copy", "_copies", "ord", "shard", "_lang_pred", "_score", "_letter", "key", "doc", "rep", "n", "component_id", "word", "gram"]
    wide = docs.withColumns({c: F.lit(7) for c in names if c not in docs.columns})
    assert sorted(map(str, mixing.mix_sources(wide).collect())) == sorted(map(str, mixing.mix_sources(docs).collect()))
    for stage in (corpus_pipeline.language, corpus_pipeline.near_duplicates, corpus_pipeline.mix):
        got, want = stage(spark, wide, sf_dir), stage(spark, docs, sf_dir)
        assert got.columns == wide.columns and sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in want.collect())
        assert got.where("_mix_key <> 7 or _letter <> 7 or _copy <> 7").isEmpty()
    assert sorted(map(str, jaccard.near_duplicate_groups(wide).collect())) == sorted(map(str, jaccard.near_duplicate_groups(docs).collect()))
    pages = spark.createDataFrame([(i, "u", "x" * 1200, 1, 2, "d", "a") for i in range(3)], "page_id long, url string, html string, key int, first int, digest string, archive string")
    assert sorted(r.record_type for r in warc.pages_through_archives(pages).collect()) == ["response", "revisit", "revisit"]
    vectors = spark.createDataFrame([(i, [1.0, 2.0], 1, 2, "c") for i in range(3)], "vec_id long, embedding array<double>, rep int, n int, codes string")
    assert [r.n_links for r in embeddings.near_duplicate_vectors(vectors).collect()] == [2, 2, 2]


def test_mix_keeps_rows_without_an_id(spark):
    rows = [(None, "s", "a b c"), (None, "s", "d e f"), (None, "s", "d e f"), (1, "s", "g h"), (2, "t", "i")]
    got = Counter(r.text for r in mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(1,), share=2.0, block=1).collect())
    assert got == {"a b c": 2, "d e f": 4, "g h": 2, "i": 2}


def test_very_long_texts(spark):
    """200,000 words in one text beside short ones."""
    from tokenizers import Tokenizer

    rng = random.Random(3)
    long = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(200000))
    table = spark.createDataFrame([(1, long, "en", "s"), (2, long.upper(), "en", "s"), (3, "short one", "de", "s"), (4, None, None, None)], "doc_id long, text string, lang string, source string")
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack_documents(table, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces}[1] == len(Tokenizer.from_file(path).encode(long, add_special_tokens=False).ids) + 1
    groups = by_id(jaccard.near_duplicate_groups(table))
    assert groups[2].component_id == 1 and groups[1].n_shingles == len({tuple(w) for w in zip(*[words(long)[i:] for i in range(5)])})
    assert by_id(lm.score_documents(table, F.lit(True)))[1].n_tokens == 200001
    assert by_id(langid.identify_languages(table, langid.language_profiles(table)))[3].lang_pred == "de"
    prints = by_id(fingerprints.fingerprint_documents(table, partitions=2))
    assert prints[1].near_next == 1.0 and prints[1].n_chars == len(long)
    sp = tokens._processor(public_tokenizers.path("piece_bpe_32k.model"))
    assert by_id(tokens.token_counts(table, public_tokenizers.path("piece_bpe_32k.model")))[1].n_tokens == len(sp.encode(long))


def test_pipeline_drops_its_own_tables_only(spark, sf_dir, tmp_path):
    """Another operator's result stays readable, the stages' tables go, and a rerun and an empty table give the same and nothing."""
    import os

    import corpus_pipeline
    from tidepanel.llm.common import shared_dir

    def tables():
        root = shared_dir(spark).removeprefix("file:")
        return {f for f in os.listdir(root)} if os.path.isdir(root) else set()

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    docs.orderBy("doc_id").limit(80).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string"))).write.parquet(f"{tmp_path}/some/documents.parquet")
    kept = resampling.resample(docs.limit(50), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    before = tables()
    first = sorted(map(tuple, corpus_pipeline.run(spark, f"{tmp_path}/some").collect()))
    left = {t.rsplit("-", 1)[0] for t in tables() - before}
    assert left <= {"stage-mix", "tokenized"} and kept.count() == 50
    assert first == sorted(map(tuple, corpus_pipeline.run(spark, f"{tmp_path}/some").collect())) and len(first) > 20
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_cuts_make_ranges_of_like_size(spark):
    """Ranges follow the bytes, also where a third of the rows are copies, and the sample names the same cuts again."""
    rng = random.Random(8)
    rows = [(i, rng.random(), 300, np.array([rng.randint(3, 900) for _ in range(6)] if i % 3 else [5, 6, 7], "<u4").tobytes()) for i in range(3000)]
    table = spark.createDataFrame([(*r, r[3]) for r in rows], "doc long, salt double, bytes long, ids binary, terms binary").repartition(5)
    placed = [packing.ordered_by_content(table, 30000).withColumn("part", F.spark_partition_id()).toPandas() for _ in range(2)]
    assert sorted(placed[0].doc) == list(range(3000)) and placed[0].equals(placed[1])
    assert placed[0].groupby("part").size().max() <= 600


def test_word_tokenizer_on_odd_texts():
    """Ids of texts of odd pieces in batches of rows, where one row may end with what the next goes on with; words with stops and contractions."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, by_word = Tokenizer.from_file(path), packing.WordTokenizer(path)
    rng = random.Random(77)
    pieces = ["a", "B", " ", "\n", "\t", "é", "日本", "'s", "1", "x9", "<", "|", "<|", "|>", "<|endoftext|>", "</s>", "<s>", ".", "!!", "The", "don't ", "I'd, ", "'re", ", ", "; ", "it?", "é. ", "\x1c", "\x85", "\xa0", " ", "é", "İ", "\x00", "ſ"]
    for _ in range(60):
        made = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "a <", "| b <|"]
        ids, offsets = by_word.encode(pa.array(made))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        assert got == [whole.encode(t or "", add_special_tokens=False).ids + [packing.END] for t in made]


def test_lm_scores_as_registered_stay_near_exact_counts(spark, sf_dir):
    """With the registered bits and probes, some unseen n-grams are found: by how much a token's score moves on average."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    want = exact_lm({i: [*words(t), None] for i, t in rows}, held)
    training = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    got = by_id(lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), training))
    for some in (True, False):
        moved = [(got[i].score - want[i]) / got[i].n_tokens for i in want if held[i] == some]
        assert len(moved) > 20 and abs(float(np.mean(moved))) < 0.1 and float(np.mean(np.abs(moved))) < 0.15, (some, np.mean(moved), np.mean(np.abs(moved)))
