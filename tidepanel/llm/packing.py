"""Packing documents into fixed windows of tokens by lexical retrieval: a sharded BM25 inverted index."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .groups import byte_slices
from .words import hashed_words, text_bytes, word_texts

END = 2
IDF_POWER = 1.0
SAMPLE, MOST_SAMPLED = 64, 1 << 20  # documents whose keys cut the order, for each range and in all


class WordTokenizer:
    """The token ids of texts, word by word.

    The tokenizer lower-cases, drops white space and never joins across it, so the ids of a text are those
    of its blank-separated words in turn. A word's ids are kept under its 64-bit hash, in arrays of about
    `held_bytes`; new words are encoded many at a time with a special token between them, as each call
    costs more than a word. Words that may hold special strings are encoded each time.
    """

    def __init__(self, path: str, held_bytes: int = 48 << 20):
        from tokenizers import Tokenizer

        self.tokenizer, self.held_bytes = Tokenizer.from_file(path), held_bytes
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.separator_id, self.separator = max(added.items())
        self.marks = sorted({t[:2] for t in added.values()})
        self.stops = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in ".,;:!?"} if self._letters_go_straight() else {}
        self.clear()

    def clear(self) -> None:
        self.codes, self.at, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, "<u4")

    def _letters_go_straight(self) -> bool:
        """Whether ASCII letters are, in lower case, one piece for the model, and a stop behind them another: told by the tokenizer's own parts."""

        def flat(part: dict | None, key: str) -> list[dict]:
            return [] if part is None else [x for p in part[key] for x in flat(p, key)] if part["type"] == "Sequence" else [part]

        parts = json.loads(self.tokenizer.to_str())
        normal, pieces = flat(parts["normalizer"], "normalizers"), flat(parts["pre_tokenizer"], "pretokenizers")
        harmless = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"}) for n in normal)
        letters = lambda p: p["type"] == "Split" and p["invert"] and p["behavior"] == "Removed" and "|[\\p{L}]+|" in (x := p["pattern"].get("Regex", "")) and x.endswith("|[^\\s\\p{L}\\p{N}]+")
        plain = lambda p: p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"]
        return harmless and any(n["type"] == "Lowercase" for n in normal) and all(letters(p) or plain(p) for p in pieces) and any(map(letters, pieces)) and not any(t["content"].isalpha() for t in parts["added_tokens"])

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in turn, and how many each has. ASCII letters, with a stop or without, go to the model where that is the same."""
        tokenize, stops = self.tokenizer.model.tokenize, self.stops

        def straight(w: str) -> list[int] | None:
            if not w.isascii():
                return None
            if w.isalpha():
                return [t.id for t in tokenize(w.lower())]
            return [t.id for t in tokenize(w[:-1].lower())] + stops[w[-1]] if w[-1:] in stops and w[:-1].isalpha() else None

        found = [straight(w) for w in words] if stops else [None] * len(words)
        others = iter(self._ids_of_texts([w for w, f in zip(words, found) if f is None]))
        found = [next(others) if f is None else f for f in found]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def _ids_of_texts(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for i in range(0, len(words), 64):
            ids = self.tokenizer.encode_batch_fast([self.separator.join(words[i : i + 64])], add_special_tokens=False)[0].ids
            ends = [k for k, x in enumerate(ids) if x == self.separator_id]
            out += [ids[a + 1 : b] for a, b in zip([-1, *ends], [*ends, len(ids)])]
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids, each row ended by END, and the rows' offsets in them."""
        data, offsets = text_bytes(column)
        starts, rows, hashes = hashed_words(data, offsets)
        marks = np.concatenate([np.flatnonzero((data[:-1] == ord(m[0])) & (data[1:] == ord(m[1]))) for m in self.marks])
        special = np.searchsorted(starts, marks, "right") - 1
        special = np.unique(special[np.searchsorted(starts, marks + 1, "right") - 1 == special])  # a mark over two rows is none
        if 20 * len(self.codes) + self.pool.nbytes > self.held_bytes:
            self.clear()
        codes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.codes, codes)
        new = np.ones(len(codes), bool) if len(self.codes) == 0 else self.codes[np.minimum(at, len(self.codes) - 1)] != codes
        if new.any():
            plain = ~np.isin(first[new], special)  # the others have no ids here
            texts = np.full(len(plain), "", object)
            texts[plain] = word_texts(data, starts, first[new][plain])
            found, length = self._ids(texts.tolist())
            begin = len(self.pool) + np.concatenate(([0], np.cumsum(length)[:-1]))
            self.pool = np.concatenate([self.pool, found])
            self.codes, self.at, self.length = (np.insert(held, at[new], more) for held, more in ((self.codes, codes[new]), (self.at, begin), (self.length, length)))
        place = np.searchsorted(self.codes, codes)[which]
        pool, begin, length = self.pool, self.at[place], self.length[place].astype(np.int64)
        if len(special):
            found = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4") for w in word_texts(data, starts, special)]
            length[special] = [len(x) for x in found]
            begin[special] = len(pool) + np.concatenate(([0], np.cumsum(length[special])[:-1]))
            pool = np.concatenate([pool, *found])
        ends = np.concatenate(([0], np.cumsum(length)))
        out = np.full(int(ends[-1]) + len(rows) - 1, END, "<u4")
        row_ends = ends[rows]
        into = np.arange(ends[-1]) + np.repeat(np.arange(len(rows) - 1), np.diff(row_ends))
        out[into] = pool[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], length)]
        return out, row_ends + np.arange(len(rows))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class LexicalIndex:
    """BM25 postings over the token ids of a shard's documents."""

    def __init__(self, ids: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        lengths = np.array([len(x) for x in ids], np.float64)
        pairs = [np.unique(x, return_counts=True) for x in ids]
        doc = np.repeat(np.arange(len(ids)), [len(t) for t, _ in pairs])
        term = np.concatenate([t for t, _ in pairs]).astype(np.int64)
        count = np.concatenate([c for _, c in pairs]).astype(np.float64)
        df = np.bincount(term)
        self.idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
        weight = self.idf[term] * count * (k1 + 1) / (count + k1 * (1 - b + b * lengths[doc] / max(lengths.mean(), 1.0)))
        order = np.argsort(term, kind="stable")
        self.docs, self.weights, self.starts = doc[order], weight[order], np.concatenate(([0], np.cumsum(df)))
        self.terms, self.size = [t[df[t] > 1] for t, _ in pairs], len(ids)

    def scores(self, doc: int, query_terms: int | None = None) -> np.ndarray:
        """BM25 of every document for the terms that one shares with others, or the rarest `query_terms` of these."""
        terms = self.terms[doc]
        if query_terms is not None and len(terms) > query_terms:
            terms = terms[np.argsort(-self.idf[terms], kind="stable")[:query_terms]]
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in terms.tolist()]
        if not spans:
            return np.zeros(self.size)
        return np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), self.size)


def pack_shard(ids: list[np.ndarray], window: int, query_terms: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length).

    Documents first fill whole windows by themselves. Each seed's rest is then filled up greedily
    with unused neighbours by falling BM25, those without a common term last in order; the best
    neighbour that doesn't fit is cut to fill the window and what is left of it stays unused.
    """
    out, start = [], np.zeros(len(ids), np.int64)
    left = np.array([len(x) for x in ids], np.int64)
    for d in np.flatnonzero(left >= window).tolist():
        while left[d] >= window:
            out.append([(d, int(start[d]), window)])
            start[d] += window
            left[d] -= window
    index = LexicalIndex(ids)
    for seed in range(len(ids)):
        if left[seed] == 0:
            continue
        sequence, space = [(seed, int(start[seed]), int(left[seed]))], int(window - left[seed])
        left[seed] = 0
        scores = np.where(left > 0, index.scores(seed, query_terms), -1.0)
        ranked = np.argsort(-scores, kind="stable")[: np.count_nonzero(left)]
        sizes = left[ranked]
        fits = np.flatnonzero(np.cumsum(sizes) <= space)
        taken = ranked[: len(fits)]
        for d in taken.tolist():
            sequence.append((d, int(start[d]), int(left[d])))
            space -= int(left[d])
            left[d] = 0
        if space and len(taken) < len(ranked):
            d = int(ranked[len(taken)])
            sequence.append((d, int(start[d]), space))
            start[d] += space
            left[d] -= space
        out.append(sequence)
    return out


def term_orders(df: np.ndarray, documents: int, seed: int = 29) -> np.ndarray:
    """Two seeded orders of the terms, each a place by term id; those with a high idf come early more often.

    The first term of a document in such an order is its weighted minhash: two documents have the same
    one about as often as their shared terms' weight is a part of all their terms'. Terms of fewer than
    two documents share the last place.
    """
    idf = np.log1p((documents - df + 0.5) / (df + 0.5))
    draws = np.random.Generator(np.random.PCG64(seed)).exponential(size=(2, len(df))) / np.maximum(idf, 1e-9) ** IDF_POWER
    places = np.argsort(np.argsort(np.where(df > 1, draws, np.inf), axis=1, kind="stable"), axis=1, kind="stable")
    return np.where(df > 1, places, len(df)).astype(np.int64)


def first_places(terms: list[bytes], orders: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """The places of each document's first term in both orders; terms are little-endian unsigned 32-bit bytes, one at least.

    Documents are taken together up to about `most` bytes.
    """
    ends = np.cumsum([len(r) for r in terms])
    out = [np.zeros((2, 0), np.int64)]
    i = 0
    while i < len(terms):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        starts = np.concatenate(([0], np.cumsum([len(r) // 4 for r in terms[i : j - 1]]))).astype(np.int64)
        out.append(np.minimum.reduceat(orders[:, np.frombuffer(b"".join(terms[i:j]), "<u4")], starts, axis=1))
        i = j
    return np.concatenate(out, axis=1)


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of 4-byte values as bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(4 * offsets.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def _tokenized(documents: DataFrame, tokenizer_path: str, id_column: str, text_column: str) -> DataFrame:
    """doc, salt, bytes (of text), ids, and terms (the distinct ids)."""
    rows = documents.select(F.col(id_column).alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    salt = F.shiftrightunsigned(F.xxhash64("doc", "text"), 12) / F.lit(float(1 << 52))
    rows = rows.select("doc", salt.alias("salt"), F.octet_length("text").cast("long").alias("bytes"), "text")

    def encode(batches):
        tokenizer = _tokenizer(tokenizer_path)
        for batch in byte_slices(batches, "text"):
            ids, offsets = tokenizer.encode(batch.column(3))
            terms = [np.unique(ids[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            sizes = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
            yield pa.record_batch([*batch.columns[:3], _binary(ids, offsets), _binary(np.concatenate(terms), sizes)], names=["doc", "salt", "bytes", "ids", "terms"])

    kind = documents.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc {kind}, salt double, bytes long, ids binary, terms binary")


def term_counts(tokenized: DataFrame) -> np.ndarray:
    """In how many documents each term occurs, by term id; the vocabulary bounds it."""

    def count(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            more = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"))
            seen, more = (seen, more) if len(seen) >= len(more) else (more, seen)
            seen[: len(more)] += more
        found = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(found), pa.array(seen[found])], names=["term", "n"])

    counts = tokenized.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(max(counts["term"].to_pylist(), default=0) + 1, np.int64)
    df[counts["term"].to_numpy()] = counts["n"].to_numpy()
    return df


def content_key(orders: np.ndarray, cuts: np.ndarray) -> Callable[[str, str], Column]:
    """(key, range) of a document: a number by which it is sorted, and how many of the cuts don't lie above it.

    The number is the place of the first term in both orders, then 26 bits of the salt. Only terms and salts
    go through Python; the other columns stay where they are.
    """
    bits = max(1, int(orders.max(initial=0)).bit_length())

    def key(terms: pd.Series, salt: pd.Series) -> pd.DataFrame:
        first = first_places(terms.tolist(), orders)
        keys = (((first[0] << bits) | first[1]) << 26) | (salt.to_numpy() * (1 << 26)).astype(np.int64)
        return pd.DataFrame({"key": keys, "range": np.searchsorted(cuts, keys, "right").astype(np.int32)})

    return F.pandas_udf(key, "key long, range int")


def ordered_by_content(tokenized: DataFrame, partition_bytes: int) -> DataFrame:
    """doc, bytes, ids: documents of the same first terms follow each other, in partitions of about partition_bytes of text.

    Documents are dealt to ranges of content_key and sorted by it, so those that share rare terms lie near
    each other, and a large group of copies is cut over as many ranges as it fills. The cuts come from
    the documents whose salt, a hash of id and text, is least, some SAMPLE a range and MOST_SAMPLED at most, so
    a rerun makes the same ranges. The sample reads terms alone, and all ids are read once.
    """
    df = term_counts(tokenized)
    orders = term_orders(df, int(df[END]) if len(df) > END else 0)  # every document has the end token
    documents, total = tokenized.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    ranges = max(1, -(-total // partition_bytes))
    cuts = np.zeros(0, np.int64)
    if ranges > 1:
        share = min(SAMPLE * ranges, MOST_SAMPLED) / documents
        sample = tokenized.where(F.col("salt") < share).select(content_key(orders, cuts)("terms", "salt")["key"].alias("key"), "bytes")
        cuts = _cuts(sample.toArrow(), ranges)
    at = content_key(orders, cuts)("terms", "salt")
    placed = tokenized.select("doc", "salt", "bytes", "ids", at.alias("at")).select("doc", "salt", "bytes", "ids", "at.range", "at.key")
    return placed.repartition(ranges, "range").sortWithinPartitions("range", "key", "salt", "doc").select("doc", "bytes", "ids")


def _cuts(sample: pa.Table, ranges: int) -> np.ndarray:
    """Keys that part the sample into ranges of about equal bytes."""
    keys = sample["key"].to_numpy()
    order = np.argsort(keys, kind="stable")
    sums = np.cumsum(np.maximum(sample["bytes"].to_numpy()[order], 64))
    at = np.searchsorted(sums, np.arange(1, ranges) * (sums[-1] / ranges if len(sums) else 0))
    return np.unique(keys[order][np.minimum(at, len(sums) - 1)]) if len(sums) else np.zeros(0, np.int64)


def shards(batches: Iterable[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.Table]:
    """Consecutive rows of (doc, bytes, ids) of shard_bytes of text; the last shard has up to half as much again.

    Rows weigh what they hold in memory at least, so empty texts don't make a shard of any number of rows.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in byte_slices(batches, "ids"):
        held.append(batch)
        size += int(np.maximum(batch.column(1).to_numpy(), 64).sum())
        while size >= shard_bytes * 3 // 2:
            rows = pa.Table.from_batches(held)
            sums = np.cumsum(np.maximum(rows["bytes"].to_numpy(), 64))
            cut = int(np.searchsorted(sums, shard_bytes)) + 1
            yield rows.slice(0, cut)
            held, size = rows.slice(cut).to_batches(), int(sums[-1] - sums[cut - 1])
    if size:
        yield pa.Table.from_batches(held)


def sharded(tokenized: DataFrame, shard_bytes: int) -> DataFrame:
    """doc, ids, shard: which documents share an index."""

    def number(batches):
        at = TaskContext.get().partitionId() << 32
        for shard in shards(batches, shard_bytes):
            for batch in shard.select(["doc", "ids"]).to_batches():
                yield batch.append_column("shard", pa.array(np.full(batch.num_rows, at), pa.int64()))
            at += 1

    kind = tokenized.schema["doc"].dataType.simpleString()
    return ordered_by_content(tokenized, 4 * shard_bytes).mapInArrow(number, f"doc {kind}, ids binary, shard long")


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 4096,
    shard_bytes: int = 4 << 20,
    query_terms: int | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are ordered by weighted minhashes of their terms, so those that share rare terms lie near
    each other, and the order is cut into shards of about `shard_bytes` of text, a bounded group
    whatever the ids, sources and copies are. Every shard has its own inverted index, and leaves at most
    one sequence short of the window. Padding is not written: a sequence is its pieces.

    A null text is empty and holds the end token alone; rows that repeat an id are documents of their
    own, and so are rows with a null id; an empty table gives no rows. A rerun over the same rows gives the
    same sequences.
    """
    tokenized, _ = written(_tokenized(documents, tokenizer_path, id_column, text_column), "tokenized")
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        for shard in shards(batches, shard_bytes):
            raw = shard["ids"].to_pylist()
            doc, start, length, crc, tokens, sequence_id, offset = [], [], [], [], [], [], []
            for sequence in pack_shard([np.frombuffer(r, "<u4") for r in raw], window, query_terms):
                at = 0
                for d, first, n in sequence:
                    for into, value in zip((doc, start, length, crc, tokens, sequence_id, offset), (d, first, n, zlib.crc32(raw[d][4 * first : 4 * (first + n)]), len(raw[d]) // 4, number, at)):
                        into.append(value)
                    at += n
                number += 1
            yield pa.record_batch([shard["doc"].combine_chunks().take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens, sequence_id, offset))], names=names)

    kind = documents.schema[id_column].dataType.simpleString()
    return ordered_by_content(tokenized, 4 * shard_bytes).mapInArrow(
        pack, f"`{id_column}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
