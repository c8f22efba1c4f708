"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import byte_slices

UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class TrigramSpace:
    """Random letter vectors of +1 and -1, and the trigram vectors bound from them.

    A letter's vector depends on its code point and the seed alone, so every worker builds the same
    space. A trigram is the product of its letters' vectors, the first rotated by two places and the
    second by one. At most `held` trigram vectors are kept at a time.
    """

    def __init__(self, dimensions: int, seed: int, held: int = 1 << 15):
        self.dimensions, self.seed, self.held = dimensions, seed, held
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.codes, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.zeros((1 << 10, self.dimensions), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= self.held:
                self.letters.clear()
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dimensions, dtype=np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        """The rows of self.vectors that hold these trigrams, made where they are missing."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        if len(self.codes):
            known = self.codes[np.minimum(at, len(self.codes) - 1)] == codes
        if not known.all():
            new, n = codes[~known], len(self.codes)
            if n + len(new) > self.held:
                self.clear()
                new, n = codes, 0
            while n + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            for k, code in enumerate(new.tolist()):
                a, b, c = code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF
                self.vectors[n + k] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            merged, places = np.concatenate([self.codes, new]), np.concatenate([self.places, np.arange(n, n + len(new))])
            order = np.argsort(merged, kind="stable")
            self.codes, self.places = merged[order], places[order]
            at = np.searchsorted(self.codes, codes)
        return self.places[at]

    def bundle(self, text: str) -> np.ndarray | None:
        """The unit vector of a text: its trigram vectors summed by count; None without a letter.

        Letters are lower-cased; a run of anything else counts as one blank, as do both ends.
        """
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = _letter_table()[points]
        if not letters.any():
            return None
        points = np.concatenate(([32], np.where(letters, points, 32), [32])).astype(np.int64)
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
        codes, counts = np.unique((points[:-2] << 42) | (points[1:-1] << 21) | points[2:], return_counts=True)
        total = np.zeros(self.dimensions, np.float32)
        for i in range(0, len(codes), self.held // 4):
            part = codes[i : i + self.held // 4]
            at = self._rows(part)
            total += counts[i : i + self.held // 4].astype(np.float32) @ self.vectors[at]
        return total / np.linalg.norm(total) if total.any() else total


@lru_cache(maxsize=2)
def _space(dimensions: int, seed: int) -> TrigramSpace:
    return TrigramSpace(dimensions, seed)


def language_profiles(
    labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", dimensions: int = 512, seed: int = 7, max_languages: int = 8192
) -> tuple[list[str], np.ndarray]:
    """Prototype unit vectors by language, from every labelled row.

    Rows whose language or text is null, or whose text has no letter, teach nothing. Each task sends
    one partial sum per language, so a language that holds most rows gathers no rows anywhere. The
    result is max_languages x dimensions numbers at most, 16 MiB by default, which is above the number of
    languages that have a code of three letters; more distinct labels than that are an error.
    """

    def partial(batches):
        space, sums = _space(dimensions, seed), {}
        for batch in byte_slices(batches, "text"):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                vector = space.bundle(text)
                if vector is not None:
                    if lang not in sums:
                        sums[lang] = np.zeros(dimensions, np.float64)
                    sums[lang] += vector
        space.clear()  # workers are used again
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "total"])

    rows = labelled.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")).where("text is not null and lang is not null")
    if len(rows.select("lang").distinct().limit(max_languages + 1).collect()) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    sums = rows.mapInArrow(partial, "lang string, total array<double>")
    places = sums.select("lang", F.posexplode("total").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = places.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("total")).orderBy("lang").collect()
    vectors = np.array([r["total"] for r in found], dtype=np.float64).reshape(len(found), dimensions)
    return [r["lang"] for r in found], (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def identify_languages(
    documents: DataFrame, profiles: tuple[list[str], np.ndarray], text_column: str = "text", seed: int = 7, lang_name: str = "lang_pred", score_name: str = "score", letter_name: str | None = None
) -> DataFrame:
    """All columns of documents, and the nearest language with its cosine (0 to 1).

    A text that is null, empty or without a letter gets `und` and 0, as does every text where no
    profile was learned. Equal cosines go to the first language by code point. Repeated rows keep
    their rows. One scan without a shuffle; input columns named like the results are replaced. With
    letter_name there is also a column of that name: whether the text holds a letter, whatever was learned.
    """
    langs, vectors = profiles
    dimensions = vectors.shape[1]

    def predict(batches):
        space = _space(dimensions, seed)
        for batch in byte_slices(batches, text_column):
            names, scores, letters = [], [], []
            for text in batch.column(batch.schema.get_field_index(text_column)).to_pylist():
                vector = space.bundle(text) if text and (langs or letter_name) else None
                letters.append(vector is not None)
                if vector is None or not langs:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    likeness = vectors @ vector
                    best = int(np.argmax(likeness))
                    names.append(langs[best])
                    scores.append(float(min(1.0, max(0.0, likeness[best]))))
            more = [pa.array(letters, pa.bool_())] if letter_name else []
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), *more], names=[*batch.schema.names, *out])
        space.clear()

    out = [lang_name, score_name, *([letter_name] if letter_name else [])]
    kept = documents.select(*[c for c in documents.columns if c not in out])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(predict, f"{fields}, {lang_name} string, {score_name} double" + (f", {letter_name} boolean" if letter_name else ""))


def training_rows(documents: DataFrame, id_column: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves a remainder other than 0: the rows to learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(folds)) != 0, F.lit(True))
