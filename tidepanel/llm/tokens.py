"""Token counts with a sentencepiece model, with overlap resynchronisation of huge documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


@lru_cache(maxsize=4)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _tokens(sp, text: str) -> list[tuple[int, int, int]]:
    """(id, begin, end) of every token; the offsets count code points of text."""
    found = sp.encode(text, return_type="offset_mapping")
    return [(i, b, e) for i, (b, e) in zip(found["ids"], found["offsets"])]


def resynchronised(sp, text: str, chunk: int = 16384, overlap: int = 256) -> Iterator[list[int]]:
    """The ids of the whole text in runs, encoded chunk by chunk; what is more than a chunk back is given out and let go.

    Each chunk begins `overlap` code points before the end of what is settled. The earlier and the
    later encoding are spliced at a boundary where both hold the same token before and the same
    token after it. Pair merging by rank is decided locally: a sequence is the encoding of its text
    exactly when each adjacent pair of tokens is the encoding of their joined text. On either side
    of such a boundary the pairs come from one true encoding each, and the pair across it from both,
    so the spliced sequence is the encoding of the whole. The first token of a later chunk carries
    the artificial leading mark and never takes part; nor do the tokens at a chunk's cut end. Where
    no common boundary exists, the overlap doubles, in the end over all that is held; should that fail
    too, what was held is not enough, and the text is encoded anew with chunks of twice the size.
    """
    n = len(text)
    done, given = _tokens(sp, text[:chunk]), 0
    end = min(chunk, n)
    while end < n:
        width = overlap
        while True:
            start = max(0, end - width)
            stop = min(n, end + chunk)
            if start == 0 and not given:
                done = _tokens(sp, text[:stop])
                break
            if given and start < done[0][1]:
                raise _NoBoundary
            later = [(i, b + start, e + start) for i, b, e in _tokens(sp, text[start:stop])]
            at = _common_boundary(done, later, start)
            if at is not None:
                done[at[0] :] = later[at[1] :]
                break
            width *= 2
        end = stop
        far = next((k for k, t in enumerate(done) if t[1] >= end - 2 * chunk), 0)
        if far:
            yield [i for i, _, _ in done[:far]]
            given += far
            del done[:far]
    yield [i for i, _, _ in done]


class _NoBoundary(Exception):
    """No common boundary lies in what is held."""


def encode_resynchronised(sp, text: str, chunk: int = 16384, overlap: int = 256) -> list[int]:
    """The ids of the whole text."""
    while True:
        try:
            return [i for run in resynchronised(sp, text, chunk, overlap) for i in run]
        except _NoBoundary:
            chunk *= 2


def count_resynchronised(sp, text: str, chunk: int = 16384, overlap: int = 256) -> int:
    """The number of the whole text's ids; holds about two chunks of them."""
    while True:
        try:
            return sum(len(run) for run in resynchronised(sp, text, chunk, overlap))
        except _NoBoundary:
            chunk *= 2


def _common_boundary(done: list, later: list, start: int) -> tuple[int, int] | None:
    """Indices (in done, in later) of the first token after a proven common boundary."""
    first = len(done)
    while first > 0 and done[first - 1][1] >= start:
        first -= 1
    seen = {}
    for k in range(first + 1, len(done)):
        # byte pieces of one character share their span, so only true advances are boundaries
        if done[k - 1][2] == done[k][1] and done[k - 1][1] < done[k - 1][2] and done[k][1] < done[k][2]:
            seen[done[k - 1], done[k]] = k
    for j in range(2, len(later)):
        k = seen.get((later[j - 1], later[j]))
        if k is not None:
            return k, j
    return None


def token_counts(
    documents: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 4096,
    chunk: int = 16384,
    overlap: int = 256,
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    Texts above two chunks are encoded by overlap resynchronisation, so memory is bounded by a few chunks'
    tokens beside the text itself, unless no boundary can be found. A null text counts as empty, with 0 tokens; repeated rows and null ids
    each keep their row; other columns are ignored; an empty table gives no rows. One scan without
    a shuffle. The model file must be at model_path on every executor.
    """
    batch_bytes = 1 << 20

    def count(batches):
        sp = _processor(model_path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            counts = [0] * len(texts)
            group, held = [], 0
            for i, text in enumerate(texts):
                if sizes[i] > 2 * chunk and len(text) > 2 * chunk:
                    counts[i] = count_resynchronised(sp, text, chunk, overlap)
                elif text:
                    group.append(i)
                    held += sizes[i]
                if group and (held >= batch_bytes or i == len(texts) - 1):
                    for k, ids in zip(group, sp.encode([texts[k] for k in group], num_threads=1)):
                        counts[k] = len(ids)
                    group, held = [], 0
            if group:
                for k, ids in zip(group, sp.encode([texts[k] for k in group], num_threads=1)):
                    counts[k] = len(ids)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts])],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    return documents.select(id_column, text_column).mapInArrow(count, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
