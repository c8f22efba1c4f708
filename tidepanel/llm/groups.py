"""Reading rows by groups and by bounded pieces inside a task, and union-find over one group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each run of equal values in the first `keys` columns; rows must come sorted by them.

    Holds one group and one batch at a time.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.concatenate((np.flatnonzero(change), [batch.num_rows]))
        start = 0
        for cut in cuts.tolist():
            held.append(batch.slice(start, cut - start))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
            start = cut
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces whose `column`, of strings or bytes, holds about `most` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        sums = np.cumsum(sizes.astype(np.int64) + 16)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(sums, (sums[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Union:
    """Union-find over positions 0..n-1; roots are the smallest position of their set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]
        return self.up
