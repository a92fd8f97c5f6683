"""Comparing blocks of rows inside tasks: rows of one cell together, classes of its members."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first ``keys`` columns."""
    rest = None
    for batch in parts:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, dtype=bool)
        change[0] = True
        for k in range(keys):
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member reachable from each of n members by the links (a, b)."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
        if (least == before).all():
            return least
