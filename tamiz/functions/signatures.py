"""Cutting texts into pieces so that each piece holds a rare gram."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Ship the functions with the task, so that workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Widest gram that stands for a piece.
WIDEST = 4
#: Texts, times the levels of rarity tried at once.
SLICE = 4096
NEVER = np.int64(1) << 62

PIECES = T.ArrayType(
    T.StructType([T.StructField("k", T.IntegerType()), T.StructField("q", T.IntegerType()), T.StructField("at", T.IntegerType())])
)


def cut(lengths: np.ndarray, wanted: np.ndarray, shortest: np.ndarray, counts: np.ndarray, limits: np.ndarray) -> tuple:
    """(pieces found, gram widths, gram places) of texts, one limit of rarity for each.

    ``counts[q - 1, i, p]`` says how often the gram of q characters at place p of text i occurs. From the left, a
    piece ends as soon as it holds a gram that occurs no more often than the limit; the last of the ``wanted``
    pieces goes to the end. Of a piece's grams the rarest stands for it.
    """
    n, most = len(lengths), int(wanted.max(initial=1))
    row = np.arange(n)
    found, start = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    best, best_q, best_at = np.full(n, NEVER), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    width, place = np.zeros((n, most), dtype=np.int32), np.zeros((n, most), dtype=np.int32)
    for j in range(int(lengths.max(initial=0))):
        q = np.minimum(WIDEST, j - start + 1)  # a narrower gram inside it is no rarer
        cost = np.where((q >= shortest) & (j < lengths), counts[q - 1, row, np.maximum(j - q + 1, 0)], NEVER)
        better = cost < best
        best = np.where(better, cost, best)
        best_q, best_at = np.where(better, q, best_q), np.where(better, j - q + 1, best_at)
        done = np.flatnonzero((best <= limits) & (found < wanted - 1))
        width[done, found[done]], place[done, found[done]] = best_q[done], best_at[done]
        found[done] += 1
        start[done], best[done] = j + 1, NEVER
    done = np.flatnonzero((best <= limits) & (found == wanted - 1))
    width[done, found[done]], place[done, found[done]] = best_q[done], best_at[done]
    found[done] += 1
    return found, width, place


def rarest_pieces(lengths: np.ndarray, wanted: np.ndarray, shortest: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram widths, gram places) of the pieces, with the smallest power of two as limit that allows the number wanted."""
    seen = counts[counts < NEVER]
    levels = int(seen.max(initial=1)).bit_length() + 1
    limits = np.int64(1) << np.arange(levels)
    n, step = len(lengths), max(1, SLICE // levels)
    width, place = (np.zeros((n, int(wanted.max(initial=1))), dtype=np.int32) for _ in range(2))
    for i in range(0, n, step):
        part = slice(i, min(n, i + step))
        size = part.stop - part.start
        tile = lambda x: np.repeat(x[part], levels)
        found, w, p = cut(tile(lengths), tile(wanted), tile(shortest), np.repeat(counts[:, part], levels, axis=1), np.tile(limits, size))
        enough = (found == tile(wanted)).reshape(size, levels)
        first = np.arange(size) * levels + enough.argmax(axis=1)
        width[part, : w.shape[1]], place[part, : p.shape[1]] = w[first], p[first]
    return width, place


def piece_chooser(counters: np.ndarray):
    """A UDF (length, pieces wanted, shortest gram, counter of each gram by width) -> array of (k, q, at)."""

    @pandas_udf(PIECES)
    def choose(
        lengths: pd.Series, wanted: pd.Series, shortest: pd.Series, w1: pd.Series, w2: pd.Series, w3: pd.Series, w4: pd.Series
    ) -> pd.Series:
        n, want, least = (x.to_numpy(dtype=np.int64) for x in (lengths, wanted, shortest))
        out = np.empty(len(n), dtype=object)
        order = np.argsort(n, kind="stable")
        i = 0
        while i < len(order):  # texts of like lengths together
            j = min(len(order), int(np.searchsorted(n[order], 2 * n[order[i]] + 16)), i + SLICE)
            rows = order[i:j]
            counts = np.full((WIDEST, len(rows), int(n[rows].max()) + 1), NEVER)
            for q, cells in enumerate((w1, w2, w3, w4)):
                held = cells.iloc[rows]
                size = held.str.len().to_numpy(dtype=np.int64)
                if size.sum():
                    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    counts[q, np.repeat(np.arange(len(rows)), size), at] = counters[np.concatenate(held.to_numpy())]
            width, place = rarest_pieces(n[rows], want[rows], least[rows], counts)
            for r, row in enumerate(rows):
                out[row] = [{"k": k, "q": int(width[r, k]), "at": int(place[r, k])} for k in range(want[row])]
            i = j
        return pd.Series(out)

    return choose
