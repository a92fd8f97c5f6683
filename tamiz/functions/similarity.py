"""Token-sort similarity: Indel similarity of whitespace tokens in sorted order."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import SPACE, strip

# Ship the scorer with the task, so that workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def token_sort(col: Column) -> Column:
    """Whitespace tokens in code-point order, joined by one space."""
    return F.array_join(F.array_sort(F.split(strip(col), SPACE + "+")), " ")


def code_points(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts one after the other, lengths)."""
    lengths = texts.str.len().to_numpy(dtype=np.int64, na_value=0) if len(texts) else np.zeros(0, dtype=np.int64)
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype="<u4"), lengths


@pandas_udf(
    T.StructType([T.StructField("letters_1", T.LongType()), T.StructField("letters_2", T.LongType())])
)
def letter_marks(texts: pd.Series) -> pd.DataFrame:
    """Two 64-bit marks of the letters of a text, for a cheap bound on edits.

    Characters fall into 32 buckets; bit (bucket, t) says that the bucket holds
    more than t characters, t = 0, 1 in the first mark and 2, 3 in the second.
    Inserting or deleting one character flips at most one bit, so two texts at
    Indel distance d differ in at most d bits.
    """
    chars, lengths = code_points(texts)
    cell = np.repeat(np.arange(len(lengths)), lengths) * 32 + chars % 32
    held = np.bincount(cell, minlength=32 * len(lengths)).reshape(-1, 1, 32)
    bits = (held > np.arange(4).reshape(1, 4, 1)).reshape(-1, 128)
    marks = np.packbits(bits, axis=1, bitorder="little").view("<i8")
    return pd.DataFrame(marks, columns=["letters_1", "letters_2"])


def padded(chars: np.ndarray, lengths: np.ndarray, filler: int) -> np.ndarray:
    """One row of code points for each text, filled up with ``filler``."""
    out = np.full((len(lengths), int(lengths.max(initial=0))), filler, dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = chars
    return out


def lcs_lengths(a: pd.Series, b: pd.Series, cells: int = 1 << 20) -> np.ndarray:
    """Longest common subsequence of each pair of strings, for a whole batch.

    A bit for every character of ``a`` in rows of 64-bit words; one step for
    every character of ``b``, over all pairs of a slice at once. Pairs are taken
    in order of their lengths, ``cells`` character comparisons at a time.
    """
    (ca, na), (cb, nb) = code_points(a), code_points(b)
    sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb
    out = np.zeros(len(na), dtype=np.int64)
    order = np.lexsort((nb, na))
    i = 0
    while i < len(order):
        j = min(len(order), i + max(1, cells // max(1, int(na[order[i]]) + 64)))
        rows = order[i:j]
        x = padded(ca[np.repeat(sa[rows], na[rows]) + _within(na[rows])], na[rows], -1)
        y = padded(cb[np.repeat(sb[rows], nb[rows]) + _within(nb[rows])], nb[rows], -2)
        words = max(1, -(-x.shape[1] // 64))
        open_bits = np.full((words, len(rows)), ~np.uint64(0))
        for step in range(y.shape[1]):
            same = np.zeros((len(rows), 64 * words), dtype=bool)
            np.equal(x, y[:, step, None], out=same[:, : x.shape[1]])
            hit = np.packbits(same, axis=1, bitorder="little").view("<u8").T
            carry = np.zeros(len(rows), dtype=np.uint64)
            for w in range(words):
                taken = open_bits[w] & hit[w]
                added = open_bits[w] + taken
                total = added + carry
                carry = ((added < taken) | (total < carry)).astype(np.uint64)
                open_bits[w] = total | (open_bits[w] & ~hit[w])
        used = np.unpackbits((~open_bits).T.copy().view(np.uint8), axis=1, bitorder="little")
        out[rows] = (used[:, : x.shape[1]] & (np.arange(x.shape[1]) < na[rows][:, None])).sum(axis=1)
        i = j
    return out


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of the given lengths, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


@pandas_udf(T.DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 * LCS / (len(a) + len(b)) for each pair of strings; 100 for two empty ones."""
    total = a.str.len().to_numpy(dtype=np.float64) + b.str.len().to_numpy(dtype=np.float64)
    return pd.Series(np.where(total > 0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1), 100.0))


# Evaluated once per pair: a deterministic function would be computed again for
# the filter on its result.
indel_similarity = indel_similarity.asNondeterministic()
