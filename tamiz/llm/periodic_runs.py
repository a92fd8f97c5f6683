"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 q)`` words long, that
no neighbouring word extends keeping the period. All runs of a text are found, with no limit on period or length.

- Periods below SHORT are found by direct scans: words compared with the words one lag before.
- Scale W = 16, 32, ... is for periods from W to 2 W - 1. Grams of W / 2 words are hashed, and the smallest gram of
  every W / 2 consecutive grams, the leftmost of equal ones, is a minimizer. The first such window of a run and
  the window one period later lie in the run and have the same words, so the two minimizers have the same gram
  and stand a period apart. Equal minimizers W to 2 W - 1 words apart are the seeds; each is extended to both
  sides by binary search over prefix hashes, and what is found is compared word by word.
- Two grams inside one run of a shorter period seed nothing new (their distance is a multiple of that period), so
  minimizers deep inside such a run are left out, and a text of one repeated word costs no more than any other.

Words are compared by 64-bit hashes. Many texts are scanned as one array, with a separator that occurs once
between two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, batches, mix, strings, windows

_U = np.uint64
_FACTOR = 0xD6E8FEB86659FD93
#: Periods below are found by direct scans; the first scale.
SHORT = 16
#: Seeds extended at a time.
SEEDS = 1 << 19

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lag_runs(h: np.ndarray, lag: int, least: int) -> np.ndarray:
    """Rows (start, end, lag) of the maximal stretches that repeat after ``lag`` words and are long enough."""
    if len(h) <= lag:
        return np.zeros((0, 3), dtype=np.int64)
    same = np.zeros(len(h) - lag + 2, dtype=bool)
    np.equal(h[lag:], h[:-lag], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])
    a, b = edges[::2], edges[1::2]
    keep = b - a + lag >= max(least, 2 * lag)
    a, b = a[keep], b[keep]
    return np.stack((a, b + lag, np.full(len(a), lag)), axis=1).astype(np.int64)


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch: a multiple of the smallest period finds the same stretch."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


class _Prefixes:
    """Whether stretches of words are equal, by one prefix sum of hashes times powers."""

    def __init__(self, h: np.ndarray):
        self.power = np.full(len(h) + 1, _FACTOR, dtype=np.uint64)
        self.power[0] = 1
        np.cumprod(self.power, dtype=np.uint64, out=self.power)
        self.sum = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * self.power[:-1], dtype=np.uint64, out=self.sum[1:])

    def equal(self, x: np.ndarray, lag: np.ndarray, length: np.ndarray) -> np.ndarray:
        y = x + lag
        return (self.sum[x + length] - self.sum[x]) * self.power[lag] == self.sum[y + length] - self.sum[y]

    def extended(self, at: np.ndarray, lag: np.ndarray, longest: int) -> np.ndarray:
        """Rows (start, end, lag) of the stretches around ``at`` that repeat after ``lag``, found in halving steps."""
        n = len(self.sum) - 1
        back, ahead = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for j in reversed(range(max(1, longest.bit_length()))):
            step = np.int64(1 << j)
            fits = np.flatnonzero(at + lag + ahead + step <= n)
            good = fits[self.equal(at[fits] + ahead[fits], lag[fits], step)]
            ahead[good] += step
            fits = np.flatnonzero(at - back - step >= 0)
            good = fits[self.equal(at[fits] - back[fits] - step, lag[fits], step)]
            back[good] += step
        return np.stack((at - back, at + ahead + lag, lag), axis=1)


def minimizers(gram: np.ndarray, width: int) -> np.ndarray:
    """Positions of the leftmost smallest gram in every ``width`` consecutive ones; ``width`` is a power of two."""
    bits = max(1, len(gram).bit_length())
    low = (mix(gram) >> _U(bits) << _U(bits)) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while size < width and len(low) > size:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    at = (low & _U((1 << bits) - 1)).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def _seeds(gram: np.ndarray, scale: int, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, distance) of equal minimizers ``scale`` to ``2 scale - 1`` words apart, some at a time."""
    g = scale // 2
    at = minimizers(gram, g)
    inside, run = np.zeros(len(at), dtype=bool), -1 - np.arange(len(at))
    left = right = np.ones(len(at), dtype=bool)
    known = known[known[:, 2] <= g]
    if len(known):
        known = known[np.argsort(known[:, 0], kind="stable")]
        reach = np.maximum.accumulate(known[:, 1])  # of the runs that start so far, the one that ends last
        which = np.maximum.accumulate(np.where(known[:, 1] == reach, np.arange(len(known)), 0))
        j = np.searchsorted(known[:, 0], at, side="right") - 1
        inside = (j >= 0) & (reach[j] >= at + g)
        run = np.where(inside, which[j], run)
        left = ~inside | (reach[j] - at < 2 * scale + g)
        right = ~inside | (at - known[which[j], 0] < 2 * scale)
    rank = np.unique(gram[at], return_inverse=True)[1].astype(np.int64)
    key = rank * np.int64(len(gram) + 4 * scale) + at
    of = np.flatnonzero(right)
    of = of[np.argsort(key[of], kind="stable")]
    left = np.flatnonzero(left)
    lo, hi = np.searchsorted(key[of], key[left] + scale), np.searchsorted(key[of], key[left] + 2 * scale)
    some = hi > lo
    left, lo, n = left[some], lo[some], (hi - lo)[some]
    total = np.concatenate(([0], np.cumsum(n)))
    i = 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(total, total[i] + SEEDS, side="right")) - 1)
        a = np.repeat(left[i:j], n[i:j])
        b = of[np.repeat(lo[i:j] - total[i:j], n[i:j]) + np.arange(total[i], total[j])]
        new = run[a] != run[b]
        yield at[a[new]], at[b[new]] - at[a[new]]
        i = j


def _checked(h: np.ndarray, runs: np.ndarray, least: int) -> np.ndarray:
    """The runs, compared word by word; the lags of those that fail are scanned directly."""
    failed = {
        int(q) for s, e, q in runs.tolist()
        if not np.array_equal(h[s : e - q], h[s + q : e]) or (s and h[s - 1] == h[s - 1 + q]) or (e < len(h) and h[e] == h[e - q])
    }
    if not failed:
        return runs
    return np.concatenate([runs[~np.isin(runs[:, 2], list(failed))], *(lag_runs(h, q, least) for q in sorted(failed))])


def runs_of(h: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, end, smallest period) of all runs, by start and end.

    ``h`` has the words of texts of the given sizes, longest first, a separator after each.
    """
    longest = int(sizes.max(initial=0))
    found = [lag_runs(h, q, least) for q in range(1, min(SHORT, longest))]
    runs = smallest_periods(np.concatenate(found)) if found else np.zeros((0, 3), dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    gram, scale, prefixes = None, SHORT, None
    while 2 * scale <= longest:
        n = int(ends[np.count_nonzero(sizes >= 2 * scale) - 1])  # only texts that can hold such a period
        g = scale // 2
        if gram is None:
            gram = windows(h[:n], g, _FACTOR)
            prefixes = _Prefixes(h[:n])
        else:
            half, starts = g // 2, n - g + 1
            gram = gram[:starts] * _U(pow(_FACTOR, half, 1 << 64)) + gram[half : half + starts]
        new = [runs]
        for at, lag in _seeds(gram, scale, runs[runs[:, 0] < n]):
            got = prefixes.extended(at, lag, longest)
            got = np.unique(got[got[:, 1] - got[:, 0] >= np.maximum(least, 2 * got[:, 2])], axis=0)
            new.append(_checked(h, got, least))
        runs = smallest_periods(np.concatenate(new))
        scale *= 2
    return runs


def _laid(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes with separators, sizes, texts, place of each word), the longest texts first."""
    size = np.diff(w.first)
    order = np.argsort(-size, kind="stable")
    start = np.zeros(len(size), dtype=np.int64)
    start[order] = np.concatenate(([0], np.cumsum(size[order] + 1)[:-1]))
    place = np.arange(len(w.hash)) + np.repeat(start - w.first[:-1], size)
    h = np.empty(len(w.hash) + len(size), dtype=np.uint64)
    h[place] = w.hash
    h[start + size] = mix(np.arange(len(size), dtype=np.uint64) + _U(0x5EED_0F_5E9A8A7085))
    return h, size[order], order, place


def find(
    docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed, *carry) of every row of ``docs``.

    Words are maximal runs of bytes other than space and tab to carriage return, numbered from 0.
    ``runs`` are all runs of the text as (start, length, period) by start, then period. ``collapsed`` is the text
    without the words that stand in some run after that run's first period, the others joined by one space.

    Only the named columns are read; names in ``carry`` that clash with a result column are refused by
    ValueError. A null text has no words, no runs and collapses to an empty text, and so does an empty one.
    Every row is judged by itself: null or repeated ids and repeated rows change nothing. A text is worked on
    whole, in memory linear in its length. An empty table gives an empty result.
    """
    if set(carry) & {"doc_id", "n_words", "runs", "collapsed"}:
        raise ValueError(f"carried columns clash with the result: {carry}")
    carried = [F.struct(*carry).alias("carried")] if carry else []
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carried)
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i, j, data, offsets in batches(batch.column(1)):
                w = Words(data, offsets, lower=False)
                h, sizes, order, place = _laid(w)
                found = runs_of(h, sizes, least)
                start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
                nth = np.searchsorted(start, found[:, 0], side="right") - 1
                text, begin = order[nth], found[:, 0] - start[nth]
                by = np.lexsort((found[:, 2], begin, text))
                held = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=j - i)))).astype(np.int32)
                values = [begin[by], (found[:, 1] - found[:, 0])[by], found[:, 2][by]]
                runs = pa.ListArray.from_arrays(pa.array(held), pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(kind)))
                dropped = np.zeros(len(h) + 1, dtype=np.int64)
                np.add.at(dropped, found[:, 0] + found[:, 2], 1)
                np.subtract.at(dropped, found[:, 1], 1)
                keep = np.cumsum(dropped)[place] == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(w.first).astype(np.int64)), runs,
                     strings(*w.joined(keep)).cast(pa.string()), *(c.slice(i, j - i) for c in batch.columns[2:])],
                    names=["doc_id", "n_words", "runs", "collapsed", "carried"][: 4 + bool(carry)],
                )

    schema = docs.select("doc_id").schema.add("n_words", "long").add("runs", docs.sparkSession.createDataFrame([], f"r {RUNS}").schema["r"].dataType)
    schema = schema.add("collapsed", "string")
    if carry:
        schema = schema.add(docs.schema["carried"])
    out = docs.mapInArrow(run, schema)
    return out.select("doc_id", "n_words", "runs", "collapsed", *(F.col("carried").getField(c).alias(c) for c in carry))
