"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they
form, the left pair first among equal scores. The best pair is merged, its new neighbours
join the agenda, entries whose symbols are gone are skipped. Symbols that are no piece fall
back to byte pieces.

When no piece holds a space mark after another character, no merge can cross the start of a
run of space marks. A text is then encoded run by run, each different run of some 4 MB of texts
once, and the agendas of short runs are worked off together; the result is the same as over the whole text.

Every Arrow batch is encoded by the sentencepiece library too; a difference raises.
"""

from __future__ import annotations

import heapq
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .worker import kept, trimmed

SPACE = "▁"
#: Longest run whose agenda is a row of a matrix, and symbols worked off together.
SHORT_CHARS, CELLS = 32, 1 << 17
NEVER = float("inf")
#: No symbol; a character that is in no piece.
NONE, STRANGE = -1, -2
#: Bytes of text encoded at a time, and given to the library at a time.
PART, SLICE = 1 << 22, 1 << 18


class Agenda:
    """Encoder over a merge-type vocabulary, given as pieces with their scores and the byte ids."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], unknown: int):
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.cost = {p: -s for p, (_, s) in pieces.items()}
        self.byte_ids, self.unknown = byte_ids, unknown
        inside = re.compile(f"[^{SPACE}]{SPACE}")
        self.by_runs = not any(inside.search(p) for p in pieces)
        self.runs = re.compile(f"{SPACE}+[^{SPACE}]*")
        # symbols as numbers: pieces first, then characters that only occur inside pieces, then other ASCII
        names = list(pieces)
        number = {p: i for i, p in enumerate(names)}
        for p in names:
            for c in p:
                number.setdefault(c, len(number))
        ids = [*self.ids.values(), *[-1] * (len(number) - len(names))]
        for c in map(chr, range(128)):
            if c not in number:
                number[c] = len(number)
                ids.append(byte_ids[ord(c)] if byte_ids else unknown)
        self.id_of = np.array(ids, dtype=np.int64)
        self.symbol = np.full(sys.maxunicode + 1, STRANGE, dtype=np.int64)
        for p, i in number.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        pairs = sorted(
            (number[p[:k]] << 32 | number[p[k:]], i) for i, p in enumerate(names) for k in range(1, len(p)) if p[:k] in number and p[k:] in number
        )
        self.pair = np.array([k for k, _ in pairs] or [-1], dtype=np.int64)
        self.merged = np.array([i for _, i in pairs] or [0], dtype=np.int64)
        self.merged_cost = np.array([self.cost[names[i]] for _, i in pairs] or [NEVER])

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost, piece) of the symbols a and b together, cost NEVER where they form no piece."""
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -2)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged_cost[at], NEVER), self.merged[at]

    def _block(self, sym: np.ndarray) -> np.ndarray:
        """Symbols (runs x places) after all merges, NONE behind the last; runs are of one length.

        A row of pair costs is a run's agenda; in each step every run merges the first of its best pairs.
        """
        out = np.full(sym.shape, NONE, dtype=np.int64)
        row = np.arange(len(sym))
        cost, piece = self._pairs(sym[:, :-1], sym[:, 1:])
        while True:
            width = sym.shape[1]
            best = cost.argmin(axis=1) if width > 1 else np.zeros(len(sym), dtype=np.int64)
            go = cost[np.arange(len(sym)), best] < NEVER if width > 1 else np.zeros(len(sym), dtype=bool)
            out[row[~go], :width] = sym[~go]
            if not go.any():
                return out
            row, sym, cost, piece, best = row[go], sym[go], cost[go], piece[go], best[go]
            n = np.arange(len(sym))
            merged = piece[n, best]
            places = np.arange(width - 1)
            take = places + (places > best[:, None])
            sym = np.take_along_axis(sym, take, axis=1)
            sym[n, best] = merged
            take = np.minimum(take[:, : width - 2], width - 2)
            cost, piece = np.take_along_axis(cost, take, axis=1), np.take_along_axis(piece, take, axis=1)
            for at, some in ((best - 1, best > 0), (best, best < width - 2)):
                r, at = n[some], at[some]
                cost[r, at], piece[r, at] = self._pairs(sym[r, at], sym[r, at + 1])

    def _many(self, rests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the runs of a space mark and each of the ``rests``."""
        length = pc.utf8_length(rests).to_numpy(zero_copy_only=False).astype(np.int64)
        chars = np.frombuffer("".join(rests.to_pylist()).encode("utf-32-le"), dtype="<u4")
        start = np.cumsum(length) - length
        order = np.argsort(length, kind="stable")
        size = np.zeros(len(length), dtype=np.int64)
        parts, alone = [], []
        i = 0
        while i < len(order):
            n = int(length[order[i]])
            if n >= SHORT_CHARS:
                alone.append(order[i:])
                break
            j = min(int(np.searchsorted(length[order], n, side="right")), i + max(1, CELLS // (n + 1)))
            rows = order[i:j]
            i = j
            sym = np.full((len(rows), n + 1), self.symbol[ord(SPACE)], dtype=np.int64)
            sym[:, 1:] = self.symbol[chars[start[rows][:, None] + np.arange(n)]]
            sym = self._block(sym)
            ids = np.where(sym == NONE, 0, self.id_of[np.maximum(sym, 0)])
            strange = (ids < 0).any(axis=1) | (sym == STRANGE).any(axis=1)
            alone.append(rows[strange])
            rows, ids, held = rows[~strange], ids[~strange], (sym != NONE)[~strange]
            size[rows] = held.sum(axis=1)
            parts.append((rows, ids[held]))
        rows = np.concatenate(alone) if alone else np.zeros(0, dtype=np.int64)
        packed = [self._packed(SPACE + r) for r in rests.take(pa.array(rows)).to_pylist()]
        size[rows] = [len(p) // 4 for p in packed]
        parts.append((rows, np.frombuffer(b"".join(packed), dtype="<u4")))
        ends = np.concatenate(([0], np.cumsum(size)))
        out = np.empty(ends[-1], dtype="<u4")
        for rows, ids in parts:
            many = size[rows]
            out[np.repeat(ends[rows] - np.cumsum(many) + many, many) + np.arange(len(ids))] = ids
        return out, ends

    def symbols(self, run: str) -> list[str]:
        """Pieces and unmerged characters of one run, from left to right."""
        return self._short(run) if len(run) <= SHORT_CHARS else self._long(run)

    def _short(self, run: str) -> list[str]:
        """The agenda as a plain list in the order of the pairs: the first of the best comes next."""
        sym, cost = list(run), self.cost
        agenda = [cost.get(run[i : i + 2], NEVER) for i in range(len(sym) - 1)]
        while agenda and (best := min(agenda)) != NEVER:
            i = agenda.index(best)
            sym[i] += sym.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = cost.get(sym[i - 1] + sym[i], NEVER)
            if i < len(agenda):
                agenda[i] = cost.get(sym[i] + sym[i + 1], NEVER)
        return sym

    def _long(self, run: str) -> list[str]:
        """The agenda as a heap over linked symbols."""
        sym: list[str | None] = list(run)
        n, cost = len(sym), self.cost
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = [(c, i, i + 1, 2) for i in range(n - 1) if (c := cost.get(run[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            a, b = sym[i], sym[j]
            if a is None or b is None or len(a) + len(b) != size or after[i] != j:
                continue  # a symbol is gone or has grown
            merged = sym[i] = a + b
            sym[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                right = sym[k]
                c = cost.get(merged + right)
                if c is not None:
                    heapq.heappush(agenda, (c, i, k, size + len(right)))
            h = before[i]
            if h >= 0:
                left = sym[h]
                c = cost.get(left + merged)
                if c is not None:
                    heapq.heappush(agenda, (c, h, i, size + len(left)))
        return [s for s in sym if s is not None]

    def _packed(self, run: str) -> bytes:
        out = array("I")
        for s in self.symbols(run):
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend([self.byte_ids[x] for x in s.encode("utf-8")])
            else:
                out.append(self.unknown)
        return pack(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text without begin and end, packed as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.by_runs:
            return self._packed(SPACE + text.replace(" ", SPACE))
        return b"".join(map(self._packed, self.runs.findall(SPACE + text.replace(" ", SPACE))))

    def looked_up(self, texts: pa.Array) -> Looked:
        """The ids of the different runs of the texts, and each text as a list of them.

        Texts whose runs all begin with one mark are split by spaces, the others are one entry each.
        """
        n = len(texts)
        plain = np.zeros(n, dtype=bool)
        if self.by_runs and n:
            odd = pc.match_substring_regex(texts, f"^ |  | $|{SPACE}|^$")
            plain = ~odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        many = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        values = lists.flatten().dictionary_encode()
        del lists
        indices, words = values.indices.to_numpy(zero_copy_only=False), values.dictionary
        del values
        table, ends = self._many(words)
        single = [self.encode(t) for t in texts.filter(pa.array(~plain)).to_pylist()]
        table = np.concatenate((table, np.frombuffer(b"".join(single), dtype="<u4")))
        size = np.concatenate((np.diff(ends), np.array([len(p) // 4 for p in single], dtype=np.int64)))
        entries = np.ones(n, dtype=np.int64)
        entries[plain] = many
        cuts = np.concatenate(([0], np.cumsum(entries)))
        entry = np.empty(cuts[-1], dtype=np.int32)
        of_plain = np.repeat(plain, entries)
        entry[of_plain] = indices
        entry[~of_plain] = len(ends) - 1 + np.arange(len(single))
        return Looked(table, np.cumsum(size) - size, size, entry, cuts)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts without begin and end: text i has ids[offsets[i]:offsets[i + 1]]."""
        return self.looked_up(texts).ids(0, len(texts))


class Looked:
    """Texts as lists of entries of a table of ids: text i has entry[cuts[i]:cuts[i + 1]], entry e the ids
    table[start[e]:start[e] + size[e]]. Texts take far less room so than as ids."""

    def __init__(self, table: np.ndarray, start: np.ndarray, size: np.ndarray, entry: np.ndarray, cuts: np.ndarray):
        self.table, self.start, self.size, self.entry, self.cuts = table, start, size, entry, cuts

    def ids(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts i to j."""
        cuts = self.cuts[i : j + 1]
        entry = self.entry[cuts[0] : cuts[-1]]
        long = self.size[entry]
        total = np.concatenate(([0], np.cumsum(long)))
        return self.table[np.repeat(self.start[entry] - total[:-1], long) + np.arange(total[-1])], total[cuts - cuts[0]]


def pack(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def load(path: str):
    """(library processor, Agenda) of a model file, once per Python worker."""
    return kept("pieces", path, lambda: _load(path))


def _load(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    byte_ids = [i for i in range(size) if sp.is_byte(i)]
    plain = {
        sp.id_to_piece(i): (i, sp.get_score(i))
        for i in range(size)
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
    }
    return sp, Agenda(plain, byte_ids, sp.unk_id())


def _slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """About ``most`` bytes each, one text at least."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
        yield texts.slice(at, upto - at)
        at = upto


def enclosed(ids: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with a begin and an end id around each text."""
    n = len(offsets) - 1
    cuts = offsets + 2 * np.arange(n + 1)
    out = np.empty(len(ids) + 2 * n, dtype="<u4")
    out[cuts[:-1]], out[cuts[1:] - 1] = begin, end
    out[np.arange(len(ids)) + 1 + 2 * np.repeat(np.arange(n), np.diff(offsets))] = ids
    return out, cuts


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(id, ids, decoded, *carry) of every row: ids with begin and end, packed; their text as the library decodes it.

    Reads only the named columns, so any other columns cannot clash; those in ``carry`` stay as they are. A null text is
    empty: begin and end only. A null id stays null. Repeated rows give repeated results, an
    empty table an empty one. One pass without a shuffle; memory is bounded by an Arrow
    batch, or by one text where a single text is larger. Raises ValueError when the
    agenda and the library differ on any text, for instance for a model with another kind of
    merges or of normalisation.
    """
    schema = docs.select(F.col(id_col), F.col(text_col)).schema
    id_type = schema[0].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, agenda = load(model_path)
        for batch in parts:
            at = 0
            for part in _slices(batch.column(1).cast(pa.large_string()).fill_null(""), PART):
                own, first = agenda.looked_up(part), 0
                for texts in _slices(part, SLICE):
                    ids, cuts = enclosed(*own.ids(first, first + len(texts)), sp.bos_id(), sp.eos_id())
                    first += len(texts)
                    plain = texts.to_pylist()
                    want = sp.encode(plain, out_type=int, add_bos=True, add_eos=True, num_threads=1)
                    sizes = np.fromiter(map(len, want), dtype=np.int64, count=len(want))
                    theirs = np.fromiter(chain.from_iterable(want), dtype="<u4", count=int(sizes.sum()))
                    if not (np.array_equal(sizes, np.diff(cuts)) and np.array_equal(ids, theirs)):
                        text = next(t for t, w, a, b in zip(plain, want, cuts, cuts[1:], strict=False) if ids[a:b].tolist() != w)
                        raise ValueError(f"agenda and library differ on a text of {len(text)} characters: {text[:80]!r}")
                    packed = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(plain), [None, pa.py_buffer(4 * cuts), pa.py_buffer(np.ascontiguousarray(ids))]
                    )
                    decoded = sp.decode(want, num_threads=1)
                    rows, *others = (c.slice(at, len(plain)) for c in (batch.column(0), *batch.columns[2:]))
                    at += len(plain)
                    yield pa.RecordBatch.from_arrays(
                        [rows, packed.cast(pa.binary()), pa.array(decoded, pa.string()), *others],
                        names=[id_col, "ids", "decoded", *carry],
                    )

    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(F.col(id_col), F.col(text_col).cast("string"), *carry).mapInArrow(
        trimmed(run), f"`{id_col}` {id_type}, ids binary, decoded string{carried}"
    )


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()
