"""Language identification by segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary. Each language has a probability for every piece. A word
has the probability of all its segmentations into pieces, summed by a forward pass; a text has the
product of its words'. The probabilities are learned by expectation maximisation: forward and
backward passes give the expected number of times that a piece is used in each language.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.runtime import materialize

from .components import small
from .worker import kept, trimmed

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Training rows for each language, chosen by a hash of the id: the bound of the sample.
SAMPLE = 2000
#: Expectation-maximisation rounds, and the weight of the mean of all languages in each.
ROUNDS, SMOOTHING = 2, 500.0
#: Tokens kept with their scores per Python worker; longer ones are scored each time.
KEPT_TOKENS, KEPT_CHARS = 200_000, 40
#: Bytes of text scored at a time.
SLICE = 1 << 20
#: Ids with this remainder of crc32 modulo 3 are held out.
HELD_OUT = 1


def held_out(id_col: str = "doc_id"):
    """Whether a row is held out; false for a null id, which training leaves out as well."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters with their marks."""
    return WORD.findall(text.lower()) if text else []


class Lattice:
    """All places where a piece fits into words; index 0 is any character that is no piece.

    The pieces are a trie, and all places of all words walk down it together.
    """

    def __init__(self, pieces: list[str]):
        self.index = {p: i + 1 for i, p in enumerate(pieces)}
        self.size = len(pieces) + 1
        node = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
        steps = sorted((node[t[:-1]] << 21 | ord(t[-1]), i) for t, i in node.items() if t)
        self.step = np.array([k for k, _ in steps] or [-1], dtype=np.int64)
        self.child = np.array([i for _, i in steps] or [0], dtype=np.int64)
        self.piece = np.zeros(len(node), dtype=np.int64)
        for p, i in self.index.items():
            self.piece[node[p]] = i

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, from, to, piece) of every fitting piece; a word starts with the space mark."""
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        chars = np.frombuffer("".join(["▁" + w for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        first = np.cumsum(length) - length
        word = np.repeat(np.arange(len(words)), length)
        left = np.repeat(first + length, length) - np.arange(len(chars))  # places up to the word's end
        at, node, found, k = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int64), [], 0
        while len(at):
            key = node << 21 | chars[at + k]
            step = np.minimum(np.searchsorted(self.step, key), len(self.step) - 1)
            good = self.step[step] == key
            node = np.where(good, self.child[step], 0)
            k += 1
            piece = self.piece[node]
            ends = np.flatnonzero(piece) if k > 1 else np.arange(len(at))  # a character that is no piece stands alone
            found.append((at[ends], np.full(len(ends), k), piece[ends]))
            on = good & (left[at] > k)
            at, node = at[on], node[on]
        start, size, piece = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3
        which = word[start]
        return which, start - first[which], start - first[which] + size, piece


def _pass(n_words: int, longest: int, from_: np.ndarray, to: np.ndarray, which: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums at each place of each word, shape (words, longest + 1, languages), scaled by
    powers of two per place and word; with the logarithms of the scales."""
    alpha = np.zeros((n_words, longest + 1, p.shape[1]))
    scale = np.zeros((n_words, longest + 1))
    alpha[:, 0] = 1.0
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(longest + 2))
    for j in range(1, longest + 1):
        e = order[cuts[j] : cuts[j + 1]]
        if not len(e):
            continue
        w = which[e]
        base = np.full(n_words, -np.inf)
        np.maximum.at(base, w, scale[w, from_[e]])
        base[np.isneginf(base)] = 0.0
        add = alpha[w, from_[e]] * p[e] * np.exp(scale[w, from_[e]] - base[w])[:, None]
        for lang in range(p.shape[1]):
            alpha[:, j, lang] = np.bincount(w, add[:, lang], n_words)
        top = alpha[:, j].max(axis=1)
        some = top > 0
        alpha[some, j] /= top[some, None]
        scale[some, j] = base[some] + np.log(top[some])
    return alpha, scale


def _alike(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes of words of like length together, about 200,000 places at a time."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]]) + 1
        upto = at
        while upto < len(order) and (int(lengths[order[upto]]) + 2) * (upto - at + 1) <= 200_000 and lengths[order[upto]] <= longest + 3:
            upto += 1
        upto = max(upto, at + 1)
        yield order[at:upto]
        at = upto


class Model:
    """Languages, and the probability of each piece in each (pieces x languages)."""

    def __init__(self, lattice: Lattice, languages: list[str], probability: np.ndarray):
        self.lattice, self.languages, self.probability = lattice, languages, probability
        self.known: dict[str, int] = {}
        self.rows, self.words = np.zeros((0, len(languages))), np.zeros(0, dtype=np.int64)

    def log_words(self, words: list[str]) -> np.ndarray:
        """log of the summed probability of all segmentations, (words x languages)."""
        out = np.zeros((len(words), len(self.languages)))
        lengths = np.array([len(w) for w in words])
        for part in _alike(lengths):
            longest = int(lengths[part].max()) + 1
            which, a, b, piece = self.lattice.edges([words[i] for i in part])
            alpha, scale = _pass(len(part), longest, a, b, which, self.probability[piece])
            last = lengths[part] + 1
            out[part] = np.log(np.maximum(alpha[np.arange(len(part)), last], 1e-300)) + scale[np.arange(len(part)), last][:, None]
        return out

    def expected(self, words: list[str], language: int, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over the words, by forward and backward passes."""
        out = np.zeros(self.lattice.size)
        sizes = np.array([len(w) for w in words])
        for part in _alike(sizes):
            some = [words[i] for i in part]
            lengths = sizes[part] + 1
            longest = int(lengths.max())
            which, a, b, piece = self.lattice.edges(some)
            p = self.probability[piece, language][:, None]
            fore, fs = _pass(len(some), longest, a, b, which, p)
            back, bs = _pass(len(some), longest, lengths[which] - b, lengths[which] - a, which, p)
            total = np.log(fore[np.arange(len(some)), lengths, 0]) + fs[np.arange(len(some)), lengths]
            after = lengths[which] - b
            log = fs[which, a] + bs[which, after] - total[which]
            post = fore[which, a, 0] * p[:, 0] * back[which, after, 0] * np.exp(log)
            out += np.bincount(piece, post * counts[part][which], self.lattice.size)
        return out

    def _tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log of the probability, number of words) of each token, (tokens x languages) and (tokens)."""
        per_token = [words_of(t) for t in tokens]
        number: dict[str, int] = {}
        row = np.array([number.setdefault(w, len(number)) for ws in per_token for w in ws], dtype=np.int64)
        many = np.fromiter(map(len, per_token), dtype=np.int64, count=len(tokens))
        rows = self.log_words(list(number))
        out = np.zeros((len(tokens), len(self.languages)))
        some = np.flatnonzero(many)
        if len(some):
            out[some] = np.add.reduceat(rows[row], (np.cumsum(many) - many)[some], axis=0)
        return out, many

    def _table(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_tokens``, from the kept tokens where they are known."""
        known = self.known
        if len(known) >= KEPT_TOKENS:
            known.clear()
            self.rows, self.words = np.zeros((0, len(self.languages))), np.zeros(0, dtype=np.int64)
        at = np.fromiter((known.get(t, -1) for t in tokens), dtype=np.int64, count=len(tokens))
        out, many = np.zeros((len(tokens), len(self.languages))), np.zeros(len(tokens), dtype=np.int64)
        old, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        out[old], many[old] = self.rows[at[old]], self.words[at[old]]
        if len(new):
            out[new], many[new] = self._tokens([tokens[i] for i in new])
            kept_ = [i for i in new.tolist() if len(tokens[i]) <= KEPT_CHARS][: KEPT_TOKENS - len(known)]
            known.update((tokens[i], len(self.words) + j) for j, i in enumerate(kept_))
            self.rows, self.words = np.concatenate([self.rows, out[kept_]]), np.concatenate([self.words, many[kept_]])
        return out, many

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its share of the probability among all languages, for each text.

        No word holds a space, so texts are sums over tokens between spaces: each different token is looked at once.
        """
        n = len(texts)
        names, shares = np.full(n, "und", dtype=object), np.zeros(n)
        if not self.languages or not n:
            return names.tolist(), shares
        lists = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
        values = lists.flatten().dictionary_encode()
        rows, many = self._table(values.dictionary.to_pylist())
        which = values.indices.to_numpy(zero_copy_only=False)
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))))[:-1]
        total, words = np.add.reduceat(rows[which], first, axis=0), np.add.reduceat(many[which], first)
        best = total.argmax(axis=1)
        some = words > 0
        names[some] = np.array(self.languages, dtype=object)[best[some]]
        shares[some] = 1.0 / np.exp(total - total[np.arange(n), best][:, None]).sum(axis=1)[some]
        return names.tolist(), shares


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of about SLICE bytes each."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, side="right")))
        yield at, texts.slice(at, upto - at)
        at = upto


def vocabulary(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [
        sp.id_to_piece(i)
        for i in range(sp.get_piece_size())
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
    ]


def first_by_hash(rows: DataFrame, group: str, sample: int, row: str = "id") -> DataFrame:
    """The ``sample`` rows (id, ...) with the smallest hashes of the id in each group, found in two
    steps so that no task gets a whole group. ``row`` tells rows of one id apart."""
    for part in (["part"], []):
        order = Window.partitionBy(group, *part).orderBy(F.xxhash64("id"), "id", row)
        rows = rows.withColumn("part", F.pmod(F.xxhash64("id", row, F.lit(1)), F.lit(64)))
        rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).drop("n", "part")
    return rows


def train(docs: DataFrame, model_path: str, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities) learned from rows that are not held out and have a language.

    At most ``sample`` rows of each language, those with the smallest hash of their id; rows equal in id, language
    and text count once, so repeated ids change no bound. The driver
    gets a number for each piece and language, as many as the vocabulary and the languages allow.
    """
    text = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    text = text.withColumn("h", F.xxhash64("text"))
    rows = text.select("id", "lang", "h")
    learnable = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id")).groupBy("id", "lang", "h").agg(F.count("*").alias("copies"))
    chosen = small(materialize(first_by_hash(learnable, "lang", sample, "h").select("id", "lang", "h", "copies"), "sample"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                held: dict[tuple[str, str], float] = defaultdict(float)
                for lang, t, copies in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    for w in words_of(t):
                        held[lang, w] += 1.0 / copies
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in held], pa.string()), pa.array([w for _, w in held], pa.string()), pa.array(list(held.values()), pa.float64())],
                    names=["lang", "word", "n"],
                )

    # each of a row's copies counts for its part: together they are one row
    counts = (
        text.join(chosen, ["id", "lang", "h"]).select("lang", "text", "copies").mapInArrow(trimmed(count), "lang string, word string, n double")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    counts = materialize(counts, "words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    lattice = Lattice(vocabulary(model_path))
    probability = np.full((lattice.size, len(languages)), 1.0 / lattice.size)
    for _ in range(ROUNDS if languages else 0):
        total = np.zeros(probability.shape)
        number = {lang: i for i, lang in enumerate(languages)}
        shared = docs.sparkSession.sparkContext.broadcast((model_path, languages, probability))

        def expect(parts, shared=shared, number=number):
            model = _model(shared)
            for batch in parts:
                langs = np.array(batch.column(0).to_pylist())
                words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for lang in np.unique(langs):
                    mine = np.flatnonzero(langs == lang)
                    uses = model.expected([words[i] for i in mine], number[lang], n[mine])
                    used = np.flatnonzero(uses)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number[lang]] * len(used), pa.int32()), pa.array(used), pa.array(uses[used])], names=["lang", "piece", "uses"]
                    )

        uses = counts.select("lang", "word", "n").mapInArrow(trimmed(expect), "lang int, piece long, uses double")
        for r in uses.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            total[r["piece"], r["lang"]] = r["uses"]
        mean = total.sum(axis=1) + 0.1
        mean /= mean.sum()
        probability = (total + SMOOTHING * mean[:, None]) / (total.sum(axis=0) + SMOOTHING)
    return languages, probability


def _model(shared) -> Model:
    """The model of a broadcast, once per Python worker."""
    value = shared.value
    path, languages, probability = value
    return kept("language", value, lambda: Model(Lattice(vocabulary(path)), languages, probability))


def predict(
    docs: DataFrame, languages: list[str], probability: np.ndarray, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; ``und`` with score 0 for a text that is null or has no letter.

    Only text decides. ``score`` is the share of the language's probability in the sum over all
    languages; equal languages go to the first in alphabetical order. Reads only the two named columns, so extra
    columns cannot clash. Null ids and repeated rows stay; an empty table gives an empty result.
    Without a language learned every text is ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model_path, languages, probability))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in parts:
            for at, texts in slices(batch.column(1)):
                names, shares = model.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(names, pa.string()), pa.array(shares)], names=["doc_id", "lang_pred", "score"]
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        trimmed(run), f"doc_id {id_type}, lang_pred string, score double"
    )


def identify(docs: DataFrame, model_path: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang): ``train``, then ``predict``."""
    languages, probability = train(docs, model_path, sample)
    out = predict(docs, languages, probability, model_path)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accept(docs: DataFrame, model_path: str, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, ...) whose text has a language, columns as they were.

    A row goes when its text is null or has no letter; however close the languages are, a text with letters
    stays, and so it does when no language was learned, for instance because no row outside the held-out third has
    one. Null ids and repeated rows stay; an empty table gives an empty result.
    """
    languages, probability = train(docs, model_path, sample)
    shared = docs.sparkSession.sparkContext.broadcast((model_path, languages, probability))
    place = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in parts:
            for at, texts in slices(batch.column(place)):
                if languages:
                    keep = [name != "und" for name in model.score(texts)[0]]
                else:
                    keep = [bool(words_of(t)) for t in texts.to_pylist()]
                yield batch.slice(at, len(texts)).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
