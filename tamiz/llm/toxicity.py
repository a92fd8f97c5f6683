"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams and itself, each hashed to a row of one embedding
table; a text is the mean over its distinct words of the mean of their rows, with STILL empty words added so
that a few words decide little. A linear softmax over the two
labels reads that mean. Table and softmax are trained together, so a misspelt word that was never
seen still shares most of its n-grams with the word it comes from.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import first_by_hash, held_out
from .worker import kept

#: The bound of the training sample: rows for each label, and the longest text among them.
SAMPLE, SAMPLE_CHARS = 2000, 20_000
BUCKETS, WIDTH, SHORTEST, LONGEST = 1 << 17, 8, 3, 6
EPOCHS, BATCH, RATE = 20, 128, 0.2
#: Rows seen in fewer sample texts stay zero: they would only be learned by heart.
LEAST_TEXTS = 20
#: Empty words added to each text's mean.
STILL = 50
#: A row is predicted toxic from this score on.
THRESHOLD = 0.7
KEPT_WORDS, KEPT_CHARS = 400_000, 40
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(word: str) -> list[int]:
    """Rows of the word itself and of its n-grams, with marks at both ends."""
    w = f"<{word}>"
    n = len(w)
    out = [zlib.crc32(w.encode()) % BUCKETS]
    for size in range(SHORTEST, min(LONGEST, n - 1) + 1):
        out += [zlib.crc32(w[i : i + size].encode()) % BUCKETS for i in range(n - size + 1)]
    return out


def fit(texts: pa.ListArray, labels: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table, weights, bias) trained on texts as lists of distinct words with labels 0 and 1.

    Minibatches with steps by Adagrad, half damped; labels weigh the same whatever their numbers.
    """
    rng = np.random.default_rng(seed)
    table = (rng.random((BUCKETS, WIDTH), dtype=np.float32) - 0.5) / WIDTH
    weights = np.zeros((WIDTH, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    if len(np.unique(labels)) < 2:
        return table * 0, weights, bias
    flat = texts.flatten().dictionary_encode()
    bags = flat.indices.to_numpy()
    doc_first = np.concatenate(([0], np.cumsum(texts.value_lengths().to_numpy())))
    found, first = array("i"), [0]
    for word in flat.dictionary:
        found.extend(grams(word.as_py()))
        first.append(len(found))
    rows, first = np.frombuffer(found, dtype=np.int32), np.array(first)
    held = np.zeros(BUCKETS, dtype=np.int32)  # sample texts that have a row
    for a, b in zip(doc_first, doc_first[1:], strict=False):
        held[np.unique(np.concatenate([rows[first[w] : first[w + 1]] for w in bags[a:b]] or [rows[:0]]))] += 1
    common = held >= LEAST_TEXTS
    table[~common] = 0
    share = np.bincount(labels, minlength=2)
    cost = (len(labels) / (2.0 * share)).astype(np.float32)
    sums = [np.full(x.shape, 1e-14, dtype=np.float32) for x in (table, weights, bias)]
    weights += rng.choice(np.array([-20, 20], dtype=np.float32), weights.shape)  # large, as a text averages many plain words
    some = np.flatnonzero(np.diff(doc_first))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(some)
        for at in range(0, len(some), BATCH):
            docs = some[at : at + BATCH]
            size = np.diff(doc_first)[docs]
            doc_of = np.repeat(np.arange(len(docs)), size)
            spot = np.concatenate([np.arange(doc_first[d], doc_first[d + 1]) for d in docs])
            words, local = np.unique(bags[spot], return_inverse=True)
            length = first[words + 1] - first[words]
            gram = rows[np.repeat(first[words] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())]
            cut = np.concatenate(([0], np.cumsum(length)[:-1]))
            mean = np.add.reduceat(table[gram], cut, axis=0) / length[:, None]
            part = (1.0 / (size + STILL)).astype(np.float32)[doc_of]
            text = np.add.reduceat(mean[local] * part[:, None], np.concatenate(([0], np.cumsum(size)[:-1])), axis=0)
            z = text @ weights + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            y = labels[docs]
            p[np.arange(len(docs)), y] -= 1
            g = p * cost[y][:, None] / len(docs)
            g_text = g @ weights.T
            flow = np.zeros((len(words), WIDTH), dtype=np.float32)
            for k in range(WIDTH):
                flow[:, k] = np.bincount(local, (g_text[doc_of, k] * part), len(words))
            g_gram = np.repeat(flow / length[:, None], length, axis=0)
            learns = common[gram]
            gram, g_gram = gram[learns], g_gram[learns]
            seen, back = np.unique(gram, return_inverse=True)
            g_table = np.stack([np.bincount(back, g_gram[:, k], len(seen)) for k in range(WIDTH)], axis=1).astype(np.float32)
            sums[0][seen] += g_table**2
            # the fourth root of a row's own sum and of the mean: rare rows move less than with Adagrad alone
            own = np.sqrt(sums[0][seen])
            table[seen] -= rate * g_table / np.sqrt(own * own.mean())
            for x, s, gx in ((weights, sums[1], text.T @ g), (bias, sums[2], g.sum(axis=0))):
                s += gx**2
                x -= rate * gx / np.sqrt(s)
    return table, weights, bias


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> tuple[np.ndarray, float]:
    """(score of each table row, bias): what the trained model adds to the log-odds of label 1.

    Learned on the driver from at most ``sample`` rows of each label, those that are not held out,
    have at most ``longest`` characters and the smallest hash of their id. Rows equal in id, label and text count
    once, so repeated ids change no bound.
    """
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").distinct()
    size = rows.select("id", "h", F.length("text").alias("chars")).where(
        F.col("id").isNotNull() & ~held_out("id") & (F.col("chars") > 0) & (F.col("chars") <= longest)
    )
    chosen = first_by_hash(size.join(known, "id").select("id", "toxic", "h").distinct(), "toxic", sample, "h")
    picked = rows.where(F.length("text") <= longest).join(F.broadcast(chosen.select("id", "toxic", "h")), ["id", "h"])
    picked = picked.dropDuplicates(["id", "toxic", "h"]).select("id", "toxic", "text")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            bags = [sorted(set(words_of(t))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bags, pa.list_(pa.string()))], names=["id", "toxic", "words"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    bags = picked.mapInArrow(count, f"id {id_type}, toxic int, words array<string>")
    found = bags.toArrow().sort_by([("id", "ascending"), ("toxic", "ascending")]).combine_chunks()
    words = found.column("words").combine_chunks().cast(pa.list_(pa.string()))
    table, weights, bias = fit(words, found.column("toxic").to_numpy().astype(np.int64))
    return (table @ (weights[:, 1] - weights[:, 0])).astype(np.float64), float(bias[1] - bias[0])


class Scorer:
    def __init__(self, rows: np.ndarray, bias: float):
        self.rows, self.bias = rows, bias
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            found = float(self.rows[grams(word)].mean())
            if len(word) <= KEPT_CHARS:
                if len(self.known) >= KEPT_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def text(self, text: str | None) -> float:
        words = sorted(set(words_of(text)))
        known = self.known
        try:
            total = sum([known[w] for w in words])
        except KeyError:
            total = sum([self.word(w) for w in words])
        z = self.bias + total / (len(words) + STILL)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))


def _scorer(shared) -> Scorer:
    """The scorer of a broadcast, once per Python worker."""
    value = shared.value
    return kept("toxicity", value, lambda: Scorer(*value))


def predict(docs: DataFrame, rows: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row: the softmax's share of label 1, and whether it reaches THRESHOLD.

    Only text decides, the whole of it. A null or empty text, or one without a word, has the score
    of the bias alone. Reads only the two named columns, so extra columns cannot clash. Null ids
    and repeated rows stay; an empty table gives an empty result. Without both labels in the
    sample every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast((rows, bias))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in parts:
            for at in range(0, batch.num_rows, 1000):
                scores = np.array([scorer.text(t) for t in batch.column(1).slice(at, 1000).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1000), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, score double, predicted int"
    )


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text): ``train``, then ``predict``."""
    return predict(docs, *train(docs, labels, sample)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
