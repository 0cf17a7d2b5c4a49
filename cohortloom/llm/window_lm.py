"""Masked pseudo-likelihood of documents by a bidirectional window network.

A token is predicted from the tokens on both sides: its class by a small network
over a window, trained in numpy; the token within its class by corpus counts. Both
come from all documents. Each task trains on masked places of its own documents and
the tasks' networks are averaged by Spark; the score of a document is the sum of the
conditional log-probabilities of all its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import pieces, text_columns
from cohortloom.llm.jaccard_join import WordHashes


@dataclass(frozen=True)
class WindowModel:
    """Sizes of the model, all fixed: none follows the corpus.

    ``buckets``: hashed words; ``codes``: input codes, the most common buckets one
    each; ``classes``: output classes, half of them single buckets; ``width``:
    hidden units; ``reach``: tokens on each side; ``masked``: share of the places
    trained on in each of ``rounds``; ``batch``: places in a step of descent.
    """

    buckets: int = 1 << 16
    codes: int = 1024
    classes: int = 128
    width: int = 16
    reach: int = 3
    masked: float = 0.125
    rounds: int = 2
    batch: int = 2048
    rate: float = 0.3
    seed: int = 7

    def shapes(self) -> list[tuple[int, ...]]:
        """Embeddings of the next and the farther tokens on either side; output; bias."""
        return [(4, self.codes, self.width), (self.width, self.classes), (self.classes,)]


def word_buckets(codes: np.ndarray, model: WindowModel) -> np.ndarray:
    return (codes % np.uint64(model.buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str, model: WindowModel) -> np.ndarray:
    """Tokens of all documents by bucket, added up in the tasks and then by Spark."""
    def count(batches):
        hashes, total = WordHashes(), np.zeros(model.buckets, np.int64)
        for batch in batches:
            for _, texts in pieces(batch, text):
                for codes in hashes.of_texts(texts):
                    total += np.bincount(word_buckets(codes, model), minlength=model.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])],
                                         names=["bucket", "n"])

    rows = docs.select(text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    counts = np.zeros(model.buckets, np.int64)
    for row in rows.toLocalIterator():
        counts[row.bucket] = row.n
    return counts


class Vocabulary:
    """Input code, class and log-probability within the class of every bucket."""

    def __init__(self, counts: np.ndarray, model: WindowModel):
        order = np.argsort(-counts, kind="stable")
        own = model.classes // 2
        self.classes = np.empty(model.buckets, np.int64)
        self.classes[order[:own]] = np.arange(own)
        # The others fall into classes of about the same number of tokens.
        rest = order[own:]
        mass = np.cumsum(counts[rest] + 1)
        self.classes[rest] = own + (mass - 1) * (model.classes - own) // mass[-1]
        smooth = counts + 1.0
        whole = np.bincount(self.classes, smooth, model.classes)
        self.inside = np.log(smooth / whole[self.classes]).astype(np.float32)
        # Code 0 is the edge of a text.
        self.codes = 1 + np.arange(model.buckets) % (model.codes - 1)
        self.codes[order[:model.codes // 2]] = 1 + np.arange(model.codes // 2)
        self.bias = np.log((whole + 1e-6) / whole.sum()).astype(np.float32)


def first_weights(vocabulary: Vocabulary, model: WindowModel) -> list[np.ndarray]:
    rng = np.random.default_rng(model.seed)
    embed, out, _ = model.shapes()
    return [rng.normal(0, 0.1, embed).astype(np.float32),
            rng.normal(0, 0.1, out).astype(np.float32), vocabulary.bias.copy()]


class Texts:
    """Some texts in one row of codes, with the edge code between them."""

    def __init__(self, texts: list, hashes: WordHashes, vocabulary: Vocabulary,
                 model: WindowModel):
        rows = [word_buckets(codes, model) for codes in hashes.of_texts(texts)]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.buckets = np.concatenate(rows) if rows else np.empty(0, np.int64)
        gaps = np.repeat(np.arange(1, len(rows) + 1) * model.reach, self.sizes)
        self.places = np.arange(len(self.buckets)) + gaps
        self.codes = np.zeros(len(self.buckets) + (len(rows) + 1) * model.reach, np.int64)
        self.codes[self.places] = vocabulary.codes[self.buckets]


def inputs(codes: np.ndarray, places: np.ndarray, model: WindowModel
           ) -> Iterator[tuple[int, np.ndarray]]:
    """(embedding, codes) of the tokens around each place."""
    for step in range(1, model.reach + 1):
        for side, offset in enumerate((-step, step)):
            yield 2 * (step > 1) + side, codes[places + offset]


def forward(weights: list[np.ndarray], codes: np.ndarray, places: np.ndarray,
            model: WindowModel) -> tuple[np.ndarray, np.ndarray]:
    """Hidden units and log-probabilities of the classes at the places."""
    embed, out, bias = weights
    total = np.zeros((len(places), model.width), np.float32)
    for kind, own in inputs(codes, places, model):
        total += embed[kind][own]
    hidden = np.tanh(total)
    logits = hidden @ out + bias
    logits -= logits.max(1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(1, keepdims=True))
    return hidden, logits


def descend(weights: list[np.ndarray], squares: list[np.ndarray], codes: np.ndarray,
            places: np.ndarray, wanted: np.ndarray, model: WindowModel) -> float:
    """One step on the places' mean loss, with rates that fall by what each weight has moved."""
    embed, out, bias = weights
    hidden, logs = forward(weights, codes, places, model)
    rows = np.arange(len(places))
    loss = -float(logs[rows, wanted].mean())
    slope = np.exp(logs)
    slope[rows, wanted] -= 1
    slope /= len(places)
    back = (slope @ out.T) * (1 - hidden * hidden)
    changes = [np.zeros_like(embed), hidden.T @ slope, slope.sum(0)]
    for kind, own in inputs(codes, places, model):
        order = np.argsort(own, kind="stable")
        values, starts = np.unique(own[order], return_index=True)
        changes[0][kind][values] += np.add.reduceat(back[order], starts, axis=0)
    for w, s, g in zip(weights, squares, changes, strict=True):
        s += g * g
        w -= model.rate * g / (np.sqrt(s) + 1e-4)
    return loss


def train_round(docs: DataFrame, text: str, vocabulary: Vocabulary, weights: list[np.ndarray],
                number: int, model: WindowModel) -> list[np.ndarray]:
    """Every task goes on from ``weights`` over its documents; the mean by tokens seen."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def train(batches):
        words, given = shared.value
        own = [w.copy() for w in given]
        squares = [np.full_like(w, 1e-6) for w in own]
        hashes, seen = WordHashes(), 0
        for batch in batches:
            for _, texts in pieces(batch, text):
                rows = Texts(texts, hashes, words, model)
                # Which places are masked depends on what is there, so reruns agree.
                rng = np.random.default_rng((model.seed, number, len(rows.buckets)))
                chosen = np.flatnonzero(rng.random(len(rows.buckets)) < model.masked)
                rng.shuffle(chosen)
                for start in range(0, len(chosen), model.batch):
                    part = chosen[start:start + model.batch]
                    descend(own, squares, rows.codes, rows.places[part],
                            words.classes[rows.buckets[part]], model)
                seen += len(chosen)
        if seen:
            flat = np.concatenate([w.ravel() for w in own]).astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat),
                 pa.array(np.full(len(flat), seen), pa.int64())], names=["place", "sum", "seen"])

    rows = docs.select(text).mapInArrow(train, "place int, sum double, seen bigint")
    mean = rows.groupBy("place").agg((F.sum("sum") / F.sum("seen")).alias("mean"))
    flat = np.concatenate([w.ravel() for w in weights]).astype(np.float32)
    for row in mean.toLocalIterator():
        flat[row.place] = row.mean
    sizes = np.cumsum([w.size for w in weights])[:-1]
    return [part.reshape(w.shape) for part, w in zip(np.split(flat, sizes), weights, strict=True)]


def fit(docs: DataFrame, model: WindowModel, text: str = "text"
        ) -> tuple[Vocabulary, list[np.ndarray]]:
    vocabulary = Vocabulary(bucket_counts(docs, text, model), model)
    weights = first_weights(vocabulary, model)
    for number in range(model.rounds):
        weights = train_round(docs, text, vocabulary, weights, number, model)
    return vocabulary, weights


def log_likelihoods(texts: list, hashes: WordHashes, vocabulary: Vocabulary,
                    weights: list[np.ndarray], model: WindowModel) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and sum of conditional log-probabilities of each text, none left out."""
    rows = Texts(texts, hashes, vocabulary, model)
    each = np.empty(len(rows.buckets), np.float64)
    for start in range(0, len(each), 1 << 15):
        part = slice(start, start + (1 << 15))
        own = rows.buckets[part]
        logs = forward(weights, rows.codes, rows.places[part], model)[1]
        each[part] = logs[np.arange(len(own)), vocabulary.classes[own]] + vocabulary.inside[own]
    sums = np.concatenate([[0.0], np.cumsum(each)])
    ends = np.cumsum(rows.sizes)
    return rows.sizes, sums[ends] - sums[ends - rows.sizes]


def score_documents(docs: DataFrame, model: WindowModel | None = None, *, ident: str = "doc_id",
                    text: str = "text", fitted: tuple[Vocabulary, list[np.ndarray]] | None = None
                    ) -> DataFrame:
    """Per row of ``docs``: id, n_tokens, log_likelihood and its mean per token.

    Trains on ``docs`` unless ``fitted`` is given. A null, empty or blank text has no
    tokens, log_likelihood 0 and no mean. Repeated rows are scored each, and count
    each in training. An empty table gives no rows. Other columns are not read. A very
    long text is trained on and scored whole by one task. Which places are masked and
    how nets are averaged follow the partitions of ``docs``, so scores of another
    layout differ slightly.
    """
    model = model or WindowModel()
    frame = docs.select(F.col(ident).alias("ident"), F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted or fit(frame, model, "_text"))

    def prepare():
        hashes, (vocabulary, weights) = WordHashes(), shared.value

        def score(texts):
            sizes, sums = log_likelihoods(texts, hashes, vocabulary, weights, model)
            return [pa.array(sizes), pa.array(sums)]
        return score

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("_sum", T.DoubleType())]
    scored = text_columns(frame, "_text", fields, prepare, ["ident"])
    return scored.select(
        F.col("ident").alias(ident), "n_tokens", F.round("_sum", 3).alias("log_likelihood"),
        F.round(F.try_divide("_sum", "n_tokens"), 6).alias("mean_log_likelihood"))
