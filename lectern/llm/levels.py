"""Problem 9: reading level of each document.

Two regularised sentence models, one over words and one over character n-grams of words, each with sentence shape, give
every sentence a distribution over the levels. A document's distributions are aggregated and a calibrated model maps the
aggregate to its level. The models are fitted on a bounded sample of labelled documents; the calibration sees only
sentence distributions of models that weren't fitted on the same document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import hashed_sample, table

#: At most so many labelled documents are fitted on: those whose ids have the least hashes.
MOST_LABELLED = 4_000
#: Characters of their texts together: documents beyond it in the order of the hashes aren't fitted on.
MOST_CHARS = 64_000_000
LEVELS = 5
TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?]+(?=\s|$)|[,;:]|\n")
BUCKETS = 1 << 14
SHAPE = 5


def ngrams(word: str) -> list[int]:
    import xxhash

    w = f"<{word}>"
    return [xxhash.xxh32_intdigest(w[i : i + k]) % BUCKETS for k in (2, 3, 4) for i in range(max(1, len(w) - k + 1))]


class Parsed:
    """Word ids of several texts with sentence and document borders, and each sentence's shape."""

    def __init__(self, texts: list[str | None], vocabulary: dict[str, int]) -> None:
        ids, sizes, commas, owner = [], [], [], []
        for d, text in enumerate(texts):
            run, comma = 0, 0
            for t in TOKEN.findall((text or "").lower()):
                first = t[0]
                if first in ".!?\n":
                    if run:
                        sizes.append(run), commas.append(comma), owner.append(d)
                    run = comma = 0
                elif first in ",;:":
                    comma += 1
                else:
                    run += 1
                    ids.append(vocabulary.setdefault(t, len(vocabulary)))
            if run:
                sizes.append(run), commas.append(comma), owner.append(d)
        self.ids, self.size, self.owner = np.array(ids, np.int64), np.array(sizes, np.int64), np.array(owner, np.int64)
        self.commas, self.docs = np.array(commas, float), len(texts)
        self.first = np.cumsum(self.size) - self.size

    def shape(self, lengths: np.ndarray) -> np.ndarray:
        """Of each sentence: a constant, its length in words (two powers), marks inside it, the mean length of its words."""
        n = np.log1p(self.size)
        letters = np.add.reduceat(lengths[self.ids], self.first) / self.size if len(self.size) else np.zeros(0)
        return np.stack([np.ones(len(n)), n - 2.5, (n - 2.5) ** 2, self.commas / (self.size + 1) * 5, (letters - 6) / 3], 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def adam(weights: list[np.ndarray], gradient, steps: int, rate: float) -> None:
    """Plain full-batch descent with adapted steps, in place."""
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, steps + 1):
        for w, g, a, b in zip(weights, gradient(), m, v):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            w -= rate * (0.1 + 0.9 * (1 - t / steps)) * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-9)


@dataclass
class Sentences:
    """Word and character tables (words x levels) and the shape's weights of both models."""

    word: np.ndarray
    char: np.ndarray
    word_shape: np.ndarray
    char_shape: np.ndarray
    grams: np.ndarray


def fit_sentences(p: Parsed, target: np.ndarray, keep: np.ndarray, lengths: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], l2: float = 2e-5, steps: int = 60) -> Sentences:
    """Both models on the sentences of the documents kept; target: a distribution of levels for each document."""
    n_words = len(lengths)
    word_of, gram_of, share = pairs
    use = keep[p.owner]
    sentence = np.repeat(np.arange(len(p.size)), p.size)
    token_use = use[sentence]
    ids = p.ids[token_use]
    size = p.size[use]
    first = np.cumsum(size) - size
    of = np.repeat(np.arange(len(size)), size)
    x, y = p.shape(lengths)[use], target[p.owner[use]]
    weight = (size / size.mean()) ** 0.5
    weight = (weight / weight.sum())[:, None]
    scale = 1 / size

    def through(tables: np.ndarray, u: np.ndarray):
        z = np.add.reduceat(tables[ids], first) * scale[:, None] + x @ u
        e = (softmax(z) - y) * weight
        back = e * scale[:, None]
        g = np.stack([np.bincount(ids, back[of, k], n_words) for k in range(LEVELS)], 1)
        return g, x.T @ e

    seen = np.bincount(ids, minlength=n_words)
    word, wu = np.zeros((n_words, LEVELS)), np.zeros((SHAPE, LEVELS))

    def word_gradient():
        g, gu = through(word, wu)
        return [g + l2 * word / np.maximum(seen, 1)[:, None] ** 0.5, gu + 1e-6 * wu]

    adam([word, wu], word_gradient, steps, 0.3)
    word[seen == 0] = 0
    gram, cu = np.zeros((BUCKETS, LEVELS)), np.zeros((SHAPE, LEVELS))
    spread = lambda: np.stack([np.bincount(word_of, gram[gram_of, k] * share, n_words) for k in range(LEVELS)], 1)

    def char_gradient():
        g, gu = through(spread(), cu)
        back = np.stack([np.bincount(gram_of, g[word_of, k] * share, BUCKETS) for k in range(LEVELS)], 1)
        return [back + l2 * gram, gu + 1e-6 * cu]

    adam([gram, cu], char_gradient, steps, 0.3)
    return Sentences(word, spread(), wu, cu, gram)


AGGREGATES = 2 * LEVELS + 8


def aggregate(p: Parsed, m: Sentences, lengths: np.ndarray, word: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Of each document: mean distributions of both models, mean and spread of the expected level, and sentence shape."""
    out = np.zeros((p.docs, AGGREGATES))
    if not len(p.size):
        return out
    x = p.shape(lengths)
    both = np.add.reduceat(np.concatenate([word, char], 1)[p.ids], p.first) / p.size[:, None]
    a, b = softmax(both[:, :LEVELS] + x @ m.word_shape), softmax(both[:, LEVELS:] + x @ m.char_shape)
    level = np.arange(1, LEVELS + 1)
    ea, eb = a @ level, b @ level
    # the tables alone, without the shape: how demanding the words are, whatever the sentences' lengths
    wa = softmax(both[:, :LEVELS]) @ level
    w = np.sqrt(p.size)
    each = np.concatenate([a, b, np.stack([ea, eb, ea**2, wa, x[:, 1], x[:, 3], x[:, 4], x[:, 2]], 1)], 1) * w[:, None]
    total = np.bincount(p.owner, w, p.docs)
    for k in range(AGGREGATES):
        out[:, k] = np.bincount(p.owner, each[:, k], p.docs) / np.maximum(total, 1e-9)
    k = 2 * LEVELS
    out[:, k + 2] = np.sqrt(np.maximum(out[:, k + 2] - out[:, k] ** 2, 0))
    return out


def expanded(x: np.ndarray) -> np.ndarray:
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j] / 2], 1)


class Model:
    """Fitted models; predict() gives distributions over the levels."""

    def fit(self, texts: list[str], target: np.ndarray) -> Model:
        vocabulary: dict[str, int] = {}
        p = Parsed(texts, vocabulary)
        words = list(vocabulary)
        lengths = np.array([len(w) for w in words], float)
        lists = [ngrams(w) for w in words]
        size = np.array([len(x) for x in lists])
        pairs = np.repeat(np.arange(len(words)), size), np.concatenate(lists), np.repeat(1 / size, size)
        fold = np.arange(len(texts)) % 2
        held = np.zeros((len(texts), AGGREGATES))
        for k in (0, 1):
            m = fit_sentences(p, target, fold != k, lengths, pairs)
            held[fold == k] = aggregate(p, m, lengths, m.word, m.char)[fold == k]
        self.sentences = fit_sentences(p, target, fold >= 0, lengths, pairs)
        self.known = {w: k for k, w in enumerate(words)}
        self.mean, self.spread = held.mean(0), held.std(0) + 1e-3
        x = expanded((held - self.mean) / self.spread)
        self.weights = np.zeros((x.shape[1], LEVELS))

        def gradient():
            g = x.T @ (softmax(x @ self.weights) - target) / len(x) + 1e-3 * self.weights
            return [g]

        adam([self.weights], gradient, 300, 0.05)
        return self

    def ready(self) -> None:
        """The tables a worker extends with the words it meets."""
        self.vocabulary = dict(self.known)
        self.lengths = np.array([len(w) for w in self.known], float)
        self.tables = np.concatenate([self.sentences.word, self.sentences.char], 1)

    def predict(self, texts: list[str | None]) -> np.ndarray:
        if not hasattr(self, "vocabulary") or len(self.vocabulary) > 10 * len(self.known) + 500_000:
            self.ready()
        before = len(self.vocabulary)
        p = Parsed(texts, self.vocabulary)
        if len(self.vocabulary) > before:
            new = list(self.vocabulary)[before:]
            rows = np.zeros((len(new), 2 * LEVELS))
            for k, w in enumerate(new):
                rows[k, LEVELS:] = self.sentences.grams[ngrams(w)].mean(0)
            self.tables = np.concatenate([self.tables, rows])
            self.lengths = np.concatenate([self.lengths, [len(w) for w in new]])
        x = aggregate(p, self.sentences, self.lengths, self.tables[:, :LEVELS], self.tables[:, LEVELS:])
        return softmax(expanded((x - self.mean) / self.spread) @ self.weights)


def consensus(labels: DataFrame) -> DataFrame:
    """(doc_id, votes): of each labelled document the number of votes for each level; repeated rows of a rater count once, null levels and those outside 1-5 not at all."""
    votes = labels.where(f"doc_id is not null and reading_level between 1 and {LEVELS}").select("doc_id", "rater", "reading_level").distinct()
    return votes.groupBy("doc_id").agg(F.array(*[F.sum((F.col("reading_level") == k).cast("int")) for k in range(1, LEVELS + 1)]).alias("votes"))


def rated(documents: DataFrame, least_tokens: int, *also: str) -> DataFrame:
    space = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    tokens = F.size(F.filter(F.split("text", space, -1), lambda t: t != ""))
    return documents.where("doc_id is not null and text is not null and lang = 'en'").where(tokens >= least_tokens).select("doc_id", "text", *also)


def fit(documents: DataFrame, labels: DataFrame, least_tokens: int = 40, most: int = MOST_LABELLED, most_chars: int = MOST_CHARS) -> Model:
    """The models, fitted on at most `most` labelled documents of at most most_chars characters together (a bounded sample of whole texts)."""
    votes = consensus(labels)
    sample = hashed_sample(votes, F.xxhash64("doc_id"), most, votes.count())
    # the few labelled documents first: only their texts are counted through
    mine = rated(documents.join(F.broadcast(sample), "doc_id"), least_tokens, "votes").dropDuplicates(["doc_id"])
    so_far = F.sum(F.length("text").cast("long")).over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))  # `most` rows
    rows = mine.withColumn("chars", so_far).where(F.col("chars") <= most_chars).drop("chars").toPandas().sort_values("doc_id")
    if not len(rows):
        raise ValueError("no labelled document to fit on")
    votes = np.stack(rows["votes"].to_list()).astype(float)
    # a vote is right most of the time: agreeing votes sharpen the target
    target = votes + 0.02
    target = target**1.5 * 1.0
    return Model().fit(rows["text"].to_list(), target / target.sum(1, keepdims=True))


def reading_levels(documents: DataFrame, labels: DataFrame, least_tokens: int = 40, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, reading_level, confidence, expected_level) of every document whose lang is exactly en and whose text has least_tokens tokens.

    Texts are read whole. Null doc_id, null, empty and short texts give no row; rows of the same doc_id and text give
    equal rows; without any labelled document a ValueError says so. Other columns aren't read.
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, least_tokens, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                p = m.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array((p.argmax(1) + 1).astype(np.int32)), pa.array(p.max(1)), pa.array(p @ np.arange(1, LEVELS + 1))], names=["doc_id", "reading_level", "confidence", "expected_level"])

    return rated(documents, least_tokens).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, reading_level int, confidence double, expected_level double")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels")).select("doc_id", "reading_level")


def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and mean confidence by level and source."""
    d = table(spark, sf_dir, "documents")
    levels = reading_levels(d, table(spark, sf_dir, "level_labels"))
    return levels.join(d.select("doc_id", F.lower("source").alias("source")), "doc_id").groupBy("source", "reading_level").agg(F.count("*").alias("documents"), F.avg("confidence").alias("mean_confidence"))
