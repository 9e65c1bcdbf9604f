"""Toxicity by a bag of subwords: averaged embeddings into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of the word itself and of its
character n-grams; a document's vector is the mean over its words. A misspelling
shares most n-grams with the word it comes from. Embeddings and softmax are
fitted together, by mini-batches, on a bounded sample of labelled documents.
Afterwards the output is linear in the mean, so one number per hashed n-gram is
all that the scoring tasks need.

In a long text few words make it toxic, and the mean over all of them drowns
these. So a document is scored by the same mean over the fiftieth of its words
that speak most for toxicity. A slope and an offset turn that into a probability; a part of the sample
that the embeddings have not seen gives these two.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.memory import Remembered
from soukwise.llm.tables import held_out, rows_where

WORDS = re.compile(r"\w+")
#: Hashed n-grams, the length of an embedding, and the lengths of the n-grams.
BUCKETS, WIDTH, GRAMS = 1 << 18, 8, (3, 4, 5)
#: The sample: documents of each class at most, and the characters of a document that may be drawn.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1500, 20_000
STEPS, BATCH, RATE, SEED = 480, 64, 0.02, 7
#: One in so many words counts for a document, one in so many sampled documents is kept for the slope and the offset.
TELLING, KEPT = 50, 4
#: Words whose value a worker remembers, in each of two generations.
REMEMBERED = 1 << 18
#: Words whose buckets the training remembers, likewise.
TRAINED = 1 << 14
#: Rows of embeddings that the training draws and moves at a time, so that the driver holds little beside them.
ROWS = 1 << 14


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its n-grams, with marks at the word's ends."""
    marked = f"<{word}>".encode()
    letters = f"<{word}>"
    grams = [letters[i:i + n].encode() for n in GRAMS for i in range(len(letters) - n + 1)]
    return [zlib.crc32(g) % BUCKETS for g in (b"=" + marked, *grams)]


def bag(text: str, known: Remembered[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which add up to 1; empty for no word."""
    weights: dict[int, float] = {}
    words = WORDS.findall(text.lower())
    for word in words:
        found = known[word]
        share = 1.0 / len(found)
        for bucket in found:
            weights[bucket] = weights.get(bucket, 0.0) + share
    buckets = np.fromiter(weights.keys(), np.int32, len(weights))
    return buckets, np.fromiter(weights.values(), np.float32, len(weights)) / np.float32(max(1, len(words)))


@dataclass
class Model:
    """What each bucket speaks for label 1, and the line that makes log odds of a document's mean."""

    value: np.ndarray
    slope: float
    offset: float

    def word(self, word: str) -> float:
        return float(self.value[subwords(word)].mean())

    def telling(self, words: list[str], value: Callable[[str], float]) -> float:
        """The mean over the fiftieth of the words that is highest, one word at least; 0 for no word."""
        if not words:
            return 0.0
        values = np.fromiter(map(value, words), np.float64, len(words))
        n = -(-len(words) // TELLING)
        return float(np.partition(values, len(values) - n)[-n:].mean())


def _probability(logit: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(logit, -700, 700))))


def embedded(texts: list[str], target: np.ndarray) -> np.ndarray:
    """Fit embeddings and softmax to texts of two classes; the logit that each bucket adds to the mean."""
    known: Remembered[str, list[int]] = Remembered(subwords, TRAINED)
    bags = [bag(t, known) for t in texts]
    rng = np.random.default_rng(SEED)
    embed = np.empty((BUCKETS, WIDTH), np.float32)
    for at in range(0, BUCKETS, ROWS):
        embed[at:at + ROWS] = rng.uniform(-1 / WIDTH, 1 / WIDTH, embed[at:at + ROWS].shape)
    weight, offset = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    params = [embed, weight, offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    slope = np.empty_like(embed)
    step = 0
    while step < STEPS:
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = [i for i in order[at:at + BATCH] if len(bags[i][0])]
            step += 1
            if not chosen:
                continue
            buckets = np.concatenate([bags[i][0] for i in chosen])
            weights = np.concatenate([bags[i][1] for i in chosen])
            sizes = np.array([len(bags[i][0]) for i in chosen])
            mean = np.add.reduceat(embed[buckets] * weights[:, None], np.cumsum(sizes) - sizes)
            logits = mean @ weight + offset
            soft = np.exp(logits - logits.max(axis=1, keepdims=True))
            soft /= soft.sum(axis=1, keepdims=True)
            soft[np.arange(len(chosen)), target[chosen]] -= 1
            soft /= len(chosen)
            back = np.repeat(soft @ weight.T, sizes, axis=0) * weights[:, None]
            for d in range(WIDTH):
                slope[:, d] = np.bincount(buckets, back[:, d], BUCKETS)
            for whole in zip(params, first, second, (slope, mean.T @ soft, soft.sum(axis=0))):
                for start in range(0, len(whole[0]), ROWS):
                    p, m, v, g = (x[start:start + ROWS] for x in whole)
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return embed @ (weight[:, 1] - weight[:, 0])


def _line(x: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, by Newton steps with a slight pull to zero."""
    middle, scale = float(x.mean()), float(x.std()) or 1.0
    design = np.stack([(x - middle) / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    pull = np.diag([1e-4, 1e-6]) * len(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + pull
        beta -= np.linalg.solve(hessian, design.T @ (p - target) + pull @ beta)
    return float(beta[0] / scale), float(beta[1] - beta[0] * middle / scale)


def fit(texts: list[str], labels: list[int], prior: float | None = None) -> Model:
    """Train on texts with labels 0 and 1. ``prior`` is the share of 1 where the model is used.

    Without two texts of either class the model answers the prior for every text.
    """
    target = np.array(labels, np.int64)
    share = float(target.mean()) if len(target) else 0.0
    prior = min(max(share if prior is None else prior, 1e-6), 1 - 1e-6)
    odds = float(np.log(prior / (1 - prior)))
    if min(int(target.sum()), len(target) - int(target.sum())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, odds)
    # Of each class every fourth text, the second one first, is kept for the line.
    rank = np.zeros(len(target), np.int64)
    for label in (0, 1):
        rank[target == label] = np.arange(int((target == label).sum()))
    kept = rank % KEPT == 1
    model = Model(embedded([t for t, k in zip(texts, kept) if not k], target[~kept]), 1.0, 0.0)
    value = Remembered(model.word, REMEMBERED).__getitem__
    x = np.array([model.telling(WORDS.findall(t.lower()), value) for t, k in zip(texts, kept) if k])
    model.slope, model.offset = _line(x, target[kept])
    model.slope = max(model.slope, 0.0)
    # The sample is balanced otherwise than the documents: move the odds.
    model.offset += odds - float(np.log(share / (1 - share)))
    return model


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[list[str], list[int], float]:
    """Texts, labels and share of 1 of a bounded sample of the labelled rows that are not held out.

    Rows are drawn by a hash of their id, ``per_class`` of each class at most and
    only texts of up to ``SAMPLE_CHARS`` characters. An id labelled twice counts as 1 if any of its labels is 1.
    """
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], [], 0.0
    drawn = None
    for label in sorted(counts):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most two times per_class ids, whatever the tables hold.
    drawn = F.broadcast(drawn)
    rows = (docs.where(F.length("text") <= SAMPLE_CHARS).join(drawn, "doc_id")
            .select("doc_id", "toxic", "text").dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    return ([r["text"] for r in rows], [r["toxic"] for r in rows],
            counts.get(1, 0) / sum(counts.values()))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not take for toxic, with all columns.

    A model that has learned nothing from texts rejects none.
    """
    if model.slope == 0:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list[str]) -> list[bool]:
        model = shared.value
        value = Remembered(model.word, REMEMBERED).__getitem__
        return [model.slope * model.telling(WORDS.findall(t.lower()), value) + model.offset < 0 for t in texts]

    return rows_where(docs, text_col, keep)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``, from its text alone.

    A text without a word, or null, gets the score that the model has for an
    empty mean. Repeated rows and null ids each keep a row, other columns are not
    looked at, an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        value = Remembered(model.word, REMEMBERED).__getitem__
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                words = WORDS.findall((text or "").lower())
                scores.append(_probability(model.slope * model.telling(words, value) + model.offset))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, score double"))
