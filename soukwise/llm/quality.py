"""Quality by random indexing: word vectors from their neighbours, pooled per document, into a two-layer network.

Every word has a sparse index vector of a few ones and minus ones, drawn by a
fixed rule. A word's vector is the sum of the index vectors of the words around
all its occurrences, in the texts of all documents, labelled or not. The sums
are whole numbers, so they do not depend on how the texts were dealt to tasks.
Words share ``ROWS`` rows by hash, so the table has a fixed size whatever the
vocabulary, and can be broadcast.

A document is described by the mean of its words' vectors and by the mean product
of neighbouring ones, which tells repetition from prose. A network of two layers, trained in numpy
on a bounded sample of labelled documents, gives log odds; rows of the sample that the network has
not seen give the temperature that they are divided by.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.llm.memory import Remembered

#: Words and single other characters.
TOKENS = re.compile(r"\w+|[^\w\s]")
#: Rows of the table of vectors, the length of a vector, the entries of an index vector and the neighbours to each side.
ROWS, WIDTH, ENTRIES, WINDOW = 1 << 16, 64, 4, 2
#: Tokens whose vectors are pooled at a time, tokens whose neighbours are added at a time, and tokens after which a task
#: gives its sums away.
CHUNK, LOT, FLUSH = 1 << 16, 1 << 18, 1 << 28
#: The sample: documents of each class at most. One in ``KEPT`` of them is kept for the temperature.
SAMPLE_PER_CLASS, KEPT = 4000, 4
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 64, 0.005, 1e-4, 11
#: Rows whose number a worker remembers, in each of two generations.
REMEMBERED = 1 << 17


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def row_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every row's index vector; the places of a row differ."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((ROWS, WIDTH), np.float32), axis=1)[:, :ENTRIES].astype(np.int64)
    return places, np.where(rng.random((ROWS, ENTRIES)) < 0.5, -1, 1).astype(np.int64)


def _rows(text: str | None, known: Remembered) -> np.ndarray:
    found = list(map(known.__getitem__, TOKENS.findall((text or "").lower())))
    return np.array(found, np.int64)


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, n, c0, c1, …): how often a row's words occur, and the sums of the index vectors around them.

    Tasks add up what they read; then the tables of the tasks are added by row.
    """
    names = ["row", "n", *[f"c{i}" for i in range(WIDTH)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        known = Remembered(row_of, REMEMBERED)
        places, signs = np.ascontiguousarray(places.T), np.ascontiguousarray(signs.T)
        # Between texts lies a row that no word has.
        gap = np.full(WINDOW, ROWS)
        sums, times, seen = np.zeros(ROWS * WIDTH, np.int64), np.zeros(ROWS, np.int64), 0
        held, size = [], 0

        def add(rows: np.ndarray) -> None:
            times[:] += np.bincount(rows, minlength=ROWS + 1)[:ROWS]
            for at in range(0, len(rows), LOT):
                part = rows[at:at + LOT + WINDOW]
                pairs = []
                for apart in range(1, WINDOW + 1):
                    left, right = part[:min(LOT, len(part) - apart)], part[apart:apart + LOT]
                    pairs.append((left << 32 | right)[(left < ROWS) & (right < ROWS)])
                pairs, n = np.unique(np.concatenate(pairs), return_counts=True)
                left, right = pairs >> 32, pairs & 0xFFFFFFFF
                for word, other in ((left, right), (right, left)):
                    for place, sign in zip(places, signs):
                        np.add.at(sums, word * WIDTH + place.take(other), sign.take(other) * n)

        def table() -> Iterator[pa.RecordBatch]:
            used = np.flatnonzero(times)
            for at in range(0, len(used), 4096):
                part = used[at:at + 4096]
                values = sums.reshape(ROWS, WIDTH)[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(times[part]), *[pa.array(np.ascontiguousarray(values[:, i])) for i in range(WIDTH)]], names)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held += [_rows(text, known), gap]
                size += len(held[-2])
                if size >= LOT:
                    add(np.concatenate(held))
                    seen, held, size = seen + size, [], 0
                if seen > FLUSH:
                    yield from table()
                    sums[:], times[:], seen = 0, 0, 0
        if held:
            add(np.concatenate(held))
        yield from table()

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, ", ".join(f"{name} bigint" for name in names))
    return parts.groupBy("row").agg(*[F.sum(name).alias(name) for name in names[1:]])


def word_vectors(sums: DataFrame) -> np.ndarray:
    """The table of unit vectors, without the direction that all words share; at most ``ROWS`` rows reach the driver."""
    vectors = np.zeros((ROWS, WIDTH))
    times = np.zeros(ROWS)
    found = sums.toArrow()
    at = found.column("row").to_numpy()
    times[at] = found.column("n").to_numpy()
    vectors[at] = np.stack([found.column(f"c{i}").to_numpy() for i in range(WIDTH)], axis=1) if len(at) else 0

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)

    vectors = unit(vectors)
    if times.any():
        vectors -= (vectors * times[:, None]).sum(axis=0) / times.sum()
    return (unit(vectors) * (times > 0)[:, None]).astype(np.float32)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The description of a document by the rows of its words: mean vector and mean product of neighbours, zeros for none."""
    mean, pairs = np.zeros(WIDTH), np.zeros(WIDTH)
    for at in range(0, len(rows), CHUNK):
        here = vectors[rows[at:at + CHUNK + 1]]
        mean += here[:CHUNK].sum(axis=0, dtype=np.float64)
        pairs += (here[1:] * here[:-1]).sum(axis=0, dtype=np.float64)
    return np.concatenate([mean / max(1, len(rows)), pairs / max(1, len(rows) - 1)])


@dataclass
class Model:
    """Word vectors, the scale of descriptions, two layers, temperature and the shift to the documents' own odds."""

    vectors: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float
    shift: float

    def logit(self, x: np.ndarray) -> float:
        """Log odds of one description; one at a time, so that equal texts get equal odds."""
        hidden = np.tanh(((x - self.middle) / self.scale) @ self.first + self.first_bias)
        return float(hidden @ self.second + self.second_bias) / self.temperature + self.shift

    def probability(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(x), -700, 700))))


def constant(vectors: np.ndarray, odds: float) -> Model:
    """A model that has learned nothing but the share of label 1."""
    n = 2 * WIDTH
    return Model(vectors, np.zeros(n), np.ones(n), np.zeros((n, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0, odds)


def network(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Two layers fitted to rows of classes 0 and 1, which weigh the same together, by mini-batches."""
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            step += 1
            hidden = np.tanh(x[chosen] @ params[0] + params[1])
            logit = np.clip(hidden @ params[2] + params[3][0], -30, 30)
            back = (1 / (1 + np.exp(-logit)) - target[chosen]) * weight[chosen] / len(chosen)
            inner = back[:, None] * params[2] * (1 - hidden * hidden)
            slopes = [x[chosen].T @ inner + DECAY * params[0], inner.sum(axis=0), hidden.T @ back + DECAY * params[2], np.array([back.sum()])]
            for p, m, v, g in zip(params, first, second, slopes):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The divisor of log odds, in 1/20 to 20, that makes labels of rows not trained on likeliest, by a narrowing search.

    The two classes weigh the same, as in training.
    """
    share = min(max(target.mean(), 1e-9), 1 - 1e-9)
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share))

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t) * np.where(target == 1, -1, 1)
        return float((weight * np.logaddexp(0, z)).mean())

    low, high = -np.log(20), np.log(20)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(x: np.ndarray, target: np.ndarray, vectors: np.ndarray, prior: float) -> Model:
    """A model from descriptions with labels 0 and 1; ``prior`` is the share of 1 where it is used.

    With fewer than two rows of either class it answers the prior for every text.
    """
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    odds = float(np.log(prior / (1 - prior)))
    if min(int((target == 1).sum()), int((target == 0).sum())) < 2:
        return constant(vectors, odds)
    rank = np.zeros(len(target), np.int64)
    for label in (0, 1):
        rank[target == label] = np.arange(int((target == label).sum()))
    kept = rank % KEPT == 1
    middle, scale = x[~kept].mean(axis=0), np.maximum(x[~kept].std(axis=0), 1e-6)
    layers = network((x[~kept] - middle) / scale, target[~kept].astype(float))
    model = Model(vectors, middle, scale, *layers, 1.0, 0.0)
    model.temperature = temperature(np.array([model.logit(row) for row in x[kept]]), target[kept])
    model.shift = odds
    return model


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Word vectors from all texts, the network from a bounded sample of labelled rows that are not held out.

    Rows are drawn by a hash of their id, ``per_class`` of each class at most. An id labelled twice counts as 1
    if any of its labels is 1. Only labels, texts and the split by id are looked at.
    """
    vectors = word_vectors(context_sums(docs))
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality")))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    drawn = [known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for label in (0, 1)]
    # At most two times per_class ids, whatever the tables hold.
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(drawn, "doc_id")
    found = described(texts, vectors).dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), 2 * WIDTH)
    return fit(x, found["quality"].to_numpy(np.int64), vectors, prior)


def described(texts: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, quality, x) of rows (doc_id, text, quality): the label and the description of the text."""
    shared = texts.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(row_of, REMEMBERED)
        for batch in batches:
            x = [pooled(_rows(t, known), shared.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "quality").mapInArrow(run, f"doc_id {kind}, quality int, x array<double>")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``, from its text alone.

    A text without a word, or null, gets the score of the zero description. Repeated rows and null ids each
    keep a row, other columns are not looked at, an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, Remembered(row_of, REMEMBERED)
        for batch in batches:
            scores = [model.probability(pooled(_rows(t, known), model.vectors)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, score double"))
