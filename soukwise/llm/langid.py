"""Language identification by interpolated Kneser-Ney character models, one per language.

A word is read letter by letter, each given the three letters before it, with
spaces before the word and one after it. The highest order counts occurrences, the
lower ones in how many contexts a sequence was seen. All rows of the training
table are counted, and discounts, contexts and probabilities come from all counted sequences, in Spark. A model
is a table of them. Tasks hold it as sorted arrays of 64-bit hashes with a probability each, and of contexts
with the weight that is left to the next lower order.

A table of more than ``PART_ROWS`` sequences is dealt into parts by the two letters before the last one, so that all that a
place in a text asks for lies in one part (sequences of one and two letters are in every part). Each part takes a pass
over the texts; the sums of the passes are added by row.

The language of a text is the one of lowest cross-entropy per letter. The training
texts show how high that gets for texts of a language by length; a text above is marked as rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soukwise.session import materialise

WORDS = re.compile(r"[^\W\d_]+")
ORDER = 4
#: Sequences and contexts of a part, about: what a task holds at a time, some 16 bytes each.
PART_ROWS = 1 << 21
#: The part of the training texts that is accepted, the lengths it is seen by, and the texts of a length from which on
#: they have a limit of their own, not that of their language.
ACCEPTED, LENGTHS, ENOUGH = 0.995, (1, 32, 128, 512), 20
#: Letters that speak for a language in the score at most: neighbouring letters are not independent.
EVIDENCE = 32
#: Characters that a task looks at together, to score each of their words once.
HELD = 8 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _keys(codes: np.ndarray) -> np.ndarray:
    """A hash for each row of character codes."""
    width = codes.shape[1]
    return (codes.astype(np.uint64) + np.uint64(1)) @ _ODD[:width] if width else np.zeros(len(codes), np.uint64)


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted array, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class LanguageModel:
    """For orders 1 to ``ORDER``: hashes of sequences with their probability, of contexts with the weight passed on."""

    unseen: float
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def fit(cls, codes: np.ndarray, counts: np.ndarray, alphabet: int) -> LanguageModel:
        """From the distinct sequences of ``ORDER`` codes and their counts, where one task can hold them."""
        levels = [(codes, counts.astype(np.float64))]
        for _ in range(ORDER - 1):
            above = levels[-1][0]
            rows, seen = np.unique(above[:, 1:], axis=0, return_counts=True)
            levels.append((rows, seen.astype(np.float64)))
        model = cls(1.0 / (alphabet + 1))
        for rows, n in reversed(levels):
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = min(max(once / max(1, once + 2 * twice), 0.1), 0.9)
            context, inverse = np.unique(_keys(rows[:, :-1]), return_inverse=True)
            total = np.bincount(inverse, n, len(context))
            kinds = np.bincount(inverse, minlength=len(context))
            passed = discount * kinds / total
            probability = (n - discount) / total[inverse] + passed[inverse] * model.probability(rows[:, 1:])
            keys = _keys(rows)
            order = np.argsort(keys)
            model.contexts.append((context, passed))
            model.grams.append((keys[order], probability[order]))
        return model

    def probability(self, codes: np.ndarray) -> np.ndarray:
        """Of the last code of each row given those before it."""
        width = codes.shape[1]
        if width == 0 or not self.grams:
            return np.full(len(codes), self.unseen)
        keys, values = self.grams[width - 1]
        at = _place(keys, _keys(codes))
        out = values[at] if len(values) else np.zeros(len(codes))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            rest = codes[missing]
            contexts, passed = self.contexts[width - 1]
            found = _place(contexts, _keys(rest[:, :-1]))
            weight = np.where(found >= 0, passed[found], 1.0) if len(passed) else 1.0
            out[missing] = weight * self.probability(rest[:, 1:])
        return out


def _windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` codes that end at each letter and at the space after each word, and where each word starts."""
    pad = " " * (ORDER - 1)
    flat = np.frombuffer("".join([f"{pad}{w} " for w in words]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    # The k-th word has k + 1 paddings before it.
    ends = np.arange(int(sizes.sum())) + np.repeat((np.arange(len(words)) + 1) * (ORDER - 1), sizes)
    return flat[ends[:, None] + np.arange(-ORDER + 1, 1)], starts


def part_of(first: np.ndarray, second: np.ndarray, parts: int) -> np.ndarray:
    """The part that knows what follows two letters, given by their codes; ``_PART`` says the same to Spark."""
    return (first.astype(np.int64) * 7919 + second.astype(np.int64) * 104729) % 1000003 % parts


_PART = "(ascii({0}) * 7919L + ascii({1}) * 104729L) % 1000003L % {parts}L"


@dataclass
class Part:
    """What a task needs of a model at a time."""

    models: list[LanguageModel]
    number: int = 0
    parts: int = 1

    @classmethod
    def of(cls, rows: pa.Table, languages: int, unseen: float, number: int, parts: int) -> Part:
        """From rows (lang, width, context, seq, value) in any order."""
        place = (rows.column("lang").to_numpy() * ORDER + rows.column("width").to_numpy() - 1) * 2 + rows.column("context").to_numpy()
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(languages * ORDER * 2 + 1))
        seqs, values = rows.column("seq").take(pa.array(order)), rows.column("value").to_numpy()[order]
        models = []
        for lang in range(languages):
            model = LanguageModel(unseen)
            for width in range(1, ORDER + 1):
                for context, into in ((0, model.grams), (1, model.contexts)):
                    at = (lang * ORDER + width - 1) * 2 + context
                    one = slice(cuts[at], cuts[at + 1])
                    flat = "".join(seqs[one].to_pylist()).encode("utf-32-le")
                    keys = _keys(np.frombuffer(flat, np.uint32).reshape(one.stop - one.start, width - context))
                    by_key = np.argsort(keys)
                    into.append((keys[by_key], values[one][by_key]))
            models.append(model)
        return cls(models, number, parts)

    def word_logs(self, words: list[str]) -> np.ndarray:
        """The logarithm of the probability of each word in each language, over the places that this part knows."""
        codes, starts = _windows(words)
        if self.parts == 1:
            return np.stack([np.add.reduceat(np.log(m.probability(codes)), starts) for m in self.models], axis=1)
        own = np.flatnonzero(part_of(codes[:, 1], codes[:, 2], self.parts) == self.number)
        out = np.zeros((len(codes), len(self.models)))
        for i, m in enumerate(self.models):
            out[own, i] = np.log(m.probability(codes[own]))
        return np.add.reduceat(out, starts, axis=0)

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The negative logarithm of the probability of each text in each language, and how many letters and word ends it has."""
        out, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            stop, held = at, 0
            while stop < len(texts) and (stop == at or held + len(texts[stop]) <= HELD):
                held += len(texts[stop])
                stop += 1
            numbers = Numbers()
            rows = []
            for text in texts[at:stop]:
                words = WORDS.findall(text.lower())
                rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            if numbers:
                known = list(numbers)
                logs = self.word_logs(known)
                letters = np.fromiter(map(len, known), np.int64, len(known)) + 1
                for i, ids in enumerate(rows, at):
                    if len(ids):
                        sizes[i] = letters[ids].sum()
                        out[i] = -logs[ids].sum(axis=0)
            at = stop
        return out, sizes


@dataclass
class Model:
    languages: list[str]
    unseen: float
    #: (part, lang, width, context, seq, value); part -1 belongs to every part.
    table: DataFrame | None
    parts: int
    #: For each language and length class the highest cross-entropy that is accepted.
    limits: np.ndarray | None = None

    def part(self, number: int) -> Part:
        rows = self.table.where(F.col("part").isin(-1, number)).drop("part").toArrow()
        return Part.of(rows, len(self.languages), self.unseen, number, self.parts)


def count_sequences(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of a table (lang, text), with a row for each task at most before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(WORDS.findall(text.lower()))
            for lang, found in words.items():
                if found:
                    codes, starts = _windows(list(found))
                    n = np.fromiter(found.values(), np.int64, len(found))
                    sizes = np.diff(np.append(starts, len(codes)))
                    keys, first, inverse = np.unique(_keys(codes), return_index=True, return_inverse=True)
                    sums = np.bincount(inverse, np.repeat(n, sizes), len(keys)).astype(np.int64)
                    flat = codes[first].astype("<u4").tobytes().decode("utf-32-le")
                    grams = [flat[i:i + ORDER] for i in range(0, len(flat), ORDER)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array(grams), pa.array(sums)], ["lang", "gram", "n"])

    return (docs.select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _smoothed(counted: DataFrame) -> tuple[DataFrame, list[str], float]:
    """(lang, width, context, seq, value) of all counted sequences (lang, gram, n): the probability of the last letter, and for
    contexts the weight passed on; the languages, and the probability of a letter that no language has."""
    level = counted.selectExpr("lang", f"{ORDER} as width", "gram as seq", "n")
    levels = [level]
    for width in range(ORDER - 1, 0, -1):
        level = (level.groupBy("lang", F.expr("substring(seq, 2)").alias("seq")).agg(F.count("*").alias("n"))
                 .select("lang", F.lit(width).alias("width"), "seq", "n"))
        levels.append(level)
    every = materialise(reduce(DataFrame.unionByName, levels))
    languages = sorted(r[0] for r in every.select("lang").distinct().collect())
    unseen = 1.0 / (every.where("width = 1").select("seq").distinct().count() + 1)

    # One row for each language and width.
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    share = F.least(F.greatest(once / F.greatest(F.lit(1), once + 2 * twice), F.lit(0.1)), F.lit(0.9))
    discounts = every.groupBy("lang", "width").agg(share.alias("discount"))
    # A context has as many rows as letters follow it.
    same = Window.partitionBy("lang", "width", "before")
    weighed = materialise(
        every.join(F.broadcast(discounts), ["lang", "width"]).withColumn("before", F.expr("substring(seq, 1, width - 1)"))
        .withColumns({"total": F.sum("n").over(same), "kinds": F.count("*").over(same)})
        .selectExpr("lang", "width", "before", "seq", "(n - discount) / total as own", "discount * kinds / total as passed"))
    below, found = None, []
    for width in range(1, ORDER + 1):
        own = weighed.where(F.col("width") == width)
        if below is None:
            lower = own.withColumn("lower", F.lit(unseen))
        else:
            lower = own.withColumn("rest", F.expr("substring(seq, 2)")).join(
                below.selectExpr("lang", "seq as rest", "value as lower"), ["lang", "rest"])
        below = lower.selectExpr("lang", "width", "0 as context", "seq", "own + passed * lower as value")
        if width < ORDER:
            below = materialise(below)
        found.append(below)
    contexts = weighed.groupBy("lang", "width", "before").agg(F.first("passed").alias("value")).selectExpr(
        "lang", "width", "1 as context", "before as seq", "value")
    return reduce(DataFrame.unionByName, [*found, contexts]), languages, unseen


def learn(docs: DataFrame, part_rows: int = PART_ROWS) -> Model:
    """The sequences of all rows of ``docs`` (text, lang) that have a text and a language; no limits yet."""
    rows, languages, unseen = _smoothed(materialise(count_sequences(docs.where("text is not null and lang is not null"))))
    if not languages:
        return Model([], unseen, None, 1)
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    rows = materialise(rows.withColumn("lang", number.cast("int")))
    parts = max(1, -(-rows.where("width > 2").count() // part_rows))
    # The two letters before the last one of a sequence are the last two of a context.
    end = "(width - 1 - {})"
    pair = _PART.format(f"substring(seq, {end.format(1)}, 1)", f"substring(seq, {end.format(0)}, 1)", parts=parts)
    part = F.expr(f"if(width > 2, int({pair}), -1)")
    return Model(languages, unseen, rows.withColumn("part", part), parts)


def entropies(docs: DataFrame, model: Model) -> DataFrame:
    """(id, own, sums, letters) for each row of a table (id, text, own): negative logarithm of the probability of the text in each
    language, and its letters and word ends. ``own`` comes along."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, own string, h bigint, sums array<double>, letters bigint"
    docs = docs.select("id", "text", "own", F.xxhash64("text", "own").alias("h"))

    def one(number: int) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(model.part(number))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums, sizes = shared.value.sums([t or "" for t in batch.column(1).to_pylist()])
                ends = np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), batch.column(3), pa.ListArray.from_arrays(ends, pa.array(sums.ravel())), pa.array(sizes)],
                    ["id", "own", "h", "sums", "letters"])

        return docs.mapInArrow(run, schema)

    found = [one(number) for number in range(model.parts)]
    if model.parts == 1:
        return found[0].drop("h")
    # Rows that are the same in all of this get the same sums: they are added together and given out again.
    added = F.array(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(len(model.languages))])
    grouped = (reduce(DataFrame.unionByName, found).groupBy("id", "own", "h", "letters")
               .agg(F.expr(f"count(*) div {model.parts}").alias("copies"), added.alias("sums")))
    return grouped.select("id", "own", F.transform("sums", lambda s: s / F.col("copies")).alias("sums"), "letters",
                          F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


_CLASS = " + ".join(f"if(letters > {length}, 1, 0)" for length in LENGTHS)


def limits(scored: DataFrame, model: Model) -> np.ndarray:
    """The accepted cross-entropy by language and length: a quantile of all rows of ``scored`` whose ``own`` is a learned language."""
    place = F.array_position(F.array(*map(F.lit, model.languages)), F.col("own"))
    seen = (scored.withColumn("l", place).where("l > 0 and letters > 0")
            .selectExpr("l - 1 as l", f"{_CLASS} as k", "sums[int(l) - 1] / letters as e"))
    quantile = F.percentile_approx("e", ACCEPTED, 10_000)
    rows = (seen.groupBy("l", "k").agg(F.count("*").alias("n"), quantile.alias("e"))
            .unionByName(seen.groupBy("l").agg(F.count("*").alias("n"), quantile.alias("e")).withColumn("k", F.lit(-1))).collect())
    out = np.full((len(model.languages), len(LENGTHS) + 1), np.inf)
    for r in sorted(rows, key=lambda r: r["k"]):
        if r["k"] < 0:
            out[r["l"]] = r["e"]
        elif r["n"] >= ENOUGH:
            out[r["l"], r["k"]] = r["e"]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", part_rows: int = PART_ROWS) -> Model:
    """Learn from all rows of ``docs`` (id, text, lang) that have a text and a language, limits included."""
    rows = docs.where("text is not null and lang is not null")
    model = learn(rows, part_rows)
    if model.languages:
        model.limits = limits(entropies(rows.select(F.col(id_col).alias("id"), "text", F.col("lang").alias("own")), model), model)
    return model


def _judged(scored: DataFrame, model: Model) -> DataFrame:
    width = len(LENGTHS) + 1
    names = F.array(*map(F.lit, model.languages))
    bounds = F.array(*[F.lit(float(x)) for x in model.limits.ravel()])
    best = scored.withColumns({"least": F.array_min("sums"), "some": F.col("letters") > 0}).withColumn(
        "best", F.array_position("sums", F.col("least")).cast("int"))
    share = F.aggregate("sums", F.lit(0.0), lambda acc, s: acc + F.exp(
        (F.col("least") - s) / F.col("letters") * F.least("letters", F.lit(EVIDENCE))))
    bound = F.element_at(bounds, (F.col("best") - 1) * width + F.expr(_CLASS) + 1)
    return best.select(
        "id", F.when(F.col("some"), F.element_at(names, F.col("best"))).otherwise("und").alias("lang_pred"),
        F.when(F.col("some"), 1 / share).otherwise(0.0).alias("score"),
        F.when(F.col("some"), F.col("least") / F.col("letters") > bound).otherwise(True).alias("rejected"))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for each row of ``docs``, from its text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if no language was learned. Of languages that are equally likely the first by name is taken. Repeated rows
    and null ids each keep a row; other columns are not looked at; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if not model.languages:
        return rows.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return _judged(entropies(rows.withColumn("own", F.lit(None).cast("string")), model), model)


def identify(docs: DataFrame, learning: Column, id_col: str = "doc_id", part_rows: int = PART_ROWS) -> DataFrame:
    """The same as ``predict(docs, fit(docs.where(learning)))``, but every text is scored once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"), F.when(learning, F.col("lang")).alias("own"))
    model = learn(rows.select("text", F.col("own").alias("lang")), part_rows)
    if not model.languages:
        return predict(rows, model, "id")
    scored = materialise(entropies(rows, model))
    model.limits = limits(scored, model)
    return _judged(scored, model)
