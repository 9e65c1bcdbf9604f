"""Benchmark decontamination: SimHash of item-sized windows, block tables, exact shingle similarity.

A document's windows of as many words as an item are compared with the items of
that length; a document that is shorter than an item is one window as a whole. Their SimHash fingerprints meet in eight tables of eight-bit blocks:
fingerprints within 23 bits have a block within 2 bits, so the tables hold all of them. At
a similarity of 0.8 about 10 of 64 bits differ. The similarity itself is the sum of the
smaller over the sum of the larger counts of the five-word shingles, counted exactly.

Only windows in which enough shingles occur in some item can be that similar, so only these get fingerprints.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.memory import Remembered
from soukwise.llm.tables import rows_where

WORDS = re.compile(r"\w+")
WIDTH, LEAST = 5, 0.8
BLOCKS, NEAR, RADIUS = 8, 2, 23
#: Bytes of benchmark text that a broadcast index holds; a larger benchmark takes a pass for each such part.
INDEX_BYTES = 16 << 20
#: Windows that are looked at together.
HELD = 4096
#: Tokens that a worker remembers, in each of two generations.
REMEMBERED = 1 << 18
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)
_NEAR_BYTES = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= NEAR


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(ids: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """A number for every run of as many word numbers as there are ``tables``, 0 if one of the words is unknown (0)."""
    width = len(tables)
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    out = np.zeros(max(0, len(ids) - width + 1), np.uint64)
    at = np.flatnonzero(unknown[width:] == unknown[:len(out)])
    if len(at):
        total = tables[0][ids[at]]
        for k in range(1, width):
            total += tables[k][ids[at + k]]
        out[at] = _mixed(total) | np.uint64(1)
    return out


def _bits(shingles: np.ndarray) -> np.ndarray:
    return np.unpackbits(_mixed(shingles).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def similarity(a: Counter, b: Counter) -> float:
    """The sum of the smaller counts over that of the larger ones."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Group:
    """The items of one length in words."""

    def __init__(self, size: int, items: list[tuple[object, np.ndarray]]) -> None:
        self.size, self.width = size, min(WIDTH, size)
        self.count = size - self.width + 1
        self.ids = [i for i, _ in items]
        self.shingles = [Counter(s.tolist()) for _, s in items]
        prints = [np.packbits(_bits(s).sum(axis=0, dtype=np.int64) * 2 > len(s)) for _, s in items]
        self.prints = np.stack(prints)
        # For each block and each value of it, the items whose block is near.
        self.tables = [_NEAR_BYTES[:, self.prints[:, b]] for b in range(BLOCKS)]

    def whole(self, shingles: np.ndarray, known: int) -> Iterator[tuple[object, float]]:
        """(item, similarity) for a text that is shorter than the items: all of it is the one window.

        ``known`` of its shingles occur in some item, so no more are shared.
        """
        if known < LEAST * (self.count + len(shingles) - known) - 1e-9:
            return
        own = Counter(shingles.tolist())
        for item, theirs in zip(self.ids, self.shingles):
            alike = similarity(own, theirs)
            if alike >= LEAST:
                yield item, alike

    def matches(self, shingles: np.ndarray, starts: np.ndarray) -> Iterator[tuple[object, int, float]]:
        """(item, start, similarity) of the windows at ``starts``, rising, that are similar to an item."""
        for at in range(0, len(starts), HELD):
            part = starts[at:at + HELD]
            low = int(part[0])
            held = shingles[low:int(part[-1]) + self.count]
            # Shingles with an unknown word differ from each other, so each gets bits of its own.
            held = np.where(held == 0, np.arange(low, low + len(held), dtype=np.uint64) << np.uint64(1), held)
            sums = np.zeros((len(held) + 1, 64), np.int32)
            np.cumsum(_bits(held), axis=0, out=sums[1:])
            counts = sums[part - low + self.count] - sums[part - low]
            prints = np.packbits(counts * 2 > self.count, axis=1)
            met = np.zeros((len(part), len(self.ids)), bool)
            for b, table in enumerate(self.tables):
                met |= table[prints[:, b]]
            w, i = np.nonzero(met)
            close = np.bitwise_count(prints[w].view(np.uint64).ravel() ^ self.prints[i].view(np.uint64).ravel()) <= RADIUS
            for start, item in zip(part[w[close]].tolist(), i[close].tolist()):
                alike = similarity(Counter(shingles[start:start + self.count].tolist()), self.shingles[item])
                if alike >= LEAST:
                    yield self.ids[item], start, alike


class Index:
    """All items of a part of the benchmark."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        self.numbers: dict[str, int] = {}
        numbered = [(item, np.array([self.numbers.setdefault(w, len(self.numbers) + 1)
                                     for w in WORDS.findall(text.lower())], np.int64)) for item, text in items]
        words = np.arange(len(self.numbers) + 1, dtype=np.uint64)
        self.tables = np.stack([_mixed(words * _ODD[k] + np.uint64(k)) for k in range(WIDTH)])
        by_size: dict[int, list] = {}
        for item, ids in numbered:
            if len(ids):
                by_size.setdefault(len(ids), []).append((item, _shingles(ids, self.tables[:len(ids)])))
        self.groups = [Group(size, found) for size, found in sorted(by_size.items())]
        self.known = {width: np.unique(np.concatenate([
            s for size, found in by_size.items() if min(WIDTH, size) == width for _, s in found]))
            for width in {g.width for g in self.groups}}
        self._tokens = None

    def _token(self, token: str) -> tuple[int, ...]:
        return tuple(self.numbers.get(w, 0) for w in WORDS.findall(token))

    def word_numbers(self, text: str) -> np.ndarray:
        """The number of each word of a text, 0 for one that no item has."""
        if self._tokens is None:
            self._tokens = Remembered(self._token, REMEMBERED)
        tokens = text.lower().split()
        return np.fromiter(chain.from_iterable(map(self._tokens.__getitem__, tokens)), np.int64)

    def find(self, text: str) -> dict[object, tuple[float, int]]:
        """For each item that a window of the text is similar to, the best similarity and its first place."""
        ids = self.word_numbers(text)
        best: dict[object, tuple[float, int]] = {}
        hits = {}
        for width, known in self.known.items():
            shingles = _shingles(ids, self.tables[:width])
            some = np.flatnonzero(shingles)
            at = np.searchsorted(known, shingles[some])
            some = some[known[np.minimum(at, len(known) - 1)] == shingles[some]]
            if len(some):
                hits[width] = shingles, some
        for group in self.groups:
            if group.width not in hits:
                continue
            shingles, some = hits[group.width]
            if len(shingles) < group.count:
                for item, alike in group.whole(shingles, len(some)):
                    if alike > best.get(item, (0.0, 0))[0]:
                        best[item] = alike, 0
                continue
            # Of two sets of n shingles with similarity x, 2x / (1 + x) of n are shared.
            needed = int(np.ceil(2 * LEAST / (1 + LEAST) * group.count - 1e-9))
            if len(some) < needed:
                continue
            first = np.unique((some[:, None] - np.arange(group.count)).ravel()) if len(some) * group.count <= 1 << 20 \
                else np.arange(len(shingles))
            first = first[(first >= 0) & (first + group.count <= len(shingles))]
            inside = np.searchsorted(some, first + group.count) - np.searchsorted(some, first)
            for item, start, alike in group.matches(shingles, first[inside >= needed]):
                if alike > best.get(item, (0.0, 0))[0]:
                    best[item] = alike, start
        return best


def _pass(docs: DataFrame, items: list[tuple[object, str]], schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Index(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = [(doc, item, alike, start) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    if text for item, (alike, start) in sorted(index.find(text).items(), key=lambda x: str(x[0]))]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1]), pa.array(columns[2], pa.float64()),
                 pa.array(columns[3], pa.int64())] if rows else
                [pa.array([], batch.schema.field(0).type), pa.array([], item_type), pa.array([], pa.float64()),
                 pa.array([], pa.int64())], ["doc_id", "item_id", "similarity", "start"])

    item_type = pa.array([i for i, _ in items]).type
    return docs.mapInArrow(run, schema)


def _parts(items: DataFrame, item_col: str, text_col: str, index_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The items, in as many parts as are needed for each to hold about ``index_bytes`` of text."""
    items = (items.select(F.col(item_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .where("id is not null and text is not null"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // index_bytes) or 1
    for part in range(parts):
        held = items if parts == 1 else items.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
        rows = sorted((tuple(r) for r in held.collect()), key=str)
        if rows:
            yield rows


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark and no passage as similar to one, with all columns."""
    for rows in _parts(items, item_col, item_text_col, index_bytes):
        docs = _without(docs, rows, text_col)
    return docs


def _without(docs: DataFrame, items: list[tuple[object, str]], text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Index(items))
    return rows_where(docs, text_col, lambda texts: [not shared.value.find(t) for t in texts])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_id, item_id, similarity, start) of the documents that hold an item, or a passage as similar to it.

    ``start`` is the first word of the best window; a document shorter than the item is one window. An item of fewer than five words has to occur as it is; an item
    or a document without a word, or with a null text, matches nothing. Items with a null id are left out. Repeated rows
    of documents each give their rows; repeated item ids give one row per document, of the best. Other columns are not looked at; empty
    tables give an empty one. The index of the items is broadcast up to ``index_bytes`` of text; a larger
    benchmark is dealt into parts by a hash of the id, with a pass over the documents for each.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = docs.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, start bigint"
    found = None
    for rows in _parts(items, item_col, item_text_col, index_bytes):
        one = _pass(docs, rows, schema)
        found = one if found is None else found.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found
