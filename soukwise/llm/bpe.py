"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the others.

Most pre-tokens are in the vocabulary as they stand. A minimal perfect hash maps
each vocabulary entry to its own slot; comparing the bytes there tells whether a
pre-token is one. Any other pre-token starts as a linked list of bytes, and a
heap of (rank, position) yields the next pair to merge.

The tables follow from the rank file, so their size is that of the vocabulary.
They are built once on the driver and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.memory import Remembered

#: Vocabulary entries per bucket of the perfect hash, on average.
LOAD = 4
SPREAD = 0x9E3779B97F4A7C15
#: Pre-tokens that a worker remembers, in each of two generations.
REMEMBERED = 1 << 18
#: Matches of the pattern that are held at a time for a long text.
LONG, HELD = 1 << 20, 1 << 16


@dataclass
class PerfectHash:
    """Slots 0 to n - 1, one for each of n distinct byte strings."""

    shift: list[int]
    size: int

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        """Displaces bucket by bucket, the largest first; single keys take the slots that are left."""
        size, n_buckets = len(keys), max(1, len(keys) // LOAD)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        buckets: list[list[int]] = [[] for _ in range(n_buckets)]
        for h in hashes:
            buckets[(h >> 32) % n_buckets].append(h)
        if len(set(hashes)) < size:
            raise ValueError("two keys share a 64-bit hash")
        taken, shift = np.zeros(size, bool), [0] * n_buckets
        tries = np.arange(256, dtype=np.uint64)
        order = sorted(range(n_buckets), key=lambda b: -len(buckets[b]))
        for b in order:
            members = np.array(buckets[b], np.uint64)
            if len(members) < 2:
                break
            base = 0
            while True:
                moved = members[:, None] + (tries + np.uint64(base)) * (members[:, None] >> np.uint64(7) | np.uint64(1))
                slots = (moved * np.uint64(SPREAD) >> np.uint64(20)) % np.uint64(size)
                fits = ~taken[slots].any(axis=0)
                for at in np.flatnonzero(fits):
                    if len(set(slots[:, at].tolist())) == len(members):
                        break
                else:
                    base += len(tries)
                    continue
                taken[slots[:, at]] = True
                shift[b] = base + int(at)
                break
        free = iter(np.flatnonzero(~taken).tolist())
        for b in order:
            if len(buckets[b]) == 1:
                shift[b] = -1 - next(free)
        return cls(shift, size)

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[(h >> 32) % len(self.shift)]
        if d < 0:
            return -1 - d
        mixed = (h + d * (h >> 7 | 1)) & 0xFFFFFFFFFFFFFFFF
        return ((mixed * SPREAD & 0xFFFFFFFFFFFFFFFF) >> 20) % self.size


class Vocabulary:
    """Ranks of byte strings, as a perfect hash and as a table of mergeable pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern, self._encoder = pattern, None
        self.perfect = PerfectHash.build(list(ranks))
        self.keys, self.ids = [b""] * len(ranks), [0] * len(ranks)
        self.text = {rank: key for key, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for key, rank in ranks.items():
            at = self.perfect.slot(key)
            self.keys[at], self.ids[at] = key, rank
            for cut in range(1, len(key)):
                left, right = ranks.get(key[:cut]), ranks.get(key[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(k): int(v) for k, v in map(bytes.split, filter(bytes.strip, lines))}, pattern)

    def encoder(self) -> Encoder:
        """The one encoder of this process; a worker's next task finds it as the last one left it."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def whole(self, piece: bytes) -> int | None:
        """The id of a pre-token that is a vocabulary entry."""
        at = self.perfect.slot(piece)
        return self.ids[at] if self.keys[at] == piece else None

    def merged(self, piece: bytes) -> list[int]:
        """The ids of any other pre-token: the pair of lowest rank merges first, of equal ones the leftmost."""
        ids, n, rank_of = [self.single[b] for b in piece], len(piece), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The rank of the pair that starts at each place, to tell outdated heap entries.
        current = [rank_of(a << 32 | b, -1) for a, b in zip(ids, ids[1:])] + [-1]
        heap = [rank << 32 | i for i, rank in enumerate(current) if rank >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if current[i] != rank:
                continue
            j = after[i]
            k = after[j]
            ids[i], ids[j], after[i], current[j] = rank, -1, k, -1
            if k < n:
                before[k] = i
                current[i] = formed = rank_of(rank << 32 | ids[k], -1)
                if formed >= 0:
                    heappush(heap, formed << 32 | i)
            else:
                current[i] = -1
            h = before[i]
            if h >= 0:
                current[h] = formed = rank_of(ids[h] << 32 | rank, -1)
                if formed >= 0:
                    heappush(heap, formed << 32 | h)
        return [x for x in ids if x >= 0]


class Encoder:
    """Encodes texts with one vocabulary and remembers the pre-tokens it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.split = vocabulary, regex.compile(vocabulary.pattern)
        self.packed = Remembered(self._packed, REMEMBERED)

    def _packed(self, piece: str) -> bytes:
        """The ids of one pre-token as little-endian 32-bit integers."""
        raw = piece.encode()
        one = self.vocabulary.whole(raw)
        ids = self.vocabulary.merged(raw) if one is None else [one]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> Iterator[bytes]:
        """The packed ids of a text, a part at a time."""
        known = self.packed.__getitem__
        if len(text) <= LONG:
            yield b"".join(map(known, self.split.findall(text)))
            return
        pieces = (m.group() for m in self.split.finditer(text))
        while held := list(islice(pieces, HELD)):
            yield b"".join(map(known, held))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _mapped(docs: DataFrame, id_col: str, text_col: str, vocabulary: Vocabulary, schema: str,
            row: Callable[[Encoder, str], tuple], types: list[pa.DataType]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder()
        for batch in batches:
            rows = [row(encoder, t or "") for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, types)]], ["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, {schema}"))


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for each row of ``docs``: ids is the array of token ids, empty for an empty or null text."""
    def row(encoder: Encoder, text: str) -> tuple:
        return (np.frombuffer(b"".join(encoder.encode(text)), "<u4").astype(np.int32),)
    return _mapped(docs, id_col, text_col, vocabulary, "ids array<int>", row, [pa.list_(pa.int32())])


def decode(tokens: DataFrame, vocabulary: Vocabulary, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) for each row of token ids; a null array counts as empty."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = shared.value.text
        for batch in batches:
            raw = [b"".join(map(text.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "bytes"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), ids_col).mapInArrow(run, f"id {kind}, bytes binary")


def digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``, without keeping the ids.

    Every text is encoded and its ids are decoded. A null text counts as empty:
    no tokens, and the digests of no bytes. Rows with equal or null ids each give
    a row; no other column is looked at; an empty table gives an empty one.
    """
    def row(encoder: Encoder, text: str) -> tuple:
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for part in encoder.encode(text):
            n += len(part) // 4
            ids.update(part)
            decoded.update(encoder.decode(part))
        return n, ids.hexdigest(), decoded.hexdigest()
    return _mapped(docs, id_col, text_col, vocabulary, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", row,
                   [pa.int64(), pa.string(), pa.string()])
