"""Two tokenizers aligned by a merge of the places where their tokens end.

The ends of the tokens of A and of B, as byte offsets, are two sorted lists. Merging
them takes as many steps as there are tokens; each new end closes one overlap of an A token
with a B token, and an end of both closes a group. The merge is divided along its diagonals: a binary
search finds where the path crosses each of them, so every piece has the same number of steps however the
tokens are spread, and all pieces of all texts at hand go forward together, as lanes of numpy arrays. A piece
emits its overlaps; the groups that pieces' borders cut are stitched by a running number of the common ends.

How often an id pair occurs is counted over all documents. Documents are cut into
chunks of bounded size; a chunk lists its distinct pairs once, and its documents refer to that list. So what travels to be
counted, and what comes back, is each chunk's list, not each document's links.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.session import materialise

#: Steps of a piece of the merge, pieces that go forward together, and characters of text that make a chunk.
STEPS, TOGETHER, CHUNK = 64, 1 << 14, 1 << 23
#: Texts that are encoded together, in characters.
ENCODED = 1 << 20
SPACE = "\N{LOWER ONE EIGHTH BLOCK}"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Tokenizers:
    """Both tokenizers and the bytes of their entries. The files are named, and read where they are used."""

    byte_path: str
    piece_path: str
    pattern: str

    def load(self) -> Loaded:
        """The tokenizers of this process; a worker's next task finds them as the last one left them."""
        key = (self.byte_path, self.piece_path, self.pattern)
        if key not in _LOADED:
            _LOADED[key] = Loaded(*key)
        return _LOADED[key]


_LOADED: dict[tuple, Loaded] = {}


class Loaded:
    def __init__(self, byte_path: str, piece_path: str, pattern: str) -> None:
        import sentencepiece
        import tiktoken
        with open(byte_path, encoding="utf-8") as file:
            described = json.load(file)
        bytes_of, entries = byte_of_character(), described["model"]["vocab"]
        special = {t["content"] for t in described["added_tokens"]}
        self.a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            if entry not in special:
                self.a[number] = bytes(bytes_of[c] for c in entry)
        # Ids of the entries are in the order of the merges, so they serve as ranks.
        self.byte_level = tiktoken.Encoding("byte level", pat_str=pattern, special_tokens={},
                                            mergeable_ranks={b: i for i, b in enumerate(self.a) if b})
        self.pieces = lib = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.b = [bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace(SPACE, " ").encode()
                  for i in range(lib.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, side)), np.int64) for side in (self.a, self.b))
        # Of each id the text within a group and at its end.
        self.a_text = [text for i in range(len(self.a)) for text in (f"{i},", f"{i}|")]
        self.b_text = [text for i in range(len(self.b)) for text in (f"{i},", f"{i};")]
        self.texts = self.a_text + self.b_text

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B of each text; none where either does not give the bytes of the text with a space in front."""
        encode, a, b = self.byte_level.encode_ordinary, self.a, self.b
        none, out = np.zeros(0, np.int64), []
        for text, right in zip(texts, self.pieces.encode(texts, num_threads=1)):
            whole = " " + text
            raw = whole.encode()
            if not text or b"".join(map(b.__getitem__, right)) != raw:
                out.append((none, none))
                continue
            left = encode(whole)
            if b"".join(map(a.__getitem__, left)) != raw:
                left, right = [], []
            out.append((np.array(left, np.int64), np.array(right, np.int64)))
        return out


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d of the merge, for each diagonal d; of equal values that of ``a`` comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # a[middle] is among the first d if it is not above b[d - middle - 1].
        at = np.where(open_, middle, 0)
        other = np.where(open_, diagonals - middle - 1, 0)
        within = a[at] <= b[other]
        low = np.where(open_ & within, middle + 1, low)
        high = np.where(open_ & ~within, middle, high)
    return low


def merged(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps (place in ``a``, place in ``b``) in order, and whether each is the last of a group.

    ``a`` and ``b`` are ascending ends, both with the same last one.
    """
    total = len(a) + len(b)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    lanes = -(-total // steps)
    starts = np.arange(lanes, dtype=np.int64) * steps
    i = crossings(a, b, starts)
    j = starts - i
    far = np.int64(max(a[-1], b[-1]) + 1)
    a_ends, b_ends = (np.append(ends, np.full(steps + 1, far)) for ends in (a, b))
    parts = [_pieces(a_ends, b_ends, i[at:at + TOGETHER], j[at:at + TOGETHER], steps, total - at * steps)
             for at in range(0, lanes, TOGETHER)]
    at_a, at_b, last = zip(*parts)
    return np.concatenate(at_a), np.concatenate(at_b), np.concatenate(last)


def _pieces(a_ends: np.ndarray, b_ends: np.ndarray, i: np.ndarray, j: np.ndarray, steps: int,
            left_over: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What pieces that begin at the places ``i`` and ``j`` emit, piece by piece; ``left_over`` steps are left to be done."""
    shape = steps, len(i)
    at_a, at_b = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    closes, both = np.zeros(shape, bool), np.zeros(shape, bool)
    for step in range(steps):
        left, right = a_ends[i], b_ends[j]
        takes_a = left <= right
        at_a[step], at_b[step] = i, j
        # An end that A has had already closes no overlap of its own.
        closes[step] = takes_a | (i == 0) | (a_ends[i - 1] != right)
        both[step] = left == right
        i, j = i + takes_a, j + ~takes_a
    # The last piece is as long as the others; what lies behind the end is cut off.
    flat = [x.T.ravel()[:left_over] for x in (at_a, at_b, both, closes)]
    return flat[0][flat[3]], flat[1][flat[3]], flat[2][flat[3]]


@dataclass
class Aligned:
    """Documents merged together: their overlaps with A and B ids, where each document's begin, and the groups."""

    a: np.ndarray
    b: np.ndarray
    links: np.ndarray
    groups: np.ndarray
    texts: list[str]


def aligned(ids: list[tuple[np.ndarray, np.ndarray]], loaded: Loaded) -> Aligned:
    """Overlaps of many documents in one merge; their byte ranges are put one after the other."""
    a, b = (np.concatenate([pair[side] for pair in ids]) if ids else np.zeros(0, np.int64) for side in (0, 1))
    n_a, n_b = (np.array([len(pair[side]) for pair in ids], np.int64) for side in (0, 1))
    place_a, place_b, last = merged(np.cumsum(loaded.a_sizes[a]), np.cumsum(loaded.b_sizes[b]))
    # Each A token belongs to the document that its place falls into.
    document = np.repeat(np.arange(len(ids)), n_a)[place_a]
    links = np.bincount(document, minlength=len(ids))
    groups = np.bincount(document[last], minlength=len(ids))
    # The running number of common ends is a token's group, across the borders of pieces.
    number = np.cumsum(last) - last
    group_a, group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    group_a[place_a], group_b[place_b] = number, number
    last_a = np.diff(group_a, append=-1) != 0
    last_b = np.diff(group_b, append=-1) != 0
    n_groups = int(last.sum())
    a_before, b_before = np.cumsum(np.bincount(group_a, minlength=n_groups)), np.cumsum(np.bincount(group_b, minlength=n_groups))
    order = np.zeros(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (b_before[group_a - 1] * (group_a > 0) if n_groups else 0)] = 2 * a + last_a
    order[np.arange(len(b)) + (a_before[group_b] if n_groups else 0)] = 2 * (b + len(loaded.a)) + last_b
    stops = np.cumsum(n_a + n_b).tolist()
    text, start, texts = loaded.texts, 0, []
    for stop in stops:
        texts.append("".join(map(text.__getitem__, order[start:stop].tolist()))[:-1])
        start = stop
    return Aligned(a[place_a], b[place_b], links, groups, texts)


def _chunks(docs: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (id, text) in lists of ``CHUNK`` characters or little more than that."""
    held, size = [], 0
    for row in docs:
        held.append(row)
        size += len(row[1])
        if size >= CHUNK or len(held) >= CHUNK >> 6:
            yield held
            held, size = [], 0
    if held:
        yield held


def _parts(texts: list[str], limit: int) -> Iterator[slice]:
    """Slices of ``texts`` of about ``limit`` characters."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield slice(start, at + 1)
            start, size = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _described(rows: list[tuple], loaded: Loaded) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """For each document its numbers, the digest of its groups, and its pairs as places in the chunk's list with how often
    it has each; the chunk's list of pairs, and how many of its documents hold each."""
    numbers, own = [], []
    texts = [text for _, text in rows]
    for part in _parts(texts, ENCODED):
        ids = loaded.encode(texts[part])
        found = aligned(ids, loaded)
        start = 0
        for (left, right), links, groups, text in zip(ids, found.links.tolist(), found.groups.tolist(), found.texts):
            keys = found.a[start:start + links] << 32 | found.b[start:start + links]
            start += links
            own.append(np.unique(keys, return_counts=True))
            digest = hashlib.sha256(text.encode()).hexdigest() if links else ""
            numbers.append((len(left), len(right), groups, links, digest))
    every = np.concatenate([keys for keys, _ in own])
    pairs, holders = np.unique(every, return_counts=True)
    out = [(id_, *n, np.searchsorted(pairs, keys).astype(np.int32), times.astype(np.int32))
           for (id_, _), n, (keys, times) in zip(rows, numbers, own)]
    return out, pairs, holders


FIELDS = ["chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs", "holders"]


def _first_pass(docs: DataFrame, tokenizers: Tokenizers, id_col: str, text_col: str) -> DataFrame:
    """A row for each document, and for each chunk one with its pairs and how many of its documents hold them."""
    kind = docs.schema[id_col].dataType
    kinds = [pa.int64(), None, *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()),
             pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["OMP_NUM_THREADS"] = "1"
        loaded, first = tokenizers.load(), TaskContext.get().partitionId() << 32
        id_kind = None

        def rows() -> Iterator[tuple]:
            nonlocal id_kind
            for batch in batches:
                id_kind = batch.schema.field(0).type
                yield from zip(batch.column(0).to_pylist(), ["" if t is None else t for t in batch.column(1).to_pylist()])

        for number, chunk in enumerate(_chunks(rows())):
            found, pairs, holders = _described(chunk, loaded)
            out = [(first + number, *row, None, None) for row in found]
            out.append((first + number, *[None] * 8, pairs, holders))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, id_kind if k is None else k) for c, k in zip(columns, kinds)], FIELDS)

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"chunk bigint, id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                             "groups_sha256 string, places array<int>, times array<int>, pairs array<bigint>, holders array<bigint>"))


def pair_counts(first: DataFrame) -> DataFrame:
    """(pair, documents, best): how many documents hold each id pair linked, and whether none of its A id's is held by more."""
    listed = first.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("documents"))
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("documents").alias("top"))
    return (counts.withColumn("a", a).join(top, "a")
            .select("pair", "documents", (F.col("documents") == F.col("top")).alias("best")))


def alignments(docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``docs``.

    Texts that are null or empty, or that one of the tokenizers does not give back byte for byte, have no
    tokens: zeros and an empty digest. Repeated rows and those without an id each are a document. Other
    columns are not looked at; an empty table gives an empty one.
    """
    first = materialise(_first_pass(docs, tokenizers, id_col, text_col))
    counts = materialise(pair_counts(first))
    listed = first.where("pairs is not null").select("chunk", F.posexplode("pairs").alias("place", "pair"))
    # At most the pairs of one chunk are gathered, and a chunk has a bound.
    known = listed.join(counts, "pair").select(F.col("chunk").alias("of"), "place", "documents", "best")
    rows = first.where("pairs is null").drop("pairs", "holders")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("place").to_numpy())
        documents = right.column("documents").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        sums = []
        for places, times in zip(left.column("places"), left.column("times")):
            at, n = places.values.to_numpy(), times.values.to_numpy().astype(np.int64)
            sums.append((int(best[at] @ n), int(documents[at] @ n)) if len(at) else (0, 0))
        n_best, count_sum = zip(*sums) if sums else ((), ())
        kept = left.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return kept.append_column("groups_sha256", left.column("groups_sha256"))

    kind = docs.schema[id_col].dataType.simpleString()
    return (rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(
        run, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"))
