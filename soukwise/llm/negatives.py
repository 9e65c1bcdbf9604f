"""Hard negatives by Four-Russians scoring: table lookups over packed bit planes instead of multiplications.

Components are whole numbers. A candidate keeps them as bit planes in two's
complement: for every plane and every group of eight dimensions one byte, whose
bits are those of the eight components. An anchor has a table for each group:
the sum of its components over each of the 256 subsets of the group. Then the inner product is
the sum over planes of 2 ** plane times the table entries that the plane's bytes name, where the
topmost plane counts negative. Scores are exact.

Every anchor meets every candidate, and neither side is held whole anywhere. Candidates are packed
into chunks and dealt by chunk to blocks of bounded size; a task holds one block at a time while the
chunks of anchors stream by it, each of which reaches every block once. The first round gives the best rows of an anchor's label, which
set the bands for the second. Each block returns its first few rows only, so what is merged
by anchor is a few rows a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soukwise.session import materialise

ANCHOR_EVERY, MOVED_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
SCALE = 256
#: Candidates in a chunk, anchors in a chunk, and candidates that are scored at a time.
CANDIDATES, ANCHORS, AT_ONCE = 1024, 128, 1024
#: Blocks that candidates are dealt to where there are enough chunks, and the chunks of a block at most.
BLOCKS, BLOCK_CHUNKS = 48, 256
#: How far apart the first blocks of two files are.
STRIDE = 7919
LEAST = np.iinfo(np.int64).min
PACKED = {"n": "int", "planes": "int", "groups": "int", "ids": "binary", "labels": "binary", "bits": "binary"}


def planes_of(numbers: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers: bytes [plane, group of eight dimensions, row], the sign plane last."""
    rows, width = numbers.shape
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = numbers
    top = int(np.where(padded < 0, ~padded, padded).max(initial=0))
    n_planes = top.bit_length() + 1
    bits = (padded[None] >> np.arange(n_planes)[:, None, None] & 1).astype(np.uint8)
    packed = np.packbits(bits, axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def subset_sums(numbers: np.ndarray) -> np.ndarray:
    """For rows of whole numbers the sums over the subsets of each group of eight: [group, subset, row]."""
    rows, width = numbers.shape
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = numbers
    grouped = padded.reshape(rows, -1, 8).transpose(1, 2, 0)
    tables = np.zeros((grouped.shape[0], 256, rows), np.int64)
    for bit in range(8):
        half = 1 << bit
        tables[:, half:2 * half] = tables[:, :half] + grouped[:, bit:bit + 1]
    # Narrow where no sum of lookups, shifted once, can overflow.
    reach = int(np.abs(padded.astype(np.float64)).sum(axis=1).max(initial=0))
    return tables.astype(np.int32) if reach < 1 << 30 else tables


def inner_products(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Scores [candidate, anchor]; of two widths the smaller counts, as missing dimensions are zeros."""
    n_planes, groups, rows = planes.shape
    groups = min(groups, tables.shape[0])
    total = np.zeros((rows, tables.shape[2]), np.int64)
    with np.errstate(over="ignore"):
        for plane in range(n_planes - 1, -1, -1):
            looked_up = None
            for group in range(groups):
                part = tables[group].take(planes[plane, group], axis=0)
                looked_up = part if looked_up is None else np.add(looked_up, part, out=looked_up)
            if looked_up is None:
                return total
            total <<= 1
            # The sign plane comes first and counts negative.
            total += -looked_up.astype(np.int64) if plane == n_planes - 1 else looked_up
    return total


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, q) of the rows that take part: components times 256, rounded down, as whole numbers.

    What exceeds a long is the nearest long.
    """
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("v"))
    edge = float(1 << 63)
    whole = F.transform("v", lambda x: F.when(x * SCALE >= edge, F.lit((1 << 63) - 1)).when(
        x * SCALE < -edge, F.lit(-(1 << 63))).otherwise(F.floor(x * SCALE).cast("bigint")))
    moved = F.when(F.col("id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return (plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
            .select("id", moved.alias("label"), whole.alias("q")))


def _ragged(column: pa.ListArray) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to the longest."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = column.flatten().to_numpy()
    return out


def packed_candidates(rows: DataFrame) -> DataFrame:
    """(n, planes, groups, ids, labels, bits): candidates by the chunk; a chunk does not cross an Arrow batch."""
    names = list(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, CANDIDATES):
                part = batch.slice(at, CANDIDATES)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                bits = planes_of(_ragged(part.column(2)))
                out.append((len(ids), bits.shape[0], bits.shape[1], ids.tobytes(), labels.tobytes(), bits.tobytes()))
            columns = list(zip(*out)) if out else [()] * len(names)
            kinds = [pa.int32()] * 3 + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.select("id", "label", "q").mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in PACKED.items()))


def _blocks(chunks: DataFrame) -> tuple[DataFrame, int]:
    """Adds ``block`` to packed candidates, and tells how many blocks there are: as many as chunks at most, ``BLOCKS`` at least
    where there are more chunks than that, and more once a block would hold over ``BLOCK_CHUNKS``."""
    total = chunks.count()
    n = max(1, min(total, BLOCKS), -(-total // BLOCK_CHUNKS))
    # Dealt in turn as they are stored, so blocks are even, whatever the rows hold and however often they repeat.
    within = F.monotonically_increasing_id() % (1 << 33)
    return chunks.withColumn("block", F.pmod(F.spark_partition_id() * STRIDE + within, F.lit(n)).cast("int")), n


class _Block:
    """The candidates of one block, as chunks that are scored one after the other."""

    def __init__(self) -> None:
        self.chunks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, n: int, planes: int, groups: int, ids: bytes, labels: bytes, bits: bytes) -> None:
        self.chunks.append((np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
                            np.frombuffer(bits, np.uint8).reshape(planes, groups, n)))


class _First:
    """The first ``k`` candidates of each anchor by score and id, as candidates come in chunks."""

    def __init__(self, anchors: int, k: int) -> None:
        self.k, self.limit = k, np.full(anchors, LEAST, np.int64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(anchors)]

    def see(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores [candidate, anchor]; only where ``allowed``."""
        wanted = allowed & (scores >= self.limit)
        if not wanted.any():
            return
        if len(ids) > self.k and wanted.sum() > 4 * self.k * wanted.shape[1]:
            # Many come in question: only those not below the k-th of this chunk can stay.
            kth = np.partition(np.where(wanted, scores, LEAST), len(ids) - self.k, axis=0)[len(ids) - self.k]
            wanted &= scores >= kth
        anchor, at = np.nonzero(wanted.T)
        value, name = scores[at, anchor], ids[at]
        order = np.lexsort((name, ~value, anchor))
        anchor, value, name = anchor[order], value[order], name[order]
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        for start in starts.tolist():
            a = int(anchor[start])
            stop = start
            while stop < len(anchor) and stop < start + self.k and anchor[stop] == a:
                stop += 1
            both = self.found[a] + list(zip((~value[start:stop]).tolist(), name[start:stop].tolist()))
            both.sort()
            self.found[a] = both[:self.k]
            if len(self.found[a]) == self.k:
                self.limit[a] = ~self.found[a][-1][0]


def _meet(chunks: DataFrame, anchors: DataFrame, n_blocks: int, score, schema: str) -> DataFrame:
    """``score(block, rows)`` for each block of candidates and each chunk of anchors.

    Both sides go to the block's partition, candidates first. ``anchors`` has the columns of ``_anchor_chunks``.
    """
    left = chunks.select("block", F.lit(0).alias("side"), *PACKED, F.lit(None).cast("binary").alias("anchors"))
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("side"),
                           *[F.lit(None).cast(t).alias(c) for c, t in PACKED.items()], "anchors")
    both = left.unionByName(right).repartition(n_blocks, "block").sortWithinPartitions("block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, _Block()
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != current:
                    current, block = row["block"], _Block()
                if row["side"] == 0:
                    block.add(row["n"], row["planes"], row["groups"], row["ids"], row["labels"], row["bits"])
                else:
                    yield from score(block, pa.ipc.open_stream(row["anchors"]).read_all())

    return both.mapInArrow(run, schema)


def _anchor_chunks(anchors: DataFrame) -> DataFrame:
    """(anchors): ``ANCHORS`` rows of the table at a time, as an Arrow stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for at in range(0, batch.num_rows, ANCHORS):
                sink = pa.BufferOutputStream()
                part = batch.slice(at, ANCHORS)
                with pa.ipc.new_stream(sink, part.schema) as stream:
                    stream.write_batch(part)
                parts.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["anchors"])

    return anchors.mapInArrow(run, "anchors binary")


def _list(column: pa.ChunkedArray) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _positives(block: _Block, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(anchor, id, score): the block's first rows of each anchor's label, without those of the anchor's own id."""
    keys, ids, labels = (rows.column(c).to_numpy() for c in ("anchor", "id", "label"))
    tables, first = subset_sums(_ragged(_list(rows.column("q")))), _First(len(keys), POSITIVES)
    for names, kinds, bits in block.chunks:
        for at in range(0, len(names), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            alike = (kinds[some, None] == labels) & (names[some, None] != ids)
            first.see(inner_products(bits[:, :, some], tables), alike, names[some])
    yield _returned(keys, first, None)


def _band(score: int) -> tuple[int, int]:
    """The least and the largest negative score that goes with a positive one: half of it, and 95 hundredths."""
    return -(-score // 2), 95 * score // 100


def _negatives(block: _Block, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(anchor, place, id, score): the block's first rows of other labels in the band of each positive."""
    keys, ids, labels = (rows.column(c).to_numpy() for c in ("anchor", "id", "label"))
    scores = [s or [] for s in _list(rows.column("positives")).to_pylist()]
    tables = subset_sums(_ragged(_list(rows.column("q"))))
    bands = []
    for place in range(POSITIVES):
        limits = [_band(s[place]) if place < len(s) else (1, 0) for s in scores]
        bands.append((*(np.array(side, np.int64) for side in zip(*limits)), _First(len(keys), NEGATIVES)))
    for names, kinds, bits in block.chunks:
        for at in range(0, len(names), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            found = inner_products(bits[:, :, some], tables)
            other = (kinds[some, None] != labels) & (names[some, None] != ids)
            for low, high, first in bands:
                first.see(found, other & (found >= low) & (found <= high), names[some])
    for place, (_, _, first) in enumerate(bands):
        yield _returned(keys, first, place)


def _returned(keys: np.ndarray, first: _First, place: int | None) -> pa.RecordBatch:
    found = [(int(key), name, ~less) for key, rows in zip(keys, first.found) for less, name in rows]
    columns = list(zip(*found)) if found else [(), (), ()]
    arrays = [pa.array(c, pa.int64()) for c in columns]
    if place is None:
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "id", "score"])
    return pa.RecordBatch.from_arrays([arrays[0], pa.array([place] * len(found), pa.int32()), *arrays[1:]],
                                      ["anchor", "place", "id", "score"])


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by the rules of ``vectors`` and ``_band``.

    Anchors are the rows whose id is divisible by ``ANCHOR_EVERY``. Rows without an id, a label or a vector, or with a
    component that is null or not finite, take no part. Shorter vectors count as filled up with zeros; sums
    that exceed a long wrap. Repeated rows are candidates each, equal anchors are one; rows with the anchor's
    own id are neither its positives nor its negatives. Rows with equal ids and scores come in any order.
    Other columns are not looked at; an empty table gives an empty one.
    """
    whole = vectors(rows, id_col, vector_col, label_col)
    chunks, n_blocks = _blocks(materialise(packed_candidates(whole)))
    anchors = materialise(whole.where(F.col("id") % ANCHOR_EVERY == 0).distinct().withColumn("anchor", F.xxhash64("id", "label", "q")))
    packed = _anchor_chunks(anchors.select("anchor", "id", "label", "q"))
    near = _meet(chunks, packed, n_blocks, _positives, "anchor bigint, id bigint, score bigint")
    positives = materialise(_ranked(near, ["anchor"], POSITIVES).select(
        "anchor", (F.col("rank") - 1).cast("int").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # Five numbers an anchor.
    scores = positives.groupBy("anchor").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"]).alias("positives"))
    with_bands = anchors.join(scores, "anchor").select("anchor", "id", "label", "q", "positives")
    far = _meet(chunks, _anchor_chunks(with_bands), n_blocks, _negatives, "anchor bigint, place int, id bigint, score bigint")
    negatives = _ranked(far, ["anchor", "place"], NEGATIVES)
    return (negatives.join(positives, ["anchor", "place"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .selectExpr("anchor_id", "positive_id", "rank", "id as negative_id", "positive_score", "score as negative_score"))


def oracle_sql(table: str = "embeddings") -> str:
    """The same rows in DuckDB SQL, by multiplication."""
    return f"""
with vectors as (
  select vec_id, case when vec_id % {MOVED_EVERY} = 0 then (label + 1) % {LABELS} else label end as label,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as q
  from {table}
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as alike,
    cast(list_sum(list_transform(list_zip(a.q, c.q), lambda p: p[1] * p[2])) as bigint) as score
  from vectors a join vectors c on a.vec_id <> c.vec_id where a.vec_id % {ANCHOR_EVERY} = 0),
positives as (
  select anchor_id, id as positive_id, score as positive_score,
    row_number() over (partition by anchor_id order by score desc, id) as place
  from scored where alike),
negatives as (
  select p.anchor_id, p.positive_id, s.id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.place order by s.score desc, s.id) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not s.alike
    and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
  where p.place <= {POSITIVES})
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negatives where rank <= {NEGATIVES}"""
