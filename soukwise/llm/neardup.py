"""One document of each group of near copies: SimHash candidates, first shingles, exact shingle similarity.

Texts are near copies if the Jaccard coefficient of their sets of five-word
shingles is 0.8 or more. Texts with equal shingle sets are one node, and links are found in three steps, each verified on the shingles:

1. Every text gets eight fingerprints. The segment counts of two of them in four grids of eight axes are cells, and the
   members of a cell within ``NEAR`` bits link to its most frequent node. This joins most groups by few links.
2. Fingerprints of sets that are 0.8 alike differ in about 9 bits, so grids alone would lose some. Therefore each text is
   also in a cell for each of its first shingles, rarest first, as many as any two sets that are 0.8 alike must share one
   of, whatever their length. Members link to the one of a cell that has the shingle earliest: that is the original of texts which each
   differ from it in their own way, as these have new, rare shingles in front.
3. In cells that still hold several components, the members outside of the most frequent one are paired with the rest.

"Rarest" goes by counts of all shingles of all texts in a table of fixed size. Any order gives the same groups, this one
keeps passages that many texts share out of the cells. Places and lengths bound how many shingles a pair can share. All eight
fingerprints of a pair may differ in ``NEAR_ALL`` of 512 bits: pairs that are 0.8 alike differ in about 80 to 100,
with a deviation of 9, so none is lost by it. Texts stay where they are, but for those that a link has to be verified on, or that may have to go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.graph import components
from soukwise.llm.simhash import CHUNK, SEED, shingle_digests
from soukwise.session import materialise

WIDTH, LEAST = 5, 0.8
PRINTS = 8
#: The axes of each grid, out of the 32 segments of two bits.
GRIDS = [range(8 * g, 8 * g + 8) for g in range(4)]
#: Fingerprints and grids of each whose cells link to their most frequent node.
HUBS = 2, 4
#: Bits of the map that tells which texts may be meant, before any is moved; one megabyte.
BITS = 1 << 23
#: Differing bits that are allowed in the fingerprint that shares a cell, and in all fingerprints together.
NEAR, NEAR_ALL = 12, 160
#: Counters of shingles by hash, a power of two, and counters in a row that is sent.
COUNTERS, BLOCK = 1 << 17, 1 << 10
_ODD = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(np.frombuffer(b"".join(shingle_digests(text, WIDTH)), ">u8").astype(np.uint64))


def prints(shingles: np.ndarray) -> list[int]:
    """The fingerprints of a shingle set, as signed integers; zeros for the empty set."""
    out = []
    for k in range(PRINTS):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(shingles), CHUNK):
            hashes = _mixed(shingles[at:at + CHUNK] + np.uint64(k * _ODD & (1 << 64) - 1))
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(counts * 2 > len(shingles)).view("<i8")[0]))
    return out


def _counters(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """How often the shingles of a table (id, text) occur, by ``COUNTERS`` hash values; a megabyte, whatever the input."""
    def blocks(counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(range(COUNTERS // BLOCK), pa.int32()),
                                           pa.array([c.tobytes() for c in counts.reshape(-1, BLOCK)], pa.binary())], ["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(counts, _counters(shingle_set(text)), 1)
        if counts.any():
            yield blocks(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(part, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["block", "counts"])

    kind = "block int, counts binary"
    total = np.zeros(COUNTERS, np.int64)
    for block, part in docs.select("text").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).collect():
        total[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(part, np.int64)
    return total


def prefix(shingles: np.ndarray, counts: np.ndarray) -> list[int]:
    """The first shingles of a set, rarest first; any set that is similar enough has one of them among its own first ones."""
    first = len(shingles) - int(np.ceil(LEAST * len(shingles) - 1e-9)) + 1
    order = np.lexsort((shingles, counts[_counters(shingles)]))
    return shingles[order[:first]].view(np.int64).tolist()


def described(docs: DataFrame) -> DataFrame:
    """(id, h, node, n, fps, firsts) of a table (id, text): hash of the text, of its shingle set, the set's size,
    fingerprints and first shingles."""
    counts = shingle_counts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, node, n, fps, firsts = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                h.append(xxhash.xxh64_intdigest(text.encode(), SEED))
                shingles = shingle_set(text)
                node.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED))
                n.append(len(shingles))
                fps.append(prints(shingles))
                firsts.append(prefix(shingles, counts))
            signed = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (h, node)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *signed, pa.array(n, pa.int64()), pa.array(fps, pa.list_(pa.int64())),
                 pa.array(firsts, pa.list_(pa.int64()))], ["id", "h", "node", "n", "fps", "firsts"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, h bigint, node bigint, n bigint, fps array<bigint>, firsts array<bigint>")


def _mask(axes: range) -> int:
    """The bits of some segments, as a signed integer."""
    bits = sum(3 << (2 * i) for i in axes)
    return bits - (1 << 64) if bits >> 63 else bits


def _cells(nodes: DataFrame, prints_used: int, grids: int) -> DataFrame:
    """(cell, node, n, fp, copies): a row for each of the first fingerprints and grids."""
    points = nodes.select("node", "n", "copies", F.posexplode(F.slice("fps", 1, prints_used)).alias("k", "fp"))
    even, odd = "(fp & 6148914691236517205L)", "(shiftrightunsigned(fp, 1) & 6148914691236517205L)"
    points = points.withColumn("point", F.expr(f"shiftleft({even} & {odd}, 1) | ({even} ^ {odd})"))
    cells = ", ".join(f"xxhash64(k, {g}, point & {_mask(axes)}L)" for g, axes in enumerate(GRIDS[:grids]))
    return points.selectExpr(f"explode(array({cells})) as cell", "node", "n", "fp", "copies")


_ALIKE = f"bit_count(fp ^ fp2) <= {NEAR} and least(n, n2) >= {LEAST} * greatest(n, n2)"
#: At the first shingle that two sets have in common, what is left of both must do.
_ENOUGH = f"{1 + LEAST} * least(n - place, n2 - place2) >= {LEAST} * (n + n2)"


def _marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``_may``: false where ``keys`` has no row with the hash ``h``. True does not say that it has one.

    A bit map of fixed size, so it can be broadcast, and so most rows need not be moved to be compared.
    """
    def slot(df: DataFrame) -> DataFrame:
        return df.withColumn("_slot", F.pmod("h", F.lit(BITS))).selectExpr(
            "*", "bitmap_bucket_number(_slot) as _bucket", "bitmap_bit_position(_slot) as _position")

    maps = slot(keys.select("h")).groupBy("_bucket").agg(F.expr("bitmap_construct_agg(_position)").alias("_bits"))
    byte = "int(conv(hex(substring(_bits, int(_position div 8) + 1, 1)), 16, 10))"
    found = slot(rows).join(F.broadcast(maps), "_bucket", "left")
    return found.withColumn("_may", F.expr(f"_bits is not null and (shiftright({byte}, int(_position % 8)) & 1) = 1")).drop(
        "_slot", "_bucket", "_position", "_bits")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose shingle sets are similar enough."""
    total = " + ".join(f"bit_count(a_fps[{k}] ^ b_fps[{k}])" for k in range(PRINTS))
    near = (pairs.distinct()
            .join(nodes.selectExpr("node as a", "fps as a_fps"), "a").join(nodes.selectExpr("node as b", "fps as b_fps"), "b")
            .where(f"{total} <= {NEAR_ALL}").select("a", "b"))
    near = materialise(near)
    wanted = materialise(near.selectExpr("explode(array(a, b)) as node").distinct().join(nodes, "node").select(
        "node", F.col("rep.id").alias("id"), F.col("rep.h").alias("h")))
    texts = (_marked(docs.withColumn("h", F.xxhash64("text")), wanted).where("_may").alias("d")
             .join(wanted.alias("w"), F.expr("d.id <=> w.id and d.h = w.h")).select("w.node", "d.text").dropDuplicates(["node"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    sets = materialise(texts.mapInArrow(run, "node bigint, shingles array<bigint>"))
    shared = "size(array_intersect(x, y))"
    return (near.join(sets.selectExpr("node as a", "shingles as x"), "a").join(sets.selectExpr("node as b", "shingles as y"), "b")
            .where(f"{shared} >= {LEAST} * (size(x) + size(y) - {shared})").select("a", "b"))


def _joined(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of ``nodes`` (node, label) after links (a, b) of nodes have joined their components."""
    a, b = nodes.toDF("a", "a_label"), nodes.toDF("b", "b_label")
    between = links.join(a, "a").join(b, "b").selectExpr("a_label as a", "b_label as b")
    roots = components(between).toDF("label", "root")
    return materialise(nodes.join(roots, "label", "left").selectExpr("node", "coalesce(root, label) as label"))


def _across(cells: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``cells`` (cell, node, n, place, label) that share a cell and not a label.

    A component that holds most of a cell is not paired with itself, so a large one costs what the others add.
    """
    counted = cells.groupBy("cell", "label").agg(F.count("*").alias("m"))
    mixed = (counted.groupBy("cell").agg(F.max(F.struct("m", "label")).alias("most"), F.count("*").alias("labels"))
             .where("labels > 1").select("cell", F.col("most.label").alias("main")))
    within = materialise(cells.join(mixed, "cell"))
    other = within.select("cell", *[F.col(c).alias(c + "2") for c in ("node", "n", "place", "label")])
    return (within.where("label <> main").join(other, "cell")
            .where(f"label <> label2 and (label2 = main or node < node2) and {_ENOUGH}").selectExpr("node as a", "node2 as b"))


def groups(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, label, rep) of the nodes of ``rows``, as ``described`` gives them; equal labels are near copies of each other.

    ``rep`` is the row (id, h) of a node with the smallest id; a null id comes last.
    """
    nodes = materialise(rows.groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h")).alias("rep"), F.first("n").alias("n"),
        F.first("fps").alias("fps"), F.first("firsts").alias("firsts"), F.count("*").alias("copies")))
    full = nodes.where("n > 0")
    cells = _cells(full, *HUBS)
    hubs = (cells.groupBy("cell").agg(F.max(F.struct("copies", "node", "n", "fp")).alias("top"), F.count("*").alias("m"))
            .where("m > 1").selectExpr("cell", "top.node as node2", "top.n as n2", "top.fp as fp2"))
    to_hub = cells.join(hubs, "cell").where(f"node <> node2 and {_ALIKE}").selectExpr("node as a", "node2 as b")
    labels = _joined(nodes.select("node", F.col("node").alias("label")), _verified(to_hub, nodes, docs))

    cells = full.select("node", F.col("n").cast("int").alias("n"), F.posexplode("firsts").alias("place", "cell"))
    earliest = (cells.groupBy("cell").agg(F.min(F.struct("place", "node", "n")).alias("top"), F.count("*").alias("m"))
                .where("m > 1").selectExpr("cell", "top.node as node2", "top.n as n2", "top.place as place2"))
    shared = materialise(cells.join(materialise(earliest), "cell"))
    by_node, by_node2 = labels, labels.toDF("node2", "label2")
    to_earliest = (shared.where(f"node <> node2 and {_ENOUGH}").select("node", "node2").distinct()
                   .join(by_node, "node").join(by_node2, "node2").where("label <> label2").selectExpr("node as a", "node2 as b"))
    labels = _joined(labels, _verified(to_earliest, nodes, docs))

    rest = shared.select("cell", "node", "n", "place").join(labels, "node")
    labels = _joined(labels, _verified(_across(materialise(rest)), nodes, docs))
    return nodes.select("node", "rep").join(labels, "node").select("node", "label", "rep")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest id stays, of repeated rows one.

    A null text counts as empty; all texts without a word are copies of each other. Null ids come last. Other
    columns, whatever their names, come along; an empty table gives an empty one.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, text_at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    texts = inner.select(F.col(at).alias("id"), F.coalesce(F.col(text_at).cast("string"), F.lit("")).alias("text"))
    rows = materialise(described(texts))
    kept = materialise(groups(rows, texts).groupBy("label").agg(F.min("rep").alias("rep"))
                       .select(F.col("rep.id").alias("kept_id"), F.col("rep.h").alias("kept_h")))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h"))
    # A row of any group that has another row may have to go; all others stay where they are.
    doubtful = rows.groupBy("id", "h").agg(F.count("*").alias("times")).join(kept, same, "left").where(
        "kept_h is null or times > 1")
    keyed = _marked(inner.withColumn("h", F.xxhash64(F.coalesce(F.col(text_at).cast("string"), F.lit("")))), doubtful)
    apart = (keyed.where("_may").join(kept, F.col(at).eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")), "left_semi")
             .dropDuplicates([at, "h"]))
    return keyed.where("not _may").unionByName(apart).drop("h", "_may").toDF(*names)
