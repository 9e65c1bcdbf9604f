"""SimHash near-duplicates through a grid over segment bit counts.

A 64-bit fingerprint is mapped to 32 numbers, the counts of set bits in its
segments of two bits. The Manhattan distance of two such points never exceeds
the Hamming distance of the fingerprints. The 32 axes are dealt to three grids
of 11, 11 and 10 axes. Two fingerprints that differ in at most 4 bits are within
1 of each other in the first or in the second grid, or equal in the third:
otherwise they would be 2 + 2 + 1 apart. So cells and their next neighbours hold
every pair, and ``bit_count`` of the difference then decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.llm.graph import components
from soukwise.session import materialise

SEED = 42
RADIUS = 4
#: Axes of each grid and how far apart two points may be in it.
GRIDS = ((range(0, 11), 1), (range(11, 22), 1), (range(22, 32), 0))
CHUNK = 1 << 16


def shingle_digests(text: str, width: int) -> list[bytes]:
    """XXH64 of every run of ``width`` words, with repeats; of all words if there are fewer.

    Words are runs of characters other than ASCII white space, A-Z lower-cased.
    """
    words = text.encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:max(1, len(words) - width + 1)].tolist()
    digest = xxhash.xxh64_digest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[min(width, len(words)) - 1:].tolist())]


def majority_bits(digests: list[bytes]) -> bytes:
    """The eight bytes whose bits are set in over half of the digests; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(digests), CHUNK):
        part = np.frombuffer(b"".join(digests[at:at + CHUNK]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(digests)).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """One row per row of ``docs``: the id and the fingerprint as a signed integer ``fp``.

    A null text counts as empty; a text without a word has fingerprint 0.
    Columns of ``docs`` besides the two named ones are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join(majority_bits(shingle_digests(t or "", width)) for t in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.frombuffer(prints, ">i8").astype(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, fp bigint"))


def _axes(point: str, grid: range) -> str:
    """The axes of one grid out of the packed point, two bits each."""
    return f"({point} & {sum(3 << (2 * i) for i in grid) - (1 << 64 if 31 in grid else 0)}L)"


def _cells(points: DataFrame) -> DataFrame:
    """A row (g, cell, fp, label, n) for each point and grid."""
    return points.selectExpr("fp", "label", "n", "inline(array({})) as (g, cell)".format(
        ", ".join(f"struct({g} as g, {_axes('point', axes)} as cell)" for g, (axes, _) in enumerate(GRIDS))))


def _probes(points: DataFrame) -> DataFrame:
    """The cells in which to look for partners: its own and, where a grid reaches 1, one step up each axis.

    Of two neighbours the lower one steps up, so each pair of cells meets once.
    """
    probes = []
    for g, (axes, reach) in enumerate(GRIDS):
        own = _axes("point", axes)
        probes.append(f"array(struct({g} as g, {own} as cell, false as step))")
        if reach:
            steps = ", ".join(str(1 << (2 * i)) + "L" for i in axes)
            # An axis holds 0, 1 or 2; its high bit is set at 2, where no step up exists.
            probes.append(f"transform(filter(array({steps}), s -> ({own} & (s * 2)) = 0), "
                          f"s -> struct({g} as g, {own} + s as cell, true as step))")
    return points.selectExpr("fp", "label", f"inline(concat({', '.join(probes)})) as (g, cell, step)")


def _points(prints: DataFrame) -> DataFrame:
    """Adds ``point``, the 32 segment counts packed two bits each: both bits, or else one of them."""
    even, odd = "(fp & 6148914691236517205L)", "(shiftrightunsigned(fp, 1) & 6148914691236517205L)"
    return prints.withColumn("point", F.expr(f"shiftleft({even} & {odd}, 1) | ({even} ^ {odd})"))


def link_components(prints: DataFrame) -> DataFrame:
    """(fp, label) for fingerprints that have a partner, from a table (fp, n) of distinct fingerprints.

    First every cell links its members to its most frequent fingerprint. That joins dense groups with
    few links, so that the full range join afterwards only has to find links between different
    components and never lists all pairs of a group.
    """
    points = _points(prints.select("fp", "n")).withColumn("label", F.col("fp"))
    cells = _cells(points)
    hubs = (cells.groupBy("g", "cell").agg(F.max(F.struct("n", "fp")).alias("top"), F.count("*").alias("members"))
            .where("members > 1").selectExpr("g", "cell", "top.fp as hub"))
    to_hub = (cells.join(hubs, ["g", "cell"])
              .where(f"fp <> hub and bit_count(fp ^ hub) <= {RADIUS}").selectExpr("fp as a", "hub as b"))
    first = materialise(components(to_hub))

    labelled = materialise(points.drop("label").join(first.withColumnRenamed("id", "fp"), "fp", "left")
                           .withColumn("label", F.expr("coalesce(label, fp)")))
    base = _cells(labelled).selectExpr("g", "cell", "fp as fp2", "label as label2")
    across = (_probes(labelled).join(base, ["g", "cell"])
              .where(f"label <> label2 and (step or fp < fp2) and bit_count(fp ^ fp2) <= {RADIUS}")
              .selectExpr("label as a", "label2 as b"))
    second = materialise(components(across))
    return (labelled.join(second.selectExpr("id as label", "label as root"), "label", "left")
            .selectExpr("fp", "coalesce(root, label) as label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp, component) for each row of ``docs``: component is the smallest id that links reach.

    Fingerprints link at ``RADIUS`` or fewer differing bits. Repeated rows keep a row each. A row with a null id takes
    part; its component is null only if no row of its component has an id. An empty table gives an empty one.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, width))
    prints = materialise(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")))
    labels = prints.join(link_components(prints), "fp")
    roots = labels.groupBy("label").agg(F.min("least").alias("component"))
    named = labels.join(roots, "label").select("fp", "component")
    return rows.join(named, "fp").select("id", "fp", "component")
