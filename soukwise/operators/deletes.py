"""Deletes followed along the references between tables.

Every row that is to go is a delete of its own. It takes along the rows that refer to it, those that refer to
them, and so on, as the references say; one row that may not lose its parent blocks the whole delete.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.session import materialise

CASCADE, RESTRICT, SET_NULL = "cascade", "restrict", "set null"


@dataclass
class Reference:
    """Rows of ``child`` refer to ``parent`` by a column; ``action`` is what a delete of the parent does."""

    child: str
    column: str
    parent: str
    action: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


def _any(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class Deletion:
    """The effect of deletes. ``tables`` are frames with a column ``key`` and those of the references.

    ``roots`` are the keys to delete, by table. A root is named by its table and key.
    """

    def __init__(self, tables: dict[str, DataFrame], references: list[Reference], roots: dict[str, DataFrame]) -> None:
        self.tables, self.references = tables, references
        self.reached = self._walk({name: keys.select(
            F.concat_ws(":", F.lit(name), F.col("key").cast("string")).alias("root"), "key").distinct() for name, keys in roots.items()})
        self.blocked = materialise(self._blocked())

    def _touched(self, reference: Reference, parents: DataFrame) -> DataFrame:
        """(root, key) of the rows that refer to any of (root, key)."""
        rows = self.tables[reference.child].select("key", F.col(reference.column).alias("_to"))
        return parents.withColumnRenamed("key", "_to").join(rows, "_to").select("root", "key")

    def _walk(self, new: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """(root, key) by table, of all rows that the deletes reach by cascades.

        A round follows each cascade once from the rows that the round before added, until none adds any; rows may refer to
        rows of their own table.
        """
        known: dict[str, list[DataFrame]] = {}
        while new:
            # Stored, because the next round and the reports read them again.
            new = {name: materialise(rows) for name, rows in new.items()}
            new = {name: rows for name, rows in new.items() if not rows.isEmpty()}
            for name, rows in new.items():
                known.setdefault(name, []).append(rows)
            found: dict[str, list[DataFrame]] = {}
            for reference in self.references:
                if reference.action == CASCADE and reference.parent in new:
                    found.setdefault(reference.child, []).append(self._touched(reference, new[reference.parent]))
            new = {}
            for name, frames in found.items():
                rows = _any(frames).distinct()
                new[name] = rows.join(_any(known[name]), ["root", "key"], "left_anti") if name in known else rows
        return {name: _any(frames) for name, frames in known.items()}

    def _blocked(self) -> DataFrame:
        """(root) of the deletes that some row forbids, however far down the chain it is."""
        names = [self._touched(r, self.reached[r.parent]).select("root")
                 for r in self.references if r.action == RESTRICT and r.parent in self.reached]
        if not names:
            return next(iter(self.tables.values())).select(F.lit("").alias("root")).limit(0)
        return _any(names).distinct()

    def going(self, table: str) -> DataFrame | None:
        """(root, key) of a table's rows that do go; None if no delete reaches the table."""
        rows = self.reached.get(table)
        return None if rows is None else rows.join(self.blocked, "root", "left_anti")

    def after(self, table: str) -> DataFrame:
        """A table as the deletes leave it: rows gone, references to rows that are gone emptied."""
        rows, gone = self.tables[table], self.going(table)
        if gone is not None:
            rows = rows.join(gone.select("key").distinct(), "key", "left_anti")
        for reference in self.references:
            if reference.child == table and reference.action == SET_NULL and (parents := self.going(reference.parent)) is not None:
                lost = parents.select(F.col("key").alias("_to"), F.lit(True).alias("_gone")).distinct()
                rows = rows.join(lost, F.col(reference.column) == F.col("_to"), "left").withColumn(
                    reference.column, F.when(F.col("_gone").isNull(), F.col(reference.column))).drop("_to", "_gone")
        return rows.select(*self.tables[table].columns)

    def report(self) -> DataFrame:
        """(relation, action, touched): rows that each reference takes along, empties, or keeps their parents by; and the
        deletes of each table that go through or are blocked."""
        parts = []

        def count(relation: str, action: str, keys: DataFrame) -> None:
            parts.append(keys.distinct().agg(F.count("*").alias("touched")).select(
                F.lit(relation).alias("relation"), F.lit(action).alias("action"), "touched"))

        for reference in self.references:
            parents = self.reached.get(reference.parent)
            if parents is None:
                continue
            if reference.action != RESTRICT:
                parents = parents.join(self.blocked, "root", "left_anti")
            count(reference.name, reference.action, self._touched(reference, parents).select("key"))
        every = _any([rows.select("root") for rows in self.reached.values()]).distinct()
        state = F.when(F.col("_no").isNull(), "deleted").otherwise("blocked")
        parts.append(every.join(self.blocked.withColumn("_no", F.lit(True)), "root", "left")
                     .groupBy(F.substring_index("root", ":", 1).alias("relation"), state.alias("action")).agg(F.count("*").alias("touched")))
        return _any(parts)
