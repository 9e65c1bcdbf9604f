"""Ranks over a whole table without a window that lacks PARTITION BY.

Such a window sends every row to one task. Here the order key is cut into
ranges at approximate quantiles; the exact row count of every range then gives
the position at which that range starts. A value so frequent that it fills whole
ranges gets a range of its own, which is cut further by the tie-breaking id. The
range of a row depends on its values only, so recomputed tasks agree.

Order keys and ids must be numbers, the ids unique. Ranges are found on doubles, which keep the order of
numbers of any size; where doubles merge different values, the values themselves decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soukwise.operators.skew import split_points, with_buckets
from soukwise.session import materialise

#: Ranges at least and at most, and the rows that one of them should hold.
BUCKETS, MOST_BUCKETS, ROWS_PER_BUCKET = 64, 1024, 1_000_000


def _at(df: DataFrame, key: str, id_col: str, points: dict[str, list[float]]) -> DataFrame:
    """Add ``_piece``, the range of the key, and ``_slot``, the range of the id inside a range that holds one frequent value."""
    placed = with_buckets(df, {c: points[c] for c in (key, id_col)})
    # A probe found twice is a value that fills a whole range. It opens its range, so it
    # comes before the rest of it.
    frequent = sorted({p for p in points[key] if points[key].count(p) > 1})
    is_frequent = f"double(`{key}`) in ({', '.join(f'{v!r}D' for v in frequent)})" if frequent else "false"
    return placed.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"int(`_in_{key}`) * 2 + if({is_frequent}, 0, 1) as _piece",
        f"if({is_frequent}, int(`_in_{id_col}`), 0) as _slot")


def _points(df: DataFrame, keys: list[str], id_col: str, buckets: int) -> dict[str, list[float]]:
    return dict(zip([*keys, id_col], split_points(df, [*keys, id_col], buckets)))


def _place(df: DataFrame, keys: list[str], id_col: str, buckets: int) -> dict[str, DataFrame]:
    """For each order key the frame with its ranges."""
    points = _points(df, keys, id_col, buckets)
    return {key: _at(df, key, id_col, points) for key in keys}


def _unsplit(df: DataFrame, counts: list[tuple[int, int, int, bool]]) -> DataFrame:
    """Pieces that look like one value but hold several are not cut by id."""
    mixed = sorted({piece for piece, _, _, single in counts if piece % 2 == 0 and not single})
    return df.withColumn("_slot", F.when(F.col("_piece").isin(mixed), 0).otherwise(F.col("_slot"))) if mixed else df


def _counted(placed: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, list[tuple[int, int, int, bool]]]]:
    """(piece, slot, rows, single) in order, for each order key: ``single`` where a piece holds one value.

    Values that share a double can make a range look like one value. Such a piece is not cut by id.
    The counts are bounded by the square of the bucket count.
    """
    parts = [df.groupBy("_piece", "_slot").agg(
        F.expr("count(*) as n"), F.expr(f"string(min(`{key}`)) as low"), F.expr(f"string(max(`{key}`)) as high"))
        .selectExpr(f"'{key}' as key", "_piece", "_slot", "n", "low", "high") for key, df in placed.items()]
    rows = reduce(DataFrame.unionByName, parts).collect()
    counts, frames = {}, {}
    for key, df in placed.items():
        own = [r for r in rows if r["key"] == key]
        values: dict[int, set] = {}
        for r in own:
            values.setdefault(r["_piece"], set()).update((r["low"], r["high"]))
        single = {piece: piece % 2 == 0 and len(seen) == 1 for piece, seen in values.items()}
        sums: dict[tuple[int, int], int] = {}
        for r in own:
            at = (r["_piece"], r["_slot"] if single[r["_piece"]] else 0)
            sums[at] = sums.get(at, 0) + r["n"]
        counts[key] = [(piece, slot, n, single[piece]) for (piece, slot), n in sorted(sums.items())]
        frames[key] = _unsplit(df, counts[key])
    return frames, counts


def _ranges(df: DataFrame) -> int:
    """How many ranges: more for more rows, so that a range stays within a task."""
    return max(BUCKETS, min(MOST_BUCKETS, df.count() // ROWS_PER_BUCKET))


def _offsets(df: DataFrame, counts: list[tuple[int, int, int, bool]]) -> DataFrame:
    """Where each piece and slot starts in the global order: bounded by the bucket count, whatever the data."""
    per_piece: dict[int, int] = {}
    for piece, _, n, _ in counts:
        per_piece[piece] = per_piece.get(piece, 0) + n
    starts, seen, first_of = [], 0, {}
    for piece, slot, n, single in counts:
        first_of.setdefault(piece, seen)
        starts.append((piece, slot, seen, first_of[piece], per_piece[piece], single))
        seen += n
    schema = "_piece int, _slot int, _start bigint, _first bigint, _size bigint, _single boolean"
    return F.broadcast(df.sparkSession.createDataFrame(starts, schema))


def _ranked(placed: DataFrame, key: str, id_col: str, counts: list[tuple[int, int, int, bool]], names: dict[str, str]) -> DataFrame:
    """Add rank columns to a frame with ``_piece`` and ``_slot``; ``names`` says which and under what names."""
    total = sum(n for _, _, n, _ in counts)
    within = Window.partitionBy("_piece", "_slot")
    single = F.col("_single")
    ties = F.when(single, F.col("_size")).otherwise(
        F.count("*").over(Window.partitionBy("_piece", "_slot", key)))
    rank = F.when(single, F.col("_first") + 1).otherwise(
        F.col("_start") + F.rank().over(within.orderBy(key)))
    found = {"row_number": F.col("_start") + F.row_number().over(within.orderBy(key, id_col)),
             "rank": rank, "pct_rank": (rank + (ties - 1) / 2) / F.lit(total)}
    return (placed.join(_offsets(placed, counts), ["_piece", "_slot"])
            .withColumns({name: found[kind] for kind, name in names.items()})
            .drop("_piece", "_slot", "_start", "_first", "_size", "_single"))


def global_ranks(df: DataFrame, key: str, id_col: str, descending: bool = False,
                 buckets: int | None = None) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``pct_rank`` over all rows.

    ``row_number`` breaks ties by ascending id. ``pct_rank`` is the average rank
    of the tied rows as a share of all rows.
    """
    df = materialise(df.withColumn("_key", F.negate(F.col(key)) if descending else F.col(key)))
    placed, counts = _counted(_place(df, ["_key"], id_col, buckets or _ranges(df)))
    return _ranked(placed["_key"], "_key", id_col, counts["_key"],
                   {c: c for c in ("row_number", "rank", "pct_rank")}).drop("_key")


def pct_ranks(df: DataFrame, keys: dict[str, str], id_col: str, buckets: int | None = None) -> DataFrame:
    """Percent ranks over the whole table by several order keys: ``keys`` maps an output column to its order column.

    The table is stored once, and one pass places all keys and one counts their ranges.
    """
    df = materialise(df)
    columns = list(dict.fromkeys(keys.values()))
    points = _points(df, columns, id_col, buckets or _ranges(df))
    _, counts = _counted({c: _at(df, c, id_col, points) for c in columns})
    for out, c in keys.items():
        df = _ranked(_unsplit(_at(df, c, id_col, points), counts[c]), c, id_col, counts[c], {"pct_rank": out})
    return df


def _tile_ends(total: int, tiles: int) -> list[int]:
    """Position of the last row of every tile but the last; the first tiles take the remainder."""
    size, extra = divmod(total, tiles)
    ends, at = [], 0
    for tile in range(tiles - 1):
        at += size + (1 if tile < extra else 0)
        ends.append(at)
    return ends


def _border_rows(placed: DataFrame, key: str, id_col: str, counts: list[tuple[int, int, int, bool]],
                 positions: list[int]) -> DataFrame:
    """(id, key) of the rows at the given 1-based positions of the global order."""
    pieces, places, seen = ["false"], ["false"], 0
    for piece, slot, n, _ in counts:
        local = sorted({p - seen for p in positions if seen < p <= seen + n})
        if local:
            here = f"_piece = {piece} and _slot = {slot}"
            pieces.append(f"({here})")
            places.append(f"({here} and _at in ({', '.join(map(str, local))}))")
        seen += n
    order = f"row_number() over (partition by _piece, _slot order by `{key}`, `{id_col}`) as _at"
    return (placed.where(" or ".join(pieces)).selectExpr("*", order)
            .where(" or ".join(places)).select(id_col, key))


def ntiles(df: DataFrame, tiles: int, keys: dict[str, tuple[str, bool]], id_col: str,
           buckets: int | None = None) -> DataFrame:
    """NTILE over the whole table for several order keys at once.

    ``keys`` maps an output column to (order column, descending). Only the rows at
    the tile borders are located; every row is then compared with them, so the
    table itself is never shuffled.
    """
    order = {out: f"_order_{out}" for out in keys}
    df = materialise(df.selectExpr("*", *[
        f"{'-' if desc else ''}`{c}` as `{order[out]}`" for out, (c, desc) in keys.items()]))
    placed, counts = _counted(_place(df, list(order.values()), id_col, buckets or _ranges(df)))
    total = sum(n for _, _, n, _ in next(iter(counts.values())))
    ends = _tile_ends(total, tiles)

    # Every key fills its own column, so that no value changes its type on the way.
    parts = [_border_rows(placed[key], key, id_col, counts[key], ends) for key in order.values()]
    borders = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).collect()

    def tile(out: str) -> str:
        # A tile that ends before the first row is empty.
        key, base = order[out], 1 + sum(1 for e in ends if e == 0)
        steps = [f"if(`{key}` > {row[key]} or (`{key}` = {row[key]} and `{id_col}` > {row[id_col]}), 1, 0)"
                 for row in borders if row[key] is not None]
        return f"int({' + '.join([str(base), *steps])}) as `{out}`"

    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in order.values()], *[tile(out) for out in keys])
