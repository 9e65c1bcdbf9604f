"""Places of pattern matches in whole texts, in DataFrame functions only.

Spark returns the matches of a pattern and, by ``split``, the text between them,
but no places. Adding up the lengths gives these. A pattern must not match the
empty string. Places count code points, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums run in blocks of this many matches, so that n matches cost about n * BLOCK steps, not n * n.
BLOCK = 256
SPAN = "array<struct<start:bigint,end:bigint,hit:string>>"


def matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """A struct of the matches of ``pattern`` and the texts between them; empty where ``guard`` is false."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                     F.split(text, pattern, -1).alias("gaps"))
    hit = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(hit, found)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def blocks(values: Column) -> Column:
    """A non-empty array cut into arrays of ``BLOCK`` elements."""
    n_blocks = F.ceil(F.size(values) / F.lit(BLOCK)).cast("int")
    return F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))


def before_each(values: Column) -> Column:
    """The sum of the elements before each element."""
    return F.transform(values, lambda _, i: _total(F.slice(values, F.lit(1), i)))


def running(cut: Column, starts: Column) -> Column:
    """The sums before each element of an array in blocks, of which ``starts`` are the sums before each block."""
    return F.flatten(F.zip_with(cut, starts, lambda block, start: F.transform(
        block, lambda _, i: start + _total(F.slice(block, F.lit(1), i)))))


def steps(found: Column) -> Column:
    """For each match the length of the text before it and of itself, as one array of integers."""
    return F.zip_with(F.slice(found["gaps"], F.lit(1), F.size(found["hits"])), found["hits"],
                      lambda gap, hit: (F.length(gap) + F.length(hit)).cast("bigint"))


def located(found: Column, sums: Column) -> Column:
    """The spans (start, end, hit) of what ``matches`` found; ``sums`` are the running sums of its ``steps``."""
    ends = F.zip_with(sums, steps(found), lambda a, b: a + b)
    spans = F.zip_with(found["hits"], ends, lambda hit, end: F.struct(
        (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))
    return F.when(found.isNotNull(), spans).otherwise(F.array().cast(SPAN))


def add_spans(df, text: str, patterns: dict[str, tuple[str, Column | None]]):
    """Adds for each kind a column ``_spans_<kind>`` with the matches of its pattern in the column ``text``.

    A step at a time, so that no pattern runs more often than it has to.
    """
    kept = [c for c in df.columns]
    df = df.select("*", *[matches(F.col(text), p, guard).alias(f"_found_{k}") for k, (p, guard) in patterns.items()])
    def step(out: str, source: str, value: Callable[[str], Column]) -> None:
        nonlocal df
        df = df.select("*", *[F.when(F.col(f"_{source}_{k}").isNotNull(), value(k)).alias(f"_{out}_{k}") for k in patterns])

    step("steps", "found", lambda k: steps(F.col(f"_found_{k}")))
    step("cut", "steps", lambda k: blocks(F.col(f"_steps_{k}")))
    step("totals", "cut", lambda k: F.transform(f"_cut_{k}", _total))
    step("starts", "totals", lambda k: before_each(F.col(f"_totals_{k}")))
    step("sums", "starts", lambda k: running(F.col(f"_cut_{k}"), F.col(f"_starts_{k}")))
    return df.select(*kept, *[located(F.col(f"_found_{k}"), F.col(f"_sums_{k}")).alias(f"_spans_{k}") for k in patterns])


def labelled(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def merged(kinds: dict[str, Column]) -> Column:
    """One array of (start, rank, end, kind), by start and then in the order of ``kinds``."""
    return F.array_sort(F.concat(*[labelled(spans, rank, kind) for rank, (kind, spans) in enumerate(kinds.items())]))


def listed(spans: Column) -> Column:
    """kind:start:end of such an array, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def in_blocks(spans: Column) -> Column:
    """An array of spans, sorted by start, in blocks of (low, high, spans): the first start, the last end, and the spans."""
    cut = F.when(F.size(spans) > 0, F.transform(blocks(spans), lambda b: F.struct(
        b[0]["start"].alias("low"), F.array_max(F.transform(b, lambda s: s["end"])).alias("high"), b.alias("spans"))))
    return F.coalesce(cut, F.array())


def apart_from(spans: Column, cut: str) -> Column:
    """Those of an array of spans that share no place with any span in the blocks of the column ``cut``.

    A span looks at the blocks and into those it reaches, so n spans cost about n * (n / BLOCK + BLOCK) steps.
    """
    def meets(span: Column) -> Column:
        return F.exists(cut, lambda b: (b["low"] < span["end"]) & (span["start"] < b["high"]) & F.exists(
            b["spans"], lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"])))
    # Named twice, so that the blocks are made once and not again for every span.
    return F.when(F.size(cut) == 0, spans).otherwise(F.filter(spans, lambda s: ~meets(s)))


def not_within_earlier(spans: Column, cut: str) -> Column:
    """Those of an array that do not begin inside another one of it, which begins before; ``cut`` has its blocks."""
    def within(span: Column) -> Column:
        return F.exists(cut, lambda b: (b["low"] < span["start"]) & (span["start"] < b["high"]) & F.exists(
            b["spans"], lambda o: (o["start"] < span["start"]) & (span["start"] < o["end"])))
    return F.when(F.size(cut) == 0, spans).otherwise(F.filter(spans, lambda s: ~within(s)))
