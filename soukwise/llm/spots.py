"""Spot signatures: chains of content words after common words describe a document.

Common words mark the places in natural text. Each content word that follows one
opens a chain with the content words after it; the chains of a text, and the words outside
of any, form a set of signatures. Sets are compared by the Jaccard coefficient. Of two sets the smaller
one's share of the larger one bounds it, so a join only looks at neighbouring
lengths, and within these at sets that share one of their rarest signatures.

All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.operators.skew import with_buckets

# Common words of English, German, French and Spanish, the places that open a chain.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "als auf aus bei das dem den der des die ein eine einen es für im ist mit nicht sich und von zu "
    "au aux ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une "
    "al como con del el ella en es la las lo los no para por que se su un una y").split()
ANCHORS = sorted(set(ANCHORS))
CHAIN = 3
#: Rows and bytes of a range of ids that is sorted together, and the most ranges.
RANGE_ROWS, RANGE_BYTES, MOST_RANGES = 2000, 8 << 20, 1 << 16


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the sorted distinct signatures of the column ``text``, each eight hex digits.

    Signatures are the chains, the content words that no chain holds, and the common words after the last content word.
    So what a place gives depends on the words around it only, not on the length of the text. A text without a word has none.
    """
    kept = df.columns
    words = F.filter(F.split(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    df = df.select("*", words.alias("_words"))
    # A mark for each common word; marks join the content word after them.
    marked = F.array_join(F.transform("_words", lambda w: F.when(w.isin(ANCHORS), ">").otherwise(w)), " ")
    df = df.select("*", F.split(F.regexp_replace(marked, r"(?:> )+", ">"), " ").alias("_content"))

    def chain(w: Column, i: Column) -> Column:
        rest = [F.ltrim(F.get("_content", i + k), F.lit(">")) for k in range(1, CHAIN)]
        whole = rest[-1] != ""
        return F.when(w.startswith(">") & whole, F.concat_ws(" ", F.ltrim(w, F.lit(">")), *rest))

    df = df.select("*", F.transform("_content", chain).alias("_chains"))

    def alone(w: Column, i: Column) -> Column:
        held = [F.get("_chains", i - k).isNotNull() for k in range(CHAIN)]
        return F.when(~held[0] & ~held[1] & ~held[2] & (w != ">"), F.ltrim(w, F.lit(">")))

    after = F.length(F.replace(F.regexp_extract(marked, "[> ]*$", 0), F.lit(" "), F.lit("")))
    spots = F.filter(F.concat("_chains", F.transform("_content", alone), F.slice(
        "_words", F.size("_words") - after + 1, after)), lambda c: c.isNotNull() & (c != ""))
    return df.select(*kept, F.array_sort(F.array_distinct(
        F.transform(spots, lambda c: F.substring(F.md5(c), 1, 8)))).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two sets; 1 for two empty ones. Skips the intersection where a side is empty."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return (F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double"))
            .otherwise(shared / (F.size(a) + F.size(b) - shared)))


def similar_pairs(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """(id1, id2, likeness) of the pairs of a table (id, signatures) whose likeness is ``least`` or more.

    Equal sets share a row first, under their smallest id, so copies do not multiply. A set meets others in its
    own band of lengths and the next one, and through its rarest signatures only: two sets that are alike share one
    among the first ``size - ceil(least * size) + 1`` of each. Empty sets are left out.
    """
    distinct = sets.where(F.size("signatures") > 0).groupBy("signatures").agg(F.min("id").alias("id"))
    counts = distinct.select(F.explode("signatures").alias("s")).groupBy("s").count()
    ordered = (distinct.select("id", F.size("signatures").alias("n"), F.explode("signatures").alias("s")).join(counts, "s")
               .groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("count", "s"))).alias("ranked")))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(least)).cast("int")
    first = F.slice("ranked", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    keyed = ordered.select("id", "n", band.alias("band"), F.explode(F.transform(first, lambda x: x["s"])).alias("s"))
    probes = keyed.select("id", "n", "s", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    left = probes.select("band", "s", F.col("id").alias("id1"), F.col("n").alias("n1"))
    right = keyed.select("band", "s", F.col("id").alias("id2"), F.col("n").alias("n2"))
    met = (left.join(right, ["band", "s"])
           .where("(n1 < n2 or (n1 = n2 and id1 < id2)) and n1 >= n2 * {}".format(least - 1e-9))
           .select("id1", "id2").distinct())
    a = distinct.select(F.col("id").alias("id1"), F.col("signatures").alias("a"))
    b = distinct.select(F.col("id").alias("id2"), F.col("signatures").alias("b"))
    return (met.join(a, "id1").join(b, "id2").select("id1", "id2", likeness(F.col("a"), F.col("b")).alias("likeness"))
            .where(F.col("likeness") >= least))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` from the row with the next smaller id, for the smallest the one with the largest.

    Rows are ordered by id descending, null ids last, equal ids by descending text. Ids are cut into ranges, each of
    which is sorted in one task; the first row of a range is also given to the range before it.
    """
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    ranges = min(MOST_RANGES, max(1, size["n"] // RANGE_ROWS, size["b"] // RANGE_BYTES))
    place = docs.withColumn("_place", F.coalesce(F.col("id").cast("double"), F.lit(-1.7e308)))
    probes = [i / ranges for i in range(1, ranges)]
    points = place.select("_place").approxQuantile("_place", probes, 1 / (4 * ranges)) if probes else []
    placed = (with_buckets(place, {"_place": points}).withColumn("_range", F.col("_in__place").cast("int"))
              .drop("_in__place") if points else place.withColumn("_range", F.lit(0))).drop("_place")
    # One row per range, whatever the table holds: the range above takes a copy of this one's first row.
    heads = F.broadcast(placed.groupBy("_range").agg(F.max("id").alias("_head")).selectExpr(
        "_range", "_head",
        "coalesce(lag(_range) over (order by _range desc), min(_range) over (order by _range desc "
        "rows between unbounded preceding and unbounded following)) as _above"))
    copies = placed.join(heads, "_range").selectExpr(
        *docs.columns, "inline(if(id <=> _head, array(struct(_range as r, false as c), struct(_above as r, true as c)), "
                       "array(struct(_range as r, false as c)))) as (_range, _copy)")
    order = "partition by _range order by _copy, id desc nulls last, text desc nulls last"
    return (copies.select("*", *[F.expr(f"lead(`{c}`) over ({order})").alias(f"next_{c}") for c in columns])
            .where("not _copy").drop("_range", "_copy"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, the signatures, those of the edited text, and the two likenesses.

    The edited text has its last half replaced by the beginning of the next document. A null text counts as
    empty. Repeated rows and null ids each keep a row (null ids come last in the order); other columns are not looked at; an
    empty table gives an empty one. A table of one row follows itself.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(with_signatures(rows, "text", "signatures"), ["text", "signatures"])
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("id", n.cast("bigint").alias("n_chars"), "signatures", "next_signatures", edited.alias("edited"))
    rows = with_signatures(rows, "edited", "edited_signatures")
    return rows.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "signatures", "edited_signatures",
                       likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
                       likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"))
