"""Personal data: patterns whose matches stand, and further spans by weak supervision.

Three labelers vote on every candidate span, also on matches that fail their pattern's check. One
looks at its form, one at word and code lists, one at the words before it; each says yes, no or nothing. An
expectation-maximisation over the counts of vote patterns estimates how far each labeler is right, for
personal data and for other text. The chance that this gives each pattern then trains the span
classifier, a naive Bayes model over features of the span; it sees kind, length, share of digits and votes.
Candidates that it takes for personal data are added.

All work on texts is DataFrame functions. The driver sees counts by votes and features, a few
thousand rows whatever the tables hold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.llm.spans import add_spans, apart_from, in_blocks, labelled, listed, merged, not_within_earlier
from soukwise.session import materialise

# The fixed patterns, written so that no place is tried twice: a local part begins where the last match ended or
# where no such character stands before it, a card number where no digit of it stands before, with 14 digits at least.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Further candidates, in this order, by the kind that a match of the joint pattern has.
OTHER = {
    "masked_email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++ ?(?:[\[(]dot[\])]|\.) ?[A-Za-z]{2,10}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[-. ][0-9]{2,3}[-. ][0-9]{4}(?![0-9A-Za-z])",
    "name": r"(?<!\p{L})(?:Mrs?|Ms|Dr|Herr|Frau|Monsieur|Madame|Señora?)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
}
ADDED = ("account", "number", *OTHER)

# Fixed lists of the list labeler, by kind: ends of addresses, calling codes, issuer digits, country codes, given names.
ENDS = "com org net edu gov io de fr es uk eu info".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 57 61 62 63 64 65 66 81 82 86 90 91".split()
COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR IE IT LU NL NO PL PT SE".split()
NAMES = "Anna Carlos Claire David Emma Hans John Juan Julia Maria Marie Mary Michael Paul Peter Pierre Sophie Thomas".split()
# Words before a span that speak for and against personal data.
CUES = (r"(?i)(?<!\p{L})(?:e-?mail|mail|phone|tel|telefon|téléphone|teléfono|call|contact|kontakt|mobile|fax|ssn|iban|account|"
        r"konto|cuenta|compte|card|visa|name|address|ip|login|user)(?!\p{L})")
COUNTER = r"(?i)(?<!\p{L})(?:version|release|isbn|issn|doi|order|invoice|page|section|figure|table|item|build)(?!\p{L})"
BEFORE = 40
YES, NO, NOTHING = 1, 0, -1
ROUNDS = 50


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Whether the digits pass the check sum: every second from the right counts twice, its digits added."""
    places = F.filter(F.split(F.reverse(_digits(hit)), ""), lambda c: c != "")
    worth = F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
    "card": lambda hit: F.length(_digits(hit)).between(14, 19) & _luhn(hit),
    "phone": lambda hit: F.length(_digits(hit)).between(10, 15),
}


def _other_kind(hit: Column) -> Column:
    return (F.when(hit.rlike(r"[\[(]at[\])]"), "masked_email").when(hit.rlike("^[A-Z]{2}[0-9]{2}"), "iban")
            .when(hit.rlike(r"^\(?[0-9]"), "national").otherwise("name"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, YES).when(no, NO).otherwise(NOTHING)


def _form(kind: Column, hit: Column) -> Column:
    """Yes for a match that passes its check, or has a form in use; no for one that does not."""
    good = (kind.isin(*KINDS) | ((kind == "national") & ~_digits(hit).rlike("^(0|1|9|[0-9]{3}00|[0-9]{5}0000)"))
            | ((kind == "iban") & F.length(F.replace(hit, F.lit(" "), F.lit(""))).between(15, 32))
            | (kind == "masked_email") | ((kind == "name") & hit.rlike(r" \p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$")))
    return _vote(good, ~good & (kind != "name"))


def _listed(kind: Column, hit: Column) -> Column:
    calling = F.regexp_extract(hit, r"^\+?([0-9]{1,2})", 1)
    found = (F.when(kind.isin("email", "masked_email"), F.lower(F.regexp_extract(hit, "([A-Za-z]+)$", 1)).isin(ENDS))
             .when(kind.isin("phone", "number"), calling.isin(CALLING) | F.substring(calling, 1, 1).isin("1", "7"))
             .when(kind.isin("card", "account"), F.substring(_digits(hit), 1, 1).isin("3", "4", "5", "6"))
             .when(kind == "iban", F.substring(hit, 1, 2).isin(COUNTRIES))
             .when(kind == "name", F.exists(F.split(hit, " "), lambda w: w.isin(NAMES))))
    return F.when(found.isNull(), NOTHING).when(found, YES).otherwise(NO)


def _context(before: Column) -> Column:
    return _vote(before.rlike(CUES), before.rlike(COUNTER))


def candidates(rows: DataFrame, kept: list[str]) -> DataFrame:
    """Of a table with a column ``text`` the columns ``kept``, base (the spans that stand) and cands: all candidates with
    kind, features and votes."""
    text = F.col("text")
    found = add_spans(rows, "text", {
        "email": (EMAIL, text.contains("@")), "ip": (IP, text.contains(".")), "card": (CARD, None),
        "phone": (PHONE, text.contains("+")), "other": ("|".join(OTHER.values()), None)})
    spans = {k: F.col(f"_spans_{k}") for k in (*KINDS, "other")}
    base = {k: F.filter(spans[k], _checked(k)) for k in KINDS}

    def as_candidates(kind: str, kept: Column) -> Column:
        return F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), F.lit(kind).alias("kind")))

    def failed(kind: str) -> Column:
        return F.filter(spans[kind], lambda s: ~_checked(kind)(s))

    others = F.transform(spans["other"], lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), _other_kind(s["hit"]).alias("kind")))
    every = F.concat(*[as_candidates(k, base[k]) for k in KINDS], as_candidates("account", failed("card")),
                     as_candidates("number", failed("phone")), others)
    listed_rows = found.select(*dict.fromkeys([*kept, "text"]), merged(base).alias("base"), every.alias("every"))

    def described(s: Column) -> Column:
        before = F.substr(F.col("text"), F.greatest(s["start"] - BEFORE, F.lit(0)).cast("int") + 1,
                          F.least(s["start"], F.lit(BEFORE)).cast("int"))
        share = F.length(_digits(s["hit"])) / F.length(s["hit"])
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.least(F.floor(F.length(s["hit"]) / 6), F.lit(6)).cast("int").alias("size"),
            F.floor(share * 4).cast("int").alias("digits"), _form(s["kind"], s["hit"]).alias("form"),
            _listed(s["kind"], s["hit"]).alias("listed"), _context(before).alias("context"))

    return listed_rows.select(*kept, "base", F.transform("every", described).alias("cands"))


def _checked(kind: str) -> Callable[[Column], Column]:
    return lambda s: CHECKS[kind](s["hit"])


LABELERS = ("form", "listed", "context")
FEATURES = ("kind", "size", "digits", *LABELERS)


def reliabilities(patterns: dict[tuple[int, ...], int]) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """By expectation-maximisation over the counts of vote patterns: the share of personal data, and for
    each labeler how often it casts each vote on other text and on personal data."""
    def start(votes: tuple[int, ...]) -> float:
        said = [v for v in votes if v != NOTHING]
        return (sum(said) + 0.5) / (len(said) + 1)

    chance = {votes: start(votes) for votes in patterns}
    share, table = 0.5, []
    for _ in range(ROUNDS):
        total = sum(patterns.values())
        yes = sum(n * chance[v] for v, n in patterns.items())
        share = (yes + 1) / (total + 2)
        table = []
        for i in range(len(LABELERS)):
            cast = {}
            for vote in (NOTHING, NO, YES):
                on = sum(n * chance[v] for v, n in patterns.items() if v[i] == vote)
                off = sum(n * (1 - chance[v]) for v, n in patterns.items() if v[i] == vote)
                # A slight belief that a labeler is more often right than wrong keeps the two classes apart.
                cast[vote] = ((off + 1 + (vote == NO)) / (total - yes + 4), (on + 1 + (vote == YES)) / (yes + 4))
            table.append(cast)
        for votes in patterns:
            odds = math.log(share / (1 - share)) + sum(
                math.log(table[i][v][1] / table[i][v][0]) for i, v in enumerate(votes))
            chance[votes] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return share, table


def classifier(counts: list[tuple[tuple, int]]) -> tuple[float, dict[str, dict[object, float]]]:
    """The prior log odds and those of each value of each feature, from (features, spans)."""
    patterns: dict[tuple[int, ...], int] = {}
    for values, n in counts:
        votes = tuple(values[-len(LABELERS):])
        patterns[votes] = patterns.get(votes, 0) + n
    share, table = reliabilities(patterns)
    sums: dict[tuple[str, object], list[float]] = {}
    yes = no = 0.0
    for values, n in counts:
        odds = math.log(share / (1 - share)) + sum(
            math.log(table[i][v][1] / table[i][v][0]) for i, v in enumerate(values[-len(LABELERS):]))
        chance = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        yes, no = yes + n * chance, no + n * (1 - chance)
        for name, value in zip(FEATURES, values):
            pair = sums.setdefault((name, value), [0.0, 0.0])
            pair[0], pair[1] = pair[0] + n * (1 - chance), pair[1] + n * chance
    weights: dict[str, dict[object, float]] = {name: {} for name in FEATURES}
    for (name, value), (off, on) in sums.items():
        weights[name][value] = math.log((on + 1) / (yes + 2)) - math.log((off + 1) / (no + 2))
    return math.log((yes + 1) / (no + 1)), weights


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base (spans of the fixed patterns that pass their check) and spans (those and the added ones).

    Both are arrays of (start, rank, end, kind) by start; a candidate that overlaps a span of base is not
    added. A null text counts as empty. Repeated rows and null ids each keep a row; other columns are not looked at; an empty
    table gives an empty one.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = materialise(candidates(texts, ["id"]))
    return _with_spans(rows, ["id", "base"], *_learned(rows))


def without_personal_data(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with each span of personal data replaced by its kind in brackets.

    The column ``size_col``, where there is one, gets the new number of characters. A null text stays null.
    Other columns, whatever their names, come along as they are.
    """
    names = docs.columns
    kept = [f"c{i}" for i in range(len(names))]
    at = kept[names.index(text_col)]
    rows = docs.toDF(*kept).withColumn("text", F.coalesce(F.col(at).cast("string"), F.lit("")))
    prior, weights = _learned(candidates(rows.select("text"), []))
    found = _with_spans(candidates(rows, [*kept, "text"]), [*kept, "text"], prior, weights)
    clean = F.when(F.col(at).isNotNull(), redacted(F.col("text"), F.col("spans")))
    found = found.select(*kept, clean.alias("clean"))
    return found.select(*[
        F.col("clean").alias(n) if n == text_col else
        F.length("clean").cast(docs.schema[n].dataType).alias(n) if n == size_col else F.col(c).alias(n)
        for c, n in zip(kept, names)])


def _learned(found: DataFrame) -> tuple[float, dict[str, dict[object, float]]]:
    # The outer form: for the other one Spark filters by the size of the array first, and makes all of it for that as well.
    seen = found.select(F.inline_outer("cands")).where("kind is not null").groupBy(*FEATURES).count().collect()
    return classifier([(tuple(r[f] for f in FEATURES), r["count"]) for r in seen])


def _with_spans(found: DataFrame, kept: list[str], prior: float, weights: dict[str, dict[object, float]]) -> DataFrame:
    def odds(s: Column) -> Column:
        out = F.lit(prior)
        for name in FEATURES:
            part = F.lit(0.0)
            for value, weight in sorted(weights[name].items(), key=lambda x: str(x[0])):
                part = F.when(s[name] == F.lit(value), F.lit(weight)).otherwise(part)
            out = out + part
        return out

    carried = [*dict.fromkeys([*kept, "base"])]
    likely = F.array_sort(F.filter("cands", lambda s: s["kind"].isin(*ADDED) & (odds(s) > 0)))
    found = found.select(*carried, likely.alias("likely"), in_blocks(F.col("base")).alias("cut"))
    found = found.select(*carried, apart_from(F.col("likely"), "cut").alias("chosen"))
    found = found.select(*carried, "chosen", in_blocks(F.col("chosen")).alias("cut"))
    found = found.select(*carried, not_within_earlier(F.col("chosen"), "cut").alias("added"))
    added = [labelled(F.filter("added", _of_kind(kind)), rank, kind) for rank, kind in enumerate(ADDED, len(KINDS))]
    return found.select(*kept, F.array_sort(F.concat("base", *added)).alias("spans"))


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span of a sorted array replaced by its kind in brackets.

    Overlapping ones are one range up to their largest end, with the kind of the first.
    """
    state = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(
            F.greatest(a["at"], s["end"]).alias("at"), a["parts"].alias("parts"))).otherwise(F.struct(
                s["end"].alias("at"), F.concat(a["parts"], F.array(
                    F.substr(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")),
                    F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("parts"))))
    return F.concat(F.array_join(state["parts"], ""), F.substr(text, state["at"].cast("int") + 1, F.length(text)))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the SHA-256 of the listed base spans and the list of all spans."""
    counts = [F.size(F.filter("base", _of_kind(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
