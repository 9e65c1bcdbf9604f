"""Secret scan: fixed patterns, and long tokens that pass a battery of randomness tests.

A token's encoding is inferred from its characters. Over that alphabet three
tests ask whether the token could be random: chi-squared of the character
counts, the number of runs of characters from the lower and the upper half, and the
correlation of neighbours. Fisher's sum joins their p-values. Natural words fail
such tests, but short ones not always: so each token has a decoy of its length, made of the words of its
text laid together, and the decoys' share above a threshold, in the same band of lengths,
estimates the false discoveries among the tokens. In each band the lowest threshold
that keeps their share below ``FALSE`` decides.

All of it is DataFrame functions; only the counts by band and p-value reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.llm.spans import add_spans, apart_from, in_blocks, labelled, listed, merged
from soukwise.session import materialise

# Fixed patterns. Those for hex and access keys hold their least length; a run that is
# too short cannot hide a longer one, so this equals matching first and dropping then.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Padding belongs to a token, but an equals sign before a value ends it.
TOKEN = (r"[A-Za-z0-9+/_-]{20,}(?:=++(?![A-Za-z0-9+/_-]))?"
         r"|(?=[A-Za-z0-9+/_=-]{20})[A-Za-z0-9+/_-]{14,19}+=++(?![A-Za-z0-9+/_-])")
# What a text's plain words are not: long tokens, and all but letters.
LONG_OR_OTHER = r"[A-Za-z0-9+/_=-]{20,}|[^A-Za-z]+"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Encodings, the narrowest first: the characters in order, and the pattern of a token of theirs.
ENCODINGS = (
    ("decimal", DIGITS, r"^[0-9]+$"),
    ("hex", DIGITS + LOWER[:6], r"^[0-9a-f]+$"),
    ("upper_hex", DIGITS + LOWER[:6].upper(), r"^[0-9A-F]+$"),
    ("base32", LOWER.upper() + "234567", r"^[A-Z2-7]+=*$"),
    ("base36", DIGITS + LOWER, r"^[0-9a-z]+$"),
    ("base62", DIGITS + LOWER.upper() + LOWER, r"^[0-9A-Za-z]+$"),
    ("base64url", LOWER.upper() + LOWER + DIGITS + "-_", r"^[0-9A-Za-z_-]+=*$"),
    ("base64", LOWER.upper() + LOWER + DIGITS + "+/", r"^[0-9A-Za-z+/]+=*$"),
)
#: The share of false discoveries that is allowed, and the steps of a p-value.
FALSE, STEPS = 0.05, 20


def _two_sided(z: Column) -> Column:
    """The chance that a normal number is as far from 0, by a polynomial with an error below 2e-7."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-12))


def _by_encoding(encoding: Column, value) -> Column:
    out = None
    for name, alphabet, _ in ENCODINGS:
        out = F.when(encoding == name, value(alphabet)) if out is None else out.when(encoding == name, value(alphabet))
    return out


def encoding(token: Column) -> Column:
    out = None
    for name, _, pattern in ENCODINGS:
        out = F.when(token.rlike(pattern), name) if out is None else out.when(token.rlike(pattern), name)
    return out


def tested(tokens: Column) -> Column:
    """For an array of spans with hits and whether they are decoys: start, end, decoy, length band, and the joint p-value."""
    named = F.transform(tokens, lambda s: F.struct(
        s["start"], s["end"], s["decoy"], F.rtrim(s["hit"], F.lit("=")).alias("token"), encoding(s["hit"]).alias("encoding")))
    counted = F.transform(F.filter(named, lambda s: s["encoding"].isNotNull() & (F.length(s["token"]) >= 2)), lambda s: F.struct(
        s["start"], s["end"], s["decoy"], s["token"], F.length(s["token"]).cast("double").alias("n"),
        _by_encoding(s["encoding"], lambda a: F.lit(float(len(a)))).alias("k"),
        F.transform(F.filter(F.split(s["token"], ""), lambda c: c != ""), lambda c: _by_encoding(
            s["encoding"], lambda a: F.instr(F.lit(a), c) - 1).cast("double")).alias("places"),
        F.aggregate(F.transform(F.array_distinct(F.filter(F.split(s["token"], ""), lambda c: c != "")), lambda c: (
            F.length(s["token"]) - F.length(F.replace(s["token"], c, F.lit("")))).cast("double")),
            F.lit(0.0), lambda a, c: a + c * c).alias("squares")))
    centred = F.transform(counted, lambda s: F.struct(
        s["start"], s["end"], s["n"], s["k"], s["squares"], s["decoy"], s["places"],
        (F.aggregate(s["places"], F.lit(0.0), lambda a, x: a + x) / s["n"]).alias("mean")))
    moments = F.transform(centred, lambda s: F.struct(
        s["start"], s["end"], s["n"], s["k"], s["squares"], s["decoy"],
        F.transform(s["places"], lambda p: F.when(p * 2 < s["k"], "L").otherwise("H")).alias("halves"),
        F.transform(s["places"], lambda p: p - s["mean"]).alias("off")))
    sums = F.transform(moments, lambda s: F.struct(
        s["start"], s["end"], s["n"], s["k"], s["squares"], s["decoy"],
        F.size(F.filter(s["halves"], lambda h: h == "L")).cast("double").alias("low"),
        F.length(F.regexp_replace(F.array_join(s["halves"], ""), "L+|H+", "x")).cast("double").alias("runs"),
        F.aggregate(s["off"], F.lit(0.0), lambda a, x: a + x * x).alias("spread"),
        F.aggregate(F.zip_with(F.slice(s["off"], F.lit(1), F.size(s["off"]) - 1),
                               F.slice(s["off"], F.lit(2), F.size(s["off"])), lambda a, b: a * b),
                    F.lit(0.0), lambda a, x: a + x).alias("lagged")))

    def logs(s: Column) -> Column:
        """The sum of the logarithms of the three p-values."""
        n, df = s["n"], s["k"] - 1
        chi = s["squares"] * s["k"] / n - n
        unit = F.lit(2.0) / (9 * df)
        uneven = (F.pow(F.greatest(chi, F.lit(0.0)) / df, 1 / 3) - (1 - unit)) / F.sqrt(unit)
        tail = _two_sided(uneven) / 2
        p_chi = F.when(uneven > 0, tail).otherwise(1 - tail)
        mean = 2 * s["low"] * (n - s["low"]) / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = F.when(variance > 0, _two_sided((s["runs"] - mean) / F.sqrt(variance))).otherwise(F.lit(1e-12))
        p_serial = F.when(s["spread"] > 0, _two_sided(s["lagged"] / s["spread"] * F.sqrt(n))).otherwise(F.lit(1e-12))
        return F.log(p_chi) + F.log(p_runs) + F.log(p_serial)

    return F.transform(sums, lambda s: F.struct(
        s["start"], s["end"], s["decoy"],
        F.least(F.floor(2 * F.log2(s["n"])), F.lit(16)).cast("int").alias("band"),
        # Fisher's sum of three has six degrees of freedom, whose tail is closed.
        (F.exp(logs(s)) * (1 - logs(s) + logs(s) * logs(s) / 2)).alias("p")))


def with_decoys(tokens: Column, letters: Column) -> Column:
    """The spans, and for each a decoy of as many letters from ``letters``, the words of the text laid together.

    Text that is too short for a decoy is repeated; one without a letter gives none.
    """
    def decoy(s: Column) -> Column:
        n = F.length(F.rtrim(s["hit"], F.lit("=")))
        room = F.greatest(F.length(letters) - n, F.lit(0))
        some = F.when(room > 0, letters).otherwise(F.repeat(letters, F.ceil(n / F.length(letters)).cast("int")))
        return F.struct(s["start"], s["end"], F.substr(some, (F.pmod(s["start"], room + 1) + 1).cast("int"), n).alias("hit"),
                        F.lit(True).alias("decoy"))

    own = F.transform(tokens, lambda s: F.struct(s["start"], s["end"], s["hit"], F.lit(False).alias("decoy")))
    return F.when(F.length(letters) > 0, F.concat(own, F.transform(tokens, decoy))).otherwise(own)


def thresholds(counts: list[tuple[bool, int, int, int]]) -> dict[int, float]:
    """For each length band the lowest p-value that passes, from (decoy, band, step, tokens).

    A band without decoys takes those of all bands; without any, as many non-random tokens pass as
    the share of p-values above the threshold. A band in which no threshold keeps the share below ``FALSE`` is left out.
    """
    above: dict[tuple[bool, int | None], list[int]] = {}
    for decoy, band, step, n in counts:
        for key in ((decoy, band), (decoy, None)):
            hist = above.setdefault(key, [0] * STEPS)
            for i in range(min(step, STEPS - 1) + 1):
                hist[i] += n
    out = {}
    for band in sorted({b for d, b, _, _ in counts if not d}):
        targets = above[False, band]
        decoys = above.get((True, band)) or above.get((True, None)) or [STEPS - i for i in range(STEPS)]
        # Random tokens are spread evenly over the p-values, so twice those above one half is their number.
        natural = max(0, targets[0] - 2 * targets[STEPS // 2])
        for i in range(STEPS):
            if targets[i] and natural * decoys[i] / decoys[0] <= FALSE * targets[i]:
                out[band] = i / STEPS
                break
    return out


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base (the spans of the fixed patterns) and spans (those and the random tokens).

    Both are arrays of (start, rank, end, kind) by start. A random token that overlaps a span of a pattern is not added.
    A null text counts as empty. Repeated rows and null ids each keep a row; other columns are not looked at;
    an empty table gives an empty one.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = add_spans(rows, "text", {
        "assign": (ASSIGN, text.contains("=") | text.contains(":")),
        "access": (ACCESS, text.contains("AKIA")),
        "hex": (HEX, None),
        "token": (TOKEN, None)})
    long = F.filter("_spans_assign", lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= ASSIGN_LEAST)
    based = found.select("id", merged({"assign": long, "access": F.col("_spans_access"), "hex": F.col("_spans_hex")})
                         .alias("base"), "_spans_token", "text")
    based = based.select("*", in_blocks(F.col("base")).alias("cut"))
    based = based.select("id", "base", "text", apart_from(F.col("_spans_token"), "cut").alias("fresh"))
    letters = F.when(F.size("fresh") > 0, F.regexp_replace("text", LONG_OR_OTHER, "")).otherwise("")
    based = based.select("id", "base", "fresh", letters.alias("letters"))
    based = based.select("id", "base", with_decoys(F.col("fresh"), F.col("letters")).alias("drawn"))
    rows = materialise(based.select("id", "base", tested(F.col("drawn")).alias("tokens")))
    counts = (rows.select(F.inline("tokens")).groupBy(
        "decoy", "band", F.least(F.floor(F.col("p") * STEPS), F.lit(STEPS - 1)).cast("int").alias("step"))
        .count().collect())  # bands times steps at most
    limits = thresholds([tuple(r) for r in counts])

    def passes(s: Column) -> Column:
        out = F.lit(False)
        for band, least in limits.items():
            out = out | ((s["band"] == band) & (s["p"] >= least))
        return out & ~s["decoy"]

    random = labelled(F.filter("tokens", passes), 3, "random")
    return rows.select("id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the SHA-256 of the listed base spans and the list of all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
