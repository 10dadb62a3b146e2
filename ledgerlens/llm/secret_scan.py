"""Secrets in texts: patterns, and a battery of randomness tests.

Patterns find assigned values, access key ids and hexadecimal runs.  The
battery adds long runs of key-like characters that look like uniform random
strings.  A run's encoding is the smallest alphabet that holds it (hex,
base32, base36, base62, base64 or its URL form; runs of letters in the case
of words and runs of digits are not candidates).  Four tests of the
hypothesis "uniform over this alphabet":

* chi-squared over symbols, standardised by its exact variance at that
  length, and chi-squared over kinds of symbols;
* Wald-Wolfowitz runs of the upper and lower half of the alphabet;
* serial correlation at lag 1.

A run's p-value is four times the least of the four.  Per stratum of
lengths, Benjamini-Hochberg rejects uniformity with a false discovery rate
of ``RATE`` (p-values in steps of a twentieth of a decade); runs that are
not rejected, and that no pattern span overlaps, are secrets.  Rejections
are thus controlled to seldom dismiss a random string, alike for short and
long runs.

All of it is built-in column functions.  Positions are code points, ends
exclusive.  Nulls: a null text is empty, without spans; a null doc_id is
kept.  Repeated rows are scanned each.  An empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import spill

RATE = 0.05
LEAST = 20  # characters of a candidate
STRATA = (20, 24, 32, 48, 64, 128)

# The kinds in listed order with their patterns.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"  # maximal runs, so the same spans as shorter matches dropped
KINDS = ("assign", "access", "hex", "random")
RUN = f"[A-Za-z0-9+/_-]{{{LEAST},}}+(?:=+(?![A-Za-z0-9+/_=-]))?"  # "=" only as padding: before a run it ends a label

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (  # pattern of a run's characters, alphabet in order; the first that fits
    ("[0-9a-f]+", _DIGITS + "abcdef"),
    ("[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("[A-Z2-7]+", _UPPER + "234567"),
    ("[0-9a-z]+", _DIGITS + _LOWER),
    ("[0-9A-Z]+", _DIGITS + _UPPER),
    ("[0-9A-Za-z]+", _DIGITS + _UPPER + _LOWER),
    ("[0-9A-Za-z+/]+", _DIGITS + _UPPER + _LOWER + "+/"),
    ("[0-9A-Za-z_-]+", _DIGITS + _UPPER + _LOWER + "-_"),
)
_WORDLIKE = "[A-Z]?[a-z]+|[A-Z]+|[0-9]+"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """start, kind, end and text of the leftmost non-overlapping matches."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,text:string>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["found"].alias("text")))).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"))
    return F.when(text.rlike(pattern), F.aggregate(pairs, first, step, lambda a: a["out"])).otherwise(first["out"])


def base_spans(text: Column) -> Column:
    """Pattern spans by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 0), lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 2)) >= 12)
    access = F.filter(matches(text, ACCESS, 1), lambda m: F.length(m["text"]) >= 18)
    spans = F.concat(assign, access, matches(text, HEX, 2))
    return F.array_sort(F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Abramowitz and Stegun 26.2.17), at least 1e-300."""
    size = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * size)
    tail = F.exp(-size * size / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-300))


def _alphabet(body: Column) -> Column:
    found = F.lit(None).cast("string")
    for pattern, letters in reversed(ALPHABETS):
        found = F.when(body.rlike(f"^(?:{pattern})$"), F.lit(letters)).otherwise(found)
    return F.when(body.rlike(f"^(?:{_WORDLIKE})$"), F.lit(None).cast("string")).otherwise(found)


def _kinds(letters: Column) -> list[tuple[Column, str]]:
    """How many symbols of each kind an alphabet has, and what removes all others from a run."""
    return [(F.length(F.regexp_replace(letters, other, "")), other) for other in ("[^0-9]", "[^A-Z]", "[^a-z]", "[0-9A-Za-z]")]


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is looked at."""
    return F.element_at(F.transform(F.array(value), use), 1)


def p_value(body: Column, letters: Column) -> Column:
    """Four times the least p-value of the tests; ``body`` of at least two characters."""
    run = F.struct(body.alias("body"), letters.alias("letters"), F.length(body).cast("double").alias("n"), F.length(letters).cast("double").alias("k"))
    return _bound(run, lambda r: _p_value(r["body"], r["letters"], r["n"], r["k"]))


def _p_value(body: Column, letters: Column, n: Column, k: Column) -> Column:
    symbols = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.length(body) - F.length(F.replace(body, F.substring(letters, i, F.lit(1)), F.lit(""))))
    squares = F.aggregate(symbols, F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    z_symbols = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    total, some = F.lit(0.0), F.lit(0)
    for size, other in _kinds(letters):
        expected = n * size / k
        seen = F.length(F.regexp_replace(body, other, "")).cast("double")
        total = total + F.when(size > 0, (seen - expected) * (seen - expected) / expected).otherwise(0.0)
        some = some + F.when(size > 0, 1).otherwise(0)
    free = F.greatest(some - 1, F.lit(1)).cast("double")
    z_kinds = (F.pow(total / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))  # Wilson and Hilferty
    values = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(letters, c).cast("double") - 1)
    zero = F.lit(0.0)
    start = F.struct(F.lit(-1.0).alias("last"), zero.alias("runs"), zero.alias("high"), zero.alias("sum"), zero.alias("square"), zero.alias("product"), zero.alias("first"))

    def step(a: Column, v: Column) -> Column:
        begun = a["last"] < 0
        turned = begun | ((v >= k / 2) != (a["last"] >= k / 2))
        return F.struct(
            v.alias("last"),
            (a["runs"] + F.when(turned, 1.0).otherwise(0.0)).alias("runs"),
            (a["high"] + F.when(v >= k / 2, 1.0).otherwise(0.0)).alias("high"),
            (a["sum"] + v).alias("sum"),
            (a["square"] + v * v).alias("square"),
            (a["product"] + F.when(begun, 0.0).otherwise(v * a["last"])).alias("product"),
            F.when(begun, v).otherwise(a["first"]).alias("first"),
        )

    def finish(a: Column) -> Column:
        high, low = a["high"], n - a["high"]
        mean = 2 * high * low / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when(spread > 0, (a["runs"] - mean) / F.sqrt(spread)).otherwise(37.0)  # one half only
        middle = a["sum"] / n
        power = a["square"] - n * middle * middle
        lagged = a["product"] - middle * (2 * a["sum"] - a["first"] - a["last"]) + (n - 1) * middle * middle
        z_serial = F.when(power > 1e-9, (lagged / power + 1 / n) * F.sqrt(n)).otherwise(37.0)
        two_sided = [F.least(2 * upper_tail(F.abs(z)), F.lit(1.0)) for z in (z_runs, z_serial)]
        return F.least(F.lit(1.0), 4 * F.least(upper_tail(z_symbols), upper_tail(z_kinds), *two_sided))

    return F.aggregate(values, start, step, finish)


def candidates(text: Column) -> Column:
    """start, end, p and length stratum of the runs that have an encoding."""

    def trimmed(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.regexp_replace(m["text"], "=+$", "").alias("body"))

    def encoded(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["body"].alias("body"), F.length(m["body"]).alias("length"), _alphabet(m["body"]).alias("letters"))

    def tested(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["length"].alias("length"), p_value(m["body"], m["letters"]).alias("p"))

    runs = F.transform(F.transform(matches(text, RUN, 3), trimmed), encoded)
    return F.transform(F.filter(runs, lambda m: (m["length"] >= LEAST) & m["letters"].isNotNull()), tested)


def stratum(length: Column) -> Column:
    at = F.lit(0)
    for k, least in enumerate(STRATA):
        at = F.when(length >= least, k).otherwise(at)
    return at


def rejected_below(scanned: DataFrame, rate: float = RATE) -> dict[int, float]:
    """Per stratum, the largest p-value at which uniformity is rejected; from counts in steps of p."""
    one = scanned.select(F.explode("candidates").alias("c")).select(stratum(F.col("c.length")).alias("k"), F.ceil(F.log10("c.p") * 20).alias("step"))
    counts = one.groupBy("k", "step").agg(F.count("*").alias("n")).collect()  # strata times 6,000 rows at most
    out = {}
    for k in {r["k"] for r in counts}:
        rows = sorted((r["step"], r["n"]) for r in counts if r["k"] == k)
        total, below = sum(n for _, n in rows), 0
        for step, n in rows:
            below += n
            if 10 ** (step / 20) * total <= rate * below:
                out[k] = 10 ** (step / 20)
    return out


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``base`` (pattern spans) and ``spans`` (all), arrays of start, kind (place in KINDS) and end."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_scanned"))
    rows = spill(rows.select(*keep, base_spans(F.col("_scanned")).alias("base"), candidates(F.col("_scanned")).alias("candidates")), "secret-candidates")
    limits = rejected_below(rows)

    def random(c: Column) -> Column:
        limit = F.lit(0.0)
        for k, p in sorted(limits.items()):
            limit = F.when(stratum(c["length"]) == k, p).otherwise(limit)
        return (c["p"] > limit) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    extra = F.transform(F.filter("candidates", random), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return rows.select(*keep, "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
