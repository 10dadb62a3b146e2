"""URL filter: host and path rules, and a character language-model ratio for the rest.

URLs that a rule allows or blocks teach two Markov models of variable
order: a character's probability after its last three characters is
interpolated with those after two, one and none (Witten-Bell), so a context
that was never seen falls back to the shorter one.  Characters map to 42
symbols (letters, one symbol for digits, the marks of URLs, one for all
else, start, end), which bounds the counts to 42^4 per model whatever the
input.  A URL without a rule is allowed if the difference of both models'
log-likelihoods per symbol reaches a cut.  The cut is calibrated on one
fifth of the ruled URLs (by crc32), which the models have not seen: it has
the best mean of both classes' accuracies, ties to the smaller, and lies in
the middle of the gap between the scores that it parts.

Nulls: a null url, or one without ``://``, has an empty host and path, no
rule, and is scored as its text (null: empty).  With no ruled URL of one
kind the ratio is 0 and the cut 0: all others are allowed.  Repeated rows
count as often as they stand.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, ascii_lower, column, spill, text_slices

ORDER = 3
MARKS = "/.-_?=&%:#~+"
START, END, OTHER, DIGIT = 0, 1, 2, 3
SYMBOLS = 4 + 26 + len(MARKS)
SLICE_CHARS = 2_000_000
STEP, LIMIT = 0.01, 8.0  # of the calibration's histogram

_OF_BYTE = np.full(256, OTHER, np.int32)
_OF_BYTE[ord("0") : ord("9") + 1] = DIGIT
for _k in range(26):
    _OF_BYTE[[ord("a") + _k, ord("A") + _k]] = 4 + _k
for _k, _c in enumerate(MARKS):
    _OF_BYTE[ord(_c)] = 30 + _k

Rule = tuple[str, str]  # ("allow" or "block", host/path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text; null if none."""
    found = F.lit(None).cast("string")
    for _, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def symbols(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of (context, symbol) for every symbol of every URL, and their number for each."""
    data = [x.partition("://")[2] or x for x in urls]
    data = [x.encode("utf-8", "replace") for x in data]
    counts = np.array([len(x) + 1 for x in data], np.int64)
    ends = np.cumsum(counts + ORDER)
    flat = np.full(int(ends[-1]) if len(ends) else 0, START, np.int64)
    within = np.ones(len(flat), bool)
    for k in range(ORDER):
        within[ends - counts - ORDER + k] = False
    text = within.copy()
    text[ends - 1] = False
    flat[text] = _OF_BYTE[np.frombuffer(b"".join(data), np.uint8)]
    flat[ends - 1] = END
    index = flat.copy()
    for k in range(1, ORDER + 1):
        index[k:] += flat[:-k] * SYMBOLS**k
    return index[within], counts


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Interpolated log-probabilities of every (context, symbol) from dense counts."""
    known = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        n = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0).astype(np.float64)
        kinds = (n > 0).sum(axis=1, keepdims=True)
        total = n.sum(axis=1, keepdims=True) + kinds
        shorter = np.tile(known.reshape(-1, SYMBOLS), (n.shape[0] // max(1, known.size // SYMBOLS), 1))
        known = np.where(total > 0, (n + kinds * shorter) / np.maximum(total, 1), shorter)
    return np.log(known).ravel()


def ratio_scorer(ratio: np.ndarray, keep: Sequence[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, urls in text_slices(batches, "url", SLICE_CHARS):
            index, n = symbols(urls)
            score = np.add.reduceat(ratio[index], np.cumsum(n) - n).astype(np.float64) / n
            yield arrow_rows(schema, [*(column(part, c) for c in keep), score])

    return run


def judge(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, ratio (the method's score) and cut for every row."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path}).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.lit(None).cast("string")
    for verdict, text in rules:
        said = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(said)
    rows = spill(rows.withColumns({"said": said, "kept_back": F.crc32(F.coalesce("url", F.lit("")).cast("binary")) % 5 == 0}), "url-rules")

    counted = pa.schema([("said", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, urls in text_slices(batches, "url", SLICE_CHARS):
            kinds = np.array(column(part, "said").to_pylist())
            for kind in ("allow", "block"):
                if (of := np.flatnonzero(kinds == kind)).size:
                    cell, n = np.unique(symbols([urls[i] for i in of.tolist()])[0], return_counts=True)
                    yield arrow_rows(counted, [[kind] * len(cell), cell, n])

    ruled = rows.filter("said is not null").select("url", "said", "kept_back")
    cells = ruled.filter("not kept_back").mapInArrow(count, "said string, cell long, n long").groupBy("said", "cell").agg(F.sum("n").alias("n"))
    tables = {kind: np.zeros(SYMBOLS ** (ORDER + 1), np.int64) for kind in ("allow", "block")}
    for kind, got in tables.items():
        seen = cells.filter(F.col("said") == kind).toPandas()  # at most SYMBOLS^4 rows
        got[seen["cell"].to_numpy()] = seen["n"].to_numpy()
    if all(x.any() for x in tables.values()):
        ratio = (log_probabilities(tables["allow"]) - log_probabilities(tables["block"])).astype(np.float32)
    else:
        ratio = np.zeros(SYMBOLS ** (ORDER + 1), np.float32)

    held = ruled.filter("kept_back").select("said", "url").mapInArrow(ratio_scorer(ratio, ["said"], pa.schema([("said", pa.string()), ("ratio", pa.float64())])), "said string, ratio double")
    step = F.floor(F.least(F.greatest("ratio", F.lit(-LIMIT)), F.lit(LIMIT)) / STEP)
    cut = best_cut([(r["said"], r["step"], r["n"]) for r in held.groupBy("said", step.alias("step")).agg(F.count("*").alias("n")).collect()])
    fields = [f for f in rows.schema if f.name in ("page_id", "host", "path", "rule", "said")]
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DoubleType, StructField, StructType

    out = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in fields), ("ratio", pa.float64())])
    scored = rows.select(*[f.name for f in fields], "url").mapInArrow(ratio_scorer(ratio, [f.name for f in fields], out), StructType([*fields, StructField("ratio", DoubleType())]))
    verdict = F.coalesce("said", F.when(F.col("ratio") >= cut, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "ratio", F.lit(cut).alias("cut"))


def best_cut(histogram: list[tuple[str, int, int]]) -> float:
    """The score from which on URLs are allowed: amid the gap between the steps that it parts."""
    total = {kind: sum(n for k, _, n in histogram if k == kind) for kind in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    steps = sorted({s for _, s, _ in histogram})
    best, at, below = -1.0, 0.0, {"allow": 0, "block": 0}
    for before, s in zip([steps[0] - 1, *steps], [*steps, steps[-1] + 1], strict=True):
        share = (1 - below["allow"] / total["allow"] + below["block"] / total["block"]) / 2
        if share > best + 1e-12:
            best, at = share, (before + 1 + s) / 2 * STEP
        for k, other, n in histogram:
            if other == s:
                below[k] += n
    return at
