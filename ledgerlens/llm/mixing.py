"""Mixing of sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; a cell's weight in
tokens is raked to the marginal shares wanted for each of the three, one
after another, in a fixed number of sweeps.  Cells are a table and each
sweep a few aggregations over it, so neither sources nor cells meet at the
driver.  Targets are tempered shares (share^``temper``, rescaled) unless a
table of shares is given.  A document's probability is its cell's raked
weight per token over the greatest of any cell, and it is kept if a number
in [0, 1) from the md5 of its id lies below: expected tokens have the raked
marginals, and a rerun keeps the same documents.  With a ``budget`` (share of
the tokens to keep) the probability is the weight times a common factor, 1 at
most, and the factor is such that the expected tokens are the budget: rare
cells are kept whole, and no single cell sets the rate of the others.

Topics are the first rule that a text meets, else "general".  Tokens are
runs without ASCII white space.

Nulls: a null source, language or text counts as the value "" (a text
without tokens); a null doc_id as the id "".  Texts without tokens have
their cell's probability, cells without any tokens probability 1.  Rows
that share an id are kept or dropped alike within a cell.  An empty table
gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import spill

WORD = r"[^\x20\x09-\x0D]+"
TOPICS = (("licence", "[Ll]icen[cs]e|[Cc]opyright"), ("tables", r" \| "), ("contacts", "@|[0-9]{3}[- ][0-9]{4}"), ("numbers", "[0-9]{4}"))
DIMENSIONS = ("source", "lang", "topic")
TEMPER = 0.9
SWEEPS = 8


def topic_of(text: Column, rules: Sequence[tuple[str, str]] = TOPICS) -> Column:
    found = F.lit("general")
    for name, pattern in reversed(rules):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def tempered(cells: DataFrame, dimension: str, temper: float) -> DataFrame:
    """(value, target): shares of the tokens, tempered."""
    totals = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("t")).filter("t > 0")
    whole = totals.agg(F.sum("t").alias("whole"))
    return totals.join(F.broadcast(whole)).select(dimension, (F.col("t") / F.col("whole")).alias("target"))  # one row


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Cells with ``raked``, their share after the sweeps; ``targets`` has (value, target) per dimension."""
    for name, shares in targets.items():
        cells = cells.join(shares.withColumnRenamed("target", f"target_{name}"), name)
    cells = spill(cells.withColumn("raked", F.col("tokens").cast("double")), "mixing-cells")
    for _ in range(sweeps):
        for name in targets:
            sums = cells.groupBy(name).agg(F.sum("raked").alias("now"))
            cells = cells.join(sums, name).withColumn("raked", F.col("raked") * F.col(f"target_{name}") / F.col("now")).drop("now")
        cells = spill(cells, "mixing-cells")
    return cells


def budget_factor(weights: DataFrame, budget: float) -> float:
    """The factor at which tokens * least(1, factor * weight) sum to the share ``budget`` of the tokens.

    Newton steps from below, an aggregation to one row each: cells that are whole stay so, and it ends when no more become so.
    """
    factor, known = 0.0, -1
    while True:
        whole = F.col("weight") * factor >= 1
        spread = F.when(whole, 0.0).otherwise(F.col("tokens") * F.col("weight"))
        total, full, open_, n = weights.agg(F.sum("tokens"), F.sum(F.when(whole, F.col("tokens")).otherwise(0)), F.sum(spread), F.count_if(whole)).first()
        if n == known or not open_:
            return factor
        factor, known = max(factor, (budget * total - full) / open_), n


def mix(docs: DataFrame, keep: list[str], targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, sweeps: int = SWEEPS, budget: float | None = None) -> DataFrame:
    """The columns ``keep`` with topic, n_tokens, weight (tokens wanted per token there is), probability and selected."""
    text = F.coalesce("text", F.lit(""))
    kept = F.struct(*keep).alias("kept")
    value = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")]
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    rows = docs.select(kept, *value, topic_of(text).alias("topic"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"), draw.alias("draw"))
    rows = spill(rows, "mixing-documents")
    cells = spill(cells_of(rows), "mixing-cells")
    wanted = cells.filter("tokens > 0")
    raked = rake(wanted, targets or {d: tempered(wanted, d, temper) for d in DIMENSIONS}, sweeps)
    total = wanted.agg(F.sum("tokens").alias("total"))
    weights = raked.join(F.broadcast(total)).select(*DIMENSIONS, "tokens", (F.col("raked") * F.col("total") / F.col("tokens")).alias("weight"))
    if budget is None:
        weights = weights.join(F.broadcast(weights.agg(F.max("weight").alias("most"))))
        rate = F.col("weight") / F.col("most")
    else:
        weights = spill(weights, "mixing-cells")
        rate = F.least(F.lit(1.0), F.col("weight") * budget_factor(weights, budget))
    weights = spill(weights.select(*DIMENSIONS, F.round("weight", 9).alias("weight"), F.round(rate, 9).alias("probability")), "mixing-weights")
    found = rows.join(weights, list(DIMENSIONS), "left")
    probability = F.coalesce("probability", F.lit(1.0))
    return found.select("kept.*", F.col("topic"), "n_tokens", F.coalesce("weight", F.lit(1.0)).alias("weight"), probability.alias("probability"), (F.col("draw") < probability).alias("selected"))


def sql(temper: float = TEMPER, sweeps: int = SWEEPS) -> str:
    """The same over the table documents, for DuckDB."""
    rules = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps, last = [], "start"
    for k in range(sweeps):
        for d in DIMENSIONS:
            name = f"rake_{k}_{d}"
            steps.append(f"{name} AS MATERIALIZED (SELECT c.* EXCLUDE (raked), raked * target_{d} / sum(raked) OVER (PARTITION BY {d}) AS raked FROM {last} c)")
            last = name
    shares = ", ".join(f"share_{d} AS (SELECT {d}, t / sum(t) OVER () AS target_{d} FROM (SELECT {d}, pow(sum(tokens), {temper}) AS t FROM cells GROUP BY {d}))" for d in DIMENSIONS)
    return f"""
WITH rows AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE {rules} ELSE 'general' END AS topic, CAST(len(regexp_extract_all(t, '{WORD}')) AS BIGINT) AS n_tokens,
    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS draw
  FROM (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents)
), cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0),
{shares},
start AS MATERIALIZED (SELECT *, tokens AS raked FROM cells JOIN share_source USING (source) JOIN share_lang USING (lang) JOIN share_topic USING (topic)),
{", ".join(steps)},
weights AS (SELECT source, lang, topic, raked * sum(tokens) OVER () / tokens AS w FROM {last}),
final AS (SELECT source, lang, topic, round(w, 9) AS weight, round(w / max(w) OVER (), 9) AS probability FROM weights)
SELECT doc_id, source, lang, topic, n_tokens, coalesce(weight, 1.0) AS weight, coalesce(probability, 1.0) AS probability, draw < coalesce(probability, 1.0) AS selected
FROM rows LEFT JOIN final USING (source, lang, topic)
"""
