"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame, and their DuckDB statements."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import fingerprints, jaccard_join, kneser_ney, mixing, packing, periodic, pivot_index, secret_scan, spelling, token_files, topk_search, toxicity, url_filter
from ledgerlens.llm.common import crc_mod, table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=1, split="drop")
    return token_files.with_crc(token_files.read_token_files(files))


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs, crc_mod("doc_id", 5) != 1, order=2)
    return kneser_ney.score(docs, model, crc_mod("doc_id", 5) == 1)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=0, capacity=2048, split="lead")
    return packing.pack(parts, capacity=2048)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    scored = toxicity.score(docs.withColumn("held_out", crc_mod("doc_id", 4) == 2), model, 0.3, ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("sentences").alias("n_sentences"), F.array_max("sentences.score").alias("worst_sentence"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    kinds = F.col("base.kind")
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *count, F.sha2(secret_scan.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5, lambda x: F.floor(x * 256.0))
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


OP7_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumns({c: F.coalesce(c, F.lit("")) for c in ("source", "lang")})
    return mixing.mix(docs, ["doc_id", "source", "lang"])


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.marked_edits(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents"))[0]


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.vocabulary(table(spark, sf_dir, "documents"), min_length=6, min_count=5, slips=199)
    return spelling.group_variants(counted, ratio=5)


def _sql_bytes(text: str) -> str:
    """The bytes of a text as a list of numbers."""
    return f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: CAST(concat('0x', substr(hex(encode({text})), 2 * i - 1, 2)) AS BIGINT))"


def _sql_crc32(numbers: str) -> str:
    """crc32 of a list of bytes: each byte is followed by eight shifts, written as -1."""
    steps = f"list_prepend(4294967295, flatten(list_transform({numbers}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])))"
    return f"xor(list_reduce({steps}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"


_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = "".join(chr(c) for c in range(0x20, 0x7F) if chr(c) not in "abcdefghijklmnopqrstuvwxyz'")[: len(_ACCENTED)]

OP11_SQL = f"""
WITH RECURSIVE spelled AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z{_ACCENTED}]+')) AS w FROM documents WHERE text IS NOT NULL
), lowered AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM spelled WHERE length(w) >= 6
), counted AS (
  SELECT doc_id, w, count(*) AS times, concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', w) AS name FROM lowered GROUP BY doc_id, w
), hashed AS (
  SELECT w, times, {_sql_crc32(_sql_bytes("name"))} AS h FROM counted
), slipped AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word FROM hashed
), vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), single AS (
  SELECT word, n, translate(word, '{_ACCENTED}', '{_STAND_INS}') AS s FROM vocabulary
), shorter AS (
  SELECT DISTINCT word, n, s, unnest(list_transform(range(0, length(s) + 1), lambda i: CASE WHEN i = 0 THEN s ELSE concat(substr(s, 1, i - 1), substr(s, i + 1)) END)) AS d FROM single
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM shorter a JOIN shorter b ON a.d = b.d AND a.word <> b.word WHERE levenshtein(a.s, b.s) = 1
), ranked AS (
  SELECT word, n, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS place FROM near
), formed AS (
  SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= 5 * v.n THEN r.other END AS form, CASE WHEN r.m >= 5 * v.n THEN r.m END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND r.place = 1
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at WHERE e.form IS NULL
"""


def op12_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_index.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)[0]
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


OP12_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), good AS (
  SELECT r, vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM rows_
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r, b.r AS other FROM good a JOIN good b ON a.r <> b.r WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.95
), reach AS (
  SELECT r, r AS other FROM rows_ UNION SELECT e.r, l.other FROM reach e JOIN links l ON l.r = e.other
), named AS (
  SELECT e.r, min(o.vec_id) AS component_id FROM reach e JOIN rows_ o ON o.r = e.other GROUP BY e.r
), counted AS (SELECT r, count(*) AS n FROM links GROUP BY r)
SELECT x.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, n.component_id, coalesce(x.vec_id = n.component_id, FALSE) AS kept
FROM rows_ x JOIN named n ON n.r = x.r LEFT JOIN counted c ON c.r = x.r
"""


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's order of a tenth of the documents: from word a on, the text goes round after p words."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), planted_period)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.withColumn("best", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP13_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_sql_crc32(_sql_bytes("coalesce(CAST(doc_id AS VARCHAR), '')"))} AS h FROM documents
), planted AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM split
), ordered AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM planted
), words AS (
  SELECT r, n, unnest(range(0, n)) AS i, unnest(list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END)) AS w FROM ordered
), again AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM again
), stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON g.r = w.r AND g.i = w.i GROUP BY w.r
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS text,
    arg_min(struct_pack(start := start, length := length, period := period), struct_pack(l := -length, s := start, p := period)) AS best
  FROM runs GROUP BY r
)
SELECT s.doc_id, CAST(coalesce(l.n_runs, 0) AS BIGINT) AS n_runs, CAST(l.best.start AS BIGINT) AS start, CAST(l.best.length AS BIGINT) AS length, CAST(l.best.period AS BIGINT) AS period,
  CAST(1000 * l.best.length // l.best.period AS BIGINT) AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM split s LEFT JOIN listed l ON l.r = s.r LEFT JOIN kept k ON k.r = s.r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_url_filter": op2_url_filter,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scan": op6_secret_scan,
    "op7_topk_search": op7_topk_search,
    "op8_source_mixing": op8_source_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_pivot_index": op12_pivot_index,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op7_topk_search": OP7_SQL,
    "op8_source_mixing": mixing.sql(),
    "op11_spelling_variants": OP11_SQL,
    "op12_pivot_index": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
