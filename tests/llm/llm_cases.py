"""Small tables with the awkward rows that every operator must take."""
import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row STRING, score STRING, shard STRING, length STRING, block STRING, n STRING, s STRING"


def edge_rows(seed=3, n=40):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Thing", "café", "naïve", "x1", "long-er", "re,", "so.", "été", "日本", "and", "to", "in"]
    texts = [" ".join(rnd.choice(vocabulary) + rnd.choice(["", "", "s", "!"]) for _ in range(rnd.randint(1, 60))) for _ in range(n)]
    texts += [None, "", " ", "\n", "a", " lead", "trail ", "two  spaces and\ttab \n line", "\x1c odd \x85 space\xa0end", "it's <|endoftext|> in <|endoftext|>", "no spaces" * 400, "x " * 3000, "ÀÉ İ ﬁ e\u0301", "one two three four", "one two three four five"]
    rows = [(i, t, rnd.choice(["en", "fr", None]), rnd.choice(["a", "a", "a", "b", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (3, "another text of a known id", "en", "a", 26), (None, "a text without id", "en", "b", 17), (None, None, None, None, None)]
    return rows


def frame(spark, rows, parts=3):
    """With extra columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, *["z"] * 7) for r in rows], SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
