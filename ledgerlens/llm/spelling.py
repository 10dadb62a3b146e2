"""Spelling variants of a corpus' words, by reduced alphabets.

Letters are hashed to a few symbols, so a word becomes a short sequence
over a small alphabet, with few one-edit neighbours:

1. Vocabulary.  Tasks count the words of whole texts; Spark adds up.
2. Reduction.  Every letter is replaced by one of ``symbols`` symbols; a
   reduced word is a 64-bit polynomial of its symbols.
3. Neighbourhoods.  All reduced words within one insertion, deletion or
   replacement of a word's own reduced one are generated from prefix and
   suffix polynomials.  If two words differ by one edit, so do their
   reductions, or these are equal.  A bitmap of the reduced vocabulary (of
   bounded size) drops most neighbours that no word has; of two different
   reduced words, only the one with the lesser number sends.
4. Join with the vocabulary on the reduced word.
5. Verification of the original strings: an edit distance of exactly one.

A word's form is its near word with the greatest count (ties: the smallest
in code-point order), if that is at least ``ratio`` times its own; roots
follow forms to their end by doubling the steps.

Nulls: a null text has no words; a null doc_id counts as the empty text.
Repeated rows count each.  Very long words take part whole.  An empty
table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, bitmap, column, in_bitmap, spill, text_slices
from ledgerlens.llm.hashing import U, mix

LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS = 8
SLICE_CHARS = 2_000_000
HELD_WORDS = 300_000  # counted before they are sent on
SLICE_KEYS = 1_000_000  # neighbours generated at a time
FILTER_BITS = 27  # of the bitmap, at most: 16 MB
RATIO = 5

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words(text: str, min_length: int) -> list[bytes]:
    """The maximal runs of letters of at least ``min_length`` code points, A-Z in lower case."""
    found = re.findall(f"[{LETTERS}]{{{min_length},}}", text)
    return "\n".join(found).encode().lower().split(b"\n") if found else []


def slip(word: bytes, h: int) -> bytes:
    """``word`` without its code point at ``h`` modulo its length."""
    w = word.decode()
    return (w[: h % len(w)] + w[h % len(w) + 1 :]).encode()


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, slips: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of at least ``min_length`` code points and ``min_count`` occurrences.

    With ``slips``, every word of a document whose crc32 of ``<doc_id>:<word>`` that number divides loses one letter first.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def send(held: Counter) -> pa.RecordBatch:
        return arrow_rows(schema, [pa.array(list(held), pa.binary()).cast(pa.string()), list(held.values())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            for key, x in zip(column(part, "id").to_pylist(), texts, strict=True):
                found = words(x, min_length)
                if slips and found:
                    h = np.fromiter(map(zlib.crc32, found, repeat(zlib.crc32(f"{key}:".encode()))), np.uint32, len(found))
                    for i in np.flatnonzero(h % np.uint32(slips) == 0).tolist():
                        found[i] = slip(found[i], int(h[i]))
                held.update(found)
                if len(held) > HELD_WORDS:
                    yield send(held)
                    held = Counter()
        if held:
            yield send(held)

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").filter(F.length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def symbols_of(word_rows: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words one after another (1 and up), and the words' lengths."""
    flat = np.frombuffer("".join(word_rows).encode("utf-32-le"), "<u4").astype(np.uint64)
    letter = mix(flat, np.zeros_like(flat)) % U(symbols) + U(1)
    return letter, np.array([len(w) for w in word_rows], np.int64)


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n + 1, base, U)
    out[0] = 1
    return np.cumprod(out)


def _ends(a: np.ndarray, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomials of every beginning (m x L+1) and every end (m x L+1) of equally long words."""
    m, length = a.shape
    begin, end = np.zeros((2, m, length + 1), U)
    end[:, :-1] = np.cumsum((a * powers[:length][::-1])[:, ::-1], axis=1)[:, ::-1]  # place i weighs B^(L-1-i)
    begin[:, 1:] = np.cumsum(a * _powers(length, _INVERSE)[:length], axis=1) * powers[:length]  # B is odd
    return begin, end


def reduced(a: np.ndarray) -> np.ndarray:
    """Numbers of equally long reduced words."""
    powers = _powers(a.shape[1])
    total = (a * powers[: a.shape[1]][::-1]).sum(axis=1, dtype=U)
    return mix(total, np.full(len(a), a.shape[1], U))


def neighbours(a: np.ndarray, symbols: int, block: int = SLICE_KEYS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) of all reduced words within one edit of each of equally long ones, their own included; may repeat."""
    m, length = a.shape
    powers = _powers(length + 1)
    begin, end = _ends(a, powers)
    rows = np.arange(m)
    yield rows, mix(end[:, 0], np.full(m, length, U))
    step = max(1, block // max(1, m * symbols))
    alphabet = np.arange(1, symbols + 1, dtype=U)
    for at in range(0, length + 1, step):
        places = np.arange(at, min(at + step, length + 1))
        inner = places[places < length]
        made = []
        if len(inner) and length > 1:  # deletions
            made.append((begin[:, inner] * powers[length - 1 - inner] + end[:, inner + 1], length - 1))
        if len(inner):  # replacements
            kept = begin[:, inner] * powers[length - inner] + end[:, inner + 1]
            made.append((kept[:, :, None] + alphabet * powers[length - 1 - inner][:, None], length))
        shifted = begin[:, places] * powers[length + 1 - places] + end[:, places]  # insertions
        made.append((shifted[:, :, None] + alphabet * powers[length - places][:, None], length + 1))
        for number, n in made:
            number = number.reshape(m, -1)
            yield np.repeat(rows, number.shape[1]), mix(number.ravel(), np.full(number.size, n, U))


def _by_length(word_rows: list[str], symbols: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, symbols) of the words of one length at a time, in parts of bounded size."""
    letter, lengths = symbols_of(word_rows, symbols)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == length)
        step = max(1, block // (max(1, length) * (2 * symbols + 1)))
        for at in range(0, len(same), step):
            part = same[at : at + step]
            yield part, letter[starts[part][:, None] + np.arange(length)]


def reduce_words(counted: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, r (the number of the reduced word)."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("r", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "word", SLICE_CHARS):
            r = np.zeros(len(texts), U)
            for at, a in _by_length(texts, symbols, SLICE_KEYS):
                r[at] = reduced(a)
            yield arrow_rows(schema, [column(part, "word"), column(part, "n"), r.view(np.int64)])

    return counted.select("word", "n").mapInArrow(run, "word string, n long, r long")


def near_words(known: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, other, m: the pairs of words of ``known`` (word, n, r) that differ by exactly one edit, each once."""
    schema = pa.schema([("key", pa.int64()), ("own", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])
    there = bitmap(known, "r", FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "word", SLICE_CHARS):
            own = np.asarray(column(part, "r"))
            for at, a in _by_length(texts, symbols, SLICE_KEYS):
                found = []
                for who, key in neighbours(a, symbols):
                    key = key.view(np.int64)
                    keep = key >= own[at][who]
                    who, key = who[keep], key[keep]
                    keep = in_bitmap(key, there)
                    found.append(np.stack([at[who[keep]], key[keep]], axis=1))
                found = np.unique(np.concatenate(found), axis=0)  # several edits may give one neighbour
                who = pa.array(found[:, 0])
                yield arrow_rows(schema, [found[:, 1].copy(), found[:, 1] == own[found[:, 0]], column(part, "word").take(who), column(part, "n").take(who)])

    sent = known.select("word", "n", "r").mapInArrow(run, "key long, own boolean, word string, n long")
    others = known.select(F.col("r").alias("key"), F.col("word").alias("other"), F.col("n").alias("m"))
    once = ~F.col("own") | (F.col("word") < F.col("other"))  # words of equal reductions meet twice
    return sent.join(others, "key").filter(once & (F.levenshtein("word", "other", 1) == 1)).select("word", "n", "other", "m")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms; ``forms``: word, form (never null, without cycles)."""
    steps = spill(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("after"))
        joined = steps.join(after, "root", "left").select("word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved"))
        joined = spill(joined, "forms")
        steps = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return steps


def group_variants(counted: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``counted`` (word, n; each word once)."""
    known = spill(reduce_words(counted, symbols), "vocabulary")
    pairs = spill(near_words(known, symbols), "near-words")
    both = pairs.union(pairs.select("other", "m", "word", "n"))
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    often = -F.col("best.less") >= ratio * F.col("n")
    near = spill(near.select("word", "n_near", F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")), "word-forms")
    ends = roots(near.filter("form is not null"))
    joined = known.select("word", "n").join(near, "word", "left").join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
