"""Toxicity of documents by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is logistic in
its distinct words and their beginnings (inflected and compounded forms
share these), a document's is the noisy-or of its sentences: 1 - prod(1 - p).
Only documents carry labels; the gradient of their log-loss reaches the
words through the noisy-or, so the model learns which sentences made a
document toxic, and names them.

Sentences end at ``. ! ?`` and line ends; words are lower-cased and end at
white space and ASCII marks.  The fit uses at most ``max_documents``
labelled documents, chosen by a hash of the id (a documented bound; whole
texts), and runs in one task, which keeps numbers of words only; features
in fewer than ``min_documents`` of them are left out.  Scores cover every
text whole and never use ids, sources, languages or labels.  A document
that reaches the cut names the likeliest sentences that make up ``SHARE``
of its score.

Nulls: a null text is empty; an empty text has one sentence without words
and gets the model's base probability.  Null labels don't train.  Documents
that are repeated are scored each.  With no label of one kind all scores
are 0 (no toxic ones known) or 1.  Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, give_back, text_slices, use_only

MAX_DOCUMENTS = 8000
SHARE = 0.75  # of a document's log(1 - score) that the located sentences make up
BEGINNINGS = (4, 5, 6, 7, 8)  # characters
MIN_DOCUMENTS = 4
SLICE_CHARS = 2_000_000
WORDS_KEPT = 300_000  # of a worker's memory; results don't depend on it
FIT_WORDS = 500_000  # looked at together in a step of the fit, but for one longer sentence; results don't depend on it
STEPS = 300
RATE = 0.08
DECAY = 2e-4
SPARSE = 1.5e-4  # pull of a weight to zero

_BREAK = "\x01"
_SENTENCE = re.compile(r"[^.!?\n\r]+")
_MARKS = {i: " " for i in range(128) if not chr(i).isalnum()} | {ord(c): f" {_BREAK} " for c in ".!?\n\r"}
_MARKS[ord("ς")] = "σ"  # lower() writes a sigma by what follows it, be it the next sentence


@dataclass(frozen=True)
class Model:
    base: float
    weights: dict[str, float]  # of features; others have none

    def of_words(self) -> "WordWeights":
        return WordWeights(self.weights)


class WordWeights(dict):
    """What a word adds to its sentence: its weight and those of its beginnings."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > WORDS_KEPT:
            self.clear()
        found = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return found


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def words(text: str) -> list[str]:
    """The words of a text, with a mark where a sentence ends."""
    return text.lower().translate(_MARKS).split()


class Bags:
    """Labelled documents as numbers: which distinct words each sentence has, and which sentences each document."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.sentence_words, self.sizes = array("i"), array("i")  # words of all sentences, how many each has
        self.sentences, self.labels = array("i"), array("b")  # per document

    def add(self, text: str, label: int) -> None:
        number, before = self.number, len(self.sizes)
        bag: set[int] = set()
        for w in [*words(text), _BREAK]:
            if w == _BREAK:
                self.sentence_words.extend(sorted(bag))
                self.sizes.append(len(bag))
                bag.clear()
            else:
                bag.add(number.setdefault(w, len(number)))
        self.sentences.append(len(self.sizes) - before)
        self.labels.append(label)


def fit(bags: Bags, min_documents: int = MIN_DOCUMENTS, steps: int = STEPS) -> Model:
    """Gradient steps on the noisy-or; the features that ``min_documents`` documents have, all of them."""
    labels = np.array(bags.labels, float)
    if not len(labels) or labels.min() == labels.max():
        return Model(30.0 if len(labels) and labels.min() else -30.0, {})
    word, sizes = np.asarray(bags.sentence_words), np.asarray(bags.sizes)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    document = np.repeat(np.arange(len(labels), dtype=np.int32), np.array(bags.sentences))
    n, kinds = len(document), len(bags.number)
    hashes, counts = array("Q"), array("b")  # of each word's features
    for w in bags.number:  # in the order of the numbers
        found = features(w)
        hashes.extend(xxhash.xxh3_64_intdigest(f) for f in found)
        counts.append(len(found))
    _, feature = np.unique(np.asarray(hashes), return_inverse=True)
    feature, counts = feature.astype(np.int32), np.array(counts, np.int64)
    del hashes
    first = np.cumsum(counts) - counts
    seen = np.zeros(int(feature.max()) + 1, np.int32)  # documents
    ends = np.searchsorted(sentence, np.searchsorted(document, np.arange(len(labels) + 1)))
    for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False):
        own = np.unique(word[a:b])
        size = counts[own]
        at = np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        seen[np.unique(feature[at])] += 1
    keep = seen[feature] >= min_documents
    kept = np.flatnonzero(seen >= min_documents)
    feature = (np.cumsum(seen >= min_documents, dtype=np.int32) - 1)[feature[keep]]
    of_word = np.repeat(np.arange(kinds, dtype=np.int32), counts)[keep]
    parts = _parts(np.cumsum(sizes, dtype=np.int64), FIT_WORDS)
    z = np.empty(n)
    weights, base = np.zeros(len(kept)), -5.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        added = np.bincount(of_word, weights[feature], minlength=kinds)  # by each word
        for s, t, a, b in parts:
            z[s:t] = np.bincount(sentence[a:b] - s, added[word[a:b]], minlength=t - s)
        p = 1 / (1 + np.exp(-base - z))
        none = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(labels))
        whole = np.maximum(-np.expm1(none), 1e-12)
        pull = np.where(labels[document] > 0, -(np.exp(none) / whole)[document], 1.0) * p / len(labels)
        by_word = np.zeros(kinds)
        for _, _, a, b in parts:
            np.add.at(by_word, word[a:b].astype(np.intp), pull[sentence[a:b]])  # in the order of the words, as in one sum
        grad = np.append(np.bincount(feature, by_word[of_word], minlength=len(kept)) + DECAY / 10 * weights, pull.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        base -= move[-1]
        strength = RATE * SPARSE / (np.sqrt(v[:-1] / (1 - 0.99**step)) + 1e-6)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - strength, 0)
    names: dict[str, float] = {}
    at = np.flatnonzero(keep)
    for w, begin in zip(bags.number, first.tolist(), strict=True):
        found = features(w)
        for k in range(np.searchsorted(at, begin), np.searchsorted(at, begin + len(found))):
            if x := weights[feature[k]]:
                names[found[at[k] - begin]] = float(x)
    return Model(float(base), names)


def _parts(ends: np.ndarray, most: int) -> list[tuple[int, int, int, int]]:
    """First and last sentence, first and last word of parts of whole sentences with ``most`` words, or one sentence; ``ends`` counts the words up to each sentence's end."""
    out, s, a = [], 0, 0
    while s < len(ends):
        t = max(s + 1, int(np.searchsorted(ends, a + most, side="right")))
        out.append((s, t, a, int(ends[t - 1])))
        s, a = t, int(ends[t - 1])
    return out


def score_texts(model: Model, texts: list[str], weight: WordWeights | None = None) -> np.ndarray:
    """Probability of each text: noisy-or of its sentences."""
    weight = model.of_words() if weight is None else weight
    base = _log_none(model.base)
    none = np.empty(len(texts))
    for i, text in enumerate(texts):
        total, z, seen = 0.0, 0.0, set()
        for w in [*words(text), _BREAK]:
            if w == _BREAK:
                total += _log_none(model.base + z) if z else base
                z = 0.0
                seen.clear()
            elif (x := weight[w]) and w not in seen:
                seen.add(w)
                z += x
        none[i] = total
    return -np.expm1(none)


def _log_none(z: float) -> float:
    return -math.log1p(math.exp(z)) if z < 30 else -z


def worst_sentences(model: Model, text: str, share: float = SHARE, weight: WordWeights | None = None) -> list[tuple[int, int, float]]:
    """(start, end, probability) in code points, in order, of the likeliest sentences that together make up ``share`` of the noisy-or's logarithm: one at least, if the text has any."""
    weight = model.of_words() if weight is None else weight
    found = []
    for s in _SENTENCE.finditer(text):
        none = _log_none(model.base + sum(weight[w] for w in set(words(s.group()))))
        found.append((none, s.start(), s.end()))
    found.sort()
    wanted, at = share * sum(f[0] for f in found), 0
    total = 0.0
    while at < len(found) and (not at or total > wanted):
        total += found[at][0]
        at += 1
    return [(a, b, -math.expm1(none)) for none, a, b in sorted(found[:at], key=lambda f: f[1])]


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", max_documents: int = MAX_DOCUMENTS) -> Model:
    """Fit on at most ``max_documents`` of the rows with a label for which ``usable`` (of doc_id) holds."""
    rows = labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = rows.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_documents)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    schema = pa.schema([("word", pa.string()), ("weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only()
        bags = Bags()
        for batch in batches:
            text, label_ = column(batch, "text"), column(batch, "label")
            for i in range(batch.num_rows):  # one text at a time
                bags.add(text[i].as_py(), label_[i].as_py())
        batch = text = label_ = None
        use_only()
        model = fit(bags)
        del bags
        give_back()
        yield arrow_rows(schema, [[None, *model.weights], [model.base, *model.weights.values()]])

    found = texts.coalesce(1).sortWithinPartitions("doc_id").mapInArrow(run, "word string, weight double").collect()  # features of the bounded sample
    base = [r["weight"] for r in found if r["word"] is None]
    return Model(base[0] if base else -30.0, {r["word"]: r["weight"] for r in found if r["word"] is not None})


def score(docs: DataFrame, model: Model, cut: float, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with score, predicted and, of what reaches the cut, the sentences (start, end, score) that make it up; every text whole."""
    scored = text if text in keep else "_scored_text"  # a kept text goes to the workers once
    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias(scored))
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    kept = docs.select(*keep).schema
    sentence = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    schema = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in kept), ("score", pa.float64()), ("predicted", pa.int32()), ("sentences", pa.list_(sentence))])
    out = StructType([*kept, *StructType.fromDDL("score double, predicted int, sentences array<struct<start:int,end:int,score:double>>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only()
        weight = model.of_words()
        for part, texts in text_slices(batches, scored, SLICE_CHARS):
            p = np.clip(score_texts(model, texts, weight), 0.0, 1.0)
            spans = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in worst_sentences(model, x, SHARE, weight)] if y >= cut else [] for x, y in zip(texts, p, strict=True)]
            yield arrow_rows(schema, [*(column(part, c) for c in kept.names), p, (p >= cut).astype(np.int32), spans])
        weight.clear()
        give_back()

    return rows.mapInArrow(run, out)
