"""64-bit hashes of words and word sequences, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from ledgerlens.llm.common import kept_by_worker

WORDS_KEPT = 300_000  # of a worker's memory; results don't depend on it
U = np.uint64


class Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


WORDS = Words()
kept_by_worker("words", WORDS.clear)


def mix(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a sequence from that of its beginning and its next hash."""
    h = (h ^ (h >> U(29))) * U(0x9E3779B97F4A7C15) + more
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def hash_of(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]) if columns else 0, 0x243F6A8885A308D3, U)
    for c in columns:
        h = mix(h, c)
    return h


def split_words(text: str) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text in order, and how many each has; a shorter text is one shingle, one without words none."""
    flat: list[bytes] = []
    words = np.empty(len(texts), np.int64)
    for i, x in enumerate(texts):
        found = split_words(x)
        words[i] = len(found)
        flat += found
    h = np.fromiter(map(WORDS.__getitem__, flat), U, len(flat))
    counts = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    starts = np.cumsum(words) - words
    whole = np.zeros(0, U)
    if len(h) >= width:
        whole = hash_of([h[i : len(h) - width + 1 + i] for i in range(width)])
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    out = np.zeros(len(at), U)
    place = np.cumsum(counts) - counts
    long = np.repeat(words >= width, counts)
    out[long] = whole[at[long]]
    for i in np.flatnonzero((words > 0) & (words < width)).tolist():
        part = h[starts[i] : starts[i] + words[i]]
        out[place[i]] = hash_of([part[k : k + 1] for k in range(len(part))])[0]
    return out, counts
