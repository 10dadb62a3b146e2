"""Ids of whole texts by a public tokenizer file.

Both tokenizers of the queries first cut a text by a pattern and then
encode every piece by itself.  For texts within Latin-1 the patterns are
written out here, and a worker keeps the ids of the pieces it has met: a
text is cut, and its pieces are looked up; only new ones go to the
tokenizer's model.  Other texts, and those with the name of a special
token, go through the whole tokenizer.  What workers keep is bounded, and
ids don't depend on it.  ``split`` says which pattern a file has:

* "drop": lower-cased words, single digits and runs of marks; white space
  gives no ids;
* "lead": words, numbers and runs of marks, each with the space before it;
* "whole": any other, encoded by the tokenizer as it is.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from ledgerlens.llm.common import kept_by_worker

# The Latin-1 part of the two pre-tokenizers' patterns.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
PATTERNS = {
    "drop": re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACE}{_LETTER}{_NUMBER}]+"),
    "lead": re.compile(f" ?[{_LETTER}]+| ?[{_NUMBER}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"),
}
SPECIAL = "<|"
PIECES_KEPT = 500_000  # of a worker's memory: met last, and as many before them


def tokenizer_file(name: str) -> str:
    """A path as it is; else the public package's file of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces(dict):
    """The ids of pieces, made when they are first asked for."""

    def __init__(self, model, code: str):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.model, self.code, self.before = model, code, {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(256)}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECES_KEPT:
            self.before = dict(self)
            self.clear()
        found = self.before.get(piece)
        if found is None:
            found = array(self.code, [t.id for t in self.model.tokenize(piece.translate(self.letters))]).tobytes()
        self[piece] = found
        return found


class Encoder:
    def __init__(self, name: str, split: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.split = split
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.pieces = Pieces(self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, as ``dtype``."""
        out: list = [None] * len(texts)
        other = []
        of, cut = self.pieces.__getitem__, PATTERNS.get(self.split)
        for i, x in enumerate(texts):
            if cut is None or SPECIAL in x or not x.isascii() and max(x) > "\xff":
                other.append(i)
            else:
                out[i] = b"".join(map(of, cut.findall(x.lower() if self.split == "drop" else x)))
        for i, found in zip(other, self.tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, self.dtype).tobytes()
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}
kept_by_worker("encoder", _ENCODERS.clear)


def encoder(name: str, split: str) -> Encoder:
    """This process's: a tokenizer file takes a second to read and tens of MB to hold."""
    if (name, split) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name, split] = Encoder(name, split)
    return _ENCODERS[name, split]
