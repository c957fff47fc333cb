"""Token ids of whole texts by a public vocabulary of words, encoded once a word."""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Words that one worker remembers, and the longest of them in bytes; others are encoded each time.
REMEMBERED, LONGEST = 400_000, 128

#: Words of these letters alone are cut here and handed to the vocabulary's model directly. Letters stand alone in
#: Unicode's composed form and have one lower case, so nothing else that the tokenizer does to a text concerns them.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Fixed value: how this vocabulary's texts are cut before merging, for those letters.
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level vocabularies write a byte that has no visible letter as one from 256 on.
_LETTER = dict(zip(_SHOWN, map(chr, _SHOWN))) | {
    byte: chr(256 + k) for k, byte in enumerate(sorted(set(range(256)).difference(_SHOWN)))
}


class WordIds(dict):
    """Word (bytes) -> its ids as little-endian unsigned 32-bit numbers.

    This kind of vocabulary drops white space and never joins what it separates, so a text's ids are its
    words' ids one after the other, and long runs of blanks cost nothing.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if len(word) <= LONGEST and _PLAIN.fullmatch(text) and "<|" not in text:
            found = b"".join([self.pieces.get(piece) or self.piece(piece) for piece in _CUT.findall(text.lower())])
        else:
            found = _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_LETTER)
        found = _bytes([token.id for token in self.model.tokenize(shown)])
        if len(self.pieces) >= REMEMBERED:
            self.pieces.clear()
        self.pieces[piece] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        """The ids of a text in UTF-8."""
        if text.isascii() and b"<|" not in text:
            text = text.lower()
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), "<u4")


def _bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@lru_cache(maxsize=2)
def word_ids(path: str = VOCABULARY) -> WordIds:
    """One encoder a Python worker."""
    return WordIds(path)
