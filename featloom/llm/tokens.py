"""Token ids of whole texts: words are encoded once per worker and remembered."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END = 1
REMEMBERED = 400_000
"""Words that a worker remembers; beyond, it forgets them and starts again."""
STEMS = 900_000
"""The same for words without capitals and marks."""
SHORT = 64
"""Only words of at most so many bytes are remembered: paragraphs without white space would fill the memory."""
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it can be seen, else one from 256 on."""
    seen = [n for n in range(256) if 33 <= n <= 126 or (161 <= n and n != 173)]
    hidden = [n for n in range(256) if n not in set(seen)]
    return {n: chr(n) for n in seen} | {n: chr(256 + i) for i, n in enumerate(hidden)}


BYTES = byte_characters()


@lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    """A tokenizer of the public library from its file; Spark runs the tasks side by side."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class Stems(dict):
    """The ids of plain words and marks, found when they are first asked for."""

    def __init__(self, model: Tokenizer) -> None:
        super().__init__()
        self.model, self.merges = model, model.model

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode()
        if LATIN.fullmatch(text) and text.islower():
            # one unit for the merges already; they work on characters that stand for bytes
            characters = text if text.isascii() else piece.decode("latin-1").translate(BYTES)
            ids = [token.id for token in self.merges.tokenize(characters)]
        else:
            ids = self.model.encode(text, add_special_tokens=False).ids
        found = array("I", ids).tobytes()
        if len(piece) <= SHORT:
            if len(self) >= STEMS:
                self.clear()
            self[piece] = found
        return found


class Words(dict):
    """The ids of words as they stand in a text.

    The vocabulary is of lower case, and letters never share a token with what follows them, so a
    Latin word in capitals or before a stop or comma has the ids of the plain word, and then those
    of the mark. That is so only if the letters stay letters in lower case: one of them gets a combining
    mark, which does join what follows, so a word with it is left to the library as it is.
    """

    def __init__(self, stems: Stems) -> None:
        super().__init__()
        self.stems = stems

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(b".,")
        lowered = stem.decode().lower()
        if LATIN.fullmatch(lowered) and LATIN.fullmatch(stem.decode()):
            found = self.stems[lowered.encode()]
            if len(stem) < len(word):
                found += self.stems[word[len(stem) :]]
        else:
            found = self.stems[word]
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


@lru_cache(2)
def known_words(path: str) -> Words:
    """What this worker remembers of a vocabulary."""
    return Words(Stems(tokenizer(path)))


def token_ids(text: bytes, path: str = WORD_BPE) -> bytes:
    """The ids of a UTF-8 text, as little-endian unsigned 32-bit numbers, without an end id.

    The vocabulary drops white space, and no token or normalisation reaches across it, so a text's
    ids are those of its words one after another.
    """
    return b"".join(map(known_words(path).__getitem__, text.split()))
