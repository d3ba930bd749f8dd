"""Byte-level BPE as a tree reduction: halves are encoded apart and joined at their boundary."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import map_batches, present, text_bytes

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
LEAF = 8
"""Bytes that are merged directly."""
DECODED = 4096
"""Ids that are decoded directly."""
REMEMBERED = 300_000
"""Words, matches, leaves and seams, of each so many, that a worker remembers before it starts again."""
# white space as Unicode has it, which is what the vocabulary's pattern goes by
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# a match of the pattern, with a stop or comma after it
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,]*)")
# a word with one space before it, or white space as far as no word takes its last character
WORD = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


class ByteBpe:
    """A vocabulary of ranks, with encoding and decoding."""

    def __init__(self, path: str = BYTE_BPE, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.digits = {rank: str(rank).encode() for rank in self.tokens}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, tuple[int, ...]] = {}
        self.matches: dict[str, tuple[int, ...]] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.seams: dict[tuple[int, int], list[int]] = {}

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; words are looked up before they are encoded."""
        known = self.known
        ids: list[int] = []
        for word in WORD.findall(text):
            found = known.get(word)
            if found is None:
                found = kept(known, word, self.encode_word(word))
            ids += found
        return ids

    def encode_word(self, word: str) -> tuple[int, ...]:
        """The ids of the pattern's matches in a word; they are met in other words again."""
        plain = PLAIN.fullmatch(word)
        parts = self.pattern.findall(word) if plain is None else [x for x in plain.groups() if x]
        ids: tuple[int, ...] = ()
        for match in parts:
            found = self.matches.get(match)
            if found is None:
                found = kept(self.matches, match, tuple(self.encode_match(match.encode())))
            ids += found
        return ids

    def encode_match(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern; a token as it is has its own rank."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.reduced(data)

    def reduced(self, data: bytes) -> list[int]:
        """The ids of bytes: those of the two halves, joined."""
        if len(data) <= LEAF:
            found = self.leaves.get(data)
            return kept(self.leaves, data, self.merged(data)) if found is None else found
        middle = len(data) // 2
        return self.join(self.reduced(data[:middle]), self.reduced(data[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the bytes of two id lists, one after the other.

        Ids are an encoding if every two neighbours are the encoding of their own bytes. That
        holds inside both lists; so a window around the boundary is encoded anew and grows to
        the side where its end does not fit the token next to it, until both ends fit. What lies outside
        can then never change.
        """
        if not left or not right:
            return left or right
        i, j = 1, 1
        window = self.seam(left[-1], right[0])
        while True:
            fits_left = i == len(left) or self.fits(left[-i - 1], window[0])
            fits_right = j == len(right) or self.fits(window[-1], right[j])
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            i += not fits_left
            j += not fits_right
            window = self.merged(b"".join(map(self.tokens.__getitem__, left[-i:] + right[:j])))

    def seam(self, a: int, b: int) -> list[int]:
        """The ids of the bytes of two tokens."""
        found = self.seams.get((a, b))
        if found is None:
            found = kept(self.seams, (a, b), self.merged(self.tokens[a] + self.tokens[b]))
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens stay as they are when they meet."""
        return len(window := self.seam(a, b)) == 2 and window[0] == a

    def merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of the lowest rank, the leftmost first, until none are left."""
        ranks = self.ranks
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            low = min(pairs)
            if low == NEVER:
                break
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NEVER)
        return [ranks[part] for part in parts]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids: those of the two halves, one after the other."""
        if len(ids) <= DECODED:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


NEVER = 1 << 62


SHORT = 64
"""Longer words and matches are not remembered: paragraphs without white space would fill the memory."""


def kept(memory: dict, key: str | bytes | tuple, value: object) -> object:
    """``value``, remembered if its key is short; a full memory starts again."""
    if len(key) > SHORT:
        return value
    if len(memory) >= REMEMBERED:
        memory.clear()
    memory[key] = value
    return value


@lru_cache(2)
def vocabulary(path: str) -> ByteBpe:
    """A vocabulary, read once per worker."""
    return ByteBpe(path)


def encoded(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = BYTE_BPE
) -> DataFrame:
    """doc_id and ids (an array) of every row; null texts are empty and have no ids."""

    def make(batch: pa.RecordBatch) -> dict:
        bpe = vocabulary(path)
        ids = [bpe.encode(x.decode()) for x in text_bytes(batch)]
        return {"doc_id": batch.column("doc_id"), "ids": ids}

    return map_batches(plain(docs, text, doc_id), make, "doc_id long, ids array<int>")


def round_trip(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = BYTE_BPE
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, and decoded again.

    No row leaves its task. Null texts are empty; equal rows each have a result.
    """

    def make(batch: pa.RecordBatch) -> dict:
        bpe = vocabulary(path)
        out: dict = {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256")}
        for data in text_bytes(batch):
            ids = bpe.encode(data.decode())
            digits = b" ".join(map(bpe.digits.__getitem__, ids))
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(digits).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return out | {"doc_id": batch.column("doc_id")}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(plain(docs, text, doc_id), make, schema)


def plain(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Ids and texts alone."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), present(text).alias("text"))
