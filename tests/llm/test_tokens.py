"""Ids, plane files and packing against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

import featloom.llm.tokens as tokens
from featloom.llm.bytebpe import ByteBpe, encoded, round_trip
from featloom.llm.packing import crossed, fitness, first_people, packed
from featloom.llm.planes import PlaneFile, encoded_files, read_chunks, restored, shuffled, write_planes
from featloom.session import scratch_path
from tests.llm import plain

ODD = [
    "",
    "a  b c d\x1ce\x85f",
    "<|startoftext|> hi<|endoftext|>x",
    "é ́x İstanbul ΣΑΣ ς ÉCOLE, école.",
    "don't 12 34'll ​zero O.K. ..., ,,a",
    "漢字 テスト\n\n x\t y　z",
    "x" * 3000,
]


def real_ids(text):
    model = tokens.tokenizer(tokens.WORD_BPE)
    return model.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(4)
    return ODD + [t or "" for _, t in plain.awkward(2)] + [plain.words(rng, 30).title() for _ in range(20)]


def test_ids_of_words(monkeypatch):
    assert isinstance(tokens.tokenizer(tokens.WORD_BPE), Tokenizer)
    for remembered in (tokens.REMEMBERED, 40):
        monkeypatch.setattr(tokens, "REMEMBERED", remembered)
        for text in texts():
            assert np.frombuffer(tokens.token_ids(text.encode()), "<u4").tolist() == real_ids(text)


def test_every_latin_letter_before_every_mark():
    """One capital gets a combining dot in lower case, which joins the mark behind it."""
    letters = [chr(c) for c in range(0x41, 0x250) if tokens.LATIN.fullmatch(chr(c))]
    assert "İ" in letters
    for mark in ("", ".", ",", "..", ".,", ",."):
        for one in letters:
            for word in (one, f"a{one}", f"{one}b", f"{one}{one.upper()}"):
                assert np.frombuffer(tokens.token_ids((word + mark).encode()), "<u4").tolist() == real_ids(word + mark)


def test_text_without_spaces_is_not_remembered():
    """Long texts without spaces: workers remember short words only."""
    rng = random.Random(9)
    bpe, words = ByteBpe(), tokens.known_words(tokens.WORD_BPE)
    words.clear()
    words.stems.clear()
    for k in range(200):
        text = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(300))
        assert np.frombuffer(tokens.token_ids(text.encode()), "<u4").tolist() == real_ids(text)
        if k < 40:
            bpe.encode(text)
    assert not words and not words.stems and not bpe.known and not bpe.matches
    for k in range(2000):
        tokens.token_ids(f"word{k} ".encode())
    assert all(len(w) <= tokens.SHORT for w in words) and len(words) == 2000


@pytest.mark.parametrize("bits", [True, False])
def test_planes(bits):
    rng = np.random.default_rng(1)
    for n in (1, 5, 4096, 4097, 9000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        assert (restored(shuffled(ids, bits), n) == ids).all()
    file = PlaneFile(bits)
    docs = [(None, [1]), (3, []), (4, [7] * 300_000), (5, [49_000, 1])]
    for doc_id, ids in docs:
        file.add(doc_id, np.array(ids, "<u4").tobytes())
    found = []
    for numbers, known, counts, ids in read_chunks(file.finish()):
        ends = np.cumsum([0, *counts])
        for k in range(len(numbers)):
            found.append((int(numbers[k]) if known[k] else None, ids[ends[k] : ends[k + 1]].tolist()))
    assert found == docs
    with pytest.raises(ValueError, match="cut off"):
        list(read_chunks(file.finish()[:-3]))


def test_files_in_order(spark, monkeypatch):
    rows = [(i, t) for k, (i, t) in enumerate(plain.awkward(2))]
    got = encoded_files(plain.frame(spark, rows, True).repartition(6)).collect()
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] is not None for r in got] == sorted(r["doc_id"] is not None for r in got)
    numbers = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert numbers == sorted(i for i, _ in rows if i is not None)
    at, wanted = 0, defaultdict(list)
    for doc_id, text in rows:
        ids = [*real_ids(text), 1]
        wanted[doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r["start"] == at and (r["n_tokens"], r["ids_crc32"]) in wanted[r["doc_id"]]
        at += r["n_tokens"]
    assert encoded_files(plain.frame(spark, [])).count() == 0


def test_small_files(spark):
    folder = scratch_path(spark, "planes")
    files = write_planes(plain.frame(spark, [(k, "a b") for k in range(50)]), folder).collect()
    assert sum(f["n_docs"] for f in files) == 50 and sum(f["n_ids"] for f in files) == 150


@pytest.mark.parametrize("clashes", [False, True])
def test_packing(spark, clashes):
    rows = plain.awkward(2) + [(500 + k, plain.words(random.Random(k), 40 + 7 * k)) for k in range(60)]
    found = packed(plain.frame(spark, rows, clashes).repartition(3)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    wanted = defaultdict(list)
    for doc_id, text in rows:
        ids = [*real_ids(text), 1]
        for at in range(0, len(ids), 4096):
            part = np.array(ids[at : at + 4096], "<u4").tobytes()
            wanted[doc_id].append((at, len(part) // 4, zlib.crc32(part)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}
    total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        total += at
    assert len(sequences) <= -(-total // 4096) + 2
    assert packed(plain.frame(spark, [])).count() == 0


def test_children_keep_all_pieces():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 4096, 300).astype(np.int32)
    people = first_people(lengths, 4096, 1)
    for seed in range(20):
        child = crossed(lengths, people[0], people[seed % 3 + 1], 4096, random.Random(seed))
        fill = np.bincount(child, weights=lengths)
        assert fill.max() <= 4096 and fill.sum() == lengths.sum() and (child >= 0).all()
        assert fitness(lengths, child, 4096) > -len(lengths)


def test_byte_bpe_is_that_of_the_library():
    bpe = ByteBpe()
    real = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(7)
    more = ["".join(rng.choice("etaoin ETAOIN.,'0123\né　") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    more += ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(20, 400))) for _ in range(200)]
    for text in texts() + more + [" " * 90 + "a" + " " * 300, "a" * 4000, " \n \n\n x"]:
        ids = bpe.encode(text)
        assert ids == real.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_joining_any_two_halves():
    bpe = ByteBpe()
    rng = random.Random(8)
    for _ in range(300):
        data = "".join(rng.choice("thea iouns") for _ in range(rng.randint(2, 60))).encode()
        cut = rng.randint(0, len(data))
        assert bpe.join(bpe.merged(data[:cut]), bpe.merged(data[cut:])) == bpe.merged(data)


def test_round_trip(spark):
    rows = plain.awkward(2)
    bpe = ByteBpe()
    found = round_trip(plain.frame(spark, rows, True)).collect()
    wanted = []
    for doc_id, text in rows:
        ids = bpe.encode(text or "")
        wanted.append((doc_id or -1, len(ids), plain.sha(" ".join(map(str, ids)).encode()), plain.sha((text or "").encode())))
    assert sorted((r[0] or -1, *r[1:]) for r in found) == sorted(wanted)
    assert encoded(plain.frame(spark, [(1, "the cat")])).first()["ids"] == bpe.encode("the cat")
    assert round_trip(plain.frame(spark, [])).count() == 0
