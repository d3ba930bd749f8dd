"""Suffix arrays against sorting, and repeated strings against looking at all of them."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featloom.llm.repeats import LENGTH, cut_repeats, kept_text, pieces_of, repeat_report
from featloom.llm.suffixes import common_prefixes, lyndon_groups, suffix_array
from tests.llm import plain


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    symbols = [*symbols, 0]
    order = suffix_array(symbols)
    assert order == sorted(range(len(symbols)), key=lambda k: symbols[k:])
    shared = common_prefixes(symbols, order, 0)
    for place in range(1, len(order)):
        a, b = symbols[order[place - 1] : -1], symbols[order[place] : -1]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[place] == n


def test_groups_are_lyndon_prefixes():
    symbols = [2, 1, 3, 1, 3, 1, 2, 0]
    group, before = lyndon_groups(symbols)
    assert group[1] == group[3] and group[1] != group[5]
    assert [before[k] for k in (0, 2, 4)] == [-1, 1, 3]


def test_long_runs():
    assert suffix_array([1] * 3000 + [0]) == list(range(3000, -1, -1))


def test_pieces_cover_every_string():
    rng = random.Random(2)
    for text in (plain.words(rng, 900), "z" * 1500, "ab" * 700, "q" * (LENGTH - 1), ""):
        data = text.encode()
        _, first, n, offset, digests = pieces_of(data)
        starts = [a + k for a, m in zip(first, n) for k in range(m)]
        assert starts == list(range(max(0, len(data) - LENGTH + 1))) and len(digests) == len(n)
        assert all(0 <= o <= LENGTH - 200 for o in offset)


def near_copies(seed):
    """Texts that share stretches of many lengths around the limit, at many offsets."""
    rng = random.Random(seed)
    base = plain.words(rng, 500)
    out = []
    for k in range(40):
        a = rng.randint(0, 900)
        part = base[a : a + rng.choice([380, 399, 400, 401, 450, 700, 1200])]
        out.append((k, plain.words(rng, rng.randint(0, 40)) + part + plain.words(rng, rng.randint(0, 40))))
    return out


@pytest.mark.parametrize("limit", [2, 5, 2048])
@pytest.mark.parametrize("rows", [plain.awkward(1), near_copies(4)], ids=["awkward", "near"])
def test_report(spark, rows, limit, monkeypatch):
    import featloom.llm.repeats as r

    whole = r.repeated_spans
    monkeypatch.setattr(r, "repeated_spans", lambda *a: whole(*a, limit=limit))
    found = repeat_report(plain.frame(spark, rows, True).repartition(4)).collect()
    kept = plain.repeats([t for _, t in rows])
    wanted = sorted(
        (i or -1, len((t or "").encode()), len((t or "").encode()) - len(k), n, plain.sha(k))
        for (i, t), (k, n) in zip(rows, kept)
    )
    assert sorted((x[0] or -1, *x[1:5]) for x in found) == wanted
    left = sorted((i or -1, len(k), plain.sha(k)) for (i, _), (k, _) in zip(rows, kept))
    assert sorted((x["doc_id"] or -1, x["n_kept"], x["kept_sha256"]) for x in found) == left
    assert all(len(x["text"].encode()) <= x["n_kept"] for x in found)


def test_whole_characters():
    text = "aéèöb".encode()
    # from the second byte of one letter to the first of another: both go, and no third one appears
    assert kept_text(text, [(2, 4)]) == "aöb" and kept_text(text, [(2, 4), (4, 6)]) == "ab"
    assert kept_text(text, []) == "aéèöb" and kept_text(text, [(0, len(text))]) == ""
    assert kept_text(text, [(2, 3), (4, 5)]) == "aöb"


def shared_passages(seed):
    """Texts that share passages around fifty words, with other white space, within texts too."""
    rng = random.Random(seed)
    base = plain.words(rng, 200).split(" ")
    out = []
    for k in range(30):
        a, n = rng.randint(0, 140), rng.choice([48, 49, 50, 51, 60])
        part = rng.choice([" ", "\n", " \t "]).join(base[a : a + n])
        out.append((k, f"{plain.words(rng, rng.randint(0, 30))} {part}\n{plain.words(rng, rng.randint(0, 30))}"))
    alone = plain.words(rng, 55)
    out.append((40, f"  {alone}\n\n{plain.words(rng, 9)}\n{alone} "))
    return out + [(41, "same " * 120), (42, "é " * 70 + "ü"), (43, None), (44, "")]


@pytest.mark.parametrize("words", [25, 50, 100])
@pytest.mark.parametrize("rows", [plain.awkward(1), shared_passages(4)], ids=["awkward", "shared"])
def test_texts_are_cut(spark, rows, words):
    docs = plain.frame(spark, rows, True).repartition(3)
    found = cut_repeats(docs, words=words)
    assert found.columns == docs.columns
    kept = plain.passages([t for _, t in rows], words)
    wanted = sorted((i or -1, k) for (i, t), k in zip(rows, kept) if t is not None)
    got = found.collect()
    assert sorted(((r["doc_id"] or -1), r["text"]) for r in got if r["text"] is not None) == wanted
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in got)


def test_empty_tables(spark):
    with pytest.raises(ValueError):
        cut_repeats(plain.frame(spark, [(1, "a")]), words=51)
    none = plain.frame(spark, [])
    assert repeat_report(none).count() == cut_repeats(none).count() == 0
