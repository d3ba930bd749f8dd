"""Exact and near duplicates against comparing all texts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from featloom.llm.components import components
from featloom.llm.exact import drop_exact, exact_groups, heavy_digests, reduced
from featloom.llm.simhash import drop_near, fingerprint, near_groups, near_links
from tests.llm import plain


@pytest.mark.parametrize("clashes", [False, True])
def test_exact_groups(spark, clashes):
    rows = plain.awkward()
    docs = plain.frame(spark, rows, clashes).repartition(5)
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    wanted = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        wanted.append((doc_id, keep, len(ids), doc_id == keep, plain.sha((text or "").encode())))
    found = exact_groups(docs)
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.select(names).collect())) == Counter(wanted)
    # few counters: the frequent texts change, the result does not
    assert Counter(map(tuple, exact_groups(docs, counters=1).select(names).collect())) == Counter(wanted)


def test_frequent_digests_are_found(spark):
    texts = ["hot"] * 300 + ["warm"] * 120 + [f"t{k}" for k in range(400)]
    random.Random(1).shuffle(texts)
    rows = spark.createDataFrame([(t,) for t in texts], "sha string").repartition(70)
    found = {r["sha"] for r in heavy_digests(rows, counters=9).collect()}
    assert {"hot", "warm"} <= found and len(found) <= 9


def test_summary_keeps_what_is_frequent():
    counts = {"a": 50, "b": 30} | {f"x{k}": 1 for k in range(20)}
    assert set(reduced(counts, 4)) == {"a", "b"} and reduced({"a": 1}, 4) == {"a": 1}


@pytest.mark.parametrize("clashes", [False, True])
def test_drop_exact(spark, clashes):
    rows = plain.awkward()
    docs = plain.frame(spark, rows, clashes)
    kept = drop_exact(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    found = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert Counter(t for _, t in found) == Counter({t or "": 1 for _, t in rows})
    best = {}
    for doc_id, text in rows:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert all((-1 if i is None else i) == best[t] for i, t in found)


def test_fingerprints():
    for _, text in plain.awkward(3):
        assert fingerprint((text or "").encode()) == plain.simhash(text)


@pytest.mark.parametrize("limit", [1, 3, 1 << 17])
def test_trie_finds_all_links(spark, limit):
    rng = random.Random(limit)
    marks = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for _ in range(4):
        for mark in list(marks)[:90]:
            for _ in range(rng.randint(0, 3)):
                mark ^= 1 << rng.randrange(64)
            marks.add(mark)
    # many that share one block and differ elsewhere
    marks |= {(7 << 48) | rng.getrandbits(20) for _ in range(60)}
    marks = sorted(marks)
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    fps = spark.createDataFrame([(m,) for m in signed], "fp long")
    found = components(near_links(fps, limit=limit))
    roots = {r["node"]: r["root"] for r in found.collect()}
    by_root = defaultdict(set)
    for m in signed:
        by_root[roots.get(m, m)].add(m)
    wanted = defaultdict(set)
    for m, k in zip(signed, plain.linked(marks)):
        wanted[k].add(m)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, wanted.values()))
    assert all(k == min(v) for k, v in by_root.items())


@pytest.mark.parametrize("clashes", [False, True])
def test_near_groups(spark, clashes):
    rows = plain.awkward(5)
    found = near_groups(plain.frame(spark, rows, clashes)).collect()
    marks = [plain.simhash(t) for _, t in rows]
    places = plain.linked(marks)
    lowest = {}
    for (doc_id, _), k in zip(rows, places):
        if doc_id is not None:
            lowest[k] = min(lowest.get(k, doc_id), doc_id)
    wanted = Counter((i, m, lowest.get(k)) for (i, _), m, k in zip(rows, marks, places))
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found) == wanted


def test_drop_near(spark):
    rows = plain.awkward(5)
    docs = plain.frame(spark, rows, True)
    kept = drop_near(docs)
    assert kept.schema == docs.schema
    places = plain.linked([plain.simhash(t) for _, t in rows])
    assert kept.count() == len(set(places))


def test_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert roots == {k: 0 for k in range(1, 61)} | {100 + k: 100 for k in range(1, 40)}


def test_empty_tables(spark):
    none = plain.frame(spark, [])
    assert exact_groups(none).count() == drop_exact(none).count() == 0
    assert near_groups(none).count() == drop_near(none).count() == 0


def test_words_and_bits_are_parameters(spark):
    rows = [(i, t) for i, t in plain.awkward(3) if i is not None]
    docs = plain.frame(spark, rows)
    found = near_groups(docs, words=5, bits=1).collect()
    marks = {r["doc_id"]: set() for r in found}
    for r in found:
        marks[r["doc_id"]].add((r["fp"] % 2**64, r["component_id"]))
    own = [(i, fingerprint((t or "").encode(), 5)) for i, t in rows]
    places = plain.linked([m for _, m in own], 1)
    low = {p: min(i for (i, _), q in zip(own, places) if q == p) for p in places}
    wanted = {i: set() for i, _ in rows}
    for (i, m), p in zip(own, places):
        wanted[i].add((m, low[p]))
    assert marks == wanted
    with pytest.raises(ValueError, match="0 to 3 bits"):
        near_groups(docs, bits=4)
