"""The mix of sources against a plain walk over each source."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from featloom.llm.mixing import BITS, SEED, mix_report, mixture, source_targets
from tests.llm import plain

NAMES = ["doc_id", "size", "source_size", "target", "taken"]


def targets(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Sharing again and again until no target is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_ones, found = percent / 100 * sum(sizes.values()), set(order), {}
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        shares = {s: left * weight[s] / total for s in open_ones}
        full = {s for s in open_ones if shares[s] > most * sizes[s]}
        if not full:
            return found | shares
        found |= {s: float(most * sizes[s]) for s in full}
        left -= sum(found[s] for s in full)
        open_ones -= full
    return found


def walk(rows):
    """Every (doc_id, size, source_size, target, taken) of (doc_id, text, source)."""
    sized = [(i, s, len(plain.SPACE.findall(t or ""))) for i, t, s in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    aims, out = targets(sizes), []
    for source, aim in aims.items():
        mark = f"{SEED}" if source is None else f"{SEED}:{source}"
        at = int(hashlib.md5(mark.encode()).hexdigest()[: BITS // 4], 16)
        rate = round(aim / sizes[source] * 2**BITS) if sizes[source] else 0
        own = [(i, n) for i, s, n in sized if s == source]
        for i, n in sorted(own, key=lambda r: (-r[1], r[0] is not None, r[0] or 0)):
            taken = ((at + rate) // 2**BITS - at // 2**BITS) * n
            at += rate
            out.append((i, n, sizes[source], round(aim, 6), taken))
    return out


def rows_of(seed=0):
    rng = random.Random(seed)
    rows = [(i, t, ("b", "a", None, "ü", "", "Z")[k % 6]) for k, (i, t) in enumerate(plain.awkward(seed))]
    rows += [(200 + k, plain.words(rng, rng.randint(0, 40)), "hot") for k in range(150)]
    rows += [(500, plain.words(rng, 60), "single"), (501, None, "empty"), (502, " \n", "empty")]
    return rows + [(600 + k, "w " * 7, "ties") for k in range(9)] + [(700, "a b c", "ties")] * 4


@pytest.mark.parametrize("clashes", [False, True])
def test_mix_report(spark, clashes):
    rows = rows_of()
    docs = plain.frame(spark, rows, clashes)
    wanted = Counter(walk(rows))
    for parts in (1, 7):
        found = mix_report(docs.repartition(parts)).collect()
        assert found[0].__fields__ == NAMES
        assert Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in found) == wanted


def test_targets_are_met(spark):
    rng = random.Random(4)
    rows = [(k, plain.words(rng, int(3 + rng.paretovariate(1.2) * 9)), f"s{rng.choice('aaaabcdefg')}") for k in range(900)]
    found = mix_report(plain.frame(spark, rows).repartition(5)).collect()
    source = {i: s for i, _, s in rows}
    taken, aims, longest = Counter(), {}, Counter()
    for r in found:
        name = source[r["doc_id"]]
        taken[name] += r["taken"]
        aims[name] = r["target"]
        longest[name] = max(longest[name], r["size"])
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
    assert all(abs(taken[s] - aims[s]) <= longest[s] for s in aims)
    assert sum(aims.values()) == pytest.approx(1.5 * sum(r["size"] for r in found))


@pytest.mark.parametrize("percent, most, weights", [(150, 2, (3, 1, 2)), (200, 2, (1, 5)), (300, 2, (1,)), (0, 1, (7, 1))])
def test_targets(spark, percent, most, weights):
    rng = random.Random(percent)
    sizes = {f"s{k:03}": rng.choice([0, 1, 5, 40, 1000, 30000]) for k in range(60)} | {None: 77, "": 3}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(6)
    found = {r["source"]: r["target"] for r in source_targets(frame, weights, percent, most).collect()}
    wanted = targets(sizes, weights, percent, most)
    assert found.keys() == wanted.keys()
    assert all(found[s] == pytest.approx(wanted[s], abs=1e-6) for s in wanted)


def test_wrong_settings(spark):
    frame = spark.createDataFrame([("a", 1)], "source string, source_size long")
    for wrong in ({"percent": -1}, {"most": 0}, {"weights": ()}, {"weights": (1, 0)}):
        with pytest.raises(ValueError):
            source_targets(frame, **wrong)


def test_mixture(spark):
    rows = rows_of(1)
    docs = plain.frame(spark, rows, clashes=True).repartition(4)
    mixed = mixture(docs)
    assert mixed.schema == docs.schema
    times = Counter(r["doc_id"] for r in mixed.collect())
    wanted, words = Counter(), Counter()
    for r in mix_report(docs).collect():
        wanted[r["doc_id"]] += r["taken"]
    for doc_id, text, _ in rows:
        words[doc_id] = len(plain.SPACE.findall(text or ""))
    once = [i for i, n in Counter(i for i, *_ in rows).items() if n == 1 and words[i]]
    assert all(times[i] * words[i] == wanted[i] for i in once)
    assert not set(times) - {i for i, *_ in rows}


def test_empty_and_very_long(spark):
    docs = plain.frame(spark, [])
    assert mix_report(docs).collect() == [] and mix_report(docs).columns == NAMES
    assert mixture(docs).collect() == []
    found = mix_report(plain.frame(spark, [(1, "word " * 1_000_000), (2, "x" * 3_000_000)])).collect()
    assert {r["doc_id"]: r["size"] for r in found} == {1: 1_000_000, 2: 1}
    found = mix_report(plain.frame(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in found] == [(0, 0, 0.0, 0)] * 2
