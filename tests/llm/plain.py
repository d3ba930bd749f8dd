"""Short, slow versions of the corpus operators, and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "fp long, kept string, root int, n int, _row string, _spans int, spans int, sha string, bucket int"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, clashes=False):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, "s1")[:3]
        full.append((doc_id, text, "en", source, None if text is None else len(text)))
    if clashes:
        full = [(*row, 1, "x", 2, 3, "r", 4, 5, "s", 6) for row in full]
        return spark.createDataFrame(full, f"{SCHEMA}, {CLASHES}")
    return spark.createDataFrame(full, SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward(seed=0):
    """Nulls, empty and long texts, copies, repeated rows, near copies and shared passages."""
    rng = random.Random(seed)
    passage = words(rng, 120)
    long = words(rng, 4000)
    copy = words(rng, 90)
    near = words(rng, 300)
    rows = [
        (None, "no id " + words(rng, 80)),
        (None, copy),
        (1, None),
        (2, ""),
        (3, copy),
        (4, copy),
        (4, copy),
        (5, long),
        (6, words(rng, 60) + " " + passage + " " + words(rng, 60)),
        (7, words(rng, 70) + "\n" + passage + "\n" + words(rng, 50)),
        (8, passage),
        (9, near),
        (10, near + " end"),
        (11, near.replace(" ", "  ")),
        (12, "é" * 500 + " ü" * 40),
        (13, "short"),
        (14, "a b"),
        (15, "x" * 1000),
        (16, " \t\n "),
        (17, (words(rng, 12) + "\n") * 9),
    ]
    return rows + [(100 + k, words(rng, rng.randint(1, 150))) for k in range(25)]


def repeats(texts, length=400):
    """Of each text the bytes that no repeated string covers, and the number of removed runs."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(d, gone) if not g), runs))
    return out


def passages(texts, words=50):
    """Each text without the words of repeated passages, and the white space after them."""
    found = [SPACE.findall(t or "") for t in texts]
    seen = Counter(tuple(w[k : k + words]) for w in found for k in range(len(w) - words + 1))
    out = []
    for text, w in zip(texts, found):
        gone = bytearray(len(w))
        for k in range(len(w) - words + 1):
            if seen[tuple(w[k : k + words])] > 1:
                gone[k : k + words] = b"\1" * words
        starts = [m.start() for m in SPACE.finditer(text or "")] + [len(text or "")]
        cut = {k for k, g in enumerate(gone) if g}
        head = (text or "")[: starts[0]]
        out.append(head + "".join(text[starts[k] : starts[k + 1]] for k in range(len(w)) if k not in cut))
    return out


def simhash(text):
    found = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(marks, bits=3):
    """The component of every fingerprint, as the set of places."""
    place = list(range(len(marks)))

    def top(k):
        while place[k] != k:
            k = place[k]
        return k

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                place[top(i)] = top(j)
    return [top(k) for k in range(len(marks))]


def quality(text):
    text = text or ""
    found = SPACE.findall(text)
    windows = Counter(tuple(found[k : k + 3]) for k in range(len(found) - 2))
    covered = {
        k + j for k in range(len(found) - 2) if windows[tuple(found[k : k + 3])] > 1 for j in range(3)
    }
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    n = len(found)
    return {
        "n_words": n,
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def sha(data):
    return hashlib.sha256(data).hexdigest()
