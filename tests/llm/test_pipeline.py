"""The pipeline against the slow versions of its stages, and its queries."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from featloom.llm.tokens import token_ids
from tests.llm import plain


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "exact_dedup",
        "near_dedup",
        "repeated_passages",
        "packing",
    ]


def write(spark, tmp_path, rows, clashes):
    plain.frame(spark, rows, clashes).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("clashes", [False, True])
def test_run(spark, tmp_path, clashes):
    rows = plain.awkward(11) + plain.awkward(11)[3:9]
    found = corpus_pipeline.run(spark, write(spark, tmp_path, rows, clashes)).collect()
    rows = [(i, t) for i, t in rows if not plain.quality(t)["base_failed"]]
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), -1 if i is None else i)
    rows = [(i, t) for t, i in best.items()]
    places = plain.linked([plain.simhash(t) for _, t in rows])
    low = {}
    for (i, t), k in zip(rows, places):
        # an unknown id is kept only if the group has no other
        rank = (i < 0, i)
        low[k] = min(low.get(k, (rank, t)), (rank, t))
    rows = [(rank[1], t) for rank, t in low.values()]
    texts = plain.passages([t for _, t in rows])
    wanted = Counter()
    for (i, _), t in zip(rows, texts):
        n = len(token_ids(t.encode())) // 4 + 1
        for k, at in enumerate(range(0, n, 4096)):
            wanted[i, k, at, min(4096, n - at)] += 1
    got = Counter((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"]) for r in found)
    assert got == wanted
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_columns_stay(spark, tmp_path):
    folder = write(spark, tmp_path, plain.awkward(12), True)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], False)).count() == 0
