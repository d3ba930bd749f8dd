"""Exact duplicates: frequent digests are split off and settled without a shuffle of their rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import Batches, present, ship, without
from featloom.session import checkpointed

COUNTERS = 1024
"""Counters of a Misra-Gries summary: a digest in more than 1/1025 of the rows is never missed."""

MERGE = 64
"""Summaries that one task merges in a round."""


def exact_groups(
    docs: DataFrame, text: str | Column = "text", doc_id: str = "doc_id", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, n_keep, text_sha256.

    Texts are equal if their SHA-256 is; null counts as empty. The row with the largest doc_id
    of equal texts stays; null doc_ids are the smallest. If full copies of that row share its
    doc_id, ``n_keep`` says how many, and all of them are marked as kept: they are one row for
    anybody who looks at the columns. Empty input gives no rows; other columns are not read.

    Misra-Gries summaries of the digests name the candidates for frequent digests. A second
    scan counts the candidates, which verifies them and finds their winners, at most
    ``counters`` rows: these are broadcast, and rows of frequent texts are settled in place. The
    other digests are grouped by an ordinary shuffle of digest and id; texts are never moved.
    """
    digests = checkpointed(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), F.sha2(present(text), 256).alias("sha")
        )
    )
    frequent = winners(
        digests.join(F.broadcast(heavy_digests(digests, counters)), "sha", "left_semi")
    )
    frequent = checkpointed(frequent)
    hot = digests.join(F.broadcast(frequent), "sha")
    cold = digests.join(F.broadcast(frequent.select("sha")), "sha", "left_anti")
    found = hot.unionByName(cold.join(winners(cold), "sha"))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "n_keep",
        F.col("sha").alias("text_sha256"),
    )


def winners(digests: DataFrame) -> DataFrame:
    """Per digest the largest doc_id, the number of rows, and of rows with that doc_id."""
    return (
        digests.groupBy("sha", "doc_id")
        .agg(F.count("*").alias("n"))
        .groupBy("sha")
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.max(F.struct("doc_id", "n")).getField("n").alias("n_keep"),
        )
    )


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them all in more than 1/(counters+1) of the rows.

    Each task keeps one summary of what it reads; summaries are merged ``MERGE`` at a time.
    """
    spark = digests.sparkSession
    ship(spark)
    schema = pa.schema([("part", pa.int64()), ("sha", pa.string()), ("n", pa.int64())])
    group = F.spark_partition_id().cast("long").alias("part")

    def summarise(batches: Batches) -> Batches:
        counts: dict[str, int] = {}
        part = 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            seen = batch.column("sha").value_counts()
            for item in zip(seen.field(0).to_pylist(), seen.field(1).to_pylist(), strict=True):
                counts[item[0]] = counts.get(item[0], 0) + item[1]
            counts = reduced(counts, counters)
        yield summary_batch(counts, part, schema)

    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        counts: dict[str, int] = {}
        shas, numbers = parts.column("sha").to_pylist(), parts.column("n").to_pylist()
        for sha, n in zip(shas, numbers, strict=True):
            counts[sha] = counts.get(sha, 0) + n
        batch = summary_batch(reduced(counts, counters), key[0].as_py(), schema)
        return pa.Table.from_batches([batch])

    text_schema = "part long, sha string, n long"
    tasks = digests.rdd.getNumPartitions()
    found = digests.select("sha", group).mapInArrow(summarise, text_schema)
    while tasks > 1:
        tasks = -(-tasks // MERGE)
        key = F.floor(F.col("part") / MERGE).cast("long").alias("part")
        found = found.select(key, "sha", "n").groupBy("part").applyInArrow(merge, text_schema)
    return checkpointed(found.select("sha"))


def reduced(counts: dict[str, int], counters: int) -> dict[str, int]:
    """A Misra-Gries summary of at most ``counters`` entries, as merging summaries reduces them."""
    if len(counts) <= counters:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) - counters - 1)[len(values) - counters - 1])
    return {sha: n - cut for sha, n in counts.items() if n > cut}


def summary_batch(counts: dict[str, int], part: int, schema: pa.Schema) -> pa.RecordBatch:
    """A summary as rows."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(counts), pa.int64()),
            pa.array(list(counts), pa.string()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        schema=schema,
    )


def drop_exact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose text another row with a larger doc_id has.

    Columns stay as they are. Of full copies of the row that stays one is left.
    """
    groups = exact_groups(docs, text, doc_id)
    verdicts = groups.select(
        "doc_id", F.col("text_sha256").alias("key"), "kept", "n_keep", F.col("text_sha256").alias("grp")
    )
    return without(docs, checkpointed(verdicts), doc_id, F.sha2(present(text), 256))
