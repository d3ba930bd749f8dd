"""Quality rules for texts, and for the hosts they come from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import map_batches, present, text_bytes, without
from featloom.session import checkpointed

SYMBOLS = b"#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED = 50
"""Percent of the words that may lie in repeated windows."""
MAX_RATE = 0.8
"""A host goes if its failure rate is above this beyond doubt."""
SURE = 2.326
"""Standard deviations for the bound on a host's rate: 99 %."""


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.split()
    inside = b"".join(words)
    letters = len(inside) if inside.isascii() else len(inside.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), letters, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three words that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    mark = b"\1" * WINDOW
    for at, window in enumerate(windows):
        seen = first.setdefault(window, at)
        if seen != at:
            covered[at : at + WINDOW] = mark
            covered[seen : seen + WINDOW] = mark
    return sum(covered)


def base_failed() -> Column:
    """The rules for single texts."""
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def measured(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source"
) -> DataFrame:
    """doc_id, host, text_hash, the measures and base_failed of every row; null text is empty."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def make(batch: pa.RecordBatch) -> dict:
        rows = [measures(x) for x in text_bytes(batch)]
        out = {n: list(x) for n, x in zip(names, zip(*rows, strict=True), strict=True)}
        return out | {n: batch.column(n) for n in ("doc_id", "host", "text_hash")}

    columns = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.xxhash64(present(text)).alias("text_hash"),
        present(text).alias("text"),
    )
    schema = "doc_id long, host string, text_hash long, " + ", ".join(f"{n} long" for n in names)
    return map_batches(columns, make, schema).withColumn("base_failed", base_failed())


def host_verdicts(
    rows: DataFrame, host: str = "host", failed: str = "base_failed", max_rate: float = MAX_RATE
) -> DataFrame:
    """host, n_docs, n_failed, rate, low, rejected: failures by host, shrunk by a beta prior.

    The prior is fitted to all hosts by moments: hosts with few texts get a rate near the usual
    one. A host is rejected if the lower bound of its posterior rate is above ``max_rate``. Texts
    without a host are not judged by one.
    """
    hosts = (
        rows.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n_docs"), F.count_if(F.col(failed)).alias("n_failed"))
    )
    hosts = checkpointed(hosts)
    alpha, beta = beta_prior(hosts, "n_docs", "n_failed")
    a, b = F.col("n_failed") + alpha, F.col("n_docs") - F.col("n_failed") + beta
    rate = a / (a + b)
    spread = F.sqrt(rate * (1 - rate) / (a + b + 1))
    return hosts.withColumn("rate", rate).withColumn("low", rate - SURE * spread).withColumn(
        "rejected", F.col("low") > max_rate
    )


def beta_prior(groups: DataFrame, trials: str, hits: str) -> tuple[float, float]:
    """Moments of a beta prior over the rates of ``groups``; a flat one if nothing can be told."""
    n, k = F.col(trials).cast("double"), F.col(hits).cast("double")
    total = groups.agg(
        F.count("*"), F.sum(n), F.sum(k), F.sum(n * n), F.sum(k * k / n)
    ).first()
    count, trials_all, hits_all, squares, spread = total
    if not count or not trials_all:
        return 1.0, 1.0
    mean = hits_all / trials_all
    if not 0 < mean < 1:
        return mean + 1 / (trials_all + 2), 1 - mean + 1 / (trials_all + 2)
    # weighted variance between groups, less what chance alone gives
    between = spread - trials_all * mean * mean - (count - 1) * mean * (1 - mean)
    room = trials_all - squares / trials_all - (count - 1)
    inner = between / room / (mean * (1 - mean)) if room > 0 else 1.0
    inner = min(max(inner, 1e-4), 0.99)
    size = 1 / inner - 1
    return mean * size, (1 - mean) * size


def judged(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source"
) -> DataFrame:
    """Every row's measures with base_failed, the host's rate and rejected, and kept.

    A text stays if no rule for texts fails and its host is not rejected. Rates are counted per
    task before any shuffle; verdicts come back by a join of two columns of numbers, which Spark
    broadcasts while hosts are few and splits under a hot host otherwise. Texts are not moved.
    """
    rows = checkpointed(measured(docs, text, doc_id, host))
    hosts = checkpointed(host_verdicts(rows).select("host", "rate", "rejected"))
    found = rows.join(hosts, "host", "left")
    bad = F.coalesce("rejected", F.lit(False))
    return found.withColumn("rejected", bad).withColumn("kept", ~F.col("base_failed") & ~bad)


def drop_low_quality(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source"
) -> DataFrame:
    """``docs`` without the rows that rules for texts or hosts reject; columns stay as they are."""
    # the host is part of the verdict: equal rows of different hosts are told apart by it
    key = F.xxhash64(F.xxhash64(present(text)), F.col(host).cast("string"))
    verdicts = judged(docs, text, doc_id, host).select(
        "doc_id",
        F.xxhash64("text_hash", "host").alias("key"),
        "kept",
        F.lit(1).alias("n_keep"),
        F.lit(0).alias("grp"),
    )
    return without(docs, checkpointed(verdicts), doc_id, key)
