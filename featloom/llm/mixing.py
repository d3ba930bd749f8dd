"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import free_name, present
from featloom.operators.ranking import running_totals
from featloom.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
"""Weights of the sources in code point order, repeated; a source that is null comes last."""
PERCENT = 150
"""What the mix takes, in percent of all words."""
MOST = 2
"""No source, and no document, is taken more often than this."""
BITS = 24
"""Expected copies are whole multiples of 1 / 2^BITS, so that their running totals are exact."""
SEED = 11


def word_count(text: str | Column = "text") -> Column:
    """The number of words of a text; null has none."""
    return F.regexp_count(present(text), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST
) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with ``weight`` and ``target``.

    Targets share ``percent`` of all sizes by weight. None is above ``most`` times its source's size;
    what is cut off is shared again by weight among the others, until none is above. That ends where
    target = min(most * size, weight * level) for one level: in the order of size / weight the first
    sources are full, and the level is what is left, over the weights that are left. Both running
    totals lie over ranges, so there may be any number of sources. An empty source has target 0; if
    even ``most`` times everything is less than ``percent`` of it, all sources are full.
    """
    if percent < 0 or most < 1 or not weights or min(weights) < 1:
        raise ValueError("percent must not be negative, most and all weights must be at least 1")
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    placed = running_totals(
        sizes.withColumn("_at", F.struct(F.col("source").isNull().alias("none"), "source")),
        order="_at",
        totals={"_place": F.lit(1)},
    )
    caps = placed.withColumns(
        {
            "weight": F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int")),
            "_cap": most * F.col("source_size"),
        }
    )
    caps = checkpointed(
        running_totals(
            caps.withColumn("_by", F.struct((F.col("_cap") / F.col("weight")).alias("full"), "_at")),
            order="_by",
            totals={"_caps": F.col("_cap"), "_weights": F.col("weight")},
        )
    )
    total, all_weights = caps.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = percent * (total or 0)
    # hundred times what the full ones before leave, and the weights that share it
    left = wanted - 100 * (F.col("_caps") - F.col("_cap"))
    share = (all_weights or 0) - F.col("_weights") + F.col("weight")
    open_ones = caps.where(left / share <= 100 * F.col("_cap") / F.col("weight"))
    first = open_ones.select(left.alias("left"), share.alias("share"), "_by").orderBy("_by").first()
    cap = F.col("_cap").cast("double")
    if first is None:
        target = cap
    else:
        level = F.lit(first["left"]).cast("double") * F.col("weight") / F.lit(100 * first["share"])
        target = F.least(cap, level)
    return caps.withColumn("target", target).select("source", "source_size", "weight", "target")


def offset(source: str, seed: int = SEED) -> Column:
    """The random offset of a source, in units of expected copies, below one: a hash of seed and source."""
    name = F.when(F.col(source).isNull(), f"{seed}").otherwise(F.concat(F.lit(f"{seed}:"), F.col(source)))
    return F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")


def with_copies(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """``rows`` (doc_id, source, size, row) with source_size, target and ``copies``.

    The expected copies of a document are target / source_size of its source. Their running total
    within the source, from a random offset on, passes a whole number as often as the document is
    taken. Documents are in falling order of size, so neighbours that swap a copy are about equally
    long and the words taken differ from the target by less than the longest document's. ``row``
    tells rows apart that agree in doc_id and size; which of them is taken makes no difference.

    The rows of a source lie in as many ranges as they need (see ``running_totals``). Targets come to
    the rows by a join that Spark broadcasts while sources are few, and splits under a hot source
    otherwise.
    """
    rows = checkpointed(rows)
    sizes = checkpointed(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sizes, weights, percent, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = checkpointed(
        targets.select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            F.round(rate * (1 << BITS)).cast("long").alias("_share"),
            offset("source", seed).alias("_offset"),
        )
    )
    met = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    at = F.struct((-F.col("size")).alias("size"), "doc_id", "row")
    summed = running_totals(
        met.withColumn("_at", at), order="_at", totals={"_upto": F.col("_share")}, keys=["source"]
    )
    end = F.col("_upto") + F.col("_offset")
    passed = F.shiftright(end, BITS) - F.shiftright(end - F.col("_share"), BITS)
    return summed.withColumn("copies", passed).drop("_at", "_upto", "_share", "_offset")


def mix_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Per document doc_id, size, source_size, target and taken: the words that the mix takes of it.

    A null text has size 0, and so has one of blanks; a null doc_id is an id like any other, first among
    equal sizes; a null source is a source. Repeated rows are documents of their own. An empty table
    gives an empty one, and other columns are not read. The same rows give the same result in any
    partitioning.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    found = with_copies(rows)
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixture(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    percent: int = PERCENT,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with all their columns.

    Rows are written once with a number, so that the copies counted are those of the same rows; whole
    rows then meet their counts by that number, in one shuffle.
    """
    name = free_name(docs, "_row")
    numbered = checkpointed(docs.withColumn(name, F.monotonically_increasing_id()))
    rows = numbered.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.col(name).alias("row"),
    )
    times = free_name(docs, "_copies")
    found = with_copies(rows, weights, percent, most, seed).where("copies > 0")
    found = found.select(F.col("row").alias(name), F.col("copies").cast("int").alias(times))
    repeated = numbered.join(found, name).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*docs.columns)
