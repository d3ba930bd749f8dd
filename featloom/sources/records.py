"""Records of text files whose quoted fields may hold line breaks, found in all splits at once.

Whether a line starts a record depends on the number of quotes in the file before it. A first pass counts the
quotes of each split and adds up the splits of each file, one row a split. A second pass knows for each
split whether it begins inside quotes; its task joins lines to records as they come, without a shuffle
of the text. Only pieces of a record that goes on in the next split meet by a shuffle, two a split at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featloom.session import checkpointed, ship_code

# Splits are told to all tasks up to this many characters of their rows; beyond, lines meet theirs by a join.
TOLD_CHARACTERS = 32 << 20
SPLIT = ["file", "begin"]
WHOLE, HEAD, TAIL = 0, 1, 2
SCHEMA = "file string, begin bigint, kind tinyint, first boolean, text string"


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every record of the files at ``path``, and whether it is the ``first`` of its file.

    A record ends at a line feed outside quotes, with a carriage return before it or not. A quote inside
    a field is doubled, and a field with a quote is quoted. Empty lines outside quotes are no records.
    """
    ship_code(spark)
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.col("value").alias("line"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy(*SPLIT).agg(F.sum(quotes).alias("quotes"))
    before = F.coalesce(
        F.sum("quotes").over(
            Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    inside, after = before % 2 == 1, (before + F.col("quotes")) % 2 == 1
    splits = checkpointed(counted.select(*SPLIT, inside.alias("inside"), after.alias("after")))
    size, broken = splits.agg(
        F.coalesce(F.sum(F.length("file") + 16), F.lit(0)),
        F.coalesce(F.bool_or(F.col("inside") | F.col("after")), F.lit(False)),
    ).first()
    splits = splits.drop("after")
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    if size <= TOLD_CHARACTERS:
        # A broadcast join leaves the lines of a task in their order.
        known = placed.join(F.broadcast(splits), SPLIT, "left")
    else:
        known = placed.join(splits.hint("shuffle_hash"), SPLIT, "left").sortWithinPartitions("place")
    message = F.lit("files are split otherwise than before: set spark.sql.files.minPartitionNum")
    known = known.select(
        *SPLIT, "line", F.coalesce("inside", F.raise_error(message).cast("boolean")).alias("inside")
    )
    found = known.mapInArrow(_join_lines, SCHEMA)
    text = F.regexp_replace("text", "\r$", "")
    # Most records are whole: they are found again for the few pieces instead of being stored.
    records = found.filter(F.col("kind") == WHOLE).select("first", "text")
    if broken:
        records = records.unionByName(_stitched(found.filter(F.col("kind") != WHOLE)))
    return records.withColumn("text", text).filter(F.col("text") != "")


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records put together from pieces: the open end of a split and what begins the splits after it."""
    record = F.sum((F.col("kind") == TAIL).cast("int")).over(
        Window.partitionBy("file").orderBy("begin", "kind")
    )
    part = F.struct("begin", "kind", "text", "first")
    joined = (
        pieces.withColumn("record", record)
        .groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(part)).alias("parts"))
    )
    return joined.select(
        F.exists("parts", lambda p: p["first"]).alias("first"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )


def _join_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of each split, which come one after the other and in their order."""
    split = None
    held: list[str] = []
    kind = WHOLE
    inside = first = False
    for batch in batches:
        for part in _one_split_each(batch):
            here = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            if here != split:
                if held:
                    yield _rows(split, [TAIL if kind == WHOLE else HEAD], [first], ["\n".join(held)])
                split, held = here, []
                inside = part.column(3)[0].as_py()
                kind = HEAD if inside else WHOLE
                first = here[1] == 0 and not inside
            lines = part.column(2)
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            # after each line: whether a quote is open
            is_open = (np.cumsum(odd) + inside) % 2 == 1
            ends = np.flatnonzero(~is_open)
            inside = bool(is_open[-1])
            if not len(ends):
                held += lines.to_pylist()
                continue
            kinds = np.full(len(ends), WHOLE, dtype=np.int8)
            firsts = np.zeros(len(ends), dtype=bool)
            kinds[0], firsts[0] = kind, first
            offsets = np.concatenate([[0], ends + 1])
            texts = _joined(lines, offsets)
            if held:
                texts[0] = "\n".join([*held, texts[0]])
            yield _rows(split, kinds, firsts, texts)
            held, kind, first = lines[offsets[-1] :].to_pylist(), WHOLE, False
    if held:
        yield _rows(split, [TAIL if kind == WHOLE else HEAD], [first], ["\n".join(held)])


def _one_split_each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The runs of rows of ``batch`` that belong to one split."""
    if not batch.num_rows:
        return
    files = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    begins = batch.column(1).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((files[1:] != files[:-1]) | (begins[1:] != begins[:-1])) + 1
    for low, high in zip([0, *edges], [*edges, batch.num_rows]):
        yield batch.slice(low, high - low)


def _joined(lines: pa.Array, offsets: np.ndarray) -> list[str]:
    """The lines from each offset to the next, joined by line feeds."""
    if len(offsets) == offsets[-1] + 1:
        return lines[: offsets[-1]].to_pylist()
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines[: offsets[-1]])
    return pc.binary_join(lists, "\n").to_pylist()


def _rows(split, kinds, firsts, texts) -> pa.RecordBatch:
    count = len(texts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([split[0]] * count, pa.string()),
            pa.array([split[1]] * count, pa.int64()),
            pa.array(kinds, pa.int8()),
            pa.array(firsts, pa.bool_()),
            pa.array(texts, pa.string()),
        ],
        ["file", "begin", "kind", "first", "text"],
    )
