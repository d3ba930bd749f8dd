"""What the corpus operators share: code on the executors, words, wide hashes, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="code-")) / "featloom_code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Batches = Iterator[pa.RecordBatch]


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], dict | None], schema: str
) -> DataFrame:
    """``make`` on every Arrow batch; it returns columns by name, or None for no rows."""
    spark = df.sparkSession
    ship(spark)
    arrow = to_arrow(spark, schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = make(batch) if batch.num_rows else None
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [as_array(columns[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def as_array(values: object, kind: pa.DataType) -> pa.Array:
    """``values`` as an Arrow array of the type that the schema names."""
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema of a schema written as text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of every text; null counts as empty."""
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py() or b""


def wide_hash(data: bytes) -> tuple[int, int]:
    """128 bits of a text as two signed numbers."""
    value = xxhash.xxh3_128_intdigest(data)
    return signed(value >> 64), signed(value & 0xFFFFFFFFFFFFFFFF)


def signed(value: int) -> int:
    """An unsigned 64-bit number as Spark's signed one."""
    return value - (1 << 64) if value >= 1 << 63 else value


def present(column: str | Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet."""
    name = base
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def without(docs: DataFrame, verdicts: DataFrame, doc_id: str, key: Column) -> DataFrame:
    """``docs`` without what ``verdicts`` (doc_id, key, kept, n_keep, grp) reject.

    Rows are known by doc_id and ``key``, a hash of the text. The rejected rows are the small side
    of an anti join. Of ``n_keep`` rows of a group that cannot be told apart, one stays.
    """
    own = F.struct(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
        F.col(doc_id).isNull().alias("none"),
        key.alias("key"),
    )
    name = free_name(docs, "_row")
    marked = docs.withColumn(name, own)
    rows = verdicts.select(
        F.struct(
            F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "key"
        ).alias(name),
        "kept",
        "n_keep",
        "grp",
    )
    gone = rows.where(~F.col("kept") | (F.col("n_keep") > 1)).select(name).distinct()
    stay = marked.join(gone, name, "left_anti").drop(name)
    twice = rows.where(F.col("kept") & (F.col("n_keep") > 1)).groupBy(name).agg(F.max("grp").alias("_grp"))
    if twice.isEmpty():
        return stay
    group = free_name(docs, "_group")
    copies = marked.join(twice.withColumnRenamed("_grp", group), name)
    return stay.unionByName(copies.dropDuplicates([group]).drop(name, group))


def whole_groups(batches: Batches, keys: list[str], rows: int) -> Iterator[pa.Table]:
    """The rows of a partition, sorted by ``keys``, in portions of about ``rows`` that split no key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            whole = pa.Table.from_batches(held)
            last = group_starts(whole, keys)[-1]
            if last:
                yield whole.slice(0, last)
                whole = whole.slice(last)
            held, n = whole.combine_chunks().to_batches(), whole.num_rows
    if n:
        yield pa.Table.from_batches(held)


def group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the runs of equal keys begin; keys are numbers without nulls."""
    change = np.zeros(rows.num_rows, bool)
    change[:1] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)
