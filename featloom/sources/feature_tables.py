"""Tables that change in one step: keyed feature tables, and the view over snapshots behind them.

A table is a catalog view over the newest of a row of snapshot tables. A change writes the next
snapshot in full, checks it, and then replaces the view in one catalog statement, so readers see the old
rows or the new ones and a failed write leaves no trace. The snapshot before stays for readers that
have begun; older ones are removed. The view carries the key, the snapshot number and the layout
as table properties. One writer per table at a time.

A table with buckets keeps every bucket in a folder of its own, as a partition of the snapshot. A merge
writes the folders of the buckets that have updates; the next snapshot names these and the folders
that stay, so it costs what its buckets cost. A folder goes when no snapshot names it any more.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featloom.operators.keys import assert_unique
from featloom.operators.upsert import upsert_rows
from featloom.session import checkpointed, delete_path

PROPERTY = "featloom."
BUCKET = "featloom_bucket"


@dataclass(frozen=True)
class FeatureTable:
    """What the catalog knows about a feature table."""

    name: str
    key: tuple[str, ...]
    comment: str
    snapshot: int
    buckets: int
    location: str | None

    @property
    def snapshot_name(self) -> str:
        return f"{self.name}__s{self.snapshot}"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _quoted(columns: Iterable[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "`" for c in columns)


def _bucket(table: FeatureTable) -> Column:
    """The bucket in which Spark puts a row of the table."""
    return F.pmod(F.hash(*table.key), F.lit(table.buckets))


def _home(spark: SparkSession, table: FeatureTable) -> str:
    """The folder of a bucketed table: the given location, or one below that of its database."""
    if table.location:
        return table.location.rstrip("/")
    *database, name = table.name.split(".")
    place = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase())
    return f"{place.locationUri.rstrip('/')}/{name}__files"


def _folders(spark: SparkSession, name: str) -> dict[int, str]:
    """The folder of each bucket that has rows in the snapshot ``name``; a few files per bucket."""
    found = {}
    for file in spark.table(name).inputFiles():
        folder = unquote(file).rpartition("/")[0]
        found[int(folder.rpartition("=")[2])] = folder
    return found


def _name_folders(spark: SparkSession, name: str, folders: dict[int, str]) -> None:
    """Make folders of older snapshots partitions of the snapshot ``name``."""
    if folders:
        listed = " ".join(
            f"PARTITION ({BUCKET} = {bucket}) LOCATION {_literal(folder)}"
            for bucket, folder in sorted(folders.items())
        )
        spark.sql(f"ALTER TABLE {name} ADD {listed}")


def publish(df: DataFrame, table: FeatureTable, staying: dict[int, str] | None = None) -> DataFrame:
    """Write the snapshot, check its keys, move the view to it, and return the view.

    ``staying`` has the folders of the buckets that ``df`` has no rows of and that stay as they are.
    """
    spark = df.sparkSession
    if table.buckets:
        place = f"{_home(spark, table)}/s{table.snapshot}"
        delete_path(spark, place)
        writer = df.withColumn(BUCKET, _bucket(table)).write.partitionBy(BUCKET)
        writer = writer.bucketBy(table.buckets, *table.key).sortBy(*table.key).option("path", place)
    else:
        writer = df.write
        if table.location:
            writer = writer.option("path", f"{table.location}/s{table.snapshot}")
    writer.mode("overwrite").format("parquet").saveAsTable(table.snapshot_name)
    if table.key:
        try:
            # With buckets, the check reads the key columns of the written buckets where they are.
            assert_unique(spark.table(table.snapshot_name), table.key)
        except ValueError:
            _remove(spark, table, table.snapshot)
            raise
    _name_folders(spark, table.snapshot_name, staying or {})
    properties = {
        "key": ",".join(table.key),
        "snapshot": str(table.snapshot),
        "buckets": str(table.buckets),
        "location": table.location or "",
        "comment": table.comment,
    }
    listed = ", ".join(f"'{PROPERTY}{k}' = {_literal(v)}" for k, v in properties.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {table.name} COMMENT {_literal(table.comment)} "
        f"TBLPROPERTIES ({listed}) AS SELECT {_quoted(df.columns)} FROM {table.snapshot_name}"
    )
    if table.snapshot >= 2:
        _remove(spark, table, table.snapshot - 2)
    return spark.table(table.name)


def _remove(spark: SparkSession, table: FeatureTable, number: int) -> None:
    """Drop a snapshot, with its files where the table has a location of its own.

    Of a table with buckets go the folders that the snapshot after it doesn't name; no later one
    can, as each takes its folders from the one before. What a failed write left goes whole.
    """
    name = f"{table.name}__s{number}"
    if not table.buckets:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if table.location:
            delete_path(spark, f"{table.location}/s{number}")
        return
    following = f"{table.name}__s{number + 1}"
    kept = set()
    gone = {f"{_home(spark, table)}/s{number}"}
    if number < table.snapshot and spark.catalog.tableExists(name):
        kept = set(_folders(spark, following).values())
        gone |= set(_folders(spark, name).values()) - kept
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _delete_unnamed(spark, gone, kept)


def _delete_unnamed(spark: SparkSession, gone: set[str], kept: set[str]) -> None:
    """Remove folders, and those of whole snapshots that hold nothing that is kept."""
    used = {folder.rpartition("/")[0].rpartition("/")[2] for folder in kept}
    for folder in gone:
        whole = folder if "=" not in folder.rpartition("/")[2] else folder.rpartition("/")[0]
        if whole.rpartition("/")[2] not in used:
            delete_path(spark, whole)
        elif whole != folder:
            delete_path(spark, folder)


def create_feature_table(
    spark: SparkSession,
    name: str,
    key: str | tuple[str, ...],
    schema: StructType,
    comment: str = "",
    buckets: int = 0,
    location: str | None = None,
) -> bool:
    """Create the empty table ``name``; do nothing and return False if it is there already.

    With ``buckets`` the snapshots are stored bucketed and sorted by the key, so that lookups and
    merges read them without a shuffle, and a merge writes only the buckets it has updates for.
    """
    if spark.catalog.tableExists(name):
        return False
    keys = (key,) if isinstance(key, str) else tuple(key)
    absent = [k for k in keys if k not in schema.fieldNames()]
    if absent:
        raise ValueError(f"key columns not in the schema: {absent}")
    if buckets and BUCKET in schema.fieldNames():
        raise ValueError(f"the name {BUCKET} is taken")
    table = FeatureTable(name, keys, comment, 0, buckets, location)
    publish(spark.createDataFrame([], schema), table)
    return True


def feature_table(spark: SparkSession, name: str) -> FeatureTable:
    """The catalog entry of a feature table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    found = {r["key"]: r["value"] for r in rows}
    if f"{PROPERTY}snapshot" not in found:
        raise ValueError(f"{name} is not a feature table")
    return FeatureTable(
        name=name,
        key=tuple(filter(None, found[f"{PROPERTY}key"].split(","))),
        comment=found[f"{PROPERTY}comment"],
        snapshot=int(found[f"{PROPERTY}snapshot"]),
        buckets=int(found[f"{PROPERTY}buckets"]),
        location=found[f"{PROPERTY}location"] or None,
    )


def merge(spark: SparkSession, name: str, updates: DataFrame) -> DataFrame:
    """Update the rows whose key exists, insert the others, keep the rest; return the table.

    The first rows of a table are written as they come. Later updates are written once to the shared
    folder, as the rows to replace and the rows to write must be the same. With buckets, only those with
    updates are read and written; the others stay in their files. The driver gets their numbers.
    """
    current = feature_table(spark, name)
    following = replace(current, snapshot=current.snapshot + 1)
    if current.buckets:
        # In the buckets of the table: neither the join nor the write nor the check moves the
        # rows again, and the stored rows stay where they are.
        updates = updates.repartition(current.buckets, *current.key)
    stored = spark.table(name)
    if set(stored.columns) != set(updates.columns):
        raise ValueError("target and updates have different columns")
    if current.snapshot == 0:
        return publish(updates.select(*stored.columns), following)
    staged = checkpointed(updates)
    staying = {}
    same = {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in updates.schema}
    if current.buckets and same:  # keys of another type have other buckets: then all is rewritten
        touched = {r[0] for r in staged.select(_bucket(current)).distinct().collect()}
        folders = _folders(spark, current.snapshot_name)
        staying = {bucket: folder for bucket, folder in folders.items() if bucket not in touched}
        rewritten = F.col(BUCKET).isin(sorted(touched & folders.keys()))
        stored = spark.table(current.snapshot_name).filter(rewritten).select(*stored.columns)
    if current.buckets:
        staged = staged.repartition(current.buckets, *current.key)
    merged = upsert_rows(stored, staged, current.key, check=False)
    return publish(merged, following, staying)


def drop_feature_table(spark: SparkSession, name: str) -> None:
    """Drop the view and its snapshots with their files if they exist."""
    if not spark.catalog.tableExists(name):
        return
    table = feature_table(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    numbers = range(max(0, table.snapshot - 1), table.snapshot + 1)
    names = [f"{name}__s{number}" for number in numbers]
    folders = set()
    if table.buckets:
        folders = {f for s in names for f in _folders(spark, s).values()}
    for number in reversed(numbers):
        _remove(spark, replace(table, snapshot=number), number)
    for whole in {folder.rpartition("/")[0] for folder in folders}:
        delete_path(spark, whole)
    if table.buckets and not table.location:
        delete_path(spark, _home(spark, table))
