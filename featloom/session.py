"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` keys use ``__`` for dots.

    Only adaptive execution, UTC timestamps and Arrow are set. Partition counts and memory stay
    with the cluster, because they depend on its size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors the modules that tasks import, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="code-")) / "featloom_tasks.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    That is the configured folder, or else the one the context was given for checkpoints. A
    machine-local temporary folder is used only in local mode with neither.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")


_OWNED: ContextVar[list[str] | None] = ContextVar("_OWNED", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end all that was written to scratch paths inside, whatever happened.

    Frames read their written rows when they are used, so use the results inside, too.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the written rows.

    Used where a frame is read several times and must be the same each time, also after the
    loss of an executor. Being columnar, later passes read only the columns they need. The rows
    stay until the :func:`scratch_scope` around ends, or else the cluster clears the folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "checkpoint")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled inside goes from the executors' disks as soon as the job that needed it is done.

    Otherwise it stays until the driver happens to collect its garbage. For frames that are executed once,
    such as those that are written; others would shuffle anew.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` in executor memory, or on executor disk where that is short, for several passes.

    The lineage stays, so blocks of a lost executor are computed again.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
