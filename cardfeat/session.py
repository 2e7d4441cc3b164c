"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a large cluster. Shuffle partitions are
# left to the caller: on a cluster start high and let AQE coalesce.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the widest rollups carry more buffers than the default of 100 fields, past
    # which Spark stops generating code for a stage
    "spark.sql.codegen.maxFields": "400",
    "spark.ui.enabled": "false",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "cardfeat", **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` overrides them.

    Keys of ``extra`` use double underscores for dots
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_SETTINGS)
    settings.update({k.replace("__", "."): v for k, v in extra.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_FOLDERS: list[tempfile.TemporaryDirectory] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own; a cluster session
    without it is refused, since executors cannot read the driver's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        own = tempfile.TemporaryDirectory(prefix="cardfeat-", dir=os.environ.get("TMPDIR"), ignore_cleanup_errors=True)
        _OWN_FOLDERS.append(own)  # deleted when Python ends
        context.setCheckpointDir(own.name)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and go on from there.

    Used where one plan feeds many jobs (fold loops): a lost executor costs a
    re-read of finished rows, not a new run of every rollup.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_STAGED: list[str] = []
#: Where the folders of the innermost :func:`stage_scope` are listed.
_SCOPE: ContextVar[list[str] | None] = ContextVar("stages", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, readable by every executor; it is deleted with the stages."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    (_STAGED if scope is None else scope).append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Unlike a row checkpoint the result keeps column pruning and size
    statistics; texts take about half the disk of Spark's default codec. The files stay until the end of the :func:`stage_scope`, or
    until :func:`drop_stages`, since the frame that is returned is read lazily.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark._jvm
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder of :func:`scratch_path`, whose readers must be done."""
    _delete(spark, [path])


def drop_stages(spark: SparkSession) -> None:
    """Delete what was staged outside of any scope; frames that read it must be done."""
    _delete(spark, _STAGED)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at its end all that is staged inside, and nothing else.

    Results must be written or collected before the end. Scopes may be nested,
    and each thread has its own.
    """
    staged: list[str] = []
    token = _SCOPE.set(staged)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete(spark, staged)
