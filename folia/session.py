"""Session settings, and the shared folder with an owner for all that is written there."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_DIRS: dict[str, str] = {}
_ROOTS: dict[str, str] = {}
_CHECKPOINTS: set[str] = set()
# The tables written inside the innermost `temporary_tables`.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def build_session(app_name: str = "folia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` overrides them.

    Shuffle partitions are left to the cluster: AQE coalesces what is too
    small and splits what is skewed, so the configured number is an upper bound.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster.

    Only a local-mode session without the setting gets a folder of this
    machine, one per application.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_DIRS[context.applicationId]


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path and the file system it is on: the shared folder need not be a local one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _root(spark: SparkSession) -> str:
    """This application's own folder in the shared one; it goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        path = f"{shared_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
        place, system = _file_system(spark, path)
        system.mkdirs(place)
        system.deleteOnExit(place)
        _ROOTS[app] = path
    return _ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never one that holds data already.

    What is written there is removed when the enclosing `temporary_tables` ends, or else
    with the application.
    """
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end whatever was written under a `new_path` of the block.

    Use it around an operator and the action on its result: results read the tables
    that were written for them until the action is over. Blocks nest, each with its own
    tables; `kept` writes one for the block outside.
    """
    made: list[str] = []
    token = _OWNED.set(made)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in made:
            place, system = _file_system(spark, path)
            system.delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, so that a lost executor costs a re-read
    and what was shuffled for it can be freed."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    return spark.read.parquet(path)


def kept(spark: SparkSession, make, name: str) -> DataFrame:
    """The table that `make()` gives, written; what was written to work it out is removed."""
    path = new_path(spark, name)
    with temporary_tables(spark):
        make().write.parquet(path)
    gc.collect()
    return spark.read.parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared folder, so that a lost
    executor costs a re-read and later uses do not repeat the work.

    Checkpoints are in a folder that Spark names for this application alone; it goes when
    the application ends.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    if context.applicationId not in _CHECKPOINTS:
        place, system = _file_system(spark, context.getCheckpointDir())
        system.deleteOnExit(place)
        _CHECKPOINTS.add(context.applicationId)
    return df.checkpoint(eager=True)
