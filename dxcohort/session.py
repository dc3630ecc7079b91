"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import copy
import os
import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on. Adaptive execution re-plans
# joins from measured sizes and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "dxcohort",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the library defaults.

    On a cluster leave ``master`` unset (spark-submit provides it) and size
    ``shuffle_partitions`` to the data: roughly input bytes / 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one
    is always used. Only a local session (tests, the bench) without the
    setting gets a private folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
                "so lineage can be cut in a way that survives executor loss"
            )
        configured = tempfile.mkdtemp(prefix="dxcohort-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


class Scratch:
    """Owner of the scratch paths that are handed out while it is the innermost one."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def remove(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())


_INNERMOST = threading.local()
#: Paths of lazily returned frames: those in use, and those nobody can read any more.
_IN_USE: dict[int, list[str]] = {}
_ORPHANS: list[str] = []


def _owners() -> list[Scratch]:
    if not hasattr(_INNERMOST, "owners"):
        _INNERMOST.owners = []
    return _INNERMOST.owners


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """A job's scratch: the paths handed out inside are removed at its end, after
    a failure as well. Frames that read them must be written by then."""
    owner = Scratch(spark)
    _owners().append(owner)
    try:
        yield owner
    finally:
        _owners().remove(owner)
        owner.remove()


def scoped_frame(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` returns, with its scratch removed once neither it
    nor a frame derived from it is referenced any more (at the next call, at
    ``sweep_scratch``, or when Python ends). A failure removes it at once.

    Derived frames share the returned frame's session object, a copy of
    ``spark``, whose end is the sign. Of two joined frames the left one's is
    shared: keep the right one while the result is in use.
    """
    sweep_scratch(spark)
    owner = Scratch(spark)
    _owners().append(owner)
    try:
        df = make()
    except BaseException:
        owner.remove()
        raise
    finally:
        _owners().remove(owner)
    if not owner.paths:
        return df
    session = copy.copy(spark)
    _IN_USE[id(owner)] = owner.paths
    weakref.finalize(session, _orphaned, id(owner)).atexit = False
    return type(df)(df._jdf, session)


def _orphaned(key: int) -> None:
    _ORPHANS.extend(_IN_USE.pop(key, ()))


def sweep_scratch(spark: SparkSession) -> None:
    """Remove the scratch of lazily returned frames that are gone."""
    while _ORPHANS:
        remove_path(spark, _ORPHANS.pop())


@atexit.register
def _sweep_at_exit() -> None:
    """What frames still hold when Python ends goes with the session, if it lives."""
    spark = SparkSession.getActiveSession()
    for key in list(_IN_USE):
        _orphaned(key)
    if spark is not None and spark.sparkContext._jsc is not None:
        try:
            sweep_scratch(spark)
        except Exception:  # the JVM has ended before: nothing can be removed
            _ORPHANS.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table in the shared folder. Its
    owner, if there is one, removes it; otherwise it stays until the folder is
    cleared."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if _owners():
        _owners()[-1].paths.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    What follows (counts, broadcast sides, the main plan) reads the written
    table, so the lineage of ``df`` runs once and ends here; a lost executor
    does not re-run it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is no more than columns and rows of files, so that reading
    it again repeats no work. (Rows may be chosen by plain filters.)"""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    for node in nodes:
        name = node.nodeName()
        if name not in ("Project", "Filter") and not name.startswith(("LogicalRelation", "Relation")):
            return False
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return True


def shuffles(df: DataFrame) -> bool:
    """Whether ``df`` is planned with a shuffle, which each further reading repeats."""
    return "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it is a written table already, else ``materialize`` of it."""
    return df if is_written(df) else materialize(df, name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Spark's file system for it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
