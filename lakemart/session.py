"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans count on. A value the user set explicitly always wins.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the aggregate above then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Bytes of rows that cross to a Python task at once. By Spark's own bound, rows and 64 MB, a task and its worker each
# hold several copies of tens of MB of long texts.
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}

_local_scratch: str | None = None
# Scratch tables of the innermost open scope; outside of any, those that ``release_scratch`` deletes.
_written: ContextVar[list[str]] = ContextVar("written", default=[])


def apply_defaults(spark: SparkSession, settings: dict[str, str] = RUNTIME_DEFAULTS) -> SparkSession:
    explicit = spark.conf.getAll
    for key, value in settings.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors share one machine, may fall back to a temporary folder.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="lakemart-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.get().append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch area and read it back.

    Used where a plan is read more than once and must not be recomputed differently, e.g. after range sampling.
    The files outlive any executor, and later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables written so far in this scope. Frames built on them cannot be read afterwards."""
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    written, removed = _written.get(), 0
    while written:
        path = jvm.org.apache.hadoop.fs.Path(written.pop())
        if path.getFileSystem(hadoop_conf).delete(path, True):
            removed += 1
    return removed


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end, whatever happens; those of others stay."""
    token = _written.set([])
    try:
        yield
    finally:
        release_scratch(spark)
        _written.reset(token)
