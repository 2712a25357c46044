"""Shared plumbing: the folder all executors see, lineage cuts, missing columns."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Suffix for working columns, so that a column of the caller cannot clash.
MARK = "__llm"
BATCH_BYTES = 4 << 20
#: Fixed value: the setting where nobody changed it.
USUAL_BATCH = "67108864b"


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.  Where none is set, a temporary one on a single machine; on a cluster that is an error, as its machines don't share one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="psmlake-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(own)
    return f"file://{own}"


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder, in a folder for each value of `by`, and read it back.

    The plan above it no longer depends on the stages below it, and the files
    outlive any executor.  The table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is already gone; the folder belongs to it
        pass


def dropped(*tables: DataFrame) -> None:
    """Remove tables of written() that nothing reads any more."""
    for df in tables:
        for path in {unquote(f).rpartition("/")[0] for f in df.inputFiles()}:
            _remove(df.sparkSession, path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the files of an action's shuffles go as it ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bounded_batches(spark: SparkSession) -> None:
    """Keep the batches that Python workers get within BATCH_BYTES, for this session: whole documents are large rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == USUAL_BATCH:  # a size that someone chose stays
        spark.conf.set(key, str(BATCH_BYTES))


def trim() -> None:
    """Give freed memory back: a Python worker lives on, and an executor's other workers need it."""
    pa.set_memory_pool(pa.system_memory_pool())  # others keep what they once held
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do without
        ctypes.CDLL(None).malloc_trim(0)


def partitions_for(total: int, each: int, least: int = 1) -> int:
    """How many parts hold `total` at about `each` a part."""
    return max(least, -(-int(total or 0) // each))
