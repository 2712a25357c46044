"""Cutting long plans, by a table in the folder that driver and executors share, and dealing rows to as many tasks as the files call for."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of the files read to a part, where the session's shuffles have fewer parts: about a million matches.
PART_BYTES = 16 << 20
#: Folders of the tables that go with the innermost passing() block.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a temporary folder on a single machine, and an error on a cluster, as its machines don't share one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="psmlake-")
    atexit.register(shutil.rmtree, folder, True)
    return f"file://{folder}"


def cut(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back; the table goes when the driver ends, or with the passing() block around.

    Later plans are short, and the rows outlive any executor.
    """
    return _cut(df, _PASSING.get())


def _cut(df: DataFrame, passing_: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    if passing_ is not None:
        passing_.append(path)  # before it is written: what a failed write leaves goes too
    else:
        atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Within, tables of cut() go with the block, and the files of an action's shuffles as it ends, not when the driver happens to collect garbage.

    Gives a cut() whose tables outlast the block, for its results: they go with the block around it, or when the driver ends.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, around, own = spark.conf.get(key, None), _PASSING.get(), []
    told = _PASSING.set(own)
    spark.conf.set(key, "true")
    try:
        yield lambda df: _cut(df, around)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        _PASSING.reset(told)
        for path in own:
            _remove(spark, path)


def parts_for(df: DataFrame) -> int:
    """As many parts as the session's shuffles have, or more where the files under `df` are larger: so a task's share doesn't grow with the input."""
    spark = df.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(f)) for f in df.inputFiles()]
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] if files else 0
    return max(usual, -(-int(size or 0) // PART_BYTES))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt by `keys` to parts_for() parts; as it is where the session's shuffles have as many, so that they combine and coalesce as usual."""
    parts = parts_for(df)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is already gone; the folder belongs to it
        pass


def give_back() -> None:
    """Give freed memory back to the machine: a Python worker lives on, and an executor's other workers need it."""
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do without
        ctypes.CDLL(None).malloc_trim(0)
