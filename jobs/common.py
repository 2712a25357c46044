"""What the jobs share: configs, columns by expressions, folders for the registered queries."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def config(path: str | Path, defaults: Mapping[str, Any]) -> dict[str, Any]:
    """The settings of a JSON file over the defaults; ValueError for unknown ones."""
    told = json.loads(Path(path).read_text())
    if unknown := sorted(set(told) - set(defaults)):
        raise ValueError(f"unknown settings {', '.join(unknown)}; known: {', '.join(defaults)}")
    return {**defaults, **told}


def named(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The columns of a job by SQL expressions over a table's own."""
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call has, under spark.checkpoint.dir; without one, on a single machine, under its temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.gettempdir()}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
