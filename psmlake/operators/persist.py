"""Keeping learned models: tables as Parquet, figures as JSON, boosted trees by Spark's own writer; the kind is checked on reading."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession

from psmlake.operators.engineer import FeatureModel
from psmlake.operators.rt import RtModel


class WrongKind(TypeError):
    """The folder holds another kind of model."""


def _head(folder: str | Path, kind: str) -> dict:
    head = json.loads((Path(folder) / "model.json").read_text())
    if head.get("kind") != kind:
        raise WrongKind(f"{folder} holds a {head.get('kind')}, not a {kind}")
    return head


def _write_head(folder: str | Path, head: dict) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "model.json").write_text(json.dumps(head))


def save_features(model: FeatureModel, folder: str | Path) -> None:
    for name, table in model.tables.items():
        table.write.mode("overwrite").parquet(str(Path(folder) / name))
    _write_head(folder, {"kind": "features", "tables": sorted(model.tables), "by": list(model.by)})


def load_features(spark: SparkSession, folder: str | Path) -> FeatureModel:
    head = _head(folder, "features")
    return FeatureModel({n: spark.read.parquet(str(Path(folder) / n)) for n in head["tables"]}, tuple(head["by"]))


def save_rt(model: RtModel, folder: str | Path) -> None:
    for name, table in model.tables.items():
        table.write.mode("overwrite").parquet(str(Path(folder) / name))
    _write_head(folder, {"kind": "rt", "tables": sorted(model.tables), "by": list(model.by)})


def load_rt(spark: SparkSession, folder: str | Path) -> RtModel:
    head = _head(folder, "rt")
    return RtModel({n: spark.read.parquet(str(Path(folder) / n)) for n in head["tables"]}, tuple(head["by"]))


def save_members(models: Sequence[GBTClassificationModel], names: Sequence[str], folder: str | Path) -> None:
    for m, model in enumerate(models):
        model.write().overwrite().save(str(Path(folder) / f"member{m}"))
    _write_head(folder, {"kind": "ensemble", "members": len(models), "features": list(names)})


def load_members(folder: str | Path) -> tuple[list[GBTClassificationModel], list[str]]:
    head = _head(folder, "ensemble")
    return [GBTClassificationModel.load(str(Path(folder) / f"member{m}")) for m in range(head["members"])], head["features"]
