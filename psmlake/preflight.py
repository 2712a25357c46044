"""Checks before a run: what is there, what is missing."""

from __future__ import annotations

import importlib.util
import shutil
from collections.abc import Callable
from dataclasses import dataclass
from enum import Enum
from pathlib import Path

from psmlake.sources.project import MANIFEST_COLUMNS, ProjectLayout


class Status(Enum):
    OK = "ok"
    WARN = "warn"
    FAIL = "fail"
    SKIP = "skip"


@dataclass(frozen=True)
class Check:
    name: str
    status: Status
    message: str = ""


@dataclass(frozen=True)
class Report:
    checks: tuple[Check, ...]

    @property
    def passed(self) -> bool:
        return all(c.status is not Status.FAIL for c in self.checks)

    def text(self) -> str:
        return "\n".join(f"[{c.status.value:>4}] {c.name}" + (f": {c.message}" if c.message else "") for c in self.checks)


def _found(name: str, there: bool, message: str, missing: Status = Status.FAIL) -> Check:
    return Check(name, Status.OK if there else missing, "" if there else message)


def environment() -> list[Check]:
    out = [_found(f"python package {p}", importlib.util.find_spec(p) is not None, "not installed") for p in ("pyspark", "pyarrow", "pandas", "numpy")]
    return [*out, _found("java", shutil.which("java") is not None, "no java on the path")]


def tools(folder: Path | None, names: tuple[str, ...] = ("MSGFPlus.jar", "MASIC_Console.exe", "PeptideHitResultsProcRunner.exe")) -> list[Check]:
    """Programs that others wrote; the library only reads what they wrote out."""
    if folder is None:
        return [Check("search tools", Status.SKIP, "no folder given")]
    return [_found(f"tool {n}", any(folder.rglob(n)), f"not under {folder}", Status.WARN) for n in names]


def _files(name: str, folder: Path, pattern: str, missing: Status = Status.FAIL) -> Check:
    n = len(list(folder.glob(pattern))) if folder.is_dir() else 0
    return Check(name, Status.OK if n else missing, f"{n} files" if n else f"no {pattern} in {folder}")


def for_search(layout: ProjectLayout) -> list[Check]:
    out = [_files("spectra", layout.input, "*.[rm][az][wm]*", Status.WARN), _files("database", layout.database, "*.f*a*")]
    if not layout.manifest.exists():
        return [*out, Check("manifest", Status.WARN, f"no {layout.manifest}; it will be made")]
    lines = layout.manifest.read_text().splitlines()
    names = lines[0].split("\t") if lines else []
    missing = [c for c in MANIFEST_COLUMNS if c not in names and c != "protein_input"]
    out.append(_found("manifest columns", not missing, f"missing {', '.join(missing)}"))
    if "database" in names:
        wanted = {r.split("\t")[names.index("database")] for r in lines[1:] if len(r.split("\t")) > names.index("database")}
        gone = sorted(d for d in wanted if not (layout.database / d).exists())
        out.append(_found("manifest databases", not gone, f"not in {layout.database}: {', '.join(gone)}"))
    return out


def for_rescoring(layout: ProjectLayout) -> list[Check]:
    return [_files("first hits", layout.first_hits, "*_fht_PlusSICStats*"), _files("spectra", layout.input, "*.mzML", Status.WARN)]


def for_quantification(layout: ProjectLayout, rescored: bool = False) -> list[Check]:
    rows = _files("rescored PSMs", layout.rescored, "*") if rescored else _files("first hits", layout.first_hits, "*_fht_PlusSICStats*")
    return [rows, _files("synopses", layout.synopsis, "*_syn.*", Status.WARN), _files("database", layout.database, "*.f*a*")]


STAGES: dict[str, Callable[..., list[Check]]] = {"search": for_search, "rescore": for_rescoring, "quantify": for_quantification}


def run(layout: ProjectLayout, stage: str = "all", rescored: bool = False, tool_folder: Path | None = None) -> Report:
    """The environment, the tools and one stage or all."""
    if stage not in (*STAGES, "all"):
        raise ValueError(f"unknown stage {stage}; known: {', '.join([*STAGES, 'all'])}")
    checks = [*environment(), *tools(tool_folder)]
    for name, check in STAGES.items():
        if stage in (name, "all"):
            checks += check(layout, rescored) if name == "quantify" else check(layout)
    return Report(tuple(checks))
