"""A project's folders and small files: layout, manifest, search parameters, database parts."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.schemas import schema

#: Spectrum file endings, in the order they are tried.
SPECTRUM_ENDINGS = (".mzML", ".mgf", ".mzXML", ".ms2")
MANIFEST_COLUMNS = ("msfilename", "protein_input", "database", "QCplot")


@dataclass(frozen=True)
class ProjectLayout:
    """Every path of a project, from its base folder."""

    base: Path

    @classmethod
    def at(cls, base: str | Path) -> ProjectLayout:
        return cls(Path(base))

    input = property(lambda s: s.base / "input")
    database = property(lambda s: s.base / "database")
    output = property(lambda s: s.base / "output")
    params = property(lambda s: s.base / "params")
    manifest = property(lambda s: s.input / "inputfile.tsv")
    search = property(lambda s: s.output / "search")
    sics = property(lambda s: s.output / "sics")
    first_hits = property(lambda s: s.output / "first_hits")
    synopsis = property(lambda s: s.output / "synopsis")
    rescored = property(lambda s: s.output / "rescored")
    selected = property(lambda s: s.output / "selected")
    withsyn = property(lambda s: s.output / "withsyn")
    filtered = property(lambda s: s.output / "filtered")
    crosstab = property(lambda s: s.output / "crosstab")
    annotated = property(lambda s: s.output / "annotated")
    coverage = property(lambda s: s.output / "coverage")
    rollup = property(lambda s: s.output / "rollup")
    qc = property(lambda s: s.output / "qc")
    checkpoints = property(lambda s: s.output / "checkpoints")

    def require(self, *paths: Path) -> ProjectLayout:
        """Itself, or FileNotFoundError naming what isn't there or is empty."""
        missing = [str(p) for p in paths if not p.exists() or (p.is_dir() and not any(p.iterdir()))]
        if missing:
            raise FileNotFoundError(f"missing or empty: {', '.join(missing)}")
        return self

    def ensure(self, *paths: Path) -> ProjectLayout:
        for p in paths:
            p.mkdir(parents=True, exist_ok=True)
        return self


def parse_conf(path: str | Path) -> dict[str, str]:
    """`key = value` lines; lines that begin with # are comments, a # further on belongs to the value; no file: nothing."""
    path = Path(path)
    if not path.exists():
        return {}
    pairs = (line.split("=", 1) for line in path.read_text().splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip() for k, v in pairs}


def update_manifest(raw_dir: str | Path, database_dir: str | Path, manifest: str | Path) -> list[dict[str, str]]:
    """The manifest's rows, written anew: from the raw files, or the old rows with the one database; ValueError unless there is exactly one."""
    found = sorted(p for p in Path(database_dir).iterdir() if p.suffix.lower() in (".fasta", ".faa"))
    if len(found) != 1:
        raise ValueError(f"need exactly one database in {database_dir}, found {len(found)}")
    manifest, name = Path(manifest), found[0].name
    if manifest.exists():
        with manifest.open(newline="") as f:
            table = list(csv.reader(f, delimiter="\t"))
        rows = [dict(zip(MANIFEST_COLUMNS, r, strict=False)) | {"database": name} for r in table[1:] if len(r) >= 4]
    else:
        stems = sorted(p.stem for p in Path(raw_dir).iterdir() if p.suffix.lower() == ".raw")
        rows = [{"msfilename": s, "protein_input": s, "database": name, "QCplot": f"{s}_tic"} for s in stems]
    manifest.parent.mkdir(parents=True, exist_ok=True)
    with manifest.open("w", newline="") as f:
        out = csv.DictWriter(f, MANIFEST_COLUMNS, delimiter="\t", lineterminator="\n")
        out.writeheader()
        out.writerows(rows)
    return rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema("manifest")).csv(path)


def spectrum_files(manifest: DataFrame, files: list[str]) -> DataFrame:
    """Manifest rows with the spectrum file of their name, of the ending tried first."""
    rows = [(Path(f).name, SPECTRUM_ENDINGS.index(Path(f).suffix)) for f in files if Path(f).suffix in SPECTRUM_ENDINGS]
    spark = manifest.sparkSession
    known = spark.createDataFrame([(re.sub(r"\.[^.]+$", "", n), n, k) for n, k in rows], "stem string, spectrum_file string, rank int")
    best = known.groupBy("stem").agg(F.min_by("spectrum_file", "rank").alias("spectrum_file"))
    stem = F.regexp_replace("msfilename", r"\.[^.]+$", "")
    return manifest.withColumn("stem", stem).join(best, "stem", "left").drop("stem")


def unmatched(manifest: DataFrame, databases: list[str], raw_stems: list[str]) -> DataFrame:
    """(kind, name): databases the manifest names that aren't there, and rows without a raw file."""
    spark = manifest.sparkSession
    there = spark.createDataFrame([(d,) for d in databases], "database string")
    raws = spark.createDataFrame([(r,) for r in raw_stems], "stem string")
    no_db = manifest.join(there, "database", "left_anti").select(F.lit("database").alias("kind"), F.col("database").alias("name"))
    named = manifest.withColumn("stem", F.regexp_replace("msfilename", r"\.[^.]+$", ""))
    no_raw = named.join(raws, "stem", "left_anti").select(F.lit("raw").alias("kind"), F.col("msfilename").alias("name"))
    return no_db.unionByName(no_raw).distinct()


def database_parts(files: list[str], prefix: str) -> list[tuple[int, str]]:
    """(part number, file) of a split database, by number."""
    pattern = re.compile(rf"^{re.escape(prefix)}_part(\d+)\.(fasta|faa)$")
    return sorted((int(m.group(1)), f) for f in files if (m := pattern.match(Path(f).name)))


def joined_parts(spark: SparkSession, parts: list[tuple[int, str]]) -> DataFrame:
    """(part, line): the lines of a split database, all parts together; by part, then as they stand, they are the whole file."""
    read = [spark.read.text(f).select(F.lit(n).alias("part"), F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line")) for n, f in parts]
    return reduce(DataFrame.unionByName, read) if read else spark.createDataFrame([], "part int, ord long, line string")


def pair_parts(results: list[str], parts: list[tuple[int, str]]) -> list[tuple[str, str]]:
    """Result files with their parts by number; ValueError where the counts differ."""
    numbered = {int(m.group(1)): f for f in results if (m := re.search(r"_part(\d+)", f))}
    if len(numbered) != len(parts) or set(numbered) != {n for n, _ in parts}:
        raise ValueError(f"{len(numbered)} results for {len(parts)} parts")
    return [(numbered[n], f) for n, f in parts]
