"""Command line: python -m psmlake.cli {check,search-post,rescore,quantify,run} --base FOLDER ...

Exit codes: 0 done, 1 a check failed, 2 a stage failed, 130 interrupted.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake import preflight
from psmlake.functions.scores import AT_LEAST, AT_LEAST_EXPLICIT, AT_MOST
from psmlake.operators import crosstab, filtering, lineage, rescore, sic_merge
from psmlake.operators.rollup import ROLLUPS
from psmlake.plans.quantify import quantify
from psmlake.plans.rescoring import rescored
from psmlake.sources import fasta, mzml, project, sinks, tsv
from psmlake.sources.project import ProjectLayout

log = logging.getLogger("psmlake")
TIE = ("Scan", "Charge", "Peptide", "Protein")
MODES = ("all_matches", "unique_only", "requires_unique")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="psmlake", description="Peptide-spectrum-match analytics on Spark")
    out.add_argument("--log-level", default="INFO", choices=("DEBUG", "INFO", "WARNING", "ERROR"))
    stages = out.add_subparsers(dest="stage", required=True)

    def stage(name: str, help_: str) -> argparse.ArgumentParser:
        p = stages.add_parser(name, help=help_)
        p.add_argument("--base", type=Path, required=True)
        p.add_argument("--input-dir", type=Path, help="in place of BASE/input")
        p.add_argument("--database-dir", type=Path, help="in place of BASE/database")
        p.add_argument("--output-dir", type=Path, help="in place of BASE/output")
        return p

    check = stage("check", "what is there and what is missing")
    check.add_argument("--for", dest="what", default="all", choices=(*preflight.STAGES, "all"))
    check.add_argument("--tools", type=Path)
    stage("search-post", "first hits with scan statistics and chromatograms")
    for name, help_ in (("rescore", "cross-validated rescoring"), ("run", "search-post, rescoring on request, quantification")):
        p = stage(name, help_)
        p.add_argument("--folds", type=int, default=5)
        p.add_argument("--ensemble", type=int, default=2)
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--spectra", action="store_true", help="with features of the mzML spectra")
        if name == "run":
            p.add_argument("--rescore", action="store_true")
            p.add_argument("--skip-search-post", action="store_true")
            _quantify_options(p)
    q = stage("quantify", "filter, crosstab, annotate, cover, roll up")
    q.add_argument("--from-rescored", action="store_true")
    _quantify_options(q)
    return out


def _quantify_options(p: argparse.ArgumentParser) -> None:
    fields = [*AT_MOST, *AT_LEAST, *AT_LEAST_EXPLICIT]
    p.add_argument("--score-field", default=None, choices=fields)
    p.add_argument("--threshold", type=float)
    p.add_argument("--score-field2", choices=fields)
    p.add_argument("--threshold2", type=float)
    p.add_argument("--num-pep", type=int, default=2)
    p.add_argument("--mode", default="all_matches", choices=MODES)
    p.add_argument("--rollup", default="sum", choices=ROLLUPS)
    p.add_argument("--outlier-alpha", type=float)


def _layout(args: argparse.Namespace) -> ProjectLayout:
    """The project's folders, with those given on the command line in place of the usual ones."""
    given = {k: v for k, v in (("input", args.input_dir), ("database", args.database_dir), ("output", args.output_dir)) if v is not None}
    kind = type("GivenLayout", (ProjectLayout,), {k: property(lambda _, v=v: v) for k, v in given.items()})
    return kind(args.base)


def search_post(spark: SparkSession, layout: ProjectLayout) -> DataFrame:
    layout.require(layout.search, layout.sics)
    hits = tsv.read_table(spark, str(layout.search), "fht", r"_fht\.(txt|tsv)$", ("Scan", "Peptide", "Protein"), "*_fht.*")
    out = sic_merge.merge_sics(hits, tsv.read_scan_stats(spark, str(layout.sics)), tsv.read_sic_stats(spark, str(layout.sics)))
    return sinks.write_stage(out, str(layout.first_hits / "parquet"))


def first_hits(spark: SparkSession, layout: ProjectLayout) -> DataFrame:
    stored = layout.first_hits / "parquet"
    return spark.read.parquet(str(stored)) if stored.exists() else tsv.read_first_hits(spark, str(layout.first_hits))


def rescore_stage(spark: SparkSession, layout: ProjectLayout, args: argparse.Namespace) -> DataFrame:
    # numbered and written first: numbers of shuffled rows change from one reading to the next
    rows = lineage.cut(first_hits(spark, layout).withColumn("psm_id", F.monotonically_increasing_id()))
    spectra = mzml.with_ms1(mzml.read_mzml(spark, str(layout.input))).withColumn("sample", F.regexp_replace("file", r"\.mzML$", "")) if args.spectra else None
    done, importance, gains = rescored(rows, (*TIE, "psm_id"), spectra, args.folds, args.ensemble, args.seed)
    out = sinks.write_stage(done.drop("psm_id"), str(layout.rescored / "parquet"))
    sinks.export_tsv(out, str(layout.rescored / "report"), single=False, order=rescore.report_order(TIE))
    sinks.export_tsv(importance, str(layout.qc / "importance"), order=[F.col("importance_mean").desc(), "feature"])
    sinks.export_tsv(gains, str(layout.qc / "gains"))
    return out


def quantify_stage(spark: SparkSession, layout: ProjectLayout, args: argparse.Namespace, from_rescored: bool) -> None:
    files = [str(p) for p in sorted([*layout.database.glob("*.fasta"), *layout.database.glob("*.faa")])]
    if not files:
        raise FileNotFoundError(f"no database in {layout.database}")
    rows = spark.read.parquet(str(layout.rescored / "parquet")) if from_rescored else first_hits(spark, layout)
    has_syn = layout.synopsis.is_dir() and any(layout.synopsis.glob("*_syn.*"))
    synopsis = tsv.read_synopsis(spark, str(layout.synopsis)) if has_syn and not from_rescored else None
    field = args.score_field or ("xpec_q" if from_rescored else "QValue")
    # with a manifest each sample has its own database; without one all are one
    databases = project.read_manifest(spark, str(layout.manifest)).select(F.col("msfilename").alias("sample"), "database") if layout.manifest.exists() else None
    if databases is not None:
        databases = databases.withColumn("database", F.element_at(F.split("database", "/"), -1))
    sequences = fasta.protein_sequences(spark, files) if databases is None else fasta.database_sequences(spark, files)
    done = quantify(
        rows, fasta.protein_info(spark, files), sequences, TIE, synopsis, from_rescored, field, args.threshold, args.score_field2, args.threshold2, args.mode, args.rollup, args.num_pep, args.outlier_alpha, folder=str(layout.output / "stages"), databases=databases
    )
    samples = [r["sample"] for r in done.annotated.select("sample").distinct().collect()]
    tie = [c for c in ("sample", "ScanNum", "Charge", "Peptide") if c in done.filtered.columns]
    sinks.export_tsv(done.filtered, str(layout.output / "filtered"), single=False, order=filtering.report_order(done.filtered, tie))
    wide = crosstab.wide(done.annotated, crosstab.KEYS, "intensity", sorted(samples, key=sinks.natural_key))
    sinks.export_tsv(wide, str(layout.output / "crosstab"), single=False, order=crosstab.report_order(wide))
    sinks.export_report(done.report(samples), str(layout.rollup / "report"), order=["Protein"])
    sinks.export_tsv(done.coverage, str(layout.coverage / "coverage"), order=["sample", "Protein"])


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(message)s")
    layout = _layout(args)
    if args.stage == "check":
        report = preflight.run(layout, args.what, tool_folder=args.tools)
        print(report.text())
        return 0 if report.passed else 1
    spark = SparkSession.builder.appName("psmlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.stage == "search-post" or args.stage == "run" and not args.skip_search_post:
            search_post(spark, layout)
        if args.stage == "rescore" or args.stage == "run" and args.rescore:
            rescore_stage(spark, layout, args)
        if args.stage in ("quantify", "run"):
            quantify_stage(spark, layout, args, getattr(args, "from_rescored", False) or getattr(args, "rescore", False))
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        log.error("%s failed: %s", args.stage, e)
        log.debug("", exc_info=True)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
