"""From PSMs to the protein report, one lazy plan; stages are written only where a folder is given."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from psmlake.operators import annotate, coverage, crosstab, filtering, rollup, shared
from psmlake.sources.sinks import write_stage


@dataclass
class Quantified:
    filtered: DataFrame
    annotated: DataFrame
    coverage: DataFrame
    values: DataFrame
    facts: DataFrame

    def report(self, samples: Sequence[str]) -> DataFrame:
        """The wide protein report."""
        from psmlake.sources.sinks import ordered

        wide = crosstab.wide(self.values.withColumnRenamed("value", "intensity"), ["Protein"], "intensity", samples, None)
        return ordered(wide.join(self.facts, "Protein"), list(samples), ["Protein"])


def quantify(
    psms: DataFrame, info: DataFrame, proteins: DataFrame, tie: Sequence[str], synopsis: DataFrame | None = None, rescored: bool = False, metric1: str = "QValue", threshold1: float | None = None, metric2: str | None = None, threshold2: float | None = None,
    mode: str = "all_matches", method: str = "sum", min_num_pep: int = 2, outlier_alpha: float | None = None, log_transform: bool = True, folder: str | None = None, databases: DataFrame | None = None,
) -> Quantified:
    """Select ions, bring back shared proteins, filter, crosstab, annotate, cover, roll up.

    `rescored`: the rows are already one a scan, with their scores; no selection then.
    `databases` (sample, database): `proteins` have a database then, and each sample's peptides are sought in its own.
    """
    keep = (lambda df, name: write_stage(df, f"{folder}/{name}")) if folder else (lambda df, _: df)
    rows = psms if rescored else filtering.prepare_sics(psms, tie)
    after = [c for c in ("ScanNum", "Charge", "Peptide", "Protein") if c in rows.columns]
    if synopsis is not None:
        rows = shared.merge_shared(rows, synopsis, after)
    filtered = keep(filtering.filter_psms(rows, metric1, threshold1, metric2, threshold2), "filtered")
    table = crosstab.peptide_crosstab(crosstab.sample_names(filtered))
    annotated = keep(annotate.uniqueness(annotate.annotated(table, info)), "annotated")
    covered = keep(coverage.coverage(annotated, proteins, mode, min_num_pep, databases=databases), "coverage")
    values, facts = rollup.protein_rollup(annotated, method, mode, covered, log_transform, outlier_alpha=outlier_alpha)
    return Quantified(filtered, annotated, covered, keep(values, "rollup"), keep(facts, "facts"))
