"""Protein rollups of the long peptide table.

Input rows: Protein, PeptideFlanked, Peptide, sample, intensity, Unique, and optionally Gene, Function, Cluster.  Everything is grouped
by protein (and sample), so a table of any number of samples costs the same shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from psmlake.functions.scores import back_from_log2, log2_safe
from psmlake.operators import grubbs
from psmlake.operators.annotate import keep_mode
from psmlake.schemas import has, require

ROLLUPS = ("sum", "rrollup", "zrollup", "qrollup", "dwrollup")
IN_LOG = ("rrollup", "zrollup", "qrollup")
TOP_SHARE = 1.0 / 3.0
#: Critical values of groups up to this size are part of the plan; those of larger ones are computed for the sizes that occur.
GRUBBS_SIZES = 500


def _grid(rows: DataFrame, values: DataFrame) -> DataFrame:
    """A row for each protein and each sample of the table."""
    return _pairs(rows).join(values, ["Protein", "sample"], "left")


def _pairs(rows: DataFrame) -> DataFrame:
    """Each protein with the one array of all samples, exploded; no join of proteins with samples is needed."""
    names = rows.agg(F.sort_array(F.collect_set("sample")).alias("s")).first()["s"]
    return rows.select("Protein").distinct().select("Protein", F.explode(F.array(*[F.lit(s) for s in names])).alias("sample"))


def reference_peptides(rows: DataFrame, n_samples: int) -> DataFrame:
    """For each protein the peptide with the fewest missing samples, then the highest median, then the first by name."""
    stats = rows.where("v is not null").groupBy("Protein", "PeptideFlanked").agg(F.count("v").alias("n"), F.median("v").alias("middle"))
    w = Window.partitionBy("Protein").orderBy((F.lit(n_samples) - F.col("n")).asc(), F.col("middle").desc_nulls_last(), "PeptideFlanked")
    return stats.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("Protein", F.col("PeptideFlanked").alias("reference"))


def _critical(alpha: float):
    @F.pandas_udf("double")
    def critical(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda n: grubbs.critical(int(n), alpha)).astype(float)

    return critical


def without_outliers(rows: DataFrame, alpha: float, by: Sequence[str], value: str = "v") -> DataFrame:
    """Grubbs' test, two-sided, once per group: the value farthest from the mean becomes null where it is beyond the critical distance."""
    w = Window.partitionBy(*by)
    far = F.abs(F.col(value) - F.col("__mean"))
    out = rows.withColumns({"__n": F.count(value).over(w), "__mean": F.avg(value).over(w), "__sd": F.stddev_samp(value).over(w)})
    out = out.withColumn("__far", F.max(far).over(w))
    first = Window.partitionBy(*by).orderBy(far.desc_nulls_last(), "PeptideFlanked")
    table = F.array(*[F.lit(grubbs.critical(n, alpha)) for n in range(GRUBBS_SIZES + 1)])
    large = rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > GRUBBS_SIZES).select("n").distinct()
    large = large.select(F.col("n").alias("__size"), _critical(alpha)("n").alias("__limit"))
    out = out.join(large, F.col("__n") == F.col("__size"), "left").drop("__size")
    limit = F.coalesce("__limit", F.element_at(table, F.least(F.col("__n"), F.lit(GRUBBS_SIZES)).cast("int") + 1))
    out = out.withColumn("__first", F.row_number().over(first))
    gone = (F.col("__n") >= 3) & (F.col("__sd") > 0) & (F.col("__first") == 1) & (F.col("__far") / F.nullif(F.col("__sd"), F.lit(0.0)) > limit)
    return out.withColumn(value, F.when(~F.coalesce(gone, F.lit(False)), F.col(value))).drop("__n", "__mean", "__sd", "__far", "__first", "__limit")


def _scaled(rows: DataFrame, logs: bool) -> DataFrame:
    """Every peptide moved onto its protein's reference by the median difference (or quotient) over shared samples."""
    n_samples = rows.select("sample").distinct().count()
    ref = reference_peptides(rows, n_samples)
    marked = rows.join(ref, "Protein")
    same = Window.partitionBy("Protein", "sample")
    marked = marked.withColumn("__ref", F.max(F.when(F.col("PeptideFlanked") == F.col("reference"), F.col("v"))).over(same))
    ratio = F.col("__ref") - F.col("v") if logs else F.when((F.col("v") != 0) & (F.col("__ref") != 0), F.col("__ref") / F.col("v"))
    factor = marked.groupBy("Protein", "PeptideFlanked").agg(F.median(ratio).alias("__f"))
    marked = marked.join(factor, ["Protein", "PeptideFlanked"])
    moved = F.col("v") + F.col("__f") if logs else F.when(F.col("__f") > 0, F.col("v") * F.col("__f"))
    own = F.col("PeptideFlanked") == F.col("reference")
    return marked.withColumn("v", F.when(own, F.col("v")).otherwise(moved)).select("Protein", "PeptideFlanked", "sample", "v")


def rollup_values(rows: DataFrame, method: str = "sum", log_transform: bool = True, report_log: bool = False, outlier_alpha: float | None = None, top_share: float = TOP_SHARE) -> DataFrame:
    """(Protein, sample, value) by one of ROLLUPS; the mode filter comes before."""
    method = method.lower()
    if method not in ROLLUPS:
        raise ValueError(f"unknown rollup {method}; known: {', '.join(ROLLUPS)}")
    logs = log_transform and method in IN_LOG
    value = log2_safe(F.col("intensity")) if logs else F.col("intensity")
    slim = rows.select("Protein", "PeptideFlanked", "sample", value.alias("v"))
    back = lambda c: back_from_log2(c) if logs and not report_log else c

    if method == "sum":
        out = slim.groupBy("Protein", "sample").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("value"))
        return _grid(rows, out).fillna(0.0, ["value"])
    if method == "dwrollup":
        share = rows.groupBy("PeptideFlanked").agg((1.0 / F.count_distinct("Protein")).alias("__w"))
        peptides = rows.select("Protein", "PeptideFlanked").distinct().join(share, "PeptideFlanked")
        total = Window.partitionBy("Protein")
        weights = peptides.withColumn("__w", F.col("__w") / F.sum("__w").over(total))
        out = slim.join(weights, ["Protein", "PeptideFlanked"]).groupBy("Protein", "sample").agg(F.coalesce(F.sum(F.col("v") * F.col("__w")), F.lit(0.0)).alias("value"))
        return _grid(rows, out).fillna(0.0, ["value"])
    if method == "rrollup":
        scaled = _scaled(slim, logs)
        if outlier_alpha is not None:
            scaled = without_outliers(scaled, outlier_alpha, ("Protein", "sample"))
        out = scaled.groupBy("Protein", "sample").agg(F.median("v").alias("value"))
    elif method == "zrollup":
        w = Window.partitionBy("Protein", "PeptideFlanked")
        z = (F.col("v") - F.avg("v").over(w)) / F.nullif(F.stddev_samp("v").over(w), F.lit(0.0))
        several = rows.groupBy("Protein").agg(F.count_distinct("PeptideFlanked").alias("__n")).where("__n > 1").select("Protein")
        out = slim.withColumn("z", z).join(several, "Protein", "left_semi").groupBy("Protein", "sample").agg(F.median("z").alias("value"))
        return _grid(rows, out)
    else:
        means = slim.groupBy("Protein", "PeptideFlanked").agg(F.avg("v").alias("__mean"))
        # the bound is taken from the very means that it is held against: a mean made twice may differ in its last digit
        bound = F.percentile("__mean", F.lit(1.0 - top_share)).over(Window.partitionBy("Protein"))
        top = means.withColumn("__bound", bound).where("__mean >= __bound").select("Protein", "PeptideFlanked")
        out = slim.join(top, ["Protein", "PeptideFlanked"], "left_semi").groupBy("Protein", "sample").agg(F.avg("v").alias("value"))
    return _grid(rows, out).withColumn("value", back(F.col("value")))


def _sorted_list(column: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_set(F.when(column != "", column))), ";")


def protein_facts(rows: DataFrame, method: str = "sum") -> DataFrame:
    """Per protein: gene, function, cluster, number and lists of peptides, whether it has unique and shared ones."""
    first = lambda c: F.min_by(F.when(F.trim(c) != "", F.col(c)), F.when(F.trim(c) != "", F.col("PeptideFlanked")))
    cols = [
        F.count_distinct("PeptideFlanked").alias("peptide_number") if method == "sum" else F.count_distinct("PeptideFlanked", "Peptide").alias("peptide_number"),
        F.bool_or("Unique").alias("has_unique"), F.bool_or(~F.col("Unique")).alias("has_shared"),
        _sorted_list(F.col("Peptide")).alias("peptides"), _sorted_list(F.col("PeptideFlanked")).alias("flanked_peptides"),
    ]
    for c in ("Gene", "Function", "Cluster"):
        if c in rows.columns:
            cols.append(first(c).alias(c))
    return rows.groupBy("Protein").agg(*cols)


def protein_rollup(annotated: DataFrame, method: str = "sum", mode: str = "all_matches", coverage: DataFrame | None = None, log_transform: bool = True, report_log: bool = False, outlier_alpha: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(values, facts): (Protein, sample, value) and one row of facts per protein; with `coverage`, only proteins in it."""
    require(annotated, "Protein", "PeptideFlanked", "Peptide", "sample", "intensity")
    rows = annotated if has(annotated, "Unique") else annotated.withColumn("Unique", F.lit(False))
    rows = keep_mode(rows, mode)
    if coverage is not None:
        rows = rows.join(coverage.select("Protein").distinct(), "Protein", "left_semi")
    return rollup_values(rows, method, log_transform, report_log, outlier_alpha), protein_facts(rows, method)
