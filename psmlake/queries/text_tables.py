"""Text scans: search parameters, spectrum marks, peptides written with flanks and masses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.functions import coerce, peptide, scores
from psmlake.operators import coverage, crosstab
from psmlake.queries.adapters import ANNOTATED_SQL, PSM_SQL, annotated, psm, rounded, table


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all pages that hold a mark, counted as spectra are in a text."""
    lines = table(spark, sf_dir, "pages").select(F.explode(F.split("html", "\n")).alias("line"))
    return lines.where(F.col("line").contains("<p>")).agg(F.count("*").alias("n"))


def peptide_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.translate("Peptide", "0123456789", "ACDEFGHIKL")
    written = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("K.", "-.", "", "r.")]), (F.col("Charge") % 4 + 1).cast("int")), letters, F.lit("M+15.995"), F.lower(letters), F.element_at(F.array(*[F.lit(x) for x in (".R", ".-", "")]), (F.col("Scan") % 3 + 1).cast("int")))
    rows = psm(spark, sf_dir).select(written.alias("p")).distinct()
    x = F.col("p")
    return rows.select("p", peptide.core(x).alias("core"), peptide.core_both_flanks(x).alias("both"), peptide.core_case(x).alias("kept_case"), F.round(peptide.modification_mass(x), 4).alias("mass"), peptide.flanks(x)["before"].alias("before"), peptide.flanks(x)["after"].alias("after"))


def score_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.when(F.col("score") % 5 == 0, 0.0).otherwise(F.pow(F.lit(10.0), -F.col("score") / 3))
    rows = psm(spark, sf_dir).select("score", e.alias("e"), (F.col("tax") * 100 - 4).alias("ppm")).distinct()
    return rounded(rows.select("score", "ppm", scores.msms_score(F.col("e")).alias("loose"), scores.msms_score_strict(F.col("e")).alias("strict"), scores.abs_ppm(F.col("ppm")).alias("abs_ppm"), scores.log2_safe(F.col("score") - 10).alias("log2"), scores.log2_safe(F.col("score") - 10, False).alias("log2_one"), scores.log1p_positive(F.col("ppm")).alias("log1p")), "ppm", "loose", "strict", "abs_ppm", "log2", "log2_one", "log1p")


def truth_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ("True", "1", "t", "YES", "y", "no", "0", " true ")
    w = F.element_at(F.array(*[F.lit(x) for x in words]), (F.col("Charge") + 1).cast("int"))
    rows = psm(spark, sf_dir).select(w.alias("w"))
    return rows.select("w", coerce.truth(F.col("w"), "string", coerce.TRUE_FILTER).alias("filter"), coerce.truth(F.col("w"), "string").alias("rollup")).groupBy("w", "filter", "rollup").agg(F.count("*").alias("n"))


def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).select(F.concat(F.lit("Run_"), F.col("sample"), F.lit("_filtered_rescored")).alias("sample"), "Scan")
    rows = crosstab.sample_names(rows).withColumn("database", coverage.normalised_name(F.concat(F.lit(" "), F.col("sample"), F.lit(".FASTA"))))
    return rows.groupBy("sample", "database").agg(F.count("*").alias("n"))


def wide_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table through its wide form and back."""
    rows = annotated(spark, sf_dir)
    samples = [str(y) for y in range(1995, 2002)]
    wide = crosstab.wide(rows, ["Protein", "PeptideFlanked"], "intensity", samples, None)
    return rounded(crosstab.long(wide, ["Protein", "PeptideFlanked"], samples), "intensity", digits=2)


QUERIES = {f.__name__: f for f in (marked_lines, peptide_cores, score_rules, truth_words, sample_names, wide_and_back)}

_L = "translate(Peptide, '0123456789', 'ACDEFGHIKL')"
SQL = {
    "marked_lines": "SELECT count(*) AS n FROM (SELECT unnest(string_split(html, chr(10))) AS line FROM pages) WHERE contains(line, '<p>')",
    "peptide_cores": rf"""WITH {PSM_SQL}, w AS (SELECT DISTINCT ['K.', '-.', '', 'r.'][Charge % 4 + 1] || {_L} || 'M+15.995' || lower({_L}) || ['.R', '.-', ''][Scan % 3 + 1] AS p FROM psm)
        SELECT p, regexp_replace(upper(regexp_replace(regexp_replace(p, '^[A-Z\-]\.', ''), '\.[A-Z\-]$', '')), '[^A-Z]', '', 'g') AS core,
        regexp_replace(upper(CASE WHEN regexp_matches(p, '^[A-Za-z\-]\..+\.[A-Za-z\-]$') THEN p[3:-3] ELSE p END), '[^A-Z]', '', 'g') AS both,
        regexp_replace(regexp_replace(regexp_replace(p, '^[A-Z\-]\.', ''), '\.[ A-Z\-]$', ''), '[^A-Za-z]', '', 'g') AS kept_case, 15.995::DOUBLE AS mass,
        nullif(nullif(regexp_extract(p, '^([A-Za-z\-]?)\.', 1), ''), '-') AS before, nullif(nullif(regexp_extract(p, '\.([A-Za-z\-]?)$', 1), ''), '-') AS after FROM w""",
    "score_rules": f"""WITH {PSM_SQL}, d AS (SELECT DISTINCT score, CASE WHEN score % 5 = 0 THEN 0.0 ELSE pow(10.0, -score / 3) END AS e, tax * 100 - 4 AS ppm FROM psm)
        SELECT score, round(ppm, 6) AS ppm, round(CASE WHEN e = 0 THEN 0.0 ELSE -log10(e) END, 6) AS loose, round(CASE WHEN e > 0 THEN -log10(e) END, 6) AS strict, round(abs(ppm), 6) AS abs_ppm, round(CASE WHEN score > 10 THEN log2(score - 10) END, 6) AS log2, round(CASE WHEN score > 10 THEN log2(score - 10) ELSE 0.0 END, 6) AS log2_one, round(ln(1 + greatest(ppm, 0)), 6) AS log1p FROM d""",
    "truth_words": f"""WITH {PSM_SQL}, w AS (SELECT ['True', '1', 't', 'YES', 'y', 'no', '0', ' true '][Charge + 1] AS w FROM psm)
        SELECT w, CAST(lower(trim(w)) IN ('true', '1', 't', 'yes') AS INT) AS filter, CAST(lower(trim(w)) IN ('true', '1', 't', 'yes', 'y') AS INT) AS rollup, count(*) AS n FROM w GROUP BY ALL""",
    "sample_names": f"WITH {PSM_SQL} SELECT 'Run_' || sample AS sample, 'run_' || sample AS database, count(*) AS n FROM psm GROUP BY ALL",
    "wide_and_back": f"WITH {ANNOTATED_SQL} SELECT Protein, PeptideFlanked, sample, round(intensity, 2) AS intensity FROM ann",
}
