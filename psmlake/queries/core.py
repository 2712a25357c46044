"""q-values, filters, shared proteins, crosstab."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.functions import decoy, scores
from psmlake.operators import annotate, crosstab, fdr, filtering, parts, shared
from psmlake.queries.adapters import PSM_SQL, TIE, TIE_SQL, psm, rounded, table

FDR_SQL = f"""ranked AS (SELECT *, sum(is_decoy) OVER w AS d, sum(1 - is_decoy) OVER w AS t FROM psm
 WINDOW w AS (PARTITION BY sample ORDER BY score DESC, {TIE_SQL} ROWS UNBOUNDED PRECEDING)),
rated AS (SELECT *, CASE WHEN t = 0 THEN 1.0 ELSE least(1.0, d / t) END AS fdr FROM ranked),
q AS (SELECT *, min(fdr) OVER (PARTITION BY sample ORDER BY score DESC, {TIE_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM rated)"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets at q <= 0.05: rows, peptides, proteins and intensity of each sample."""
    rows = fdr.accepted(fdr.estimate_fdr(psm(spark, sf_dir), "score", TIE), "q", 0.05)
    out = rows.groupBy("sample").agg(F.count("*").alias("n_psms"), F.count_distinct("Peptide").alias("n_peptides"), F.count_distinct("Protein").alias("n_proteins"), F.sum("ParentIonIntensity").alias("intensity"), F.max("q").alias("max_q"))
    return rounded(out, "max_q").withColumn("intensity", F.round("intensity", 2))


def fdr_psm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fdr.estimate_fdr(psm(spark, sf_dir), "score", TIE)
    return rounded(rows.select("sample", "Scan", "Charge", "Peptide", "Protein", "is_decoy", "q"), "q", digits=9)


def fdr_peptide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fdr.estimate_peptide_fdr(psm(spark, sf_dir), "score", TIE)
    return rounded(rows.groupBy("sample", "Peptide").agg(F.max("pep_q").alias("pep_q"), F.min("pep_q").alias("low"), F.count("*").alias("n")), "pep_q", "low", digits=9)


def fdr_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("SpecEValue", 51 - F.col("score")).drop("QValue")
    rows = fdr.compute_q_value(rows, TIE)
    return rounded(rows.groupBy("sample", "score").agg(F.max("QValue").alias("q"), F.count("*").alias("n")), "q", digits=9)


def fdr_peptide_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("SpecEValue", 51 - F.col("score")).withColumn("Peptide", F.translate("Peptide", "0123456789", "ACDEFGHIKL"))
    rows = fdr.compute_peptide_q_value(rows, TIE)
    return rounded(rows.groupBy("sample", "Peptide").agg(F.max("PepQValue").alias("pep_q"), F.count("*").alias("n")), "pep_q", digits=9)


def fdr_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fdr.estimate_fdr(psm(spark, sf_dir), "score", TIE, to="after")
    return rounded(fdr.gains(rows.withColumn("before", F.col("QValue")), "before", "after"), "gain_pct")


def fdr_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fdr.estimate_fdr(psm(spark, sf_dir), "score", TIE)
    kind = fdr.overlap_class(F.col("QValue"), F.col("q"), F.col("is_decoy"), 0.05)
    return rows.groupBy("sample", kind.alias("kind")).agg(F.count("*").alias("n"))


def _chances(rows: DataFrame) -> DataFrame:
    return rows.select("sample", *TIE, "is_decoy", (F.col("score") / 50).alias("p"), scores.evidence(F.col("ParentIonIntensity"), F.lit(30000.0)).alias("e"))


def alpha_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weight for all samples together; alpha_tuning_by_sample() tunes each."""
    return fdr.tune_alpha(_chances(psm(spark, sf_dir)), "p", "e", TIE, threshold=0.05)


def alpha_tuning_by_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fdr.tune_alpha(_chances(psm(spark, sf_dir)), "p", "e", TIE, threshold=0.05, by=("sample",))


def best_per_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.best_per_scan(psm(spark, sf_dir), TIE).select("sample", "Scan", "Charge", "Peptide", "Protein", "ParentIonIntensity")


def prepare_sics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).select(
        "sample", "Scan", "Charge", F.lit(1.0).alias("PrecursorMZ"), F.lit(0.0).alias("DelM"), (F.col("tax") * 100 - 4).alias("DelM_PPM"), F.lit(1.0).alias("MH"), "Peptide",
        F.when(F.col("is_decoy") == 1, F.concat(F.lit("XXX_"), F.col("Protein"))).otherwise(F.col("Protein")).alias("Protein"), (F.col("score") / 1e6).alias("MSGFDB_SpecEValue"), "QValue", F.col("QValue").alias("PepQValue"),
        F.lit(0.0).alias("ElutionTime"), "ParentIonIntensity", F.col("Scan").alias("OptimalScanNumber"),
    )
    out = filtering.prepare_sics(rows, ("Charge", "Peptide", "Protein", "MSGFDB_SpecEValue"))
    return rounded(out.select("sample", "ScanNum", "Charge", "Peptide", "Protein", "is_decoy", "MSMSScore", "absPPM"), "MSMSScore", "absPPM")


def filter_psms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("MSMSScore", F.col("score")).withColumn("absPPM", F.col("tax")).withColumn("Peptide", F.concat(F.lit("K."), F.translate("Peptide", "0123456789", "ACDEFGHIKL"), F.lit(".R")))
    out = filtering.filter_psms(rows, "QValue", 0.05, "MSMSScore", 20.0, 5e3)
    return out.select("sample", "Scan", "Charge", "Peptide", "PeptideFlanked", "Protein", "MSMSScore", "ParentIonIntensity").groupBy("sample", "Peptide", "PeptideFlanked", "Protein").agg(F.count("*").alias("n"), F.round(F.max("MSMSScore"), 3).alias("top"), F.round(F.max("ParentIonIntensity"), 2).alias("intensity"))


def metric_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("MSMSScore", F.col("score"))
    kept = [filtering.metric_filter(rows, m, t).groupBy("sample").agg(F.count("*").alias("n")).withColumn("metric", F.lit(m)) for m, t in (("QValue", 0.02), ("MSMSScore", 40.0), ("MSMSScore", None))]
    return kept[0].unionByName(kept[1]).unionByName(kept[2].withColumn("metric", F.lit("default")))


def peptide_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("Peptide", F.translate("Peptide", "0123456789", "ACDEFGHIKL"))
    return filtering.peptide_level(rows)


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.distinct_counts(psm(spark, sf_dir))


def merge_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir)
    found = rows.where("QValue <= 0.03 and is_decoy = 0")
    out = shared.merge_shared(found, rows.select("sample", "Scan", "Peptide", "Protein"), TIE)
    return out.groupBy("sample", "Peptide", "Protein").agg(F.count("*").alias("n"), F.round(F.min("ParentIonIntensity"), 2).alias("low"), F.max("is_decoy").alias("is_decoy"))


def peptide_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).withColumn("PeptideFlanked", F.concat(F.lit("K."), F.col("Peptide"), F.lit(".R")))
    long = crosstab.peptide_crosstab(rows)
    return crosstab.wide(long, crosstab.KEYS, "intensity", [str(y) for y in range(1995, 2002)])


def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).select(F.col("Peptide").alias("PeptideFlanked"), "Protein").distinct()
    out = annotate.uniqueness(rows)
    return out.select("PeptideFlanked", "Protein", F.col("Unique").cast("int").alias("is_unique"), F.col("Shared").cast("int").alias("is_shared"))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).groupBy("Protein").agg(F.count("*").alias("n"))
    info = table(spark, sf_dir, "supplier").where("s_suppkey % 7 > 0").select(F.col("s_suppkey").cast("string").alias("Protein"), F.col("s_name").alias("Gene"), F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("Function"))
    return annotate.annotated(rows, info)


def corrected_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).select(F.col("sample").alias("SpecFile"), F.col("Scan").alias("ScanNum"), "Charge", "Peptide", "Protein", F.col("Charge").alias("part"), (51 - F.col("score")).alias("SpecEValue"), F.col("tax").alias("EValue"), "ParentIonIntensity", "tax")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n_peptides"))
    best = parts.best_per_spectrum(parts.corrected_parts(rows, sizes), ("part", "Peptide", "Protein", "ParentIonIntensity", "tax"))
    return rounded(best.select("SpecFile", "ScanNum", "part", "Peptide", "Protein", "SpecEValue", "EValue", "CorrectionFactor"), "EValue", "CorrectionFactor")


def decoy_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("XXX_", "", "rev_", "DECOY")]), (F.col("Charge") % 4 + 1).cast("int")), F.col("Protein"))
    pair = F.concat_ws(";", name, F.when(F.col("Scan") % 2 == 0, F.concat(F.lit("XXX_"), F.col("Protein"))))
    rows = psm(spark, sf_dir).select(decoy.by_prefix(name).alias("by_prefix"), decoy.anywhere(name).alias("anywhere"), decoy.all_of(pair).alias("all_of"))
    return rows.groupBy("by_prefix", "anywhere", "all_of").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (flagship, fdr_psm, fdr_peptide, fdr_plus_one, fdr_peptide_plus_one, fdr_gains, fdr_overlap, alpha_tuning, alpha_tuning_by_sample, best_per_scan, prepare_sics, filter_psms, metric_directions, peptide_level, distinct_counts, merge_shared, peptide_crosstab, uniqueness, annotated, corrected_parts, decoy_rules)}

_CORE = "translate(Peptide, '0123456789', 'ACDEFGHIKL')"
_PLUS = f"""ranked AS (SELECT *, sum(is_decoy) OVER w AS d, sum(1 - is_decoy) OVER w AS t FROM src
 WINDOW w AS (PARTITION BY sample ORDER BY score DESC, {TIE_SQL} ROWS UNBOUNDED PRECEDING)),
rated AS (SELECT *, CASE WHEN t = 0 THEN 1.0 ELSE (d + 1) / t END AS fdr FROM ranked),
q AS (SELECT *, min(fdr) OVER (PARTITION BY sample ORDER BY score DESC, {TIE_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM rated)"""

SQL = {
    "flagship": f"""WITH {PSM_SQL}, {FDR_SQL}
        SELECT sample, count(*) AS n_psms, count(DISTINCT Peptide) AS n_peptides, count(DISTINCT Protein) AS n_proteins, round(sum(ParentIonIntensity), 2) AS intensity, round(max(q), 6) AS max_q
        FROM q WHERE is_decoy = 0 AND q <= 0.05 GROUP BY sample""",
    "fdr_psm": f"WITH {PSM_SQL}, {FDR_SQL} SELECT sample, Scan, Charge, Peptide, Protein, is_decoy, round(q, 9) AS q FROM q",
    "fdr_peptide": f"""WITH {PSM_SQL.replace('psm AS', 'allpsm AS')}, psm AS (SELECT * FROM allpsm QUALIFY row_number() OVER (PARTITION BY sample, Peptide ORDER BY score DESC, {TIE_SQL}) = 1), {FDR_SQL}
        SELECT sample, Peptide, round(max(q), 9) AS pep_q, round(max(q), 9) AS low, any_value(n) AS n FROM q JOIN (SELECT sample, Peptide, count(*) AS n FROM allpsm GROUP BY ALL) USING (sample, Peptide) GROUP BY sample, Peptide""",
    "fdr_plus_one": f"WITH {PSM_SQL}, src AS (SELECT * FROM psm), {_PLUS} SELECT sample, score, round(max(q), 9) AS q, count(*) AS n FROM q GROUP BY ALL",
    "fdr_peptide_plus_one": f"""WITH {PSM_SQL}, src AS (SELECT * REPLACE ({_CORE} AS Peptide) FROM psm QUALIFY row_number() OVER (PARTITION BY sample, {_CORE} ORDER BY score DESC, Scan, Charge, {_CORE}, Protein, ParentIonIntensity, tax) = 1), {_PLUS}
        SELECT sample, Peptide, round(max(q), 9) AS pep_q, any_value(n) AS n FROM q JOIN (SELECT sample, {_CORE} AS Peptide, count(*) AS n FROM psm GROUP BY ALL) USING (sample, Peptide) GROUP BY sample, Peptide""",
    "fdr_gains": f"""WITH {PSM_SQL}, {FDR_SQL}, g AS (SELECT sample, threshold, count(*) FILTER (is_decoy = 0 AND QValue <= threshold) AS n_before, count(*) FILTER (is_decoy = 0 AND q <= threshold) AS n_after
        FROM q, (VALUES (0.01::DOUBLE), (0.05::DOUBLE), (0.1::DOUBLE)) v(threshold) GROUP BY ALL)
        SELECT *, round(CASE WHEN n_before > 0 THEN 100.0 * (n_after - n_before) / n_before WHEN n_after = 0 THEN 0.0 END, 6) AS gain_pct FROM g""",
    "fdr_overlap": f"""WITH {PSM_SQL}, {FDR_SQL} SELECT sample, CASE WHEN is_decoy = 1 THEN CASE WHEN q <= 0.05 THEN 'decoy_leak' ELSE 'decoy' END WHEN QValue <= 0.05 AND q <= 0.05 THEN 'common' WHEN q <= 0.05 THEN 'gained' WHEN QValue <= 0.05 THEN 'lost' ELSE 'missed' END AS kind, count(*) AS n FROM q GROUP BY ALL""",
    "best_per_scan": f"""WITH {PSM_SQL} SELECT sample, Scan, Charge, Peptide, Protein, ParentIonIntensity FROM psm QUALIFY row_number() OVER (PARTITION BY sample, Scan ORDER BY ParentIonIntensity DESC, {TIE_SQL}) = 1""",
    "prepare_sics": f"""WITH {PSM_SQL}, named AS (SELECT * REPLACE (CASE WHEN is_decoy = 1 THEN 'XXX_' || Protein ELSE Protein END AS Protein) FROM psm)
        SELECT sample, Scan AS ScanNum, Charge, Peptide, Protein, CASE WHEN starts_with(Protein, 'XXX_') THEN 1 ELSE 0 END AS is_decoy, round(-log10(score / 1e6), 6) AS MSMSScore, round(abs(tax * 100 - 4), 6) AS absPPM
        FROM named QUALIFY row_number() OVER (PARTITION BY sample, Scan ORDER BY ParentIonIntensity DESC, Charge, Peptide, Protein, score) = 1""",
    "filter_psms": f"""WITH {PSM_SQL}, f AS (SELECT DISTINCT *, {_CORE} AS core FROM psm WHERE is_decoy = 0 AND QValue <= 0.05 AND score >= 20 AND ParentIonIntensity >= 5000)
        SELECT sample, core AS Peptide, 'K.' || core || '.R' AS PeptideFlanked, Protein, count(*) AS n, round(max(score), 3) AS top, round(max(ParentIonIntensity), 2) AS intensity FROM f GROUP BY ALL""",
    "metric_directions": f"""WITH {PSM_SQL} SELECT sample, count(*) AS n, 'QValue' AS metric FROM psm WHERE QValue <= 0.02 GROUP BY sample
        UNION ALL SELECT sample, count(*), 'MSMSScore' FROM psm WHERE score >= 40 GROUP BY sample UNION ALL SELECT sample, count(*), 'default' FROM psm WHERE score >= 10 GROUP BY sample""",
    "peptide_level": f"WITH {PSM_SQL} SELECT sample, {_CORE} AS Peptide, min(is_decoy) AS is_decoy, min(QValue) AS QValue FROM psm GROUP BY ALL",
    "distinct_counts": f"WITH {PSM_SQL} SELECT sample, count(DISTINCT Peptide) AS n_peptides, count(DISTINCT Protein) AS n_proteins FROM psm GROUP BY ALL",
    "merge_shared": f"""WITH {PSM_SQL}, found AS (SELECT * FROM psm WHERE QValue <= 0.03 AND is_decoy = 0),
        new AS (SELECT DISTINCT sample, Scan, Peptide, Protein FROM psm p WHERE (sample, Peptide) IN (SELECT (sample, Peptide) FROM found) AND (sample, Peptide, Protein) NOT IN (SELECT (sample, Peptide, Protein) FROM found)),
        best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY sample, Peptide ORDER BY QValue, {TIE_SQL}) = 1),
        everything AS (SELECT sample, Peptide, Protein, ParentIonIntensity, is_decoy FROM found UNION ALL SELECT sample, Peptide, new.Protein, ParentIonIntensity, 0 FROM new JOIN best USING (sample, Peptide))
        SELECT sample, Peptide, Protein, count(*) AS n, round(min(ParentIonIntensity), 2) AS low, max(is_decoy) AS is_decoy FROM everything GROUP BY ALL""",
    "peptide_crosstab": f"""WITH {PSM_SQL} SELECT Peptide, 'K.' || Peptide || '.R' AS PeptideFlanked, Protein, {", ".join(f"coalesce(max(ParentIonIntensity) FILTER (sample = '{y}'), 0) AS \"{y}\"" for y in range(1995, 2002))} FROM psm GROUP BY Peptide, Protein""",
    "uniqueness": f"""WITH {PSM_SQL}, d AS (SELECT DISTINCT Peptide AS PeptideFlanked, Protein FROM psm)
        SELECT PeptideFlanked, Protein, CASE WHEN n = 1 THEN 1 ELSE 0 END AS is_unique, CASE WHEN n > 1 THEN 1 ELSE 0 END AS is_shared FROM d JOIN (SELECT PeptideFlanked, count(*) AS n FROM d GROUP BY ALL) USING (PeptideFlanked)""",
    "annotated": f"""WITH {PSM_SQL} SELECT Protein, count(*) AS n, coalesce(any_value(s_name), 'Unknown') AS Gene, coalesce('nation ' || CAST(any_value(s_nationkey) AS VARCHAR), 'Unknown') AS Function
        FROM psm LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 7 > 0) ON CAST(s_suppkey AS VARCHAR) = Protein GROUP BY Protein""",
    "corrected_parts": f"""WITH {PSM_SQL}, sizes AS (SELECT Charge, count(*) AS n FROM psm GROUP BY Charge), r AS (SELECT psm.*, (SELECT sum(n) FROM sizes) / n AS f FROM psm JOIN sizes USING (Charge))
        SELECT sample AS SpecFile, Scan AS ScanNum, Charge AS part, Peptide, Protein, 51 - score AS SpecEValue, round(tax * f, 6) AS EValue, round(f, 6) AS CorrectionFactor
        FROM r QUALIFY row_number() OVER (PARTITION BY sample, Scan ORDER BY 51 - score, Charge, Peptide, Protein, ParentIonIntensity, tax) = 1""",
    "decoy_rules": f"""WITH {PSM_SQL}, n AS (SELECT ['XXX_', '', 'rev_', 'DECOY'][Charge % 4 + 1] || Protein AS name, Scan % 2 = 0 AS second, Charge % 4 = 0 AS first FROM psm)
        SELECT CASE WHEN starts_with(name, 'XXX_') THEN 1 ELSE 0 END AS by_prefix, CASE WHEN regexp_matches(name, '(?i)DECOY|REV_|XXX_') THEN 1 ELSE 0 END AS anywhere, CASE WHEN first THEN 1 ELSE 0 END AS all_of, count(*) AS n FROM n GROUP BY ALL""",
    "alpha_tuning": f"""WITH {PSM_SQL}, base AS (SELECT {TIE_SQL}, is_decoy, score / 50 AS p, least(1.0, greatest(0.0, 1 - exp(-(ln(2.0) / 30000.0) * ParentIonIntensity))) AS e FROM psm),
        grid AS (SELECT *, least(1.0, greatest(0.0, 1 - (1 - least(1.0, alpha) * p) * (1 - e), CASE WHEN e >= 0.7 THEN 0.8 * e ELSE 0.0 END)) AS s FROM base, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE), (1.5::DOUBLE), (2.0::DOUBLE)) v(alpha)),
        r AS (SELECT *, sum(is_decoy) OVER w AS d, sum(1 - is_decoy) OVER w AS t FROM grid WINDOW w AS (PARTITION BY alpha ORDER BY s DESC, {TIE_SQL} ROWS UNBOUNDED PRECEDING)),
        f AS (SELECT *, CASE WHEN t = 0 THEN 1.0 ELSE least(1.0, d / t) END AS fdr FROM r),
        q AS (SELECT *, min(fdr) OVER (PARTITION BY alpha ORDER BY s DESC, {TIE_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM f)
        SELECT alpha, count(*) FILTER (is_decoy = 0 AND q < 0.05) AS n_ids FROM q GROUP BY alpha""",
    "alpha_tuning_by_sample": f"""WITH {PSM_SQL}, base AS (SELECT sample, {TIE_SQL}, is_decoy, score / 50 AS p, least(1.0, greatest(0.0, 1 - exp(-(ln(2.0) / 30000.0) * ParentIonIntensity))) AS e FROM psm),
        grid AS (SELECT *, least(1.0, greatest(0.0, 1 - (1 - least(1.0, alpha) * p) * (1 - e), CASE WHEN e >= 0.7 THEN 0.8 * e ELSE 0.0 END)) AS s FROM base, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE), (1.5::DOUBLE), (2.0::DOUBLE)) v(alpha)),
        r AS (SELECT *, sum(is_decoy) OVER w AS d, sum(1 - is_decoy) OVER w AS t FROM grid WINDOW w AS (PARTITION BY sample, alpha ORDER BY s DESC, {TIE_SQL} ROWS UNBOUNDED PRECEDING)),
        f AS (SELECT *, CASE WHEN t = 0 THEN 1.0 ELSE least(1.0, d / t) END AS fdr FROM r),
        q AS (SELECT *, min(fdr) OVER (PARTITION BY sample, alpha ORDER BY s DESC, {TIE_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM f)
        SELECT sample, alpha, count(*) FILTER (is_decoy = 0 AND q < 0.05) AS n_ids FROM q GROUP BY ALL""",
}
