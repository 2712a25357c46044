"""Figures of quality: density curves, peaks of histograms, points of curves, best rows, places in an ordered report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.operators import filtering, qc, scan
from psmlake.queries.adapters import PSM_SQL, TIE, TIE_SQL, psm, rounded


def density_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities of targets' and decoys' intensities in each sample, on grids of their own."""
    out = qc.density_curve(psm(spark, sf_dir), "ParentIonIntensity", ("sample", "is_decoy"), points=64)
    return rounded(out.withColumns({"density": F.col("density") * 1e6, "x": F.col("x") / 1e3, "bandwidth": F.col("bandwidth") / 1e3}), "x", "density", "bandwidth", digits=5)


def peak_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.peak_bin(qc.histogram(psm(spark, sf_dir), "score", ("sample", "is_decoy"), 0.0, 51.0, 17), ("sample", "is_decoy"))


def curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.curve_points(psm(spark, sf_dir), "score", by=("sample",)), "recall", "false_share", "precision", digits=9)


def strongest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thousand best rows, for a plot."""
    return qc.strongest(psm(spark, sf_dir), "score", 1000, TIE).select("sample", "Scan", "Charge", "Peptide", "score")


def report_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's place in the filtered report's order, numbered over ranges of it."""
    rows = psm(spark, sf_dir).withColumn("MSMSScore", F.col("score"))
    laid = scan.laid_out(rows, (), filtering.report_order(rows, TIE))
    return scan.running_sums(laid, {"place": F.lit(1).cast("long")}).select("Scan", "Charge", "Peptide", "Protein", "tax", "place")


QUERIES = {f.__name__: f for f in (density_curves, peak_bins, curve_points, strongest_rows, report_places)}

SQL = {
    # weights go to two grid points, kernels run from grid to grid
    "density_curves": f"""WITH {PSM_SQL}, s AS (SELECT sample, is_decoy, count(*) AS n, min(ParentIonIntensity) AS lo, max(ParentIonIntensity) AS hi, coalesce(nullif(stddev_samp(ParentIonIntensity) * pow(count(*), -0.2), 0), 1.0) AS h FROM psm GROUP BY ALL),
        g AS (SELECT *, lo - 3 * h AS a, (hi - lo + 6 * h) / 63 AS step FROM s), p AS (SELECT sample, is_decoy, (ParentIonIntensity - a) / step AS p FROM psm JOIN g USING (sample, is_decoy)),
        w AS (SELECT sample, is_decoy, floor(p) AS i, 1 - (p - floor(p)) AS w FROM p UNION ALL SELECT sample, is_decoy, floor(p) + 1, p - floor(p) FROM p), b AS (SELECT sample, is_decoy, i, sum(w) AS w FROM w GROUP BY ALL)
        SELECT sample, is_decoy, k::INT AS point, round(any_value(a + k * step) / 1e3, 5) AS x, round(sum(w * exp(-0.5 * pow((k - i) * step / h, 2))) / any_value(n * h * sqrt(2 * pi())) * 1e6, 5) AS density, round(any_value(h) / 1e3, 5) AS bandwidth
        FROM b JOIN g USING (sample, is_decoy), range(64) r(k) GROUP BY sample, is_decoy, k""",
    "peak_bins": f"""WITH {PSM_SQL}, b AS (SELECT sample, is_decoy, least(16, CAST(floor(score / 3.0) AS INT)) AS bin, count(*) AS n FROM psm WHERE score BETWEEN 0 AND 51 GROUP BY ALL)
        SELECT sample, is_decoy, bin AS peak_bin FROM b QUALIFY row_number() OVER (PARTITION BY sample, is_decoy ORDER BY n DESC, bin) = 1""",
    "curve_points": f"""WITH {PSM_SQL}, s AS (SELECT sample, score, sum(1 - is_decoy) AS t, sum(is_decoy) AS d FROM psm GROUP BY ALL),
        c AS (SELECT sample, score, sum(t) OVER w AS ct, sum(d) OVER w AS cd, sum(t) OVER (PARTITION BY sample) AS ts, sum(d) OVER (PARTITION BY sample) AS ds FROM s WINDOW w AS (PARTITION BY sample ORDER BY score DESC))
        SELECT sample, score, round(ct / ts, 9) AS recall, round(cd / ds, 9) AS false_share, round(ct / (ct + cd), 9) AS "precision" FROM c""",
    "strongest_rows": f"WITH {PSM_SQL} SELECT sample, Scan, Charge, Peptide, score FROM psm ORDER BY score DESC, {TIE_SQL} LIMIT 1000",
    "report_places": f"WITH {PSM_SQL} SELECT Scan, Charge, Peptide, Protein, tax, row_number() OVER (ORDER BY score DESC, Protein, {TIE_SQL}) AS place FROM psm",
}
