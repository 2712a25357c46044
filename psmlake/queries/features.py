"""Features, folds, retention time and rescoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.functions import arrays, chem, peptide
from psmlake.operators import engineer, folds, fragments, lineage, qc, rescore, rt, spectral
from psmlake.queries.adapters import PSM_SQL, psm, rounded, table


def _peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSMs whose peptides are spelled from the part number, as K.XXXX.R, with the columns a search gives."""
    core = F.translate("Peptide", "0123456789", "KRPMSTYLFW")
    return psm(spark, sf_dir).select(
        "sample", "Scan", "Charge", F.concat(F.lit("K."), core, F.lit("AGIDEVKPR"), F.lit(".A")).alias("Peptide"), "Protein", "is_decoy", F.col("score").alias("MSGFScore"), (F.col("tax") * 100 - 4).alias("DelM_PPM"), "QValue",
        F.pow(F.lit(10.0), -F.col("score") / 4).alias("MSGFDB_SpecEValue"), (F.col("ParentIonIntensity") / 1000).alias("ElutionTime"), "ParentIonIntensity", F.col("Scan").alias("OptimalScanNumber"), (F.col("score") * 20).alias("ParentIonMZ"), "tax",
    )


PEP_TIE = ("Scan", "Charge", "Peptide", "Protein", "ParentIonIntensity", "tax")


def residue_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _peptides(spark, sf_dir).select("Peptide").distinct().withColumn("core", peptide.core_both_flanks(F.col("Peptide")))
    out = rows.select("Peptide", F.length("core").alias("n"), peptide.count(F.col("core"), "[KRH]").alias("basic"), peptide.count(F.col("core"), "[DE]").alias("acidic"), peptide.missed_cleavages(F.col("core")).alias("missed"), F.col("core").rlike("[KR]P").cast("int").alias("kp"), peptide.hydropathy(F.col("core")).alias("hydropathy"))
    return rounded(out, "hydropathy")


def rank_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = engineer.stateless(_peptides(spark, sf_dir))
    return rounded(rows.groupBy("sample", "n_psms_in_scan", "is_singleton_scan").agg(F.count("*").alias("n"), F.avg("delta_score").alias("delta"), F.avg("delta_score_norm").alias("norm")), "delta", "norm")


def _learned(rows: DataFrame) -> DataFrame:
    names = ("pep_best_specev", "pep_n_observations", "pep_score_consistency", "pep_charge_diversity", "pep_score_relative_to_best", "peptide_best_score", "peptide_median_score", "peptide_reliability", "mass_error_zscore", "precursor_mz_deviation", "relative_parent_intensity", "specEval_pctrank_in_class")
    times = ("rt_is_valid", "rt_deviation_from_peptide", "rt_deviation_from_charge", "rt_per_residue", "rt_coelution_density", "rt_x_hydrophobicity")
    figures = [F.avg(c).alias(c) for c in (*names, *times)]
    out = rows.groupBy("sample", "is_decoy").agg(*figures, F.sum("is_best_for_peptide").alias("best"), F.count("*").alias("n"))
    return rounded(out, *names, *times, digits=5)


def learned_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned features of every row, from the scans of its sample that have the other parity: means by sample and class."""
    needed = ("sample", "half", "Peptide", "PeptideCore", "Charge", "is_decoy", engineer.SCORE, "DelM_PPM", "abs_mass_error_ppm", "ParentIonMZ", "ParentIonIntensity", "ElutionTime")
    with lineage.passing(spark) as kept:
        rows = lineage.cut(_halves(spark, sf_dir).select(*needed))  # read by each learned table
        model = engineer.fit(rows.withColumn("half", 1 - F.col("half")), by=("sample", "half"))
        return kept(_learned(engineer.transform(rows, model, in_steps=True)))


def _halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer.stateless(_peptides(spark, sf_dir).withColumn("half", (F.col("Scan") % 2).cast("int")), by=("sample", "half"))


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a row and its scan: means and extremes by sample."""
    rows = engineer.stateless(_peptides(spark, sf_dir).withColumn("DelM", F.col("tax") - 0.03), rank=True)
    names = ("neg_log_specEvalue", "specevalue_rank", "log_msgf_score", "abs_mass_error_ppm", "abs_delm_da", "c_half_hydro", "n_term_hydro", "hydrophobic_ratio", "charge_x_mass_error", "charge_to_length_ratio", "log_n_psms_in_scan", "delta_score", "delta_score_norm")
    out = rows.groupBy("sample").agg(*[F.avg(c).alias(c) for c in names], F.max("specevalue_rank").alias("ranks"), F.sum("is_singleton_scan").alias("singletons"), F.sum("cterm_is_KR").alias("tryptic"))
    return rounded(out, *names)


def coelution_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events within half a minute, each event against all."""
    rows = table(spark, sf_dir, "events").select("event_id", ((F.unix_micros(F.col("ts").cast("timestamp")) % 86400000000) / 6e7).alias("ElutionTime"))
    times = rows.groupBy(F.col("ElutionTime").alias("value")).agg(F.count("*").alias("n"))
    return engineer.coelution(rows, times, F.col("ElutionTime"), F.lit(0.5), ()).select("event_id", F.col("rt_coelution_density").alias("n"))


def fold_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample's scans by class and fold: each fold's share of a class is even to one scan."""
    rows = _peptides(spark, sf_dir)
    kinds = folds.scan_classes(rows, by=("sample",)).join(folds.scan_folds(rows, by=("sample",)), ["sample", "OptimalScanNumber"])
    sizes = kinds.groupBy("sample", "kind", "fold").agg(F.count("*").alias("n"))
    return sizes.groupBy("sample", "kind").agg(F.sum("n").alias("scans"), F.count("*").alias("folds"), (F.max("n") - F.min("n") <= 1).cast("int").alias("even"))


def spectrum_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as spectra: total, base peak, share of the 8 largest, norm, and similarity to the next vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("e"))
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("e").alias("o"))
    both = rows.join(other, "vec_id")
    out = both.select("vec_id", arrays.total(F.col("e")).alias("tic"), F.array_max("e").alias("base"), arrays.top_share(F.col("e"), 8).alias("top"), arrays.norm(F.col("e")).alias("norm"), arrays.cosine(F.col("e"), F.col("o")).alias("cosine"), arrays.spectral_angle(F.col("e"), F.col("o")).alias("angle"), arrays.pearson(F.col("e"), F.col("o")).alias("pearson"))
    return rounded(out, "tic", "base", "top", "norm", "cosine", "angle", "pearson", digits=5)


def longest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.collect_set((F.col("l_partkey") % 200).cast("int")).alias("x"))
    return rows.select("l_suppkey", arrays.longest_run(F.col("x")).alias("run"))


def carried_ms1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as scans, the assistant's as MS1: each turn with the last one of the assistant before or at it."""
    from psmlake.sources.mzml import carried_ms1 as carry

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("ord"), F.col("turn").alias("scan"), F.when(F.col("role") == "assistant", 1).otherwise(2).alias("ms_level"))
    return carry(rows).select("file", "ord", "ms1_scan")


def _spectra(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = lineage.dealt(_peptides(spark, sf_dir), "sample", "Scan").withColumn("psm_id", F.xxhash64(*PEP_TIE))  # one deal for rows and spectra
    # a spectrum is told by what its scan leaves over 97 and 1013: those arrays are made once each, not once a scan
    peaks = F.transform(F.sequence(F.lit(1), F.lit(120)), lambda k: 100.0 + k * 7.3 + F.pmod(F.col("id") * k, F.lit(97)) / 10)
    heights = F.transform(F.sequence(F.lit(1), F.lit(120)), lambda k: 10.0 + F.pmod(F.col("id") * k * k, F.lit(1013)).cast("double"))
    scans = rows.select("sample", "Scan").distinct()
    for over, name, values in ((97, "mz", peaks), (1013, "intensity", heights)):
        kinds = spark.range(0, over, 1, 1).select(F.col("id").alias(f"__{name}"), values.alias(name))
        scans = scans.join(F.broadcast(kinds), F.pmod(F.col("Scan"), F.lit(over)) == F.col(f"__{name}"))
    spectra = scans.select("sample", F.col("Scan").alias("scan"), "mz", "intensity", F.lit(500.0).alias("precursor_mz"))
    return rows, spectra


def spectral_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every PSM from the spectrum of its scan."""
    rows, spectra = _spectra(spark, sf_dir)
    return spectral.extract(rows, spectra, tolerance=0.5)


def fragment_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched ions, coverages and intensities of every PSM."""
    rows, spectra = _spectra(spark, sf_dir)
    key = ["sample", *PEP_TIE]
    out = fragments.match_figures(rows.select(*key), spectra, key, tolerance=0.5)
    return rounded(out, *[c for c in out.columns if c not in key and not c.startswith("num_")], digits=9)


def isotope_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as survey spectra, a peak near every half isotope step; precursors somewhere among them."""
    rows = table(spark, sf_dir, "embeddings")
    peaks = rows.select("vec_id", F.posexplode("embedding").alias("i", "e")).select("vec_id", (400 + F.col("i") * 0.5016775 + F.pmod(F.col("vec_id") * F.col("i"), F.lit(7)) * 0.006 - 0.015).alias("mz"), F.abs(F.col("e").cast("double") * 1000).alias("intensity"))
    precursors = rows.select("vec_id", (400 + F.col("vec_id") % 40 * 0.5016775).alias("precursor_mz"), (F.col("vec_id") % 3 + 1).cast("int").alias("Charge"))
    return rounded(fragments.isotope_figures(precursors, peaks, ("vec_id",)), "isotope_pattern_score", "chimeric_indicator", digits=5)


def retention_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibration on times that follow the retention score, and how well it tells them."""
    rows = _peptides(spark, sf_dir).select("sample", "Scan", "Charge", "Peptide", "is_decoy", "MSGFScore")
    rows = rows.repartition(lineage.parts_for(rows), "sample", "Scan")  # a table in one file is one task's, and scores take time
    core = peptide.core_both_flanks(F.col("Peptide"))
    rows = lineage.cut(rows.withColumn("ElutionTime", 30 + 1.5 * peptide.retention_score(core) + (F.col("MSGFScore") - 25) / 50))  # read by the fit and its test
    model = rt.fit(rows)  # every sample's
    told = lineage.cut(rt.predict(rows, model).select("sample", "ElutionTime", "rt_pred"))
    return rounded(qc.rt_agreement(told, "ElutionTime", "rt_pred", ("sample",)), "median_error", "mad", "mae", "normalised_mae", "pearson", digits=3)


def rescoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, sample by sample, with the operator's own folds, members and trees: area under the curve before and after."""
    rows = _peptides(spark, sf_dir).drop("QValue")
    scored, _ = rescore.cross_validated(rows)
    done = rescore.combined(scored, PEP_TIE)
    before, after = (qc.roc_auc(done, c, by=("sample",)) for c in ("MSGFScore", "xpec_score"))
    return before.select("sample", F.lit("before").alias("stage"), "auc").unionByName(after.select("sample", F.lit("after").alias("stage"), "auc"))


QUERIES = {f.__name__: f for f in (residue_features, rank_gaps, row_features, learned_peptides, coelution_density, fold_balance, spectrum_figures, longest_runs, carried_ms1, spectral_features, fragment_matches, isotope_figures, retention_model, rescoring)}

_PEP = f"""{PSM_SQL}, pep0 AS (SELECT sample, Scan, Charge, 'K.' || translate(Peptide, '0123456789', 'KRPMSTYLFW') || 'AGIDEVKPR.A' AS Peptide, translate(Peptide, '0123456789', 'KRPMSTYLFW') || 'AGIDEVKPR' AS core, Protein, is_decoy, score AS MSGFScore, tax * 100 - 4 AS DelM_PPM,
 ParentIonIntensity, tax, pow(10.0, -score / 4) AS e, ParentIonIntensity / 1000 AS t, score * 20 AS mz, Scan % 2 AS half FROM psm), pep AS (SELECT *, -log10(e) AS s, length(core) AS len FROM pep0)"""
_KD = "CASE r WHEN 'A' THEN 1.8 WHEN 'R' THEN -4.5 WHEN 'N' THEN -3.5 WHEN 'D' THEN -3.5 WHEN 'C' THEN 2.5 WHEN 'Q' THEN -3.5 WHEN 'E' THEN -3.5 WHEN 'G' THEN -0.4 WHEN 'H' THEN -3.2 WHEN 'I' THEN 4.5 WHEN 'L' THEN 3.8 WHEN 'K' THEN -3.9 WHEN 'M' THEN 1.9 WHEN 'F' THEN 2.8 WHEN 'P' THEN -1.6 WHEN 'S' THEN -0.8 WHEN 'T' THEN -0.7 WHEN 'W' THEN -0.9 WHEN 'Y' THEN -1.3 WHEN 'V' THEN 4.2 END::DOUBLE"
_RC = "CASE r " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in peptide.RETENTION.items()) + " ELSE 0 END::DOUBLE"
_MASS = "CASE r " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in chem.RESIDUES.items()) + " ELSE 0 END::DOUBLE"
_DAY = "(epoch_us(ts) % 86400000000) / 6e7"

SQL = {
    "fragment_matches": f"""WITH {_PEP}, c AS (SELECT DISTINCT core, len FROM pep), r AS (SELECT core, len, i, substr(core, i, 1) AS r FROM (SELECT core, len, unnest(range(1, len + 1)) AS i FROM c)),
        s AS (SELECT core, len, i, sum({_MASS}) OVER (PARTITION BY core ORDER BY i) AS s, sum({_MASS}) OVER (PARTITION BY core) AS whole FROM r),
        ions AS (SELECT * FROM (SELECT core, 'b' AS kind, i AS number, s + {chem.PROTON} AS mz FROM s WHERE i < len UNION ALL SELECT core, 'y', len - i, whole - s + {chem.WATER} + {chem.PROTON} FROM s WHERE i < len) WHERE mz > 100),
        peaks AS (SELECT Scan, 100 + k * 7.3::DOUBLE + (Scan * k % 97) / 10.0::DOUBLE AS p, 10.0::DOUBLE + Scan * k * k % 1013 AS h, k FROM (SELECT DISTINCT Scan FROM pep), range(1, 121) t(k)),
        own AS (SELECT DISTINCT Scan, core FROM pep), tic AS (SELECT Scan, sum(h) AS tic FROM peaks GROUP BY Scan),
        hits AS (SELECT own.Scan, core, kind, number, h FROM own JOIN ions USING (core) JOIN peaks ON peaks.Scan = own.Scan AND abs(p - mz) <= 0.5
            QUALIFY row_number() OVER (PARTITION BY own.Scan, core, kind, number ORDER BY p < mz DESC, CASE WHEN p < mz THEN -p ELSE p END, CASE WHEN p < mz THEN -k ELSE k END) = 1),
        f AS (SELECT Scan, core, count(*) FILTER (kind = 'b') AS nb, count(*) FILTER (kind = 'y') AS ny, coalesce(sum(h) FILTER (kind = 'b'), 0) AS ib, coalesce(sum(h) FILTER (kind = 'y'), 0) AS iy FROM hits GROUP BY ALL),
        n AS (SELECT core, count(*) FILTER (kind = 'b') AS b, count(*) FILTER (kind = 'y') AS y FROM ions GROUP BY core),
        a AS (SELECT pep.*, b, y, tic, coalesce(nb, 0) AS nb, coalesce(ny, 0) AS ny, coalesce(ib, 0) AS ib, coalesce(iy, 0) AS iy FROM pep JOIN n USING (core) JOIN tic USING (Scan) LEFT JOIN f USING (Scan, core))
        SELECT sample, Scan, Charge, Peptide, Protein, ParentIonIntensity, tax, nb AS num_matched_b_ions, ny AS num_matched_y_ions, nb + ny AS num_matched_ions_total, round(nb / greatest(b, 1), 9) AS b_ion_coverage, round(ny / greatest(y, 1), 9) AS y_ion_coverage,
        round((nb + ny) / greatest(b + y, 1), 9) AS total_ion_coverage, round(tic, 9) AS total_ion_current, round((ib + iy) / greatest(tic, 1), 9) AS matched_intensity_fraction, round((ib + iy) / greatest(nb + ny, 1), 9) AS mean_matched_ion_intensity,
        round(ib / greatest(iy, 1), 9) AS b_to_y_intensity_ratio, round(iy / greatest(ib + iy, 1), 9) AS y_to_total_ratio FROM a""",
    "isotope_figures": f"""WITH p AS (SELECT vec_id, 400 + i * 0.5016775::DOUBLE + (vec_id * i % 7) * 0.006::DOUBLE - 0.015::DOUBLE AS mz, abs(e::DOUBLE * 1000) AS h FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)),
        t AS (SELECT vec_id, 400 + (vec_id % 40) * 0.5016775::DOUBLE AS m, vec_id % 3 + 1 AS z, k, 400 + (vec_id % 40) * 0.5016775::DOUBLE + k * ({chem.ISOTOPE_STEP}::DOUBLE / (vec_id % 3 + 1)) AS w FROM embeddings, range(0, 3) r(k)),
        s AS (SELECT vec_id, m, z, k, h, abs(mz - w) AS off FROM t JOIN p USING (vec_id) QUALIFY row_number() OVER (PARTITION BY vec_id, k ORDER BY abs(mz - w), mz) = 1),
        i AS (SELECT vec_id, m, z, coalesce(max(h) FILTER (k = 0 AND off < 0.02), 0) AS a, coalesce(max(h) FILTER (k = 1 AND off < 0.02), 0) AS b, coalesce(max(h) FILTER (k = 2 AND off < 0.02), 0) AS c FROM s GROUP BY ALL)
        SELECT vec_id, round(CASE WHEN a <> 0 THEN greatest(0.0, least(1.0, 1 - abs(b / (a + 1e-10) - least(0.0011 * m * z, 0.8)))) ELSE 0.0 END, 5) AS isotope_pattern_score, CASE WHEN a <> 0 AND c / (b + 1e-10) > 1.5 THEN 1.0 ELSE 0.0 END AS chimeric_indicator FROM i""",
    "residue_features": f"""WITH {_PEP}, d AS (SELECT DISTINCT Peptide, core FROM pep), r AS (SELECT Peptide, unnest(string_split(core, '')) AS r FROM d)
        SELECT d.Peptide, length(core) AS n, len(regexp_extract_all(core, '[KRH]')) AS basic, len(regexp_extract_all(core, '[DE]')) AS acidic,
        greatest(0, len(regexp_extract_all(core, '[KR]')) - len(regexp_extract_all(core, '[KR]P')) - 1) AS missed, CAST(regexp_matches(core, '[KR]P') AS INT) AS kp, round(h, 6) AS hydropathy
        FROM d JOIN (SELECT Peptide, avg({_KD}) AS h FROM r GROUP BY Peptide) USING (Peptide)""",
    "rank_gaps": f"""WITH {_PEP}, k AS (SELECT *, row_number() OVER (PARTITION BY sample, Scan ORDER BY s DESC) AS rn FROM pep),
        g AS (SELECT sample, Scan, count(*) AS c, max(s) FILTER (rn = 1) AS a, max(s) FILTER (rn = 2) AS b FROM k GROUP BY ALL), f AS (SELECT *, coalesce(a - b, -1.0) AS d FROM g)
        SELECT sample, c AS n_psms_in_scan, CASE WHEN d = -1.0 THEN 1 ELSE 0 END AS is_singleton_scan, CAST(sum(c) AS BIGINT) AS n, round(sum(d * c) / sum(c), 6) AS delta, round(sum(greatest(0.0, least(1.0, d / (abs(a) + 1e-8))) * c) / sum(c), 6) AS norm FROM f GROUP BY ALL""",
    "row_features": f"""WITH {_PEP}, k AS (SELECT *, row_number() OVER (PARTITION BY sample, Scan ORDER BY s DESC) AS rn, dense_rank() OVER (PARTITION BY sample ORDER BY e) AS dr FROM pep),
        g AS (SELECT sample, Scan, count(*) AS c, max(s) FILTER (rn = 1) AS a, max(s) FILTER (rn = 2) AS b FROM k GROUP BY ALL),
        f AS (SELECT k.*, c, coalesce(a - b, -1.0) AS d, a, substring(core, len // 2 + 1) AS tail, substring(core, 1, 1) AS r FROM k JOIN g USING (sample, Scan))
        SELECT sample, round(avg(s), 6) AS "neg_log_specEvalue", round(avg(dr), 6) AS specevalue_rank, round(avg(ln(1 + MSGFScore)), 6) AS log_msgf_score, round(avg(abs(DelM_PPM)), 6) AS abs_mass_error_ppm, round(avg(abs(tax - 0.03)), 6) AS abs_delm_da,
        round(avg(length(regexp_replace(tail, '[^ACILMFV]', '', 'g')) / (len - len // 2)), 6) AS c_half_hydro, round(avg({{kd}}), 6) AS n_term_hydro, round(avg(length(regexp_replace(core, '[^AILMFWV]', '', 'g')) / len), 6) AS hydrophobic_ratio,
        round(avg(Charge * abs(DelM_PPM)), 6) AS charge_x_mass_error, round(avg(Charge / len), 6) AS charge_to_length_ratio, round(avg(ln(1 + c)), 6) AS log_n_psms_in_scan, round(avg(d), 6) AS delta_score, round(avg(greatest(0.0, least(1.0, d / (abs(a) + 1e-8)))), 6) AS delta_score_norm,
        CAST(max(dr) AS INT) AS ranks, CAST(sum(CASE WHEN d = -1.0 THEN 1 ELSE 0 END) AS BIGINT) AS singletons, CAST(sum(CASE WHEN regexp_matches(core, '[KR]$') THEN 1 ELSE 0 END) AS BIGINT) AS tryptic FROM f GROUP BY sample""".replace("{kd}", _KD),
    "learned_peptides": f"""WITH {_PEP}, tr AS (SELECT * REPLACE (1 - half AS half), CASE WHEN len <= 7 THEN 's' WHEN len <= 11 THEN 'm' WHEN len <= 16 THEN 'l' ELSE 'xl' END AS bin FROM pep),
        m AS (SELECT sample, half, Peptide, max(s) AS best, count(s) AS n, coalesce(stddev_samp(s), 0) AS sd, count(DISTINCT Charge) AS z FROM tr GROUP BY ALL), f AS (SELECT sample, half, quantile_cont(s, 0.25) AS q FROM tr GROUP BY ALL),
        p AS (SELECT sample, half, Peptide, count(s) AS n, max(s) AS best, median(s) AS med FROM tr WHERE is_decoy = 0 GROUP BY ALL), u AS (SELECT sample, half, median(s) AS med, quantile_cont(s, 0.75) AS best FROM tr WHERE is_decoy = 0 GROUP BY ALL),
        c AS (SELECT sample, half, Charge, median(abs(DelM_PPM)) AS em, stddev_pop(abs(DelM_PPM)) AS es, median(mz) AS mm, stddev_pop(mz) AS ms FROM tr GROUP BY ALL),
        i AS (SELECT sample, half, median(ln(1 + ParentIonIntensity)) AS li, quantile_cont(t, 0.02) FILTER (t > 0) AS void, median(mz) AS mz_all FROM tr GROUP BY ALL), late AS (SELECT tr.* FROM tr JOIN i USING (sample, half) WHERE t >= void),
        g AS (SELECT sample, half, median(t) AS med FROM late GROUP BY ALL), pt AS (SELECT sample, half, Peptide, median(t) AS pm FROM late GROUP BY ALL), ct AS (SELECT sample, half, Charge, median(t) AS cm FROM late GROUP BY ALL),
        tt AS (SELECT sample, half, count(*) AS n, CASE WHEN median(t) < 300 THEN 0.5 ELSE 30 END AS reach FROM late WHERE is_decoy = 0 GROUP BY ALL),
        own AS (SELECT *, CASE WHEN len <= 7 THEN 's' WHEN len <= 11 THEN 'm' WHEN len <= 16 THEN 'l' ELSE 'xl' END AS bin, row_number() OVER () AS id FROM pep),
        refs AS (SELECT sample, half, Charge, bin, list(s) AS l FROM tr GROUP BY ALL HAVING count(*) >= 5),
        rk AS (SELECT id, len(list_filter(l, lambda x: x < s)) / len(l) AS share FROM own JOIN refs USING (sample, half, Charge, bin)),
        dens AS (SELECT id, count(late.t) AS n FROM own JOIN tt USING (sample, half) LEFT JOIN late ON late.sample = own.sample AND late.half = own.half AND late.is_decoy = 0 AND late.t BETWEEN own.t - reach AND own.t + reach WHERE tt.n >= 10 GROUP BY id),
        h AS (SELECT core, avg({{rc}}) AS hyd FROM (SELECT core, unnest(string_split(core, '')) AS r FROM (SELECT DISTINCT core FROM pep)) GROUP BY core),
        j AS (SELECT own.*, coalesce(m.best, f.q, 0) AS b1, ln(1 + coalesce(m.n, 0)) AS b2, coalesce(m.sd, 0) AS b3, coalesce(m.z, 1) AS b4, coalesce(p.best, u.best, 0) AS b5, coalesce(p.med, u.med, 0) AS b6, coalesce(p.best / (greatest(p.n, 1) + 1e-6), 0) AS b7, least(5, coalesce(p.n, 1)) AS b8,
            abs((abs(DelM_PPM) - coalesce(em, 0)) / (coalesce(es, 1) + 1e-6)) AS b9, (mz - coalesce(mm, mz_all)) / (coalesce(ms, 1) + 1e-6) AS b10, ln(1 + ParentIonIntensity) - li AS b11, coalesce(share, 0.5) AS b12, own.t >= void AS ok, abs(own.t - coalesce(pm, g.med)) AS b13, abs(own.t - coalesce(cm, g.med)) AS b14, dens.n AS b15, hyd
            FROM own LEFT JOIN m USING (sample, half, Peptide) LEFT JOIN f USING (sample, half) LEFT JOIN p USING (sample, half, Peptide) LEFT JOIN u USING (sample, half) LEFT JOIN c USING (sample, half, Charge) LEFT JOIN i USING (sample, half)
            LEFT JOIN rk USING (id) LEFT JOIN g USING (sample, half) LEFT JOIN pt USING (sample, half, Peptide) LEFT JOIN ct USING (sample, half, Charge) LEFT JOIN dens USING (id) LEFT JOIN h USING (core))
        SELECT sample, is_decoy, round(avg(b1), 5) AS pep_best_specev, round(avg(b2), 5) AS pep_n_observations, round(avg(b3), 5) AS pep_score_consistency, round(avg(b4), 5) AS pep_charge_diversity, round(avg(s - b1), 5) AS pep_score_relative_to_best, round(avg(b5), 5) AS peptide_best_score, round(avg(b6), 5) AS peptide_median_score,
        round(avg(b7), 5) AS peptide_reliability, round(avg(b9), 5) AS mass_error_zscore, round(avg(b10), 5) AS precursor_mz_deviation, round(avg(b11), 5) AS relative_parent_intensity, round(avg(b12), 5) AS "specEval_pctrank_in_class", round(avg(ok::INT), 5) AS rt_is_valid,
        round(avg(CASE WHEN ok THEN b13 ELSE 0 END), 5) AS rt_deviation_from_peptide, round(avg(CASE WHEN ok THEN b14 ELSE 0 END), 5) AS rt_deviation_from_charge, round(avg(CASE WHEN ok THEN t / len ELSE 0 END), 5) AS rt_per_residue, round(avg(b15), 5) AS rt_coelution_density,
        round(avg(CASE WHEN ok THEN t * hyd ELSE 0 END), 5) AS rt_x_hydrophobicity, CAST(sum(CASE WHEN s >= b5 - 1e-6 AND b8 <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS best, count(*) AS n FROM j GROUP BY ALL""".replace("{rc}", _RC),
    "coelution_density": f"WITH e AS (SELECT event_id, {_DAY} AS t FROM events) SELECT event_id, count(*) OVER (ORDER BY t RANGE BETWEEN 0.5 PRECEDING AND 0.5 FOLLOWING) AS n FROM e",
    "fold_balance": f"""WITH {_PEP}, k AS (SELECT sample, Scan, CASE WHEN max(is_decoy) = 0 THEN 'target' WHEN min(is_decoy) = 1 THEN 'decoy' ELSE 'mixed' END AS kind FROM pep GROUP BY ALL)
        SELECT sample, kind, count(*) AS scans, least(5, count(*)) AS folds, 1 AS even FROM k GROUP BY ALL""",
    "spectrum_figures": """WITH e AS (SELECT vec_id, [abs(x::DOUBLE) for x in embedding] AS e FROM embeddings), b AS (SELECT a.vec_id, a.e, o.e AS o FROM e a JOIN e o ON o.vec_id = a.vec_id + 1),
        c AS (SELECT *, list_cosine_similarity(e, o) AS c, list_avg(e) AS me, list_avg(o) AS mo FROM b)
        SELECT vec_id, round(list_sum(e), 5) AS tic, round(list_max(e), 5) AS base, round(list_sum(list_reverse_sort(e)[1:8]) / greatest(list_sum(e), 1.0), 5) AS top, round(sqrt(list_sum([x * x for x in e])), 5) AS norm, round(c, 5) AS cosine, round(1 - 2 * acos(least(1.0, c)) / pi(), 5) AS angle,
        round(list_cosine_similarity([x - me for x in e], [x - mo for x in o]), 5) AS pearson FROM c""",
    "longest_runs": """WITH d AS (SELECT DISTINCT l_suppkey, l_partkey % 200 AS x FROM lineitem), g AS (SELECT l_suppkey, x - row_number() OVER (PARTITION BY l_suppkey ORDER BY x) AS g FROM d), c AS (SELECT l_suppkey, g, count(*) AS n FROM g GROUP BY ALL)
        SELECT l_suppkey, max(n) AS run FROM c GROUP BY l_suppkey""",
    "carried_ms1": "SELECT conv_id AS file, turn AS ord, last_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS ms1_scan FROM conversations",
}
