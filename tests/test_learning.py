from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from psmlake.operators import engineer, persist, qc, rescore, rt
from psmlake.plans import rescoring


def psms(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        d = int(rng.random() < 0.4)
        core = "".join(rng.choice(list("AGILMFVKDE"), rng.integers(7, 14))) + "K"
        score = float(rng.normal(20 - 5 * d, 4))
        x = float(rt_score(core))
        rows.append((i, "s", i // 2, i // 2, int(rng.integers(2, 4)), f"R.{core}.A", ("XXX_" if d else "") + f"P{i % 40}", d, score, float(rng.normal(0, 2 + 4 * d)), 10 ** (-score / 2), 40 + 1.2 * x + float(rng.normal(0, 0.3 + 8 * d)), 1e4, 0.05))
    return spark.createDataFrame(rows, "psm_id long, sample string, Scan int, OptimalScanNumber int, Charge int, Peptide string, Protein string, is_decoy int, MSGFScore double, DelM_PPM double, MSGFDB_SpecEValue double, ElutionTime double, ParentIonIntensity double, QValue double")


def rt_score(core):
    from psmlake.functions.peptide import RETENTION

    return sum(RETENTION.get(c, 0) for c in core) - 0.35 * np.log1p(len(core)) + 0.42 * RETENTION.get(core[0], 0)


def test_rescoring_ranks_at_least_as_well(spark):
    rows = psms(spark)
    done, importance, gains = rescoring.rescored(rows, ("Scan", "psm_id"), n_folds=2, n_members=1, most_trees=8)
    done = done.persist()
    assert done.count() == 600
    assert {"xpec_q", "xpec_pepq", "xpec_score", "rescore_prob"} <= set(done.columns)
    before, after = (qc.roc_auc(done, c).first()["auc"] for c in ("MSGFScore", "xpec_score"))
    assert after >= before - 0.01
    assert importance.count() > 5
    assert done.where("xpec_score < 0 or xpec_score > 1 or xpec_q < 0").count() == 0
    assert gains.count() == 3


def test_rising_is_rising():
    assert rt.rising(np.array([3.0, 1.0, 2.0, 5.0])).tolist() == [2.0, 2.0, 2.0, 5.0]


def test_retention_model_round_trip(spark, tmp_path):
    rows = psms(spark)
    model = rt.fit(rows)
    got = rt.predict(rows, model)
    figures = qc.rt_agreement(got.where("is_decoy = 0"), "ElutionTime", "rt_pred", ()).first()
    assert figures["pearson"] > 0.95
    assert got.where("rt_score < 0 or rt_score > 1").count() == 0
    persist.save_rt(model, tmp_path)
    again = persist.load_rt(spark, tmp_path)
    pick = lambda m: sorted((r.psm_id, r.rt_pred, r.rt_score) for r in rt.predict(rows, m).collect())
    assert pick(model) == pick(again)
    with pytest.raises(persist.WrongKind):
        persist.load_features(spark, tmp_path)
    few = rt.predict(rows.limit(5), rt.fit(rows.limit(5))).first()  # no curve of so few
    assert few.rt_pred is None and few.rt_score == 0


def test_residual_trees(spark):
    rows = psms(spark, 400)
    model = rt.fit(rows)
    trees = rt.fit_residuals(rows, model, "MSGFScore", most_trees=5)
    out = rt.with_residuals(rt.predict(rows, model), trees)
    assert out.columns == rt.predict(rows, model).columns


def test_feature_model_round_trip(spark, tmp_path):
    rows = engineer.stateless(psms(spark, 200))
    model = engineer.fit(rows)
    persist.save_features(model, tmp_path)
    again = persist.load_features(spark, tmp_path)
    names = ["psm_id", "pep_best_specev", "mass_error_zscore", "rt_coelution_density", "specEval_pctrank_in_class"]
    assert sorted(map(tuple, engineer.transform(rows, model).select(*names).collect())) == sorted(map(tuple, engineer.transform(rows, again).select(*names).collect()))


def test_tiers_and_trimmed_mean(spark):
    assert rescore.tier(120_000).depth == 7 and rescore.tier(60_000).depth == 6 and rescore.tier(10).depth == 5
    row = spark.createDataFrame([(0.0, 1.0, 9.0)], "a double, b double, c double")
    assert row.select(rescore.trimmed_mean([F.col(c) for c in "abbbbbc"]).alias("m")).first().m == 1.0
    assert row.select(rescore.trimmed_mean([F.col(c) for c in "abc"]).alias("m")).first().m == pytest.approx(10 / 3)


def weights_by_hand(target, auc, gap, error):
    """Each row's weight before the mean is taken out."""
    noise = auc / 0.75 if auc < 0.75 else 1.0
    floor, scale = 0.7 + 0.3 * (1 - noise), max(np.percentile(gap[target], 90, method="inverted_cdf"), 1e-6)
    w = (floor + (1 - floor) * (np.tanh(gap / scale) + 1) / 2) * np.exp(-0.15 * noise * np.clip(error, 0, 10))
    share = (~target).sum() / target.sum()
    return np.where(target, np.clip(w, 0.3, 2) * (1.0 if auc < 0.7 or abs(share - 1) < 0.15 else share), 1.0)


@pytest.mark.parametrize("spread", [6.0, 1.2, 0.2])
def test_weights_by_hand(spark, spread):
    rng = np.random.default_rng(4)
    target = rng.random(400) < 0.7
    score = rng.normal(size=400) + spread * 0.3 * target
    gap, error = rng.normal(1, 1, 400).round(3), rng.normal(1, 4, 400).round(3)
    rows = [("s", 0, i, int(not t), float(s), float(g), float(e)) for i, (t, s, g, e) in enumerate(zip(target, score, gap, error, strict=True))]
    df = spark.createDataFrame(rows, f"sample string, k int, __row long, is_decoy int, {engineer.SCORE} double, delta_score double, mass_error_zscore double")
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in score[target] for b in score[~target]])
    got = rescore.with_weights(df).orderBy("__row").toPandas().weight.to_numpy()
    want = weights_by_hand(target, auc, gap, error)
    assert np.allclose(got, want / want.mean())


def test_members_are_kept(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [("s", 0, i, False, int(x + 0.5 * rng.normal() < 0), True, 1.0, [float(x), float(rng.normal())]) for i, x in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(rows, "sample string, k int, __row long, test boolean, is_decoy int, told boolean, weight double, x array<double>")
    df = df.withColumn("features", rescore.array_to_vector("x"))
    models = rescore.fitted(df, 2, 1, most_trees=3)
    persist.save_members(models, ["x", "noise"], tmp_path)
    again, names = persist.load_members(tmp_path)
    assert names == ["x", "noise"] and len(again) == 2
    a, b = ({r["__row"]: r.rescore_prob for r in rescore.scored(df, m).collect()} for m in (models, again))
    assert a == b
    assert models[0].featureImportances[0] > models[0].featureImportances[1]
    few = rescore.fitted(df, 1, 1, most_rows=100, most_trees=2)
    assert len(few) == 1
    assert {r.rescore_prob for r in rescore.scored(df.withColumn("told", F.lit(False)), models).collect()} == {0.5}


def test_offsets_are_learned_where_seen_and_plausible(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        core = "".join(rng.choice(list("AGILMFVKDESTWY"), rng.integers(6, 20))) + "MK"
        base, at = 12 + 1.3 * float(rt_score(core)), core.find("M")
        modified = f"R.{core[: at + 1]}+15.995{core[at + 1 :]}.A"
        for sample, shift in (("s", -2.5), ("t", 9.0)):  # the second is beyond belief
            rows += [(sample, f"R.{core}.A", 2, base + rng.normal(0, 0.3), 0), (sample, modified, 2, base + shift + rng.normal(0, 0.3), 0)]
    df = spark.createDataFrame(rows, "sample string, Peptide string, Charge int, ElutionTime double, is_decoy int")
    got = {r["sample"]: r.asDict() for r in rt.learned_offsets(df).collect()}
    assert got["s"]["oxidation"] == pytest.approx(-2.5, abs=0.2) and got["t"]["oxidation"] == -3.5
    assert {(r["phospho"], r["deamidation"]) for r in got.values()} == {(-5.0, -0.5)}
    told = rt.predict(df.where("sample = 's'"), rt.fit(df))
    assert told.select(F.median(F.abs(F.col("ElutionTime") - F.col("rt_pred")))).first()[0] < 0.6


def test_time_features_by_hand(spark):
    rows = spark.createDataFrame([("s", "K.AAA.R", 2, float(i) if i else None, i > 2, 10.0, i % 2) for i in range(60)], "sample string, Peptide string, Charge int, ElutionTime double, valid boolean, usual double, is_decoy int")
    none = rt.fit(rows.limit(0))
    got = {r.ElutionTime: r for r in rt.time_features(rows, none, F.col("valid"), F.col("usual")).collect()}
    assert {r.rt_match_prob for r in got.values()} == {0.5} and {r.predicted_rt for r in got.values()} == {10.0}
    assert [got[t].rt_delta for t in (None, 1.0, 2.0, 20.0)] == [0, 0, 0, 10] and got[2.0].raw_rt_delta is None
    cap = np.quantile(np.abs(np.arange(3, 60) - 10), 0.9)
    assert max(r.abs_rt_delta for r in got.values()) == pytest.approx(cap)
    few = rt.time_features(rows.where("ElutionTime in (3, 55)"), none, F.col("valid"), F.col("usual")).collect()
    assert {r.ElutionTime: r.abs_rt_delta for r in few} == {3.0: 7.0, 55.0: 40.0}


def test_scans_of_one_number_in_two_samples_are_two_scans(spark):
    one = psms(spark, 240)
    other = psms(spark, 240, seed=9).withColumn("sample", F.lit("t")).withColumn("psm_id", F.col("psm_id") + 1000)
    alone, _ = rescore.cross_validated(one, 2, 1, most_trees=3)
    both, importance = rescore.cross_validated(one.unionByName(other), 2, 1, most_trees=3)
    a = {r.psm_id: (r.predicted_rt, r.fold) for r in alone.collect()}
    b = {r.psm_id: (r.predicted_rt, r.fold) for r in both.collect()}
    assert len(a) == 240 and len(b) == 480
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)  # what is learned of a sample does not depend on others
    assert {"rt_match_prob", "abs_rt_delta", "pep_best_specev", "delta_score"} <= {r.feature for r in importance.collect()}


def test_labels_of_test_rows_change_no_feature(spark, monkeypatch):
    rows = psms(spark, 240)
    seen = []
    vectors = rescore.vectors
    monkeypatch.setattr(rescore, "vectors", lambda wide, names: seen.append({(r["k"], r["__row"]): [r[c] for c in names] for r in wide.where("test").collect()}) or vectors(wide, names))
    monkeypatch.setattr(rescore, "fitted", lambda *a: [])
    laid_out = rescore._laid_out
    for flip in (False, True):
        # a row's label is turned around where it is a test row, and stays where it trains
        monkeypatch.setattr(rescore, "_laid_out", lambda r, n, flip=flip: laid_out(r, n).withColumn("is_decoy", F.when(F.col("test") & F.lit(flip), 1 - F.col("is_decoy")).otherwise(F.col("is_decoy"))))
        rescore.cross_validated(rows, 2, 1)
    assert len(seen[0]) == 240 and seen[0].keys() == seen[1].keys()
    assert all(seen[0][i] == pytest.approx(seen[1][i], nan_ok=True) for i in seen[0])


def test_one_class_gets_a_half(spark):
    rows = psms(spark, 60).withColumn("is_decoy", F.lit(0))
    scored, importance = rescore.cross_validated(rows, 2, 1, most_trees=3)
    assert {r.rescore_prob for r in scored.collect()} == {0.5} and importance.count() == 0


def test_selected_features_vary(spark):
    rows = spark.createDataFrame([(1.0, 5, True, "x", 0), (2.0, 5, False, "y", 1)], "a double, same int, flag boolean, text string, is_decoy int")
    assert engineer.select_features(rows) == ["a", "flag"]
    holes = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "a double")
    fill = engineer.medians(holes, ["a"])
    assert [r.a for r in engineer.imputed(holes, fill).collect()] == [1.0, 2.0, 2.0, 3.0]


def lineitems(spark, path, n):
    """A small lineitem table, two to a scan; the path of its folder."""
    rng = np.random.default_rng(5)
    rows = [(f"{1995 + i % 7}-03-04", 1 + i // 2, 1 + i % 2, int(rng.integers(1, 40)), int(rng.integers(1, 9)), float(rng.integers(1, 51)), float(rng.integers(0, 11)) / 100, float(rng.integers(900, 90000)), float(rng.integers(0, 9)) / 100, "R" if rng.random() < 0.4 else "N") for i in range(n)]
    docs = spark.createDataFrame(rows, "d string, l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_extendedprice double, l_tax double, l_returnflag string")
    docs.withColumn("l_shipdate", F.col("d").cast("date")).drop("d").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_spectral_features_of_every_psm(spark, tmp_path):
    from psmlake.operators import spectral
    from psmlake.queries import features

    folder = lineitems(spark, tmp_path, 150)
    got = {r.psm_id: r.asDict() for r in features.spectral_features(spark, folder).collect()}
    rows = features._peptides(spark, folder).withColumn("psm_id", F.xxhash64(*features.PEP_TIE)).collect()
    assert len(rows) == 150 and set(got) == {r.psm_id for r in rows}
    k = np.arange(1, 121)
    for r in rows:
        want = spectral.features(r.Peptide, r.Charge, 100.0 + k * 7.3 + (r.Scan * k % 97) / 10, 10.0 + (r.Scan * k * k % 1013), 500.0, tolerance=0.5)
        assert want["spectral_feature_error"] is None and got[r.psm_id]["spectral_feature_error"] is None
        for c in (*spectral.COUNTS, *spectral.VALUES):
            assert got[r.psm_id][c] == pytest.approx(want[c], abs=1e-9), c


def test_rescoring_query_scores_every_row_with_the_shipped_models(spark, tmp_path):
    from psmlake.queries import features

    got = {(r["sample"], r.stage): r.auc for r in features.rescoring(spark, lineitems(spark, tmp_path, 700)).collect()}
    assert {stage for _, stage in got} == {"before", "after"} and len(got) == 14
    assert all(0 <= v <= 1 for v in got.values())


def test_retention_query_calibrates_every_sample(spark, tmp_path):
    from psmlake.queries import features

    got = features.retention_model(spark, lineitems(spark, tmp_path, 700)).collect()
    assert len(got) == 7 and all(r.pearson > 0.9 for r in got)


def test_learned_figures_reach_all_rows(spark, tmp_path):
    from psmlake.queries import features

    assert sum(r.n for r in features.learned_peptides(spark, lineitems(spark, tmp_path, 150)).collect()) == 150
