from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from psmlake.functions import scores
from psmlake.operators import fdr, lineage, scan


def frame(spark, scores, decoys, sample="s"):
    return spark.createDataFrame([(sample, i, float(s), int(d)) for i, (s, d) in enumerate(zip(scores, decoys, strict=True))], "sample string, id long, score double, is_decoy int")


def plain(scores, decoys, plus_one=False, clip=True):
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))
    d = np.cumsum([decoys[i] for i in order])
    t = np.cumsum([1 - decoys[i] for i in order])
    rate = np.where(t == 0, 1.0, (d + plus_one) / np.maximum(t, 1))
    if clip:
        rate = np.clip(rate, 0, 1)
    q = np.minimum.accumulate(rate[::-1])[::-1]
    return {i: q[k] for k, i in enumerate(order)}


def test_q_values_by_hand(spark):
    got = {r.id: r.q for r in fdr.estimate_fdr(frame(spark, [9, 8, 7, 6, 5, 4], [0, 0, 1, 0, 1, 0]), "score", ["id"]).collect()}
    assert [got[i] for i in range(6)] == pytest.approx([0, 0, 1 / 3, 1 / 3, 1 / 2, 1 / 2])


def test_plus_one_may_exceed_one(spark):
    rows = frame(spark, [9, 8, 7, 6], [0, 1, 1, 1]).withColumn("SpecEValue", 10 - F.col("score"))
    got = {r.id: r.QValue for r in fdr.compute_q_value(rows, ["id"]).collect()}
    assert [got[i] for i in range(4)] == [1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize("seed", range(3))
def test_parts_give_what_one_pass_gives(spark, seed):
    rng = np.random.default_rng(seed)
    scores = rng.integers(0, 40, 700).astype(float)
    decoys = (rng.random(700) < 0.4).astype(int)
    got = {r.id: r.q for r in fdr.estimate_fdr(frame(spark, scores, decoys), "score", ["id"]).collect()}
    want = plain(scores.tolist(), decoys.tolist())
    assert got == pytest.approx(want)


def test_one_score_of_many_rows_lies_in_many_parts(spark):
    n = 200_000
    rows = spark.range(n).select(F.lit("s").alias("sample"), "id", F.lit(7.0).alias("score"), (F.xxhash64("id") % 3 == 0).cast("int").alias("is_decoy"))
    laid = scan.laid_out(rows, ["sample"], [fdr.falling("score"), F.col("id")], 16)
    sizes = [r["count"] for r in laid.groupBy(scan.PART).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * n / 16
    got = fdr.q_values(rows, [fdr.falling("score"), F.col("id")], parts=16).select("id", "is_decoy", "q").toPandas()
    want = plain([7.0] * n, got.sort_values("id").is_decoy.tolist())
    assert np.abs(got.sort_values("id").q.to_numpy() - np.array([want[i] for i in range(n)])).max() < 1e-12


def test_not_a_number_and_null_groups(spark):
    rows = spark.createDataFrame([(None, 1, float("nan"), 1), (None, 2, 5.0, 0), (None, 3, 4.0, 1), ("s", 4, 1.0, 0), ("s", 5, 2.0, 1)], "sample string, id long, score double, is_decoy int")
    got = {r.id: r.q for r in fdr.estimate_fdr(rows, "score", ["id"]).collect()}
    assert got == {2: 0.0, 3: 1.0, 1: 1.0, 5: 1.0, 4: 1.0}


def test_ranks_by_value(spark):
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2], i, float(v) if v else None) for i, v in enumerate(rng.integers(0, 30, 500))]
    df = spark.createDataFrame(rows, "sample string, id long, v double")
    ranks = {"first": lambda n, upto, dense, of: upto - n + 1, "dense": lambda n, upto, dense, of: dense, "share": lambda n, upto, dense, of: (upto - (n - 1) / 2) / of}
    got = scan.ranked(df, ["sample"], F.col("v"), ranks).toPandas().sort_values("id").reset_index(drop=True)
    by = got.groupby("sample")["v"]
    for name, how in (("first", {"method": "min"}), ("dense", {"method": "dense"}), ("share", {"pct": True})):
        assert np.allclose(got[name].astype(float), by.rank(**how), equal_nan=True)


def test_monotone_and_one_value_a_peptide(spark):
    rows = spark.createDataFrame([("s", 1, "K.PEP.R", 1e-9, 0), ("s", 2, "K.PEP.R", 1e-3, 0), ("s", 3, "R.QQQ.K", 1e-5, 1), ("s", 4, "R.AAA.K", 1e-4, 0)], "sample string, id long, Peptide string, SpecEValue double, is_decoy int")
    got = {r.id: r.PepQValue for r in fdr.compute_peptide_q_value(rows, ["id"]).collect()}
    assert got[1] == got[2]
    assert got[1] <= got[3] <= got[4] or got[3] == got[4]


def test_missing_scores_come_last(spark):
    rows = spark.createDataFrame([("s", 1, None, 1), ("s", 2, 5.0, 0)], "sample string, id long, score double, is_decoy int")
    got = {r.id: r.q for r in fdr.estimate_fdr(rows, "score", ["id"]).collect()}
    assert got == {1: 1.0, 2: 0.0}


@pytest.mark.parametrize(("scores", "decoys"), [([1, 2], [0, 0]), ([1, 2], [1, 1]), ([1, None], [0, 1])])
def test_inputs_are_checked(spark, scores, decoys):
    rows = spark.createDataFrame([(s if s is None else float(s), d) for s, d in zip(scores, decoys, strict=True)], "score double, is_decoy int")
    with pytest.raises(fdr.FdrInputError):
        fdr.check_inputs(rows, "score")


def test_empty_table(spark):
    assert fdr.estimate_fdr(frame(spark, [], []), "score", ["id"]).count() == 0


def test_alpha_is_tuned_for_each_sample(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "abc"[i % 3], float(rng.random()), float(rng.random()), int(rng.random() < 0.2)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, sample string, p double, e double, is_decoy int")
    got = {(r.sample, r.alpha): r.n_ids for r in fdr.tune_alpha(df, "p", "e", ("id",), threshold=0.2, by=("sample",)).collect()}
    want = {(s, r.alpha): r.n_ids for s in "abc" for r in fdr.tune_alpha(df.where(f"sample = '{s}'"), "p", "e", ("id",), threshold=0.2).collect()}
    assert got == want and len(got) == 18


def test_alpha_tuning_by_every_prefix_of_tied_scores(spark):
    rng = np.random.default_rng(11)
    for n, values, threshold, compat in ((400, 3, 0.3, False), (400, 12, 0.2, True), (300, 300, 0.25, False), (40, 1, 0.4, False), (60, 4, 1.5, True)):
        label = (rng.random(n) < 0.3).astype(int)
        table = [(int(k), float(rng.integers(0, values)) / values * (1.0 if label[k] else 1.2), float(rng.integers(0, 2)) / 9, int(label[k])) for k in rng.permutation(n)]
        df = spark.createDataFrame(table, "id int, p double, e double, is_decoy int")
        got = {r.alpha: r.n_ids for r in fdr.tune_alpha(df, "p", "e", ("id",), threshold=threshold, compat=compat).collect()}
        exploded = df.crossJoin(spark.createDataFrame([(a,) for a in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)], "alpha double")).withColumn("score", scores.noisy_or(F.col("p"), F.col("e"), F.col("alpha"), 1.0))
        rows = exploded.toPandas()
        for a, g in rows.groupby("alpha"):
            g = g.sort_values(["score", "id"], ascending=[False, True])
            d, t = g.is_decoy.cumsum(), (1 - g.is_decoy).cumsum()
            q = np.where(t > 0, np.minimum(1, d / np.maximum(t, 1)), 1.0)[::-1]
            q = np.minimum.accumulate(q)[::-1]
            assert got[a] == int(((q < threshold) & (compat | (g.is_decoy == 0))).sum())


def test_more_parts_for_larger_files(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/a table [1]%20"
    spark.range(5000).select(F.lit("s").alias("sample"), "id", F.rand(1).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("is_decoy")).write.parquet(path)
    df = spark.read.parquet(path.replace("[", "\\[").replace("]", "\\]"))
    want = {r.id: r.q for r in fdr.estimate_fdr(df, "score", ("id",)).collect()}
    assert lineage.parts_for(df) == 4 and lineage.parts_for(df.limit(1).union(df)) == 4
    assert lineage.parts_for(spark.range(10)) == 4
    monkeypatch.setattr(lineage, "PART_BYTES", 2000)
    assert lineage.parts_for(df) > 8 and lineage.dealt(df, "id").rdd.getNumPartitions() == lineage.parts_for(df)
    assert scan.laid_out(df, ("sample",), [F.col("score"), F.col("id")]).select(scan.PART).distinct().count() > 8
    assert {r.id: r.q for r in fdr.estimate_fdr(df, "score", ("id",)).collect()} == want
