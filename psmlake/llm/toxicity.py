"""Toxicity as expected severity by cumulative-link ordinal regression on sparse text features.

A document's features are its distinct words and their beginnings of 4 to 10 bytes, hashed to `SLOTS` slots, lower-cased, edges of
punctuation cut off.  One weight vector is shared by all ordered thresholds: P(grade > k) = 1 / (1 + exp(theta_k - w.x)).
The expected severity is the sum of these chances over k.

Labels tell toxic documents from others; grades come from how densely a labelled toxic document uses the features that
labels tell apart best: those too frequent in toxic documents to be chance.  0 is not toxic, then terciles of that density.  The model is fitted on at most `sample_rows` labelled
documents, half of them toxic where there are enough, taken in the order of a hash of their id; a fifth of them sets the severity from which a
document counts as toxic.  Every document is scored, on its whole text.

Defined results: a null or empty text has no features and the severity of the thresholds alone; null or other
labels than 0 and 1 are not used, a repeated label is used once; without any toxic or any other labels the severity is 0 throughout;
ids may be null or repeat, each row gets its own score; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import MARK, bounded_batches, written
from .text_kernels import U64, Words, mix, slices

SLOTS = 1 << 18
BEGINNINGS = (4, 6, 7, 8, 9, 10)


def feature_rows(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each feature, feature) for slices of the column; features may repeat."""
    for first, data, offsets in slices(texts):
        w = Words(data, offsets)
        w.trim()
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
        some = w.starts < w.ends
        whole = [(w.hashes() >> U64(64 - 18)).astype(np.int64)]
        for k in BEGINNINGS:
            whole.append((mix(w.hashes(k) + U64(k)) >> U64(64 - 18)).astype(np.int64))
        yield first, len(offsets) - 1, np.tile(row[some], len(whole)), np.concatenate([h[some] for h in whole])


@dataclass
class OrdinalModel:
    weights: np.ndarray  # by slot, mostly zero
    thresholds: np.ndarray  # ascending
    cut: float  # severity from which a document counts as toxic

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, n, row, slot in feature_rows(texts):
            used = self.weights[slot] != 0
            both = np.unique(row[used] * SLOTS + slot[used])
            out[first : first + n] = np.bincount(both // SLOTS, self.weights[both % SLOTS], n)
        return out

    def exceeding(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def fit_ordinal(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, features: int, weight: np.ndarray, penalty: float = 0.003, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights, none below 0, and ascending thresholds by maximum penalised likelihood (Adam on all rows)."""
    k = int(grade.max())
    n = len(grade)
    w, base, gaps = np.zeros(features), np.zeros(1), np.zeros(max(0, k - 1))
    params = [w, base, gaps]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    above = (grade[:, None] > np.arange(k)[None, :]).astype(float)
    total = weight.sum()
    for t in range(1, rounds + 1):
        theta = np.concatenate([base, base + np.cumsum(np.exp(gaps))])
        s = np.bincount(row, w[feature], n)
        p = 1 / (1 + np.exp(np.clip(theta[None, :] - s[:, None], -40, 40)))  # P(grade > k)
        # chance of the row's own grade: difference of neighbouring exceeding chances
        wide = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], 1)
        own = np.maximum(wide[np.arange(n), grade] - wide[np.arange(n), grade + 1], 1e-12)
        slope = p * (1 - p)
        d = np.zeros((n, k))  # of the log chance by each p
        hit = grade >= 1
        d[np.flatnonzero(hit), grade[hit] - 1] += 1 / own[hit]
        low = grade < k
        d[np.flatnonzero(low), grade[low]] -= 1 / own[low]
        by_s = (d * slope) * (weight / total)[:, None]
        g_w = -np.bincount(feature, by_s.sum(1)[row], features) + penalty * w / max(1, features) ** 0.5
        g_theta = by_s.sum(0)
        g_gaps = np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(gaps)
        for i, g in enumerate((g_w, np.array([g_theta.sum()]), g_gaps)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] -= 0.05 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-9)
        np.maximum(w, 0, out=w)
    return w, np.concatenate([base, base + np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = 6000, odds: float = 3.0, surprise: float = 20.0, grades: int = 3) -> OrdinalModel:
    """The model from a bounded sample of labelled documents."""
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias(f"l{MARK}"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").groupBy(f"l{MARK}").agg(F.max("toxic").alias("toxic"))
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64(f"l{MARK}", F.lit(11))
    picked = [known.where(F.col("toxic") == k).orderBy(order, f"l{MARK}").limit(sample_rows // 2) for k in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    joined = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}")).join(F.broadcast(chosen), F.col(f"id{MARK}") == F.col(f"l{MARK}"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs: list[bytes] = [b""] * len(batch)
            for first, n, row, slot in feature_rows(batch.column(1)):
                order_ = np.argsort(row, kind="stable")
                edges = np.searchsorted(row[order_], np.arange(n + 1))
                for i in range(n):
                    own, many = np.unique(slot[order_[edges[i] : edges[i + 1]]], return_counts=True)
                    blobs[first + i] = np.stack([own, many]).astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(blobs, pa.binary())], names=["id", "toxic", "features"])

    kind = joined.schema[0].dataType.simpleString()
    sample = written(joined.select(f"id{MARK}", f"text{MARK}", "toxic").mapInArrow(features, f"id {kind}, toxic int, features binary").withColumn("held", F.pmod(F.xxhash64("id", F.lit(23)), F.lit(5)) == 4))
    train = sample.where("not held")
    n1, n0 = (train.where(F.col("toxic") == k).count() for k in (1, 0))
    if n1 < 5 or n0 < 5:
        return OrdinalModel(np.zeros(SLOTS), np.full(grades, 60.0), 0.5)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((2, SLOTS), np.int64)
            for toxic_, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(blob.as_buffer(), "<i4").reshape(2, -1)[0]
                total[0, own] += toxic_
                total[1, own] += 1
            some = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], names=["slot", "toxic", "n"])

    counts = train.select("toxic", "features").mapInArrow(slots, "slot long, toxic long, n long").groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where("toxic > 2").orderBy("slot").limit(SLOTS).toArrow()
    in_toxic, in_all = np.zeros(SLOTS), np.zeros(SLOTS)
    in_toxic[counts.column("slot").to_numpy()], in_all[counts.column("slot").to_numpy()] = counts.column("toxic").to_numpy(), counts.column("n").to_numpy()
    lift = np.log((in_toxic + 0.5) / (n1 + 1)) - np.log((in_all - in_toxic + 0.5) / (n0 + 1))
    # only what speaks for toxicity, and too often for chance: what is rare in toxic text must not outweigh an insult
    expected = in_all * (n1 / (n1 + n0))
    surprise_of = 2 * in_toxic * np.log(np.maximum(in_toxic, 1e-9) / np.maximum(expected, 1e-9))
    chosen_slots = np.flatnonzero((lift >= odds) & (surprise_of >= surprise))
    if not len(chosen_slots):
        return OrdinalModel(np.zeros(SLOTS), np.full(grades, 60.0), 0.5)
    number = np.full(SLOTS, -1)
    number[chosen_slots] = np.arange(len(chosen_slots))
    telling = docs.sparkSession.sparkContext.broadcast(chosen_slots.astype(np.int32))

    def chosen_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, blobs = [], []
            for blob in batch.column(3):
                own = np.frombuffer(blob.as_buffer(), "<i4").reshape(2, -1)
                size.append(int(own[1].sum()))
                blobs.append(own[:, np.isin(own[0], telling.value)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(size, pa.int64()), pa.array(blobs, pa.binary())], names=["id", "toxic", "held", "size", "features"])

    got = sample.select("id", "toxic", "held", "features").mapInArrow(chosen_only, f"id {kind}, toxic int, held boolean, size long, features binary").orderBy("id", "size", "features").limit(2 * sample_rows).toArrow()
    toxic, held = got.column("toxic").to_numpy().astype(np.int64), got.column("held").to_numpy()
    pairs = [np.frombuffer(b.as_buffer(), "<i4").reshape(2, -1) for b in got.column("features")]
    row = np.repeat(np.arange(len(pairs)), [p.shape[1] for p in pairs])
    slot, many = np.concatenate(pairs, axis=1)
    own = ~held[row]
    used = number[slot] >= 0
    density = np.bincount(row[used], many[used], len(pairs)) / np.maximum(1, got.column("size").to_numpy())
    bounds = np.quantile(density[toxic == 1], np.arange(1, grades) / grades)
    grade = np.where(toxic == 1, 1 + np.searchsorted(bounds, density, "right"), 0)
    train = own & used
    place = np.cumsum(~held) - 1
    own_grade = grade[~held]
    top = int(own_grade.max())
    if top == 0:
        return OrdinalModel(np.zeros(SLOTS), np.full(grades, 60.0), 0.5)
    own_grade = np.unique(own_grade, return_inverse=True)[1] if len(np.unique(own_grade)) < top + 1 else own_grade
    w, theta = fit_ordinal(place[row[train]], number[slot[train]], own_grade, len(chosen_slots), np.ones(len(own_grade)))
    weights = np.zeros(SLOTS)
    weights[chosen_slots] = np.where(w > 1e-3, w, 0)
    model = OrdinalModel(weights, theta, 0.5)
    s = np.bincount(row, weights[slot], len(pairs))
    severity = model.exceeding(s).sum(1)
    if toxic[held].any():  # the held part weighs as the labels do, not as the sample's halves
        model.cut = best_cut(severity[held], toxic[held], (shares[0] / shares[1]) / (n0 / n1))
    return model


def best_cut(severity: np.ndarray, toxic: np.ndarray, usual: float = 1.0) -> float:
    """The middle of the severities between which a cut gives the best F1, where a row that isn't toxic counts `usual` times."""
    order = np.argsort(-severity, kind="stable")
    s, t = severity[order], toxic[order]
    hits = np.cumsum(t)
    f1 = 2 * hits / (hits + usual * np.cumsum(1 - t) + t.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # no cut within equal severities
    k = int(np.argmax(f1))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def severity(docs: DataFrame, model: OrdinalModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row: doc_id, severity (expected grade), grade (the likeliest), toxic."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: OrdinalModel = shared.value
        for batch in batches:
            above = own.exceeding(own.scores(batch.column(1)))
            expected = above.sum(1)
            wide = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1)
            grade = np.argmax(wide[:, :-1] - wide[:, 1:], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(expected, 9)), pa.array(grade.astype(np.int32)), pa.array(expected >= own.cut)], names=[f"id{MARK}", "severity", "grade", "toxic"])

    slim = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}"))
    return slim.mapInArrow(score, f"id{MARK} {slim.schema[0].dataType.simpleString()}, severity double, grade int, toxic boolean").withColumnRenamed(f"id{MARK}", doc_id)
