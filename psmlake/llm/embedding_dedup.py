"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are turned into principal axes, largest variance first; the turn keeps every inner product.  Vectors of one label are
dealt, in bins of their first coordinate, into tiles of about `tile_rows`; a crowded bin is dealt by the next coordinate, and one that is crowded in all leading coordinates is spread over several tiles.  Two
tiles meet only where their boxes over the leading coordinates come within the distance that the threshold allows; a grid of that distance over the first two coordinates
finds them, so tiles far apart are never compared.
Where they meet, products are summed over the leading coordinates first: the sum so far and the norms of the two rests bound the cosine, and a
block stops as soon as none of its pairs can reach the threshold.  What remains is decided by the cosine of the given vectors
in double precision.  A meeting returns each vector's number of links and a spanning forest, never its pairs.

The axes come from at most `sample_rows` vectors; they decide the speed, not the result.  Equal vectors of a label are one class, told by 128 bits of a hash in which
both zeros are one.

Defined results: vectors that are null, zero or hold null or non-finite components, and those with a null label, link with nothing; so do
vectors of different lengths; components of any finite size are scaled by powers of two, so that no norm overflows; a null id takes its class's component; rows that repeat an id are vectors of their own;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .runtime import bounded_batches, written

BIN = 0.02
LEADING = 4
BLOCK = 512
SLACK = 1e-9


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two to a largest component from 0.5 to 1; cosines stay what they are."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: principal axes of unit vectors, largest variance first."""
    vectors = scaled(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    _, turned = np.linalg.eigh(np.cov(unit, rowvar=False, bias=True).reshape(unit.shape[1], -1))
    return np.ascontiguousarray(turned[:, ::-1])


def links_between(x: np.ndarray, y: np.ndarray, basis: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold; of one set with itself, those with i < j."""
    x, y = scaled(x), scaled(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    ux, uy = (x / nx[:, None]) @ basis, (y / ny[:, None]) @ basis
    ox, oy = np.argsort(ux[:, 0], kind="stable"), np.argsort(uy[:, 0], kind="stable")
    ux, uy = ux[ox], uy[oy]
    dims = ux.shape[1]
    steps = sorted({min(dims, k) for k in (4, 8, 16, 32, dims)} | {dims})
    rest = {k: (np.sqrt((ux[:, k:] ** 2).sum(1)), np.sqrt((uy[:, k:] ** 2).sum(1))) for k in steps}
    far = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    found_i, found_j = [], []
    for a in range(0, len(ux), BLOCK):
        for b in range(0, len(uy), BLOCK):
            p, q = ux[a : a + BLOCK], uy[b : b + BLOCK]
            if p[0, 0] - q[-1, 0] > far or q[0, 0] - p[-1, 0] > far:
                continue
            total, at, i, j = np.zeros((len(p), len(q))), 0, None, None
            for k in steps:
                total += p[:, at:k] @ q[:, at:k].T
                at = k
                open_ = total + np.outer(rest[k][0][a : a + BLOCK], rest[k][1][b : b + BLOCK]) >= threshold - SLACK
                n = int(open_.sum())
                if n == 0:
                    break
                if k == dims or n * 16 < open_.size:
                    i, j = np.nonzero(open_)
                    break
            if i is None:
                continue
            i, j = ox[a + i], oy[b + j]
            if same:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 1 << 16):
                u, v = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                cosine = np.einsum("ij,ij->i", x[u], y[v]) / (nx[u] * ny[v])
                found_i.append(u[cosine >= threshold])
                found_j.append(v[cosine >= threshold])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (none, none)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number in each one's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def _keyed(with_vector: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of id, vector, label into id, label, two halves of a hash of the vector, and its bytes if asked for.

    With its bytes, rows that can link only; else all, the others with a null label and numbers in place of hashes, so that they match nothing and lie anywhere.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, es = len(batch), batch.column(1).cast(pa.list_(pa.float64()))
            dims = pc.fill_null(pc.list_value_length(es), 0).to_numpy()
            labelled = pc.is_valid(batch.column(2)).to_numpy(zero_copy_only=False)
            fit, keys, held = np.zeros(n, bool), np.zeros((n, 2), np.int64), [None] * n
            keys[:, 0] = np.arange(n)
            for d in np.unique(dims[labelled & (dims > 0)]):
                at = np.flatnonzero(labelled & (dims == d))
                v = es.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d) + 0.0  # makes -0.0 zero, and null is NaN
                good = np.isfinite(v).all(1) & (v != 0).any(1)
                fit[at[good]] = True
                for i, row in zip(at[good].tolist(), v[good], strict=True):
                    held[i] = row.tobytes()
                    keys[i] = np.frombuffer(blake2b(held[i], digest_size=16).digest(), np.int64)
            label = pc.if_else(pa.array(fit), batch.column(2), pa.scalar(None, batch.column(2).type))
            cols = [batch.column(0), label, pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())]
            if with_vector:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(held, pa.binary())], names=["id", "label", "key", "key2", "e"]).filter(pa.array(fit))
            else:
                yield pa.RecordBatch.from_arrays(cols, names=["id", "label", "key", "key2"])

    return keyed


def _matrix(held: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, from their bytes."""
    return np.frombuffer(b"".join(held.to_pylist()), np.float64).reshape(len(held), -1)


def _tiled(rows: DataFrame, tile_rows: int) -> DataFrame:
    """`rows` with a tile: runs of bins of the first coordinate; within a crowded bin, runs of bins of the next; at last salted parts."""
    rows = rows.withColumn("tile", F.xxhash64("label", "dim"))
    done = None
    for k in range(LEADING):
        rows = rows.withColumn("bin", F.floor(F.col(f"c{k}") / BIN).cast("int"))
        bins = rows.groupBy("tile", "bin").agg(F.count("*").alias("many"))
        before = Window.partitionBy("tile").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        run = F.floor(F.coalesce(F.sum("many").over(before), F.lit(0)) / tile_rows)
        crowded = F.col("many") > tile_rows
        # a crowded bin is a tile of its own, else the bins that begin in the same stretch of `tile_rows` are one
        bins = bins.select(F.col("tile").alias("t"), F.col("bin").alias("b"), "many", crowded.alias("crowded"), F.xxhash64("tile", F.lit(k), F.when(crowded, F.col("bin")), run).alias("next"))
        rows = written(rows.join(bins, (F.col("tile") == F.col("t")) & (F.col("bin") == F.col("b"))).withColumn("tile", F.col("next")).drop("t", "b", "bin", "next"))
        own = rows.where("not crowded").drop("many", "crowded")
        done = own if done is None else done.unionByName(own)
        rows = rows.where("crowded").drop("crowded")
        if rows.isEmpty():
            return written(done)
        rows = rows.withColumnRenamed("many", "held") if k == LEADING - 1 else rows.drop("many")
    salts = F.ceil(F.col("held") / tile_rows).cast("long")
    return written(done.unionByName(rows.withColumn("tile", F.xxhash64("tile", F.pmod(F.xxhash64("node"), salts))).drop("held")))


def _near_tiles(tiled: DataFrame, threshold: float) -> DataFrame:
    """(pair, a, b): tiles of a label, each with itself too, whose boxes come within the distance of the threshold."""
    boxes = written(tiled.groupBy("label", "dim", "tile").agg(*[f(f"c{k}").alias(f"{n}{k}") for k in range(LEADING) for n, f in (("low", F.min), ("high", F.max))]))
    far = max(1e-3, (2 - 2 * threshold) ** 0.5) + SLACK

    def cells(df: DataFrame, wider: float) -> DataFrame:
        for k in (0, 1):
            first, last = (F.floor((F.col(f"{n}{k}") + d) / far).cast("int") for n, d in (("low", -wider), ("high", wider)))
            df = df.withColumn(f"cell{k}", F.explode(F.sequence(first, last)))
        return df

    x, y = cells(boxes, 0.0).alias("x"), cells(boxes, far).alias("y")
    gaps = [F.greatest(F.lit(0.0), F.col(f"x.low{k}") - F.col(f"y.high{k}"), F.col(f"y.low{k}") - F.col(f"x.high{k}")) for k in range(LEADING)]
    apart = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
    same = [F.col(f"x.{n}") == F.col(f"y.{n}") for n in ("cell0", "cell1", "label", "dim")]
    meet = same[0] & same[1] & same[2] & same[3] & (F.col("x.tile") <= F.col("y.tile")) & (apart <= 2 - 2 * threshold + SLACK)
    return x.join(y, meet).select(F.col("x.tile").alias("a"), F.col("y.tile").alias("b")).distinct().withColumn("pair", F.xxhash64("a", "b"))


def embedding_groups(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.98, tile_rows: int = 2048, sample_rows: int = 20_000
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    bounded_batches(vectors.sparkSession)
    numbers = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType.simpleString()
    e = F.col(f"`{embedding}`") if numbers in ("array<float>", "array<double>") else F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), e.alias("e"), F.col(f"`{label}`").cast("string").alias("label"))
    keys = f"id {rows.schema[0].dataType.simpleString()}, label string, key long, key2 long"
    fit = rows.mapInArrow(_keyed(True), f"{keys}, e binary")
    classes = fit.groupBy("label", "key", "key2").agg(F.first("e").alias("e"), F.min("id").alias("least"), F.count("*").alias("weight"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", (F.octet_length("e") / 8).cast("int")))

    sample = classes.select("dim", "e", F.xxhash64("key", F.lit(1)).alias("h")).orderBy("h").limit(sample_rows).select("dim", "e").toArrow()
    held, dims = sample.column("e").combine_chunks(), sample.column("dim").to_numpy()
    by_dim = {int(d): _matrix(held.take(pa.array(np.flatnonzero(dims == d)))) for d in np.unique(dims)}
    bases = spark.sparkContext.broadcast({d: axes(v) for d, v in by_dim.items()})

    def lead(batches):
        for batch in batches:
            dims, es = batch.column(2).to_numpy(), batch.column(3)
            out = np.zeros((LEADING, len(batch)))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                v = scaled(_matrix(es.take(pa.array(at))))
                v = v / np.linalg.norm(v, axis=1, keepdims=True)
                basis = bases.value.get(int(d))
                got = v[:, :LEADING] if basis is None else v @ basis[:, :LEADING]
                out[: got.shape[1], at] = got.T
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c) for c in out]], names=["node", "label", "dim", *[f"c{k}" for k in range(LEADING)]])

    coords = classes.select("node", "label", "dim", "e").mapInArrow(lead, "node long, label string, dim int, " + ", ".join(f"c{k} double" for k in range(LEADING)))
    tiled = _tiled(written(coords), tile_rows)
    pairs = _near_tiles(tiled, threshold)
    sides = pairs.select("pair", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("tile"), F.lit(2).alias("side")))).otherwise(F.array(F.struct(F.col("a").alias("tile"), F.lit(0).alias("side")), F.struct(F.col("b").alias("tile"), F.lit(1).alias("side"))))).alias("s")).select("pair", "s.tile", "s.side")
    meetings = sides.join(tiled.select("node", "tile"), "tile").join(classes.select("node", "weight", "e"), "node").select("pair", "side", "node", "weight", "e")

    def compare(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        node, weight = group.column("node").to_numpy(), group.column("weight").to_numpy()
        v = _matrix(group.column("e"))
        basis = bases.value.get(v.shape[1])
        basis = np.eye(v.shape[1]) if basis is None else basis
        if side[0] == 2:
            i, j = links_between(v, v, basis, threshold, True)
        else:
            p, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            i, j = links_between(v[p], v[q], basis, threshold, False)
            i, j = p[i], q[j]
        n = len(node)
        links = np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)
        root = forest(n, i, j)
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[some]), "links": pa.array(links[some].astype(np.int64)), "root": pa.array(node[root[some]])})

    met = written(meetings.groupBy("pair").applyInArrow(compare, "node long, links long, root long"))
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(met.select("node", "root"), "node", "root")
    named = classes.select("node", "label", "key", "key2", "least", "weight").join(comp, "node", "left").join(counts, "node", "left")
    named = written(named.withColumn("component", F.coalesce("component", "node")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select("label", "key", "key2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id")
    out = rows.mapInArrow(_keyed(False), keys).join(named.withColumn("known", F.lit(True)), ["label", "key", "key2"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
