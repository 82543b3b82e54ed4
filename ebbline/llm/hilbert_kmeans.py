"""Exact centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors become whole numbers (``floor(scale * x)``) and are put in the order of
a Hilbert curve (Skilling, 2004) over the leading bits of all components, by a
range exchange.  Consecutive vectors form blocks; each block keeps the smallest
and largest value of every component, its box.  A round of the clustering
bounds the distance between a centroid and everything in a block by the box
alone: a centroid whose least distance to the box exceeds the smallest of the
greatest distances can be nearest to nothing in it.  The vectors of a block are
compared exactly, in whole numbers, with the centroids that remain, so the
bounds change the work and never the result.

A task returns sums and counts of its blocks by cluster; these are added up by
Spark, and only one row per cluster and component reaches the driver.  The blocks
are written once and read in every round.

Defined cases: vectors of another length, or with a null or non-finite
component, are left out; equal vectors and repeated rows count each; ties go to
the smaller centroid; with fewer vectors than centroids every vector starts
one; components of 2**27 and more (after scaling) are compared by whole numbers
of any length, and a distance above the largest long is given as that; an empty
table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged

COMPONENTS, SCALE, CENTROIDS, ROUNDS = 64, 256, 40, 5
SEED = "2"
CURVE_BITS = 3                   # of a component, in the place on the curve; any number gives the same clusters
BLOCK = 128                      # vectors of a block
SAFE = 1 << 27                   # whole numbers below it have distances that fit a long
MOST = (1 << 63) - 1
BLOCKS = "vec_ids array<long>, vectors binary, low array<long>, high array<long>, far array<array<string>>"


def kept_vectors(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
            .filter((F.size("embedding") == components) & F.coalesce(finite, F.lit(False))))


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of every row of ``cells`` (n x d numbers below 2**bits), as bytes in that order."""
    x = cells.T.astype(np.uint64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:                                         # undo the rotations, from the highest bit down
        p = np.uint64(q - 1)
        for i in range(d):
            high = (x[i] & np.uint64(q)) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):                                # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= t
    planes = [(x >> np.uint64(b)) & np.uint64(1) for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def whole(embedding: pa.Array, components: int, scale: int) -> tuple[np.ndarray, list[list[int]] | None]:
    """floor(scale * x) as int64; where a component is too large for that, also exact lists."""
    x = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, components)
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    small = np.abs(y) < SAFE
    if small.all():
        return y.astype(np.int64), None
    # a double is a fraction of whole numbers, so floor division has no rounding and no overflow
    exact = [[a * scale // b for a, b in (v.as_integer_ratio() for v in row)] for row in x.tolist()]
    return np.where(small, y, 0).astype(np.int64), exact


def ordered(vectors: DataFrame, low: float, high: float, components: int, scale: int, bits: int) -> DataFrame:
    """vec_id, embedding and place, range-sorted by the place on the curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (high - low) or 1.0
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            cells = np.clip((x - low) / width * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hilbert_keys(cells, bits), pa.binary())],
                                             names=["vec_id", "embedding", "place"])

    keyed = vectors.mapInArrow(run, "vec_id long, embedding array<double>, place binary")
    # equal vectors share a place, so the id spreads a vector that very many rows repeat
    return keyed.repartitionByRange("place", F.xxhash64("vec_id")).sortWithinPartitions("place")


def in_blocks(rows: DataFrame, components: int, scale: int, size: int) -> DataFrame:
    """One row for each block of ``size`` consecutive vectors of a task, with its box."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, exact = whole(b.column(1), components, scale)
            ids, out = b.column(0).to_pylist(), []
            for i in range(0, len(ids), size):
                part = values[i:i + size]
                far = None if exact is None else [[str(v) for v in row] for row in exact[i:i + size]]
                out.append((ids[i:i + size], part.tobytes(), part.min(0).tolist(), part.max(0).tolist(), far))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["vec_ids", "vectors", "low", "high", "far"])

    return rows.select("vec_id", "embedding").mapInArrow(run, BLOCKS)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector inside the box."""
    under, over = low - centroids, centroids - high
    least = np.square(np.maximum(np.maximum(under, over), 0)).sum(1)
    most = np.square(np.maximum(np.abs(under), np.abs(over))).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(part: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of the rows of one block; ties go to the smaller number."""
    which = candidates(low, high, centroids)
    distance = np.empty((len(part), len(which)), np.int64)
    for j, c in enumerate(which):
        distance[:, j] = np.square(part - centroids[c]).sum(1)
    best = distance.argmin(1)
    return which[best], distance[np.arange(len(part)), best]


def assigned(batch: pa.RecordBatch, centroids: list[list[int]], components: int):
    """(vec_ids, rows of whole numbers, clusters, distances) of every block of a batch."""
    tame = all(abs(v) < SAFE for c in centroids for v in c)
    array = np.array(centroids, np.int64).reshape(len(centroids), components) if tame else None
    for ids, data, low, high, far in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
        if far is None and tame:
            part = np.frombuffer(data, np.int64).reshape(-1, components)
            cluster, distance = nearest(part, np.array(low), np.array(high), array)
        else:                                            # whole numbers of any length
            part = (np.array([[int(v) for v in row] for row in far], object) if far is not None
                    else np.frombuffer(data, np.int64).reshape(-1, components).astype(object))
            table = np.stack([np.square(part - np.array(c, object)).sum(1) for c in centroids], 1)
            cluster = np.array([min(range(len(row)), key=row.__getitem__) for row in table.tolist()], np.int64)
            distance = table[np.arange(len(part)), cluster]
        yield ids, part, cluster, distance


def summed(blocks: DataFrame, centroids: list[list[int]], components: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of every non-empty cluster; one row per cluster and component is collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * len(centroids)
        total = [np.zeros(components, object) for _ in centroids]
        for b in batches:
            for _, part, cluster, _ in assigned(b, centroids, components):
                for c in np.unique(cluster):
                    mine = part[cluster == c]
                    count[c] += len(mine)
                    total[c] = total[c] + mine.sum(0)    # of one block at most, so int64 holds it
        rows = [(c, i, count[c], str(int(v))) for c in range(len(centroids)) if count[c] for i, v in enumerate(total[c])]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                         names=["cluster", "i", "n", "total"])

    parts = blocks.mapInArrow(run, "cluster int, i int, n long, total string")
    rows = (parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * components))[1][r["i"]] = int(r["total"])
    return out


def first_centroids(vectors: DataFrame, n: int, components: int, scale: int, seed: str) -> list[list[int]]:
    """The kept vectors with the smallest hash of their id, in that order (equal ids: by their components)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("h"), "embedding").orderBy("h", "embedding").limit(n).toArrow()
    values, exact = whole(rows.column("embedding").combine_chunks(), components, scale)
    return exact if exact is not None else values.tolist()


def clustered(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, n: int = CENTROIDS, rounds: int = ROUNDS,
              seed: str = SEED, bits: int = CURVE_BITS, block: int = BLOCK) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every kept vector; the final centroids)."""
    prepare(vectors.sparkSession)
    kept = kept_vectors(vectors, components)
    centroids = first_centroids(kept, n, components, scale, seed)
    # the 1st and 99th percentile bound the cells well enough; what lies outside goes to the outer cells
    span = kept.select(F.explode("embedding").alias("x")).agg(F.percentile_approx("x", [0.01, 0.99], 100)).first()[0] or [0, 0]
    blocks = staged(in_blocks(ordered(kept, span[0], span[1], components, scale, bits), components, scale, block), "blocks")
    for _ in range(rounds):
        for c, (count, total) in summed(blocks, centroids, components).items():
            centroids[c] = [v // count for v in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, _, cluster, distance in assigned(b, centroids, components):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)),
                     pa.array([min(int(d), MOST) for d in distance], pa.int64())], names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, "vec_id long, cluster int, distance long"), centroids


def query(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    rows, centroids = clustered(vectors)
    rows = staged(rows, "clustered")
    spark = rows.sparkSession
    digests = spark.createDataFrame(
        [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)],
        "cluster int, centroid_sha256 string")
    by = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))        # CENTROIDS rows at most
    total = by.agg(F.sum("cluster_inertia").alias("inertia"))
    return (rows.join(F.broadcast(by.join(F.broadcast(digests), "cluster")), "cluster")
            .withColumn("inertia", total.scalar())
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def oracle(components: int = COMPONENTS, scale: int = SCALE, n: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same in SQL, one pair of steps for each round (compares every vector with every centroid)."""
    steps = [f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {components}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {components}),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, v FROM kept),
vals AS (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM numbered),
c0 AS (SELECT k, x, i FROM (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS k FROM numbered) f
       JOIN vals USING (rid) WHERE k < {n})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS (
  SELECT rid, k, d FROM (
    SELECT rid, k, d, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS o FROM (
      SELECT rid, k, CAST(sum((vals.x - c.x) * (vals.x - c.x)) AS BIGINT) AS d
      FROM vals JOIN c{t} c ON vals.i = c.i GROUP BY rid, k) p) q WHERE o = 1)""")
        if t < rounds:
            steps.append(f"""c{t + 1} AS (
  SELECT c.k, coalesce(m.x, c.x) AS x, c.i FROM c{t} c LEFT JOIN (
    SELECT k, i, (s - ((s % n) + n) % n) // n AS x FROM (
      SELECT k, i, CAST(sum(x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{t} JOIN vals USING (rid) GROUP BY k, i) g) m
  ON m.k = c.k AND m.i = c.i)""")
    last = rounds
    return "WITH " + ",\n".join(steps) + f"""
SELECT r.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       h.centroid_sha256
FROM a{last} a JOIN numbered r USING (rid)
JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY k) h ON h.k = a.k"""


ORACLE = oracle()
