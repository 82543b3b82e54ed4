"""Helpers shared by the operators of this subpackage.

Conventions that every operator here keeps:

* a null ``text`` counts as the empty text, unless its docstring says otherwise;
* rows are never dropped, capped or sampled: one input row gives one output row
  (or its pieces), repeated rows included;
* working columns start with ``_w_`` so that they cannot clash with a caller's
  extra columns;
* intermediate tables go under the shared folder in ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_core_conf, shared_path

# rows of one Arrow batch that a Python task holds at a time
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Session settings of this subpackage: small Arrow batches keep Python tasks small."""
    apply_core_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once into the shared folder and return the table read back.

    A lost executor can then neither force a recomputation nor make two
    readers see different rows.
    """
    path = shared_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column as one uint8 array, and the n+1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def texts_of(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def runs_by_size(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to at most ``limit`` (a larger one alone)."""
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if i > start and total + s > limit:
            yield start, i
            start, total = i, 0
        total += s
    if start < len(sizes):
        yield start, len(sizes)


def stratified_sample(rows: DataFrame, stratum: str, key: str, per_stratum: int, limit: int) -> DataFrame:
    """About ``per_stratum`` rows of each stratum, chosen by a hash of ``key``; at most ``limit`` rows.

    For fitting only.  The number of strata is the number of classes of a
    model; their counts are what is collected.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(stratum).count().orderBy(F.desc("count")).limit(1000).collect()
              if r[0] is not None}
    if not counts:
        return rows.limit(0)
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(stratum) == F.lit(value), F.lit(int(min(1.0, per_stratum / n) * 1_000_000))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1_000_000)) < share).limit(limit)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                    per_class: int) -> DataFrame:
    """(text, label) of a bounded sample of training rows; held-out ids never enter.

    The picked ids are at most ``3 * per_class`` rows, so they are broadcast
    and the texts are found in one scan without a shuffle of the corpus.
    """
    lab = (labels.filter(F.col(label).isin(0, 1)).filter(fold(modulus) != held_out)
           .select(F.col("doc_id").alias("_w_id"), F.col(label).cast("int").alias("label")))
    picked = stratified_sample(lab, "label", "_w_id", per_class, 3 * per_class)
    return (docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_w_id"))
            .select("text", "label").limit(6 * per_class))


def pack(weights: dict[str, np.ndarray]) -> bytes:
    buf = io.BytesIO()
    np.savez(buf, **weights)
    return buf.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def fit_in_task(sample: DataFrame, train: Callable[[pa.Table], dict[str, np.ndarray] | None]) -> dict[str, np.ndarray] | None:
    """Run ``train`` over the whole (bounded) sample in one task; only the weights come back.

    None where there is nothing to learn from.  A lost executor only makes
    Spark run the task again.
    """
    names = sample.columns

    def run(batches):
        got = [b for b in batches if b.num_rows]
        weights = train(pa.Table.from_batches(got)) if got else None
        yield pa.RecordBatch.from_pydict({"blob": [None if weights is None else pack(weights)]},
                                         schema=pa.schema([("blob", pa.binary())]))

    out = sample.select(*names).repartition(1).mapInArrow(run, "blob binary").collect()
    blobs = [r[0] for r in out if r[0] is not None]
    return unpack(bytes(blobs[0])) if blobs else None


class Adam:
    """Plain Adam steps on a dict of float32 arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.999 ** self.t)
            self.p[k] -= (self.rate * scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
