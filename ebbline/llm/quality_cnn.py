"""Quality classifier: a byte-level convolutional network trained in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters run over the byte embeddings of each chunk, each filter's
largest response is kept per chunk, and the chunk vectors are combined (mean
and maximum over the document) into one probability.

Defined cases: null and empty texts are one chunk of padding and get the score
that the network gives to it; repeated rows and ids are scored one by one;
without any training rows, or with one class only, every score is 0.5.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Adam, fit_in_task, fold, labelled_sample, raw_bytes, sigmoid

CHUNK, HOP = 256, 192          # bytes of a chunk; the next one starts so many bytes later
WIDTH, STEP = 8, 2             # bytes of a filter, and between its positions
EMBED, FILTERS = 8, 16
PAD = 256
PER_CLASS = 1500               # bound of the fitting sample: about so many rows of each label
EPOCHS, DOCS_A_STEP, RATE = 10, 16, 0.01
BLOCK = 512                    # chunks in memory at a time
THRESHOLD = 0.3


def chunk_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every chunk its document and its first and last byte; each document has one at least."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-(size - CHUNK) // HOP) + 1)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[doc] + nth * HOP
    return doc, start, np.minimum(start + CHUNK, offsets[doc + 1])


def symbols(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte codes of chunks, padded at the end."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    if not len(data):
        return np.full(at.shape, PAD)
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16), PAD)    # PAD is no byte


def respond(p: dict, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest response of each filter in each chunk, its position, and all windows."""
    e = p["embed"][code].reshape(len(code), CHUNK * EMBED)
    n = (CHUNK - WIDTH) // STEP + 1
    win = np.lib.stride_tricks.as_strided(e, (len(code), n, WIDTH * EMBED),
                                          (e.strides[0], STEP * EMBED * e.itemsize, e.itemsize))
    z = np.ascontiguousarray(win).reshape(-1, WIDTH * EMBED) @ p["filters"]
    z = z.reshape(len(code), n, FILTERS)
    at = z.argmax(axis=1)
    return np.take_along_axis(z, at[:, None], 1)[:, 0] + p["bias"], at, win


def init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    f = lambda *s, by=0.1: (rng.standard_normal(s) * by).astype(np.float32)
    return {"embed": f(257, EMBED, by=0.5), "filters": f(WIDTH * EMBED, FILTERS, by=0.15),
            "bias": np.zeros(FILTERS, np.float32), "mean_w": f(FILTERS), "max_w": f(FILTERS),
            "out_b": np.zeros(1, np.float32)}


def train(rows: pa.Table) -> dict[str, np.ndarray] | None:
    """Adam over whole documents; the order of the rows does not matter."""
    label = np.array(rows["label"].to_pylist(), np.float32)
    if len(set(label.tolist())) < 2:
        return None
    rng = np.random.default_rng(7)
    order = sorted(range(len(label)), key=lambda i: (rows["text"][i].as_py() or "", float(label[i])))
    rows, label = rows.take(order), label[order]
    data, offsets = raw_bytes(rows["text"])
    doc, start, end = chunk_starts(offsets)
    first = np.searchsorted(doc, np.arange(len(label) + 1))
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    p = init(rng)
    adam = Adam(p, RATE)
    steps = EPOCHS * -(-len(label) // DOCS_A_STEP)
    done = 0
    for _ in range(EPOCHS):
        perm = rng.permutation(len(label))
        for k in range(0, len(perm), DOCS_A_STEP):
            batch = perm[k:k + DOCS_A_STEP]
            grads = {name: np.zeros_like(v) for name, v in p.items()}
            for d in batch:
                accumulate(p, grads, data, start[first[d]:first[d + 1]], end[first[d]:first[d + 1]],
                           label[d], weight[d] / len(batch))
            adam.step(grads, scale=1 - 0.9 * done / steps)
            done += 1
    return p


def accumulate(p, grads, data, start, end, label, weight) -> None:
    """Add one document's gradient; its chunks are taken in blocks."""
    blocks = [(symbols(data, start[i:i + BLOCK], end[i:i + BLOCK])) for i in range(0, len(start), BLOCK)]
    found = [respond(p, code)[:2] for code in blocks]
    m = np.concatenate([np.maximum(z, 0) for z, _ in found])
    mean, top = m.mean(0), m.max(0)
    g = float(sigmoid(mean @ p["mean_w"] + top @ p["max_w"] + p["out_b"])[0] - label) * weight
    grads["mean_w"] += g * mean
    grads["max_w"] += g * top
    grads["out_b"] += g
    best = m.argmax(0)
    gm = np.repeat((g * p["mean_w"] / len(m))[None], len(m), 0)
    gm[best, np.arange(FILTERS)] += g * p["max_w"]
    gm = (gm * (m > 0)).astype(np.float32)
    grads["bias"] += gm.sum(0)
    row = 0
    for code, (_, at) in zip(blocks, found, strict=True):
        part = gm[row:row + len(code)]
        row += len(code)
        span = at[:, :, None] * STEP + np.arange(WIDTH)                       # chunk, filter, width
        used = np.take_along_axis(code[:, None, :], span, 2)
        e = p["embed"][used].reshape(len(code), FILTERS, WIDTH * EMBED)
        grads["filters"] += np.einsum("cf,cfw->wf", part, e)
        back = part[:, :, None] * p["filters"].T[None]
        np.add.at(grads["embed"], used.reshape(-1), back.reshape(-1, EMBED))


def score(p: dict | None, column: pa.Array) -> np.ndarray:
    """Probability of label 1 for every text of a column, in blocks of chunks."""
    data, offsets = raw_bytes(column)
    n = len(offsets) - 1
    if p is None or n == 0:
        return np.full(n, 0.5)
    doc, start, end = chunk_starts(offsets)
    total, top = np.zeros((n, FILTERS)), np.zeros((n, FILTERS))
    for i in range(0, len(doc), BLOCK):
        z, _, _ = respond(p, symbols(data, start[i:i + BLOCK], end[i:i + BLOCK]))
        z = np.maximum(z, 0)
        d = doc[i:i + BLOCK]
        cut = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        total[d[cut]] += np.add.reduceat(z, cut)
        top[d[cut]] = np.maximum(top[d[cut]], np.maximum.reduceat(z, cut))
    count = np.bincount(doc, minlength=n)[:, None]
    return sigmoid((total / count) @ p["mean_w"] + top @ p["max_w"] + p["out_b"])


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0,
        per_class: int = PER_CLASS) -> dict[str, np.ndarray] | None:
    """Train on a bounded sample (about ``per_class`` rows of each label) outside the held-out fold."""
    return fit_in_task(labelled_sample(docs, labels, "quality", modulus, held_out, per_class), train)


def quality_scores(docs: DataFrame, model: dict[str, np.ndarray] | None, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and quality_score (0 to 1), quality_predicted (0 or 1).

    Columns of these two names in ``docs`` are replaced.
    """
    docs = docs.drop("quality_score", "quality_predicted")
    schema = T.StructType([f for f in docs.schema.fields] + [T.StructField("quality_score", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            s = pa.array(score(model, b.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, "quality_score"])

    return docs.mapInArrow(run, schema).withColumn(
        "quality_predicted", (F.col("quality_score") >= threshold).cast("int"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = quality_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
                         F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))
