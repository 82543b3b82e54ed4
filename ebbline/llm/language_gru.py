"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

The UTF-8 bytes of the whole text are cut into windows; in each one a GRU runs
forwards and another backwards, every byte position gets a probability for
each learned language, and a document's probabilities are the mean over all of
its positions.  Training is by backpropagation through time.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
repeated rows are labelled one by one; rows with a null lang are not learned
from; without any training rows every document is ``und`` with score 0.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Adam, fit_in_task, fold, raw_bytes, stratified_sample, texts_of

WINDOW, HIDDEN = 48, 8
PER_LANGUAGE, MAX_ROWS = 400, 20_000   # bound of the fitting sample
WINDOWS_A_ROW = 12                     # windows of a sampled row that training uses
EPOCHS, WINDOWS_A_STEP, RATE = 4, 128, 0.02
BLOCK = 2048                           # windows in memory at a time
PAD = 256
LETTER = regex.compile(r"\p{L}")


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first byte and byte behind the last one of every window."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    start = offsets[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    return doc, start, np.minimum(start + WINDOW, offsets[doc + 1])


def codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bytes by position and window (time first), padded at the end."""
    at = np.arange(WINDOW)[:, None] + start
    return np.where(at < end, data[np.minimum(at, len(data) - 1)].astype(np.int16), PAD)    # PAD is no byte


def init(rng: np.random.Generator, n: int) -> dict[str, np.ndarray]:
    f = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
    p = {"b": np.zeros(n, np.float32)}
    for d in "fb":
        p |= {f"{d}x": f(257, 3 * HIDDEN, by=0.3), f"{d}u": f(HIDDEN, 3 * HIDDEN, by=0.3),
              f"{d}o": f(HIDDEN, n, by=0.3)}
    return p


def run_gru(p: dict, d: str, code: np.ndarray, keep: bool):
    """Hidden states by position; with ``keep`` also what the way back needs."""
    steps = range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1)
    h = np.zeros((code.shape[1], HIDDEN), np.float32)
    states, saved = np.empty((WINDOW, *h.shape), np.float32), [None] * WINDOW
    for t in steps:
        x, u = p[f"{d}x"][code[t]], h @ p[f"{d}u"]
        gates = 0.5 + 0.5 * np.tanh(0.5 * (x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN]))
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        if keep:
            saved[t] = (h, z, r, n, u[:, 2 * HIDDEN:])
        h = n + z * (h - n)
        states[t] = h
    return states, saved


def label_positions(p: dict, code: np.ndarray) -> np.ndarray:
    """Language probabilities of every position."""
    z = run_gru(p, "f", code, False)[0] @ p["fo"] + run_gru(p, "b", code, False)[0] @ p["bo"] + p["b"]
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def back_gru(p: dict, d: str, code: np.ndarray, saved, gh: np.ndarray, grads: dict) -> None:
    """Backpropagation through time; ``gh`` is the gradient at every hidden state."""
    steps = range(WINDOW - 1, -1, -1) if d == "f" else range(WINDOW)
    carry = np.zeros_like(gh[0])
    u = p[f"{d}u"]
    for t in steps:
        h, z, r, n, un = saved[t]
        g = gh[t] + carry
        gz = g * (h - n) * z * (1 - z)
        gn = g * (1 - z) * (1 - n * n)
        gr = gn * un * r * (1 - r)
        gx = np.concatenate([gz, gr, gn], 1)
        gu = np.concatenate([gz, gr, gn * r], 1)
        np.add.at(grads[f"{d}x"], code[t], gx)
        grads[f"{d}u"] += h.T @ gu
        carry = g * z + gu @ u.T


def loss_grads(p: dict, code: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy over all positions that hold a byte."""
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    fs, fsaved = run_gru(p, "f", code, True)
    bs, bsaved = run_gru(p, "b", code, True)
    z = fs @ p["fo"] + bs @ p["bo"] + p["b"]
    z = np.exp(z - z.max(-1, keepdims=True))
    g = z / z.sum(-1, keepdims=True)
    g[:, np.arange(code.shape[1]), label] -= 1
    real = (code != PAD)[:, :, None]
    g = (g * real / max(1, real.sum())).astype(np.float32)
    grads["b"] += g.sum((0, 1))
    for d, states, saved in (("f", fs, fsaved), ("b", bs, bsaved)):
        grads[f"{d}o"] += np.einsum("tnh,tnl->hl", states, g)
        back_gru(p, d, code, saved, g @ p[f"{d}o"].T, grads)
    return grads


def train(rows: pa.Table) -> dict[str, np.ndarray] | None:
    """Adam over windows drawn from the rows; the order of the rows does not matter."""
    pairs = sorted((t, v) for t, v in zip(texts_of(rows["text"].combine_chunks()), rows["lang"].to_pylist(), strict=True)
                   if LETTER.search(t))
    if not pairs:
        return None
    names = sorted({v for _, v in pairs})
    data, offsets = raw_bytes(pa.array([t for t, _ in pairs]))
    doc, start, end = windows(offsets)
    rng = np.random.default_rng(5)
    order = np.lexsort((rng.random(len(doc)), doc))
    nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
    pick = order[nth < WINDOWS_A_ROW]
    label = np.array([names.index(v) for _, v in pairs])[doc]
    p = init(rng, len(names))
    adam = Adam(p, RATE)
    total, done = EPOCHS * -(-len(pick) // WINDOWS_A_STEP), 0
    for _ in range(EPOCHS):
        perm = rng.permutation(pick)
        for k in range(0, len(perm), WINDOWS_A_STEP):
            w = perm[k:k + WINDOWS_A_STEP]
            grads = loss_grads(p, codes(data, start[w], end[w]), label[w])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            adam.step({n: g / max(1.0, norm) for n, g in grads.items()}, 1 - 0.9 * done / total)
            done += 1
    return p | {"names": np.array(names)}


def score(p: dict | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and its probability for every text of a column, in blocks of windows."""
    texts = texts_of(column)
    lang, best = ["und"] * len(texts), np.zeros(len(texts))
    data, offsets = raw_bytes(column)
    if p is None or not len(data):
        return lang, best
    doc, start, end = windows(offsets)
    total = np.zeros((len(texts), len(p["names"])))
    for i in range(0, len(doc), BLOCK):
        code = codes(data, start[i:i + BLOCK], end[i:i + BLOCK])
        part = (label_positions(p, code) * (code != PAD)[:, :, None]).sum(0)
        d = doc[i:i + BLOCK]
        cut = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        total[d[cut]] += np.add.reduceat(part, cut)
    share = total / np.maximum(1, np.diff(offsets))[:, None]
    top = share.argmax(1)
    for i, text in enumerate(texts):
        if LETTER.search(text):
            lang[i], best[i] = str(p["names"][top[i]]), min(1.0, float(share[i, top[i]]))
    return lang, best


def fit(docs: DataFrame, modulus: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> dict | None:
    """Train on a bounded sample (about ``per_language`` rows of each language) outside the held-out fold."""
    rows = docs.filter(F.col("lang").isNotNull() & (fold(modulus) != held_out)).select("doc_id", "text", "lang")
    sample = stratified_sample(rows, "lang", "doc_id", per_language, MAX_ROWS).select("text", "lang")
    return fit_in_task(sample, train)


def languages(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of ``docs`` and lang_pred, lang_score; such columns are replaced."""
    docs = docs.drop("lang_pred", "lang_score")
    schema = T.StructType([f for f in docs.schema.fields] + [T.StructField("lang_pred", T.StringType()),
                                                             T.StructField("lang_score", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            lang, best = score(model, b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(best, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "lang_score"])

    return docs.mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    found = languages(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"))
