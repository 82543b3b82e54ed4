"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy on every labelled row.

Every word of the whole text is looked up by two hashes, one of the word and
one of its beginning (so that inflected forms share what is learned), filters of one, two and three words run over the embeddings, each filter's largest
response in the document is kept, and a logistic unit combines them.  The
decision threshold is calibrated by language: a language is read off the text
by its function words (never from a column), each one's threshold is set on
training rows that took no part in the fitting, and the score is shifted so
that every language's threshold lies at ``THRESHOLD``.  Rows are fitted in shards,
every shard by a task, whose weights are averaged after each epoch.

Defined cases: null and empty texts, and texts without a word, are one padding
word; repeated rows are scored one by one; without training rows, or with one
class only, every score is 0.5.
"""
from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Adam, fold, sigmoid, staged, texts_of

BUCKETS, EMBED = 1 << 16, 8        # of each of the two hashes
WIDTHS, FILTERS = (1, 2, 3), 8     # words of a filter; filters of each width
SHARD_ROWS, SHARD_BYTES = 8192, 1 << 26   # training rows (and bytes of their bucket numbers) that one task passes
BROADCAST_MARKS = 1_000_000        # marked ids sent to every task at most
EPOCHS, DOCS_A_STEP, RATE, EMBED_RATE = 8, 16, 0.01, 0.2
STEM = 4                           # characters of a word's beginning
CALIBRATION_SHARE, LEAST_TO_CALIBRATE = 5, 20   # every fifth training row calibrates; rows of a class it takes
BLOCK_WORDS = 20_000               # words in memory at a time
LOGIT_STEPS = 1024                 # counted steps of a unit of the logit
THRESHOLD = 0.7
SLICE = 1024                       # buckets of a part of merged weights
TABLES, DENSE = ("first", "second"), ("bias", "out", "out_b", *(f"w{w}" for w in WIDTHS))
MERGED = pa.schema([("part", pa.int32()), ("at", pa.binary()), ("val", pa.binary())])
PARTS = pa.schema([("shard", pa.int32()), *MERGED])
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")

# fixed values: frequent function words by which a text's language is told for the calibration
FUNCTION_WORDS = {
    "en": "the of and to in is that it with for was on are this be",
    "de": "der die und das den von zu mit sich des auf ist im nicht ein",
    "fr": "le la les de des et un une est que qui dans pour sur au",
    "es": "el la los de y que en un una es por con para del se",
}
_LANGUAGE_BITS: dict[str, int] = {}
for _i, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in _words.split():
        _LANGUAGE_BITS[_w] = _LANGUAGE_BITS.get(_w, 0) | 1 << 32 + _i
LANGUAGES = [*FUNCTION_WORDS, "other"]


class Codes(dict):
    """A word's code: its two bucket numbers (16 bits each), above them a bit of each language whose function word it is."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        first = 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
        second = 1 + zlib.crc32(word[:STEM].encode("utf-8", "surrogatepass"), 0x5BD1E995) % (BUCKETS - 1)
        code = self[word] = first | second << 16 | _LANGUAGE_BITS.get(word, 0)
        return code


_code_of = Codes()


def codes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_code_of.__getitem__, words), np.int64, len(words))


def sides(code: np.ndarray) -> np.ndarray:
    """Bucket numbers of each word and of its beginning; 0 is kept for padding."""
    return np.stack([code & 0xFFFF, code >> 16 & 0xFFFF], 1)


def buckets(words: list[str]) -> np.ndarray:
    return sides(codes(words))


def word_blocks(text: str) -> Iterator[tuple[list[str], bool]]:
    """All words of a text, in blocks that overlap by the widest filter less one, and if it is the last block."""
    if len(text) < 100_000:
        yield WORD.findall(text.lower()), True
        return
    found = (m[0].lower() for m in WORD.finditer(text))
    block = list(islice(found, BLOCK_WORDS))
    while more := list(islice(found, BLOCK_WORDS)):
        yield block, False
        block = block[-(max(WIDTHS) - 1):] + more
    yield block, True


def padded_sides(code: np.ndarray, more: int = 0) -> np.ndarray:
    """Buckets of one block with padding behind it (and one padding word at least)."""
    return sides(np.concatenate([code, np.zeros(max(WIDTHS) + more, np.int64)]))


def encode(words: list[str]) -> np.ndarray:
    return padded_sides(codes(words))


def respond(p: dict, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filter responses at every position, and the embeddings."""
    e = np.concatenate([p["first"][ids[:, 0]], p["second"][ids[:, 1]]], 1)
    padded = np.concatenate([e, np.zeros((max(WIDTHS) - 1, 2 * EMBED), np.float32)])
    z = [sum(padded[k:k + len(e)] @ p[f"w{w}"][k] for k in range(w)) for w in WIDTHS]
    return np.concatenate(z, 1) + p["bias"], padded


def language(code: np.ndarray) -> np.ndarray:
    """Function words of each language among the words of these codes."""
    marked = code[code >= 1 << 32] >> 32
    return np.array([np.count_nonzero(marked & 1 << i) for i in range(len(LANGUAGES) - 1)], np.int64)


def name_of(hits: np.ndarray) -> int:
    return int(hits.argmax()) if hits.max() > 0 else len(LANGUAGES) - 1


def init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    f = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
    n = FILTERS * len(WIDTHS)
    p = {"first": f(BUCKETS, EMBED, by=0.05), "second": f(BUCKETS, EMBED, by=0.05), "bias": np.zeros(n, np.float32),
         "out": np.abs(f(n, by=0.3)), "out_b": np.full(1, -0.5, np.float32)}
    p["first"][0] = p["second"][0] = 0
    return p | {f"w{w}": f(w, 2 * EMBED, FILTERS, by=0.5) for w in WIDTHS}


def logits(p: dict, texts: list[str]) -> tuple[np.ndarray, list[int]]:
    """Raw logit of every text, and its language."""
    top = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf)
    hits = np.zeros((len(texts), len(LANGUAGES) - 1), np.int64)
    held: list[tuple[int, np.ndarray, int]] = []
    apart = max(WIDTHS) - 1     # words of padding; no window reaches into the next text

    def flush() -> None:
        if held:
            z, _ = respond(p, np.concatenate([ids for _, ids, _ in held]))
            sizes = np.array([len(ids) for _, ids, _ in held])
            starts = np.cumsum(sizes) - sizes
            z[np.arange(len(z)) - np.repeat(starts, sizes) >= np.repeat([used for _, _, used in held], sizes)] = -np.inf
            np.maximum.at(top, [i for i, _, _ in held], np.maximum.reduceat(z, starts))
            held.clear()

    total = 0
    for i, text in enumerate(texts):
        for words, last in word_blocks(text):
            whole = len(words) if last else len(words) - apart      # the other words begin the next block
            code = codes(words)
            hits[i] += language(code[:whole])
            held.append((i, ids := padded_sides(code, apart), whole + max(WIDTHS) * last))
            total += len(ids)
            if total >= BLOCK_WORDS:
                flush()
                total = 0
    flush()
    return np.maximum(top, 0) @ p["out"] + p["out_b"], [name_of(h) for h in hits]


def local_epoch(state: dict, docs: list[np.ndarray], label: np.ndarray, weight: np.ndarray, shard: int, epoch: int) -> None:
    """One pass over a shard's rows, in an order of its own; ``state`` (see :func:`start`) is changed in place."""
    p = state["p"]
    dense = {k: p[k] for k in DENSE}
    adam = Adam(dense, RATE)
    adam.m, adam.v, adam.t, square = state["m"], state["v"], state["t"], state["square"]
    perm = np.random.default_rng([11, shard, epoch]).permutation(len(docs))
    steps = -(-len(docs) // DOCS_A_STEP)
    for done, k in enumerate(range(0, len(perm), DOCS_A_STEP), epoch * steps):
        batch = perm[k:k + DOCS_A_STEP]
        grads = {name: np.zeros_like(v) for name, v in dense.items()}
        touched: list[tuple[np.ndarray, np.ndarray]] = []
        for d in batch:
            accumulate(p, grads, touched, docs[d], label[d], weight[d] / len(batch))
        rate = 1 - 0.9 * done / (EPOCHS * steps)
        for name in dense:
            grads[name] += 1e-4 * dense[name]
        adam.step(grads, rate)
        where, by = np.concatenate([a for a, _ in touched]), np.concatenate([g for _, g in touched])
        for side, name in enumerate(TABLES):
            at, inverse = np.unique(where[:, side], return_inverse=True)
            g = np.zeros((len(at), EMBED), np.float32)
            np.add.at(g, inverse, by[:, side * EMBED:(side + 1) * EMBED])
            g[at == 0] = 0
            square[name][at] += (g * g).mean(1)
            p[name][at] -= EMBED_RATE * rate * 0.5 * g / np.sqrt(square[name][at])[:, None]
    state["t"] = adam.t


def start() -> dict:
    """Weights ``p``, and what their steps remember: moments ``m`` and ``v`` of ``t`` steps, sums of squares of the tables."""
    p = init(np.random.default_rng(11))
    zeros = lambda: {k: np.zeros_like(p[k]) for k in DENSE}
    return {"p": p, "m": zeros(), "v": zeros(), "t": 0, "square": {k: np.full(BUCKETS, 1e-4, np.float32) for k in TABLES}}


def parts_of(state: dict, before: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, rows, values): the rows of the tables that a shard moved, by slices of the buckets, and all dense weights."""
    for side, name in enumerate(TABLES):
        moved = np.flatnonzero(state["square"][name] != before["square"][name])
        for part in np.unique(moved // SLICE):
            at = moved[moved // SLICE == part]
            yield (side * (BUCKETS // SLICE) + int(part), at.astype(np.int32),
                   np.concatenate([state["p"][name][at], state["square"][name][at, None]], 1))
    dense = np.concatenate([state[k][name].ravel() for k in ("p", "m", "v") for name in DENSE] + [[state["t"]]])
    yield -1, np.zeros(1, np.int32), dense.astype(np.float32)[None]


def put(state: dict, part: int, at: np.ndarray, values: np.ndarray) -> None:
    """Take over the means of one part."""
    if part >= 0:
        name = TABLES[part // (BUCKETS // SLICE)]
        state["p"][name][at], state["square"][name][at] = values[:, :-1], values[:, -1]
        return
    flat = values[0]
    for k in ("p", "m", "v"):
        for name in DENSE:
            size = state[k][name].size
            state[k][name][...], flat = flat[:size].reshape(state[k][name].shape), flat[size:]
    state["t"] = int(round(float(flat[0])))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of every row over the shards that moved it; rows come by part, then by shard."""
    def means(part: int, total: dict[int, tuple[np.ndarray, int]]) -> pa.RecordBatch:
        at = np.array(sorted(total), np.int32)
        values = np.array([total[i][0] / total[i][1] for i in at.tolist()], np.float32)
        return pa.RecordBatch.from_pydict({"part": [part], "at": [at.tobytes()], "val": [values.tobytes()]}, schema=MERGED)

    last, total = None, {}
    for b in batches:
        for part, at, val in zip(*(b.column(c).to_pylist() for c in ("part", "at", "val")), strict=True):
            if part != last and total:
                yield means(last, total)
                total = {}
            last = part
            at = np.frombuffer(at, np.int32)
            for i, v in zip(at.tolist(), np.frombuffer(val, np.float32).reshape(len(at), -1).astype(np.float64), strict=True):
                was, n = total.get(i, (0.0, 0))
                total[i] = was + v, n + 1
    if total:
        yield means(last, total)


def ids_of(blob: bytes) -> np.ndarray:
    """Buckets of a stored text, with padding behind them as in :func:`encode`."""
    return np.concatenate([np.frombuffer(blob, np.uint16).reshape(-1, 2).astype(np.int64), np.zeros((max(WIDTHS), 2), np.int64)])


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows as bucket numbers (16 bits each) and the language their function words tell."""
    for b in batches:
        ids, lang = [], []
        for text in texts_of(b.column(b.schema.names.index("text"))):
            code = codes(WORD.findall(text.lower()))
            ids.append(sides(code).astype(np.uint16).tobytes())
            lang.append(name_of(language(code)))
        keep = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(n)) for n in keep), pa.array(lang, pa.int32()),
                                          pa.array(ids, pa.binary())], names=[*keep, "lang", "ids"])


def training_rows(docs: DataFrame, labels: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """(key, pick, own, label, lang, ids) of every labelled row outside the held-out fold; rows with ``own`` are fitted on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lab = (labels.filter(F.col("toxic").isin(0, 1)).filter(fold(modulus) != held_out)
           .select("doc_id", F.col("toxic").cast("int").alias("label")))
    # the texts stay where they are while the marks are few enough to be sent to them; else both are dealt out by id
    lab = F.broadcast(lab) if lab.limit(BROADCAST_MARKS + 1).count() <= BROADCAST_MARKS else lab
    rows = docs.filter(fold(modulus) != held_out).select("doc_id", text.alias("text")).join(lab, "doc_id").select(
        F.xxhash64("text").alias("key"), F.xxhash64("doc_id", F.lit(23)).alias("pick"),
        (F.crc32(F.col("text").cast("binary")) % CALIBRATION_SHARE > 0).alias("own"), "label", "text")
    return staged(rows.mapInArrow(encoded, "key long, pick long, own boolean, label int, lang int, ids binary"), "toxicity")


def shard_pass(before: dict, epoch: int, positive: float) -> Callable[[pa.Table], pa.Table]:
    """A shard's rows to the parts of its weights after one epoch from the state ``before``; classes weigh alike."""
    def run(table: pa.Table) -> pa.Table:
        now, shard = copy.deepcopy(before), table["shard"][0].as_py()
        order = np.lexsort((table["label"].to_numpy(), table["key"].to_numpy()))
        blobs, label = table["ids"].to_pylist(), table["label"].to_numpy()[order].astype(np.float32)
        local_epoch(now, [ids_of(blobs[i]) for i in order], label,
                    np.where(label == 1, 0.5 / positive, 0.5 / (1 - positive)), shard, epoch)
        out = [(shard, part, at.tobytes(), values.tobytes()) for part, at, values in parts_of(now, before)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PARTS)], schema=PARTS)

    return run


def train(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> dict[str, np.ndarray] | None:
    """Fit on four fifths of the rows, all of them, in shards; calibrate on the rest.

    Every shard of a bounded number of rows (and words) is passed once by a
    task of its own in every epoch, from the same weights.  Then each weight
    becomes its mean over the shards that moved it.  Merged weights (a fixed
    number) reach the driver, never rows.
    """
    counts = {(r["own"], r["label"]): (r["n"], r["size"]) for r in rows.groupBy("own", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("ids")).alias("size")).collect()}
    if len({y for _, y in counts}) < 2:
        return None
    split = all((True, y) in counts for y in (0, 1))        # else every row is fitted on
    used = [(y, *c) for (own, y), c in counts.items() if own or not split]
    n = sum(c for _, c, _ in used)
    positive = sum(c for y, c, _ in used if y == 1) / n
    shards = max(1, -(-n // shard_rows), -(-sum(size for _, _, size in used) // SHARD_BYTES))
    fitted = (rows.filter("own") if split else rows).select(
        F.pmod("pick", F.lit(shards)).cast("int").alias("shard"), "key", "label", "ids")
    fitted = fitted.repartition(shards, "shard").sortWithinPartitions("shard", "key", "label").persist(StorageLevel.DISK_ONLY)
    state = start()
    try:
        for epoch in range(EPOCHS):
            moved = fitted.groupBy("shard").applyInArrow(shard_pass(state, epoch, positive), "shard int, part int, at binary, val binary")
            merged = moved.repartition("part").sortWithinPartitions("part", "shard").mapInArrow(merge, "part int, at binary, val binary")
            state = copy.deepcopy(state)
            for r in merged.collect():      # at most every row of the two tables once
                at = np.frombuffer(bytes(r["at"]), np.int32)
                put(state, r["part"], at, np.frombuffer(bytes(r["val"]), np.float32).reshape(len(at), -1))
    finally:
        fitted.unpersist()
    return state["p"] | {"shift": calibrate(state["p"], rows.filter(~F.col("own")))}


def accumulate(p, grads, touched, ids, label, weight) -> None:
    z, e = respond(p, ids)
    at = z.argmax(0)
    m = np.maximum(z[at, np.arange(z.shape[1])], 0)
    g = float(sigmoid(m @ p["out"] + p["out_b"])[0] - label) * weight
    grads["out"] += g * m
    grads["out_b"] += g
    gm = (g * p["out"] * (m > 0)).astype(np.float32)
    grads["bias"] += gm
    n = len(ids)
    padded = np.concatenate([ids, np.zeros((max(WIDTHS) - 1, 2), np.int64)])
    for j, w in enumerate(WIDTHS):
        cols = slice(j * FILTERS, (j + 1) * FILTERS)
        for k in range(w):
            pos = at[cols] + k
            grads[f"w{w}"][k] += (e[pos] * gm[cols, None]).T
            inside = pos < n
            touched.append((padded[pos[inside]], (p[f"w{w}"][k] * gm[cols]).T[inside]))


def calibrate(p: dict, rows: DataFrame) -> np.ndarray:
    """For each language the logit that parts its calibration rows best (the common one where they are few).

    Rows are counted by logit, in steps of 1 / ``LOGIT_STEPS`` from -40 to 40:
    a table of bounded size, whatever the rows.
    """
    def run(batches):
        for b in batches:
            z = [np.maximum(respond(p, ids_of(ids))[0].max(0), 0) @ p["out"] + p["out_b"][0] for ids in b.column(2).to_pylist()]
            steps = np.rint(np.clip(np.array(z, np.float64), -40, 40) * LOGIT_STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(steps)], names=["lang", "label", "z"])

    got = (rows.select("lang", "label", "ids").mapInArrow(run, "lang int, label int, z long").groupBy("lang", "z")
           .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).collect())
    shift = np.zeros(len(LANGUAGES))
    if not got:
        return shift
    lang, z, pos, neg = np.array([tuple(r) for r in got], np.int64).T

    def best(use: np.ndarray, otherwise: float) -> float:
        if min(pos[use].sum(), neg[use].sum()) < LEAST_TO_CALIBRATE:
            return otherwise
        at, inverse = np.unique(z[use], return_inverse=True)
        below = [np.cumsum(np.bincount(inverse, n[use]))[:-1] / n[use].sum() for n in (pos, neg)]
        cuts = (at[1:] + at[:-1]) / 2 / LOGIT_STEPS
        # a false alarm weighs twice a miss, as toxic rows are rarer in a corpus than in balanced weights
        gain = 1 - below[0] + 2 * below[1]
        if not len(cuts):
            return float(at[0]) / LOGIT_STEPS
        top = cuts[gain >= gain.max() - 1e-9]
        return float(top[len(top) // 2])

    common = best(np.ones(len(z), bool), 0.0)
    shift[:] = [best(lang == i, common) for i in range(len(LANGUAGES))]
    return shift


def score(p: dict | None, column: pa.Array) -> np.ndarray:
    texts = texts_of(column)
    if p is None or not texts:
        return np.full(len(texts), 0.5)
    z, lang = logits(p, texts)
    return sigmoid(z - p["shift"][lang] + np.log(THRESHOLD / (1 - THRESHOLD)))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1,
        shard_rows: int = SHARD_ROWS) -> dict[str, np.ndarray] | None:
    """Train on every labelled row outside the held-out fold (None: nothing to learn from)."""
    return train(training_rows(docs, labels, modulus, held_out), shard_rows)


def toxicity_scores(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """All columns of ``docs`` and toxicity_score (0 to 1), toxicity_predicted (0 or 1); such columns are replaced."""
    docs = docs.drop("toxicity_score", "toxicity_predicted")
    schema = T.StructType([f for f in docs.schema.fields] + [T.StructField("toxicity_score", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            s = pa.array(score(model, b.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, "toxicity_score"])

    return docs.mapInArrow(run, schema).withColumn(
        "toxicity_predicted", (F.col("toxicity_score") >= THRESHOLD).cast("int"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = toxicity_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
                         F.col("toxicity_score").alias("score"), F.col("toxicity_predicted").alias("predicted"))
