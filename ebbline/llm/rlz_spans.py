"""Repeated passages by relative Lempel-Ziv factors against indexed reference blocks.

A word is removed where a window of ``WINDOW`` consecutive words covers it that
also starts in a document with a smaller id.

Every window has one anchor: the word sequence of length ``GRAM`` in it with the
least hash (winnowing, Schleimer et al., 2003), so equal windows have equal
anchors, and windows with one anchor are neighbours (a run).  Of an anchor that
occurs in several texts the one with the least id is the reference.  A document
is parsed against each reference block that an anchor leads it to, and against
no other, since those share no window with it.  The block indexes its words by
anchor; the parse goes through the document's runs in order, takes the longest
factors through the anchor (compared word by word in both directions), and skips
the runs that lie inside a factor already.  Factors of at least ``WINDOW`` words
are repeated spans.

What no factor covers lies at the ends of factors: windows that share the anchor
with the reference but not all words.  They may occur in another document that
parts from the reference in the same way, so they are checked by themselves: all
such windows of the corpus meet by a 128-bit hash of their words, combined
before the exchange.  A window of the reference itself needs no check, since no
smaller id has its anchor.

Equal texts are one node, with the least of their ids.  A block that very many
documents lead to is copied to several tasks, each with a part of them.  Texts
are read again only for nodes that share an anchor or lose words: a bit table of
fixed size lets the others pass by.

Defined cases: a null text has no words; a text below ``WINDOW`` words keeps all;
rows with the same id never remove from each other; a null id counts as larger
than every other; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged
from .words import bit_table, bits_at, byte_kinds, digest_of_text, words_of

WINDOW, GRAM = 50, 16                # GRAM is a power of two
CELLS = 1 << 23                      # bits of the tables of texts to read again: 1 MiB, whatever the corpus
SHARE = 2048                         # anchors of documents that lead to one copy of a reference block, on average
LAST_ID = (1 << 63) - 1              # order of a null id
KINDS = byte_kinds(b" \t\n\x0b\x0c\r")
_hashes: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def later(x: np.ndarray, step: int) -> np.ndarray:
    return np.concatenate([x[step:], np.zeros(min(step, len(x)), x.dtype)])


def word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    if len(_hashes) > 500_000:
        _hashes.clear()
    known = np.empty(len(coded.dictionary), np.uint64)
    for i, w in enumerate(coded.dictionary.to_pylist()):
        h = _hashes.get(w)
        if h is None:
            h = _hashes[w] = xxhash.xxh3_64_intdigest(w)
        known[i] = h
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def runs_of(words: pa.Array, row: np.ndarray, n: int):
    """Of every run: row, place of the anchor, first and last window start (within the row's words) and anchor hash."""
    count = np.bincount(row, minlength=n)
    begin = np.cumsum(count) - count
    gram, length = word_hashes(words), 1
    with np.errstate(over="ignore"):
        while length < GRAM:
            gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + later(gram, length))
            length *= 2
    least, place, span, want = gram, np.arange(len(gram)), 1, WINDOW - GRAM + 1
    while span < want:                               # least of ever more neighbours, the leftmost of equal ones
        step = min(span, want - span)
        other = later(least, step)
        least, place = np.where(other < least, other, least), np.where(other < least, later(place, step), place)
        span += step
    at = np.arange(len(gram))
    whole = at + WINDOW <= (begin + count)[row]
    at = at[whole]
    place = place[whole]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][:len(place)])
    last = np.r_[first[1:], len(place)][:len(first)] - 1
    owner, place = row[at[first]], place[first]
    base = begin[owner]
    return owner, place - base, at[first] - base, at[last] - base, gram[place].view(np.int64)


def looked_at(docs: DataFrame) -> DataFrame:
    """id, digest, n_words, digest of all words, and distinct anchors of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("whole", pa.string()),
                        ("grams", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, row, _ = words_of(b.column(2), KINDS)
            n = b.num_rows
            count = np.bincount(row, minlength=n)
            ends = np.cumsum(count)
            every = words.to_pylist()
            whole = [hashlib.sha256(b" ".join(every[e - c:e])).hexdigest() for c, e in zip(count.tolist(), ends.tolist(), strict=True)]
            owner, _, _, _, gram = runs_of(words, row, n)
            cuts = np.searchsorted(owner, np.arange(1, n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(count.astype(np.int64)), pa.array(whole, pa.string()),
                 pa.array([np.unique(g) for g in np.split(gram, cuts)], pa.list_(pa.int64()))], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of_text().alias("digest"), "text")
            .mapInArrow(run, "doc_id long, digest binary, n_words long, whole string, grams array<long>"))


def cell(column: str = "digest"):
    return F.pmod(F.xxhash64(column), F.lit(CELLS))


def texts_for(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (digest, id, ...) with the text; of the corpus only what the bit table lets through is exchanged."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select(cell().alias("c")).distinct(), "c", CELLS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = b.filter(pa.array(bits_at(table.value, b.column(2).to_numpy(zero_copy_only=False))))
            if some.num_rows:
                yield some.select([0, 1, 3])

    rows = docs.select(order_id().alias("id"), digest_of_text().alias("digest"), "text")
    near = rows.select("id", "digest", cell().alias("c"), "text").mapInArrow(run, "id long, digest binary, text string")
    return near.join(wanted, ["digest", "id"])


def order_id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges that cover the given ones (sorted by begin)."""
    out: list[tuple[int, int]] = []
    for a, b in zip(first.tolist(), end.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SEGMENT = ("ref long, salt int, target boolean, nid long, id long, start int, words string, places array<int>, "
           "firsts array<int>, lasts array<int>, grams array<long>")


def segments(texts: DataFrame) -> DataFrame:
    """The parts of a text around its shared anchors: for the reference block of each, or as the block itself.

    ``texts`` has nid, id, text and wanted: (gram, ref, salts) of its shared anchors.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in SEGMENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, row, _ = words_of(b.column(2), KINDS)
            owner, place, first, last, gram = runs_of(words, row, b.num_rows)
            begin = np.searchsorted(row, np.arange(b.num_rows))
            out = []
            for i, (nid, own_id, wanted) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(),
                                                          strict=True)):
                lo, hi = np.searchsorted(owner, [i, i + 1])
                leads: dict[int, list[tuple[int, int]]] = {}
                for w in wanted:
                    leads.setdefault(w["gram"], []).append((w["ref"], w["salts"]))
                by: dict[tuple[int, int], list[int]] = {}
                for k in range(lo, hi):
                    for lead in leads.get(int(gram[k]), ()):
                        by.setdefault(lead, []).append(k)
                for (ref, salts), ks in by.items():
                    k = np.array(ks)
                    for s, e in merged(first[k], last[k] + WINDOW):
                        mine = k[(first[k] >= s) & (first[k] < e)]
                        text = b" ".join(words.slice(int(begin[i]) + s, e - s).to_pylist()).decode("utf-8")
                        target = ref != nid
                        for salt in [xxhash.xxh3_64_intdigest(nid.to_bytes(8, "little")) % salts] if target else range(salts):
                            out.append((ref, salt, target, nid, own_id, s, text, (place[mine] - s).tolist(),
                                        (first[mine] - s).tolist(), (last[mine] - s).tolist(), gram[mine].tolist()))
            for i in range(0, len(out), 256):
                cols = list(zip(*out[i:i + 256], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return texts.select("nid", "id", "text", "wanted").mapInArrow(run, SEGMENT)


def agreement(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning, looked at in ever longer pieces."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at:min(at + step, n)] != b[at:min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


class Block:
    """The indexed words of one reference."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.index: dict[int, list[tuple[np.ndarray, int]]] = {}
        self.seen: set[tuple[int, bytes]] = set()
        self.id: int | None = None

    def add(self, own_id: int, words: list[str], places, firsts, lasts, grams) -> None:
        self.id, number = own_id, self.number
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
        for p, f, e, g in zip(places, firsts, lasts, grams, strict=True):
            around = (p - f, ids[f:e + WINDOW].tobytes())     # a run that repeats within the reference is indexed once
            if around not in self.seen:
                self.seen.add(around)
                self.index.setdefault(g, []).append((ids, p))

    def parse(self, own_id: int, words: list[str], places, firsts, lasts, grams) -> tuple[np.ndarray, np.ndarray]:
        """Which window starts lie in a factor of ``WINDOW`` words or more, and which others an anchor leads to.

        Another text with the reference's id has no factors, only windows to check.
        """
        number = self.number
        ids = np.array([number.get(w, -1) for w in words], np.int32)
        inside, reached = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        for p, f, e, g in zip(places, firsts, lasts, grams, strict=True):
            reached[f:e + 1] = True
            if own_id == self.id or inside[f:e + 1].all():
                continue
            for ref, q in self.index.get(g, ()):
                left = agreement(ids[:p][::-1], ref[:q][::-1])
                right = agreement(ids[p:], ref[q:])
                if left + right >= WINDOW and right >= GRAM:
                    inside[p - left:p + right - WINDOW + 1] = True
        return inside, reached & ~inside


FOUND = "nid long, id long, first int, last int, window binary"


def parsed(rows: DataFrame) -> DataFrame:
    """Ranges of window starts inside factors (window is null), and single ones left to check, with their hash."""
    schema = pa.schema([("nid", pa.int64()), ("id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key = Block(), None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if (r["ref"], r["salt"]) != key:
                    block, key = Block(), (r["ref"], r["salt"])
                words = r["words"].split(" ")
                runs = (r["places"], r["firsts"], r["lasts"], r["grams"])
                if not r["target"]:
                    block.add(r["id"], words, *runs)
                    continue
                inside, left = block.parse(r["id"], words, *runs)
                edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
                out += [(r["nid"], r["id"], r["start"] + s, r["start"] + e - 1, None)
                        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                out += [(r["nid"], r["id"], r["start"] + s, r["start"] + s,
                         xxhash.xxh3_128_digest(" ".join(words[s:s + WINDOW]).encode("utf-8")))
                        for s in np.flatnonzero(left).tolist()]
            for i in range(0, len(out), 8192):
                cols = list(zip(*out[i:i + 8192], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return (rows.repartition("ref", "salt").sortWithinPartitions("ref", "salt", "target").mapInArrow(run, FOUND))


def repeated_windows(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """nid, first, last: ranges of starts of windows that also start in a document with a smaller id.

    ``nodes`` has nid, digest, id and grams of every distinct text.
    """
    anchors = nodes.select("nid", "id", F.explode("grams").alias("gram"))
    shared = (anchors.groupBy("gram").agg(F.min_by("nid", "id").alias("ref"), F.min("nid").alias("_lo"),
                                          F.max("nid").alias("_hi"), F.count(F.lit(1)).alias("n"))
              .filter("_lo < _hi").select("gram", "ref", "n"))
    shared = staged(shared, "shared")
    salts = shared.groupBy("ref").agg(F.ceil(F.sum("n") / SHARE).cast("int").alias("salts"))
    shared = staged(shared.join(salts, "ref"), "led")
    lead = F.struct("gram", "ref", "salts").alias("lead")
    targets = anchors.join(shared, "gram").filter(F.col("nid") != F.col("ref")).select("nid", lead)
    own = shared.select(F.col("ref").alias("nid"), lead)
    wanted = targets.union(own).groupBy("nid").agg(F.collect_list("lead").alias("wanted"))    # anchors of one text
    wanted = staged(wanted.join(nodes.select("nid", "digest", "id"), "nid"), "wanted")
    found = staged(parsed(segments(texts_for(docs, wanted))), "found")
    rest = found.filter(F.col("window").isNotNull())
    common = (rest.groupBy("window").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).filter("_lo < _hi")
              .select("window", "_lo"))
    checked = rest.join(common, "window").filter(F.col("id") > F.col("_lo")).select("nid", "first", "last")
    return found.filter(F.col("window").isNull()).select("nid", "first", "last").union(checked)


def kept_words(texts: DataFrame) -> DataFrame:
    """digest, spans of removed words (start, end), n_removed and kept_sha256 of texts with ``ranges`` of window starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, row, _ = words_of(b.column(1), KINDS)
            begin = np.searchsorted(row, np.arange(b.num_rows + 1))
            spans, removed, shas = [], [], []
            for i, ranges in enumerate(b.column(2).to_pylist()):
                r = np.array(sorted((x["first"], x["last"]) for x in ranges), np.int64)
                gone = merged(r[:, 0], r[:, 1] + WINDOW)
                mine, at, kept = words.slice(int(begin[i]), int(begin[i + 1] - begin[i])).to_pylist(), 0, []
                for s, e in gone:
                    kept += mine[at:s]
                    at = e
                kept += mine[at:]
                spans.append([{"start": s, "end": e} for s, e in gone])
                removed.append(len(mine) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(removed, pa.int64()), pa.array(shas, pa.string())], names=["digest", "spans", "n_removed", "kept_sha256"])

    return texts.select("digest", "text", "ranges").mapInArrow(
        run, "digest binary, spans array<struct<start: long, end: long>>, n_removed long, kept_sha256 string")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans of removed words (start, end), n_removed and kept_sha256 of every document."""
    prepare(docs.sparkSession)
    rows = staged(looked_at(docs), "looked")
    nodes = staged(rows.withColumn("id", order_id()).groupBy("digest").agg(
        F.min("id").alias("id"), F.max("id").alias("_most"), F.first("grams").alias("grams"))
        .withColumn("nid", F.monotonically_increasing_id()), "nodes")
    ranges = (repeated_windows(nodes.filter(F.size("grams") > 0), docs).groupBy("nid")
              .agg(F.collect_list(F.struct("first", "last")).alias("ranges")))                # ranges of one text
    hit = staged(nodes.select("nid", "digest", "id").join(ranges, "nid"), "hit")
    lost = staged(kept_words(texts_for(docs, hit)), "lost")
    lost = lost.dropDuplicates(["digest"])               # rows that repeat id and text give the same result twice
    copied = nodes.filter(F.col("_most") > F.col("id")).select("digest", F.col("id").alias("_least"))
    out = rows.join(lost, "digest", "left").join(copied, "digest", "left")
    copy = F.coalesce((order_id() > F.col("_least")) & (F.col("n_words") >= WINDOW), F.lit(False))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return out.select("doc_id", "n_words", F.when(copy, everything).otherwise(F.coalesce("spans", none)).alias("spans"),
                      F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole"))
                      .alias("kept_sha256"))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    return repeated_spans(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def oracle(window: int = WINDOW) -> str:
    """The same in SQL: every window by its text."""
    return rf"""WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {LAST_ID}) AS o,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT rid, o, unnest(generate_series(1, len(ws) - {window - 1})) AS s FROM docs),
wins AS MATERIALIZED (SELECT rid, s.o, s, md5(array_to_string(ws[s:s + {window - 1}], ' ')) AS h FROM starts s JOIN docs USING (rid)),
least AS (SELECT h, min(o) AS lo FROM wins GROUP BY h),
hits AS (SELECT rid, s FROM wins JOIN least USING (h) WHERE o > lo),
gone AS (SELECT DISTINCT rid, unnest(generate_series(s, s + {window - 1})) AS i FROM hits),
listed AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
kept AS (SELECT l.rid, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t FROM listed l ANTI JOIN gone g ON g.rid = l.rid AND g.i = l.i
         GROUP BY l.rid)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (rid)"""


ORACLE = oracle()
