"""Phrase collocations by an FM-index over the word ids of every shard.

A shard is a run of documents of about ``SHARD_WORDS`` words.  Its words become
symbols (a word of a language is one symbol; ends of pieces and words too rare
to be part of a candidate are 0) and are indexed twice: the Burrows-Wheeler
transform of the sequence and of its reverse.  A phrase is an interval in each;
both are kept in step (Lam et al., 2009), so a phrase can be extended by a word
on either side, and the size of the interval is the phrase's count in the
shard.  All phrases of one length are extended at once, to the right and to the
left in turn, up to the depth wanted.

Most phrases of a shard are rare in the corpus, so they are first summed by
hash: a shard sends, for each block of hashes, the 32-bit hashes in order and
their counts (some 3 bytes a phrase), a task adds up a block, and the hashes
that reach the least count are put in a bit table of bounded size that goes to
all shards.  This is done for words, then for pairs of words, then for longer
phrases all of whose pairs passed.  Every part of a frequent phrase is frequent
and phrases that share a hash are counted together, so nothing is lost; a false
hit costs work.  What passes is summed once more in the same blocks, with a
second hash beside (over 96 bits in all, so that no two phrases are taken for
one), and each frequent phrase is spelled out by one of the shards that hold it.

Scores, the removal of contained phrases and the ranks are DataFrame
operations over the counted phrases; products are decimals of 38 digits.

Defined cases: a null text has no words, a null lang counts as ``und``; repeated
rows count each; an empty table gives no rows; ties are ordered by the phrase.
A task holds one shard: about ``SHARD_WORDS`` words, or one Arrow batch of
documents where that is longer.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged
from .words import bit_table, bits_at, byte_kinds, words_of

LEAST, LONGEST, TOP = 100, 5, 2000
SHARD_WORDS = 1_000_000
HELD_CELLS = 4_000_000           # counts of a block of hashes that a task holds before it adds them up
MOST_BITS = 1 << 27              # bits of a table of frequent phrases: 16 MiB at most, whatever the corpus
CELLS = 1 << 24                  # bits of the table of frequent words: 2 MiB, whatever the corpus
SALTS = 32                       # parts of a language that are ranked apart before the last ranking
KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
COUNTED = "lang string, phrase string, n long"
INDEXED = "block int, cells binary, counts binary, shard long, ahead binary, behind binary, names binary, langs binary"


class Shard:
    """Words of a run of documents: symbols in order, and the language and word of each symbol."""

    def __init__(self, words: list[pa.Array], langs: list[np.ndarray], breaks: list[np.ndarray], names: list[str]):
        coded = pa.chunked_array(words, pa.large_binary()).combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, self.symbol = np.unique(code * len(names) + np.concatenate(langs), return_inverse=True)
        self.word = coded.dictionary.take(pa.array(kinds // len(names)))
        self.lang = kinds % len(names)
        self.names = names
        self.breaks = np.concatenate(breaks)

    def cells(self) -> np.ndarray:
        """The cell of every symbol in the table of frequent words."""
        seeds = [xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) for n in self.names]
        return np.array([xxhash.xxh64_intdigest(w, seeds[k]) % CELLS
                         for w, k in zip(self.word.to_pylist(), self.lang.tolist(), strict=True)], np.int64)

    def langs(self) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(self.lang))


def shards(batches: Iterator[pa.RecordBatch], size: int = SHARD_WORDS) -> Iterator[Shard]:
    """Shards of (lang, text) rows of one task."""
    words, langs, breaks, names, held = [], [], [], {}, 0
    for b in batches:
        w, row, new = words_of(b.column(1), KINDS, lower=True)
        if not len(w):
            continue
        codes = np.array([names.setdefault(x, len(names)) for x in b.column(0).to_pylist()], np.int64)
        words.append(w)
        langs.append(codes[row])
        breaks.append(new)
        held += len(w)
        if held >= size:
            yield Shard(words, langs, breaks, list(names))
            words, langs, breaks, names, held = [], [], [], {}, 0
    if held:
        yield Shard(words, langs, breaks, list(names))


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame, size: int = SHARD_WORDS) -> DataFrame:
    """lang, phrase (one word), n and the cell of the word, over all documents."""
    def run(batches):
        for s in shards(batches, size):
            n = np.bincount(s.symbol, minlength=len(s.word))
            yield pa.RecordBatch.from_arrays([s.langs(), s.word.cast(pa.large_string()).cast(pa.string()), pa.array(n, pa.int64()),
                                              pa.array(s.cells(), pa.int64())], names=["lang", "phrase", "n", "cell"])

    parts = texts(docs).mapInArrow(run, COUNTED + ", cell long")
    return staged(parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.first("cell").alias("cell")), "words")


def dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


class Index:
    """One direction of the index: the transform, and where each symbol's occurrences lie in it."""

    def __init__(self, transform: np.ndarray):
        self.transform, self.n = transform, len(transform)
        self.at = np.sort(transform.astype(np.int64) * self.n + np.arange(self.n))

    @classmethod
    def of(cls, text: np.ndarray) -> Index:
        """Of the cyclic sequence ``text``, sorted by the four symbols from each place on."""
        two = dense(text * (int(text.max(initial=0)) + 1) + np.roll(text, -1))
        four = two * (int(two.max(initial=0)) + 1) + np.roll(two, -2)
        return cls(np.roll(text, 1)[np.argsort(four, kind="stable")].astype(np.int32))

    def first(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Beginning of the interval of a phrase extended by ``symbol``, whose interval began at ``before``."""
        return np.searchsorted(self.at, symbol * self.n + before)


def extended(index: Index, begin: np.ndarray, other: np.ndarray, size: np.ndarray):
    """All one-word extensions of phrases: (phrase, symbol, begin, other begin, count).

    ``begin`` is the interval in ``index``, whose transform holds the words
    before (in its direction); within the other index the extensions of a phrase
    follow each other by symbol.
    """
    phrase = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size) + begin[phrase]
    span = int(index.transform.max(initial=0)) + 1
    key, count = np.unique(phrase * span + index.transform[place], return_counts=True)
    phrase, symbol = key // span, key % span
    total = np.cumsum(count) - count
    head = np.searchsorted(phrase, phrase)
    begin2, other2 = index.first(symbol, begin[phrase]), other[phrase] + total - total[head]
    real = symbol > 0
    return phrase[real], symbol[real], begin2[real], other2[real], count[real]


def pairs_of(ahead: Index, behind: Index):
    """(first, second, begin ahead, begin behind, count) of all pairs of symbols; same order at every call."""
    size = np.bincount(ahead.transform)
    begin = np.cumsum(size) - size
    some = np.flatnonzero(size)[1:] if size[0] else np.flatnonzero(size)
    phrase, symbol, at, other, count = extended(behind, begin[some], begin[some], size[some])
    return some[phrase], symbol, other, at, count


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def unpack(data: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def phrases(columns: list[np.ndarray], names: pa.Array) -> pa.Array:
    """Space-joined words of phrases, given by one array of symbols for each place."""
    parts = [names.take(pa.array(c - 1)) for c in columns]
    return reduce(lambda a, b: pc.binary_join_element_wise(a, b, pa.scalar(b" ", pa.large_binary())), parts).cast(
        pa.large_string()).cast(pa.string())


def phrase_hashes(columns: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases from those of their words, the same in every shard."""
    h = hashes[columns[0] - 1]
    with np.errstate(over="ignore"):
        for c in columns[1:]:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[c - 1])
    return h


def counted(h: np.ndarray, count: np.ndarray, blocks: int, second: np.ndarray | None = None) -> pa.RecordBatch:
    """Hashes and counts of phrases of one shard as a row for each block of hashes: 32 bits of a hash in order, and counts.

    ``second`` has other hashes of the phrases, which are then packed beside.
    """
    key = cells_of(h, blocks)
    order = np.argsort(key)
    key, count = key[order], count[order].astype(np.uint32)
    block = (key >> np.uint64(32)).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]][:len(block)])
    low = key.astype(np.uint32)
    ends = np.r_[heads[1:], len(block)]
    columns = {"block": pa.array(block[heads].astype(np.int32)),
               "cells": pa.array([pack(np.diff(low[i:j], prepend=np.uint32(0))) for i, j in zip(heads, ends)], pa.binary()),
               "counts": pa.array([pack(count[i:j]) for i, j in zip(heads, ends)], pa.binary())}
    if second is not None:
        columns["second"] = pa.array([pack(second[order[i:j]]) for i, j in zip(heads, ends)], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def frequent_places(rows: DataFrame, least: int) -> DataFrame:
    """place (a hash) of every cell whose count over all shards reaches ``least``.

    A block is streamed and summed by one task, which holds its distinct cells.
    Phrases that share a cell are counted together, so no frequent one is missed.
    """
    def run(batches):
        block, held, size = None, [], 0

        def summed():
            low, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return low, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        def done():
            low, n = summed()
            full = (np.uint64(block) << np.uint64(32)) | low[n >= least].astype(np.uint64)
            return pa.RecordBatch.from_arrays([pa.array((mix(full) >> np.uint64(1)).astype(np.int64))], names=["place"])

        for b in batches:
            for k, cells, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block is not None and k != block:
                    yield done()
                    held, size = [], 0
                block = k
                held.append((np.cumsum(unpack(cells, np.uint32), dtype=np.uint32), unpack(counts, np.uint32)))
                size += len(held[-1][0])
                if size > HELD_CELLS:
                    held = [summed()]
                    size = 0
        if block is not None:
            yield done()

    return staged(rows.select("block", "cells", "counts").repartition("block").sortWithinPartitions("block")
                  .mapInArrow(run, "place long"), "places")


class Places:
    """A bit table of frequent places, sized by their number up to a bound; false hits cost work only."""

    def __init__(self, places: DataFrame):
        n = places.count()
        self.size = min(MOST_BITS, 1 << max(15, (32 * n).bit_length()))
        self.bits = bit_table(places.select(F.pmod("place", F.lit(self.size)).alias("c")), "c", self.size)

    def hold(self, h: np.ndarray, blocks: int) -> np.ndarray:
        return bits_at(self.bits, ((mix(cells_of(h, blocks)) >> np.uint64(1)) % np.uint64(self.size)).astype(np.int64))


def indexed(docs: DataFrame, frequent: np.ndarray, blocks: int, size: int = SHARD_WORDS) -> DataFrame:
    """A row (block -1) with the index of each shard, and rows with the hashes and counts of its pairs of words."""
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in INDEXED.split(", ")])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for k, s in enumerate(shards(batches, size)):
            keep = bits_at(table.value, s.cells())
            number = np.where(keep, np.cumsum(keep), 0)
            plain = number[s.symbol]
            text = np.zeros(2 * len(plain) + 1, np.int64)         # a 0 before each piece, and at most one in a row
            step = np.cumsum(1 + s.breaks.astype(np.int64)) - 1
            text[step] = plain
            text = text[:step[-1] + 1]
            text = np.append(text[np.r_[True, (text[1:] > 0) | (text[:-1] > 0)]], 0)
            words, langs = s.word.filter(pa.array(keep)), s.langs().filter(pa.array(keep))
            ahead, behind = Index.of(text), Index.of(text[::-1])
            yield pa.RecordBatch.from_pydict(
                {"block": [-1], "cells": [None], "counts": [None], "shard": [part << 32 | k], "ahead": [pack(ahead.transform)], "behind": [pack(behind.transform)],
                 "names": [squeezed(b"\x20".join(words.to_pylist()))], "langs": [squeezed("\x00".join(langs.to_pylist()).encode())]},
                schema=schema)
            first, second, _, _, count = pairs_of(ahead, behind)
            if len(first):
                rows = counted(phrase_hashes([first, second], word_hashes(words, langs)), count, blocks)
                none = pa.nulls(rows.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(rows.num_rows, pa.int64()), none, none, none, none], schema=schema)

    return staged(texts(docs).mapInArrow(run, INDEXED), "index", "zstd")


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def word_hashes(words: pa.Array, langs: pa.Array, digest=xxhash.xxh64_intdigest) -> np.ndarray:
    seeds = {n: digest(n.encode("utf-8", "surrogatepass")) for n in langs.unique().to_pylist()}
    return np.array([digest(w, seeds[k]) for w, k in zip(words.to_pylist(), langs.to_pylist(), strict=True)], np.uint64)


def cells_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Block of a hash (upper half) and its 32 bits within the block."""
    return ((h >> np.uint64(32)) % np.uint64(blocks)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))


def walked(row: dict, blocks: int, pairs: Places, longer: Places | None, longest: int):
    """(words, langs, then for each length: symbols by place, hashes and counts) of the phrases of a shard that can be frequent."""
    ahead, behind = Index(unpack(row["ahead"])), Index(unpack(row["behind"]))
    names = pa.array(zstandard.ZstdDecompressor().decompress(row["names"]).split(b"\x20"), pa.large_binary())
    langs = pa.array(zstandard.ZstdDecompressor().decompress(row["langs"]).decode().split("\x00"), pa.string())
    hashes = word_hashes(names, langs)
    yield names, langs
    first, second, a, b, count = pairs_of(ahead, behind)
    columns, allowed, span = [first, second], None, len(names) + 1
    for length in range(2, longest + 1):
        if length > 2:
            if length % 2:                                        # to the right: the reversed text's words before
                phrase, symbol, b, a, count = extended(behind, b, a, count)
                pair = columns[-1][phrase] * span + symbol
            else:
                phrase, symbol, a, b, count = extended(ahead, a, b, count)
                pair = symbol * span + columns[0][phrase]
            columns = [c[phrase] for c in columns]
            columns = [*columns, symbol] if length % 2 else [symbol, *columns]
            ok = allowed[np.minimum(np.searchsorted(allowed, pair), len(allowed) - 1)] == pair
        h = phrase_hashes(columns, hashes)
        if length == 2:
            ok = pairs.hold(h, blocks)
        elif longer is not None:
            ok &= longer.hold(h, blocks)
        columns, h, a, b, count = [c[ok] for c in columns], h[ok], a[ok], b[ok], count[ok]
        if not len(h):
            return
        if length == 2:
            allowed = np.sort(columns[0] * span + columns[1])
        yield columns, h, count


def longer_cells(index: DataFrame, blocks: int, pairs: Places, longest: int) -> DataFrame:
    """Hashes and counts of the phrases of three words and more, all of whose pairs can be frequent."""
    shared = index.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            found = list(walked(row, blocks, shared.value, None, longest))[2:]
            if found:
                yield counted(np.concatenate([h for _, h, _ in found]), np.concatenate([n for _, _, n in found]), blocks)

    return index.mapInArrow(run, "block int, cells binary, counts binary")


def passed(row: dict, blocks: int, pairs: Places, longer: Places, longest: int):
    """(words, langs), then of each length: symbols, cells, second hashes and counts of the phrases that pass both tables."""
    (names, langs), *found = walked(row, blocks, pairs, longer, longest)
    second = word_hashes(names, langs, xxhash.xxh3_64_intdigest)
    return (names, langs), [(columns, h, phrase_hashes(columns, second), count) for columns, h, count in found]


def frequent_sums(index: DataFrame, blocks: int, pairs: Places, longer: Places, longest: int, least: int) -> DataFrame:
    """cell, second, n over all shards, and one shard that holds it, of every phrase with at least ``least`` occurrences.

    A phrase is told by both hashes, over 96 bits.
    """
    shared = index.sparkSession.sparkContext.broadcast((pairs, longer))

    def run(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            _, found = passed(row, blocks, *shared.value, longest)
            if found:
                rows = counted(*(np.concatenate([f[i] for f in found]) for i in (1, 3)), blocks, np.concatenate([f[2] for f in found]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(rows.num_rows, row["shard"]))], schema=schema)

    kinds = [("block", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary()), ("second", pa.binary()), ("shard", pa.int64())]
    schema = pa.schema(kinds)

    def added(held):
        low, other, n, shard = (np.concatenate(x) for x in zip(*held, strict=True))
        turn = mix(other ^ mix(shard.astype(np.uint64)))          # spreads the phrases over the shards that hold them
        order = np.lexsort((turn, other, low))
        low, other, n, shard = low[order], other[order], n[order], shard[order]
        head = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (other[1:] != other[:-1])])
        return low[head], other[head], np.add.reduceat(n, head), shard[head]

    def sums(batches):
        block, held, size = None, [], 0

        def done():
            low, other, n, shard = added(held)
            ok = n >= least
            cell = (np.uint64(block) << np.uint64(32)) | low[ok].astype(np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(other[ok].view(np.int64)), pa.array(n[ok]),
                                               pa.array(shard[ok])], names=["cell", "second", "n", "shard"])

        for b in batches:
            for k, cells, counts, second, shard in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block is not None and k != block:
                    yield done()
                    held, size = [], 0
                block = k
                low = np.cumsum(unpack(cells, np.uint32), dtype=np.uint32)
                held.append((low, unpack(second, np.uint64), unpack(counts, np.uint32).astype(np.int64), np.full(len(low), shard)))
                size += len(low)
                if size > HELD_CELLS:
                    held, size = [added(held)], 0
        if block is not None:
            yield done()

    return staged(index.mapInArrow(run, "block int, cells binary, counts binary, second binary, shard long")
                  .repartition("block").sortWithinPartitions("block").mapInArrow(sums, "cell long, second long, n long, shard long"), "sums")


def spelled(index: DataFrame, blocks: int, pairs: Places, longer: Places, longest: int, sums: DataFrame) -> DataFrame:
    """lang, phrase, n of all phrases in ``sums``, each spelled by the shard named there."""
    shared = index.sparkSession.sparkContext.broadcast((pairs, longer))
    wanted = sums.groupBy("shard").agg(F.collect_list(F.struct("cell", "second", "n")).alias("wanted"))   # phrases of one shard

    def run(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            (names, langs), found = passed(row, blocks, *shared.value, longest)
            want = {(w["cell"], w["second"]): w["n"] for w in row["wanted"]}
            for columns, h, second, _ in found:
                both = zip(cells_of(h, blocks).view(np.int64).tolist(), second.view(np.int64).tolist(), strict=True)
                n = [want.get(x) for x in both]
                at = np.flatnonzero([x is not None for x in n])
                if len(at):
                    part = [c[at] for c in columns]
                    yield pa.RecordBatch.from_arrays([langs.take(pa.array(part[0] - 1)), phrases(part, names),
                                                      pa.array([n[i] for i in at], pa.int64())], names=["lang", "phrase", "n"])

    return index.join(wanted, "shard").mapInArrow(run, COUNTED)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, size: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n of all phrases with at least ``least`` occurrences; lang, n of all words)."""
    words = word_counts(docs, size)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ones = words.filter(F.col("n") >= least)
    blocks = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = indexed(docs, bit_table(ones, "cell", CELLS), blocks, size)
    pairs = Places(frequent_places(index.filter("block >= 0"), least))
    whole = index.filter("block = -1").select("shard", "ahead", "behind", "names", "langs")
    longer = Places(frequent_places(longer_cells(whole, blocks, pairs, longest), least))
    sums = frequent_sums(whole, blocks, pairs, longer, longest, least)
    more = spelled(whole, blocks, pairs, longer, longest, sums)
    return staged(ones.select("lang", "phrase", "n").union(more), "phrases"), totals


def without_contained(candidates: DataFrame) -> DataFrame:
    """Candidates that do not lie in a longer one with as many occurrences.

    A longer phrase has no more occurrences than its part, and all between the
    two then have equally many, so the extensions by one word decide.
    """
    n = F.size("words")
    part = lambda start: F.array_join(F.slice("words", start, n - 1), " ")
    longer = candidates.filter(n > 2)
    parts = longer.select("lang", F.explode(F.array(part(1), part(2))).alias("phrase"), "a").distinct()
    return candidates.join(parts, ["lang", "phrase", "a"], "left_anti")


def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with l, r, n and score of their lowest cut."""
    cut = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
            .select("lang", "phrase", "a", "k", cut(F.lit(1), F.col("k")).alias("_left"),
                    cut(F.col("k") + 1, F.size("words")).alias("_right")))
    cuts = (cuts.join(counts.toDF("lang", "_left", "l"), ["lang", "_left"])
            .join(counts.toDF("lang", "_right", "r"), ["lang", "_right"]).join(totals, "lang"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = (cuts.withColumn("_up", (F.lit(1000).cast("decimal(4,0)") * wide("a")).cast("decimal(23,0)") * wide("n"))
            .withColumn("_down", wide("l") * wide("r")).withColumn("score", F.expr("_up div _down")))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top``; parts of a language are ranked first, so no task meets all of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    from pyspark.sql import Window
    apart = Window.partitionBy("lang", "_w_salt").orderBy(*order)
    together = Window.partitionBy("lang").orderBy(*order)
    some = (rows.withColumn("_w_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("_w_rank", F.row_number().over(apart))
            .filter(F.col("_w_rank") <= top).drop("_w_salt", "_w_rank"))
    return some.withColumn("rank", F.row_number().over(together)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, size: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    prepare(docs.sparkSession)
    counts, totals = frequent_phrases(docs, least, longest, size)
    candidates = (counts.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
                  .filter(F.size("words") > 1))
    return ranked(scored(without_contained(candidates), counts, totals), top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """The same in SQL: all phrases by windows over the words of a piece."""
    lead = ", ".join(f"lead(w, {k}) OVER p AS w{k}" for k in range(1, longest))
    grams = " UNION ALL ".join(
        f"SELECT lang, {d} AS d, concat_ws(' ', {', '.join(['w', *(f'w{k}' for k in range(1, d))])}) AS phrase, count(*) AS n FROM seq"
        f" WHERE {f'w{d - 1}' if d > 1 else 'w'} IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}" for d in range(1, longest + 1))
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, array_to_string(ws[1:{k}], ' ') AS lp, array_to_string(ws[{k + 1}:], ' ') AS rp"
        f" FROM alive WHERE len(ws) > {k}" for k in range(1, longest))
    return rf"""WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT id, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p, generate_subscripts(string_split_regex(t, '[.,;:!?\x0A-\x0D]'), 1) AS i FROM docs),
listed AS (SELECT id, lang, i, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
seq AS (SELECT lang, w, {lead} FROM (SELECT id, lang, i, unnest(ws) AS w, generate_subscripts(ws, 1) AS j FROM listed) q
        WINDOW p AS (PARTITION BY id, i ORDER BY j)),
grams AS ({grams}),
totals AS (SELECT lang, count(*) AS n FROM seq GROUP BY lang),
cands AS (SELECT lang, phrase, n AS a, d, string_split(phrase, ' ') AS ws FROM grams WHERE d > 1),
alive AS (SELECT * FROM cands c WHERE NOT EXISTS (
  SELECT 1 FROM cands b WHERE b.lang = c.lang AND b.d > c.d AND 100 * b.a >= 100 * c.a
  AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS ({cuts}),
scores AS (SELECT c.lang, c.phrase, c.a, c.k, g.n AS l, h.n AS r, t.n,
  (CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(g.n AS HUGEINT) * h.n) AS score
  FROM cuts c JOIN grams g ON g.lang = c.lang AND g.phrase = c.lp JOIN grams h ON h.lang = c.lang AND h.phrase = c.rp
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scores),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= {top}"""


ORACLE = oracle()
