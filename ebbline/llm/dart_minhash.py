"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is the weighted set of its five-word shingles (lower-cased words
between white space; a text of fewer words is one shingle), each weighted by
how often it occurs.  DartMinHash (Christiani, 2020) throws hashed darts into
the region (weight below the element's weight, rank below theta) of every
element: unit cells of that plane hold a Poisson number of darts, fixed by a
hash of the element and the cell.  A dart belongs to one coordinate of the
signature, and each coordinate keeps its earliest dart, the one of least rank.
Two documents agree in a coordinate with a probability of their weighted
Jaccard similarity.  Theta is chosen so that enough darts fall for all
coordinates; where one stays empty, theta is doubled.

Equal texts are one node.  The signature is cut into bands; nodes that share a
band's key are a bucket.  Each bucket has one leader, and every other member is
compared with it exactly (weighted Jaccard over all shingles, 0.8 or more), so
work grows with the members and not with their pairs.  Buckets whose members
are still in several classes get further leaders, also within sub-buckets that
share a second band.  The same rounds also sweep: each round puts all keys on a
circle, by another hash; nodes of such buckets that share two keys which are
neighbours among the keys of both are dealt into small blocks, and those of a
block that are in different classes are compared; a sub-bucket that fits one
block is compared whole.  The rounds end when one finds few new links.

What is still in several classes then is finished exactly: all nodes of buckets
in several classes are joined on a prefix of their units, rarest first.  Two
sets of similarity 0.8 share a unit among the first fifth of the larger one and
the first ninth of the smaller one, and sizes and positions bound what they can
share (PPJoin, Xiao et al., 2008).  Every such pair of different classes that no
round compared is compared, so no link of these nodes is missed.

Defined cases: texts without a word (null ones too) are each alone in a class;
repeated rows are one class; the class id is the least doc_id in the class
(null if all are null).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, texts_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 6                    # a pair of similarity 0.8 shares a band with probability 0.9993
COORDINATES = BANDS * ROWS
BLOCK_NODES = 8                        # nodes of a block in a sweep, on average
ORDER_CELLS = 1 << 20                  # cells of the counts by which units are ordered; any number gives the same links
FEW_LINKS = 0.01                       # of the rows of open buckets: rounds that find less give way to the exact join
SIZE_STEP = 1.05                       # of the ranges of sizes by which sets that share a unit are parted; any step gives the same links
SALT_ROWS = 256                        # rows of a range that meet in one task's part of it, on average
BLOCK_WORDS = 40_000                   # words of the documents that are hashed together
POISSON = np.cumsum([np.exp(-1) / float(np.prod(np.arange(1, k + 1))) for k in range(20)])
_words: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> list[int]:
    out = []
    for w in text.lower().split():
        h = _words.get(w)
        if h is None:
            if len(_words) > 200_000:
                _words.clear()
            h = _words[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        out.append(h)
    return out


def unit_cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every unit of weight: the n-th occurrence of a shingle is its n-th unit."""
    hashes = [word_hashes(t) for t in texts]
    n = np.array([len(h) for h in hashes], np.int64)
    words = np.array([h for hs in hashes for h in [*hs, *[0] * (SHINGLE - 1)]], np.uint64)
    first = np.cumsum(n + SHINGLE - 1) - (n + SHINGLE - 1)
    count = np.where(n > 0, np.maximum(1, n - SHINGLE + 1), 0)
    doc = np.repeat(np.arange(len(texts)), count)
    at = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    shingle = np.zeros(len(doc), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            shingle = mix(shingle * np.uint64(0x9E3779B97F4A7C15) + words[at + k] + np.uint64(k + 1))
        order = np.lexsort((shingle, doc))
        doc, shingle = doc[order], shingle[order]
        new = np.r_[True, (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])] if len(doc) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        nth = np.arange(len(doc)) - np.repeat(start, np.diff(np.r_[start, len(doc)]))
        return doc, mix(shingle + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def throw_darts(doc: np.ndarray, cell: np.ndarray, theta: np.ndarray):
    """Document, coordinate, rank and identity of all darts of rank below the document's theta."""
    layers = np.ceil(theta).astype(np.int64)[doc]
    unit = np.repeat(np.arange(len(doc)), layers)
    layer = np.arange(len(unit)) - np.repeat(np.cumsum(layers) - layers, layers)
    with np.errstate(over="ignore"):
        seed = mix(cell[unit] + (layer + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        darts = np.searchsorted(POISSON, (seed >> np.uint64(11)) / 2.0 ** 53, side="right")
        which = np.repeat(np.arange(len(unit)), darts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(seed[which] + (nth + 1).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    rank = layer[which] + (dart >> np.uint64(11)) / 2.0 ** 53
    owner = doc[unit[which]]
    low = rank < theta[owner]
    dart, rank, owner = dart[low], rank[low], owner[low]
    ident = mix(dart ^ np.uint64(0x8EBC6AF09C88C6E3))
    return owner, (ident % np.uint64(COORDINATES)).astype(np.int64), rank, ident


def signatures(doc: np.ndarray, cell: np.ndarray, n: int) -> np.ndarray:
    """Earliest dart of every coordinate (documents without a unit have zeros)."""
    sig = np.zeros((n, COORDINATES), np.uint64)
    weight = np.bincount(doc, minlength=n)
    darts = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
    left = weight > 0
    while left.any():
        use = left[doc]
        theta = np.where(left, darts / np.maximum(weight, 1), 0.0)
        owner, coordinate, rank, ident = throw_darts(doc[use], cell[use], theta)
        slot = owner * COORDINATES + coordinate
        best = np.full(n * COORDINATES, np.inf)
        np.minimum.at(best, slot, rank)
        earliest = rank == best[slot]
        sig.reshape(-1)[slot[earliest]] = ident[earliest]
        left &= np.isinf(best.reshape(n, COORDINATES)).any(1)
        darts *= 2
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS)).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(-1, BANDS, ROWS)[:, :, r])
    return key.view(np.int64)


def blocks(texts: list[str]):
    """Ranges of texts of a bounded size together; a longer text is a block of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BLOCK_WORDS * 6:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def text_digest() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, digest and band keys (null for a text without words) of every document."""
    def run(batches):
        for b in batches:
            texts, keys = texts_of(b.column(2)), []
            for i, j in blocks(texts):
                doc, cell = unit_cells(texts[i:j])
                some = np.bincount(doc, minlength=j - i) > 0
                found = band_keys(signatures(doc, cell, j - i))
                keys += [k.tolist() if s else None for k, s in zip(found, some, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["doc_id", "digest", "bands"])

    return (docs.select(F.col("doc_id").cast("long"), text_digest().alias("digest"), "text")
            .mapInArrow(run, "doc_id long, digest string, bands array<long>"))


def weighted_sets(texts: DataFrame) -> DataFrame:
    """nid and its sorted units of weight; shared units over all units is the weighted Jaccard similarity."""
    def run(batches):
        for b in batches:
            texts, out = texts_of(b.column(1)), []
            for i, j in blocks(texts):
                doc, cell = unit_cells(texts[i:j])
                out += [c.view(np.int64) for c in np.split(cell, np.cumsum(np.bincount(doc, minlength=j - i))[:-1])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], names=["nid", "units"])

    return texts.select("nid", "text").mapInArrow(run, "nid long, units array<long>")


def candidates(members: DataFrame, lead: DataFrame, keys: list[str]) -> DataFrame:
    """Members with the leader of their bucket, where the two are in different classes."""
    return (members.select(*keys, "nid", "class").join(lead, keys).filter(F.col("class") != F.col("lead_class"))
            .select("nid", "class", "lead", "lead_class"))


def leaders(members: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The member that is first in ``order`` of every bucket."""
    return (members.groupBy(*keys).agg(F.min(F.struct(order.alias("o"), "nid", "class")).alias("_lead"))
            .select(*keys, F.col("_lead.nid").alias("lead"), F.col("_lead.class").alias("lead_class")))


def sub_buckets(open_rows: DataFrame, turn: int) -> DataFrame:
    """(nid, class, sub): a node is in the sub-buckets of its keys that are neighbours on this turn's circle of keys.

    The circle is an order by hash, the same for all nodes, so those that share
    most keys share most sub-buckets, too; a node has no more of them than keys.
    """
    on_circle = F.struct(F.xxhash64("key", F.lit(turn)).alias("o"), "key")
    keys = (open_rows.groupBy("nid", "class").agg(F.sort_array(F.collect_set(on_circle))["key"].alias("keys"))
            .filter(F.size("keys") > 1))
    after = lambda i: F.get("keys", F.pmod(i + 1, F.size("keys")))
    both = F.transform("keys", lambda k, i: F.xxhash64(F.least(k, after(i)), F.greatest(k, after(i))))
    return keys.select("nid", "class", F.explode(F.array_distinct(both)).alias("sub"))


def block_pairs(open_rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of different classes that share a sub-bucket and, by a hash of this turn, a block of it.

    A sub-bucket has blocks in proportion to its nodes, so the pairs grow with
    the nodes.
    """
    subs = staged(sub_buckets(open_rows, turn), "subs")
    blocks_of = (subs.groupBy("sub").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("_lo"), F.max("class").alias("_hi"))
                 .filter("_lo < _hi").select("sub", F.ceil(F.col("n") / BLOCK_NODES).alias("n_blocks")))
    dealt = staged(subs.join(blocks_of, "sub").select("nid", "class", F.xxhash64("sub", F.pmod(
        F.xxhash64("nid", "sub", F.lit(turn)), "n_blocks")).alias("block")), "blocks")
    other = dealt.toDF("lead", "lead_class", "block")
    return (dealt.join(other, (dealt["block"] == other["block"]) & (F.col("nid") < F.col("lead"))
                       & (F.col("class") != F.col("lead_class")))
            .select("nid", "class", "lead", "lead_class"))


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """nid and units of the nodes in ``wanted``, from one scan of the documents."""
    wanted = wanted.join(nodes.select("nid", "digest", "least_id"), "nid")
    texts = docs.select(F.col("doc_id").cast("long").alias("_w_id"), text_digest().alias("digest"), "text")
    found = texts.join(wanted, (texts["digest"] == wanted["digest"]) & texts["_w_id"].eqNullSafe(wanted["least_id"]))
    return staged(weighted_sets(found.select("nid", "text")).groupBy("nid").agg(F.first("units").alias("units")), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with a similarity of at least 0.8."""
    a, b = sets.toDF("nid", "_a"), sets.toDF("lead", "_b")
    shared = F.size(F.array_intersect("_a", "_b"))
    return staged(pairs.join(a, "nid").join(b, "lead")
                  .filter(shared >= F.lit(SIMILARITY) * (F.size("_a") + F.size("_b") - shared)).select("nid", "lead"),
                  "verified")


def classes_of(links: DataFrame) -> DataFrame:
    """(nid, class) of all nodes with a link, by contraction.

    In each round every node is mapped to the least of itself and its
    neighbours, the mapping is applied to the links, and links within one node
    vanish; stars vanish at once and chains halve at least.
    """
    links = links.toDF("u", "v")
    classes = None
    while True:
        ends = links.union(links.select("v", "u"))
        step = staged(ends.groupBy("u").agg(F.least("u", F.min("v")).alias("c")), "labels")
        if classes is None:
            classes = step.toDF("nid", "class")
        else:
            classes = (classes.join(step.toDF("class", "_c"), "class", "left")
                       .select("nid", F.coalesce("_c", "class").alias("class")))
        links = staged(links.join(step.toDF("u", "a"), "u").join(step.toDF("v", "b"), "v").filter("a != b")
                       .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
        if links.isEmpty():
            return staged(classes, "classes")


def unit_order(open_sets: DataFrame) -> np.ndarray:
    """How many units fall in each of a fixed number of cells; a bounded table, whatever the corpus."""
    cells = open_sets.select(F.explode("units").alias("unit")).groupBy(
        F.pmod("unit", F.lit(ORDER_CELLS)).cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(ORDER_CELLS, np.int32)
    counts[cells["cell"].to_numpy()] = np.minimum(cells["n"].to_numpy(), 2 ** 31 - 1)
    return counts


def least_shared(size, other=None):
    """Units that a set of this size shares at least with one of similarity 0.8, of the other or of any size."""
    bound = SIMILARITY * size if other is None else SIMILARITY / (1 + SIMILARITY) * (size + other)
    return np.ceil(bound - 1e-6).astype(np.int64) if isinstance(bound, np.ndarray) else F.ceil(bound - F.lit(1e-6))


def prefixes(open_sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """unit, nid, class, size, place of the first units of every node, by count and value.

    A partner of no lesser size shares one of the first that are marked as
    ``early``; a unit alone in its cell is shared with nobody and left out.
    """
    def run(batches):
        for b in batches:
            lists = b.column(2)
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            unit = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            count = counts[unit % ORDER_CELLS]
            by = np.lexsort((unit, count, row))
            unit, count = unit[by], count[by]
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            use = (count > 1) & (place <= (size - least_shared(size))[row])
            row, place = row[use], place[use]
            early = place <= (size - least_shared(size, size))[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit[use]), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(size[row]),
                 pa.array(place), pa.array(early)], names=["unit", "nid", "class", "size", "place", "early"])

    return open_sets.select("nid", "class", "units").mapInArrow(
        run, "unit long, nid long, class long, size long, place long, early boolean")


def size_cell(size: Column) -> Column:
    """Number of a range of sizes; neighbouring ranges are a twentieth apart."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(SIZE_STEP)))


def meetings(first: DataFrame) -> DataFrame:
    """(unit, class, size, place, lead_class, _size, _place) of all that meet in a unit and can have a similarity of 0.8.

    Nodes of one class, size and place meet as one.  The larger one's size and
    place bound the sizes of its partners from both sides, so it is sent to the
    cells of these sizes only: a common unit that stands too far behind in all
    sets costs a row of each, not one of each pair.  Cells with many rows are
    dealt over salts.
    """
    shapes = staged(first.groupBy("unit", "class", "size", "place").agg(F.max("early").alias("early")), "shapes")
    units = (shapes.groupBy("unit").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi"), F.max("early").alias("_some"))
             .filter("_lo < _hi AND _some").select("unit"))
    shapes = staged(shapes.join(units, "unit"), "live")
    a = shapes.filter("early").select("unit", "class", "size", "place", size_cell(F.col("size")).alias("cell"))
    cells = staged(a.groupBy("unit", "cell").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi"),
                                                 F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts")), "cells")
    rest, share = F.col("_size") - F.col("_place"), SIMILARITY / (1 + SIMILARITY)
    most = F.least("_size", F.floor((rest + F.lit(1e-4)) / F.lit(share)).cast("long") - F.col("_size"))
    b = (shapes.select("unit", F.col("class").alias("lead_class"), F.col("size").alias("_size"), F.col("place").alias("_place"))
         .withColumn("_least", F.greatest(least_shared(F.col("_size")), F.lit(1).cast("long"))).withColumn("_most", most)
         .filter("_least <= _most")
         .withColumn("cell", F.explode(F.sequence(size_cell(F.col("_least")), size_cell(F.col("_most")))))
         .join(cells, ["unit", "cell"]).filter("_lo < _hi OR _lo <> lead_class")
         .select("unit", "cell", "lead_class", "_size", "_place",
                 F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")))
    a = a.join(cells, ["unit", "cell"]).select("unit", "cell", "class", "size", "place", F.pmod(
        F.xxhash64("class", "size", "place"), "salts").alias("salt"))
    both = F.least(F.col("size") - F.col("place"), rest)
    on = [a[c] == b[c] for c in ("unit", "cell", "salt")]
    return (a.join(b, [*on, F.col("class") != F.col("lead_class"), F.col("size") <= F.col("_size"),
                       least_shared(F.col("_size")) <= F.col("size"), both >= least_shared(F.col("size"), F.col("_size"))])
            .select(a["unit"], "class", "size", "place", "lead_class", "_size", "_place"))


def prefix_pairs(open_nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of ``open_nodes`` (nid, class) of different classes that can have a similarity of 0.8."""
    open_sets = staged(open_nodes.join(sets, "nid").select("nid", "class", "units"), "opensets")
    first = staged(prefixes(open_sets, unit_order(open_sets)), "prefixes")
    meet = staged(meetings(first), "meet")
    small = first.filter("early").select("unit", "class", "size", "place", "nid")
    large = first.select("unit", F.col("class").alias("lead_class"), F.col("size").alias("_size"), F.col("place").alias("_place"),
                         F.col("nid").alias("lead"))
    return (meet.join(small, ["unit", "class", "size", "place"]).join(large, ["unit", "lead_class", "_size", "_place"])
            .filter((F.col("size") < F.col("_size")) | (F.col("nid") < F.col("lead")))
            .select("nid", "class", "lead", "lead_class").distinct())


def merged(classes: DataFrame | None, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The classes after the links ``found`` among ``pairs``; what is linked already is one node."""
    bridges = (found.join(pairs, ["nid", "lead"]).select(F.least("class", "lead_class").alias("u"),
                                                         F.greatest("class", "lead_class").alias("v")).distinct())
    joined = classes_of(bridges if classes is None else staged(bridges, "bridges"))
    if classes is None:
        return joined
    joined = joined.toDF("class", "_c")
    alone = joined.select(F.col("class").alias("nid"), "class").join(classes, "nid", "left_anti")
    return staged(classes.select("nid", "class").union(alone).join(joined, "class", "left")
                  .select("nid", F.coalesce("_c", "class").alias("class")), "classes")


def finished(classes: DataFrame | None, open_rows: DataFrame, tested: DataFrame, sets: DataFrame) -> DataFrame:
    """The classes after an exact comparison of all that the rounds left in open buckets."""
    if classes is None:
        classes = open_rows.select("nid", "class").limit(0)
    if open_rows.isEmpty():
        return classes
    pairs = prefix_pairs(open_rows.select("nid", "class").distinct(), sets)
    done = tested.select(F.least("nid", "lead").alias("_u"), F.greatest("nid", "lead").alias("_v"))
    pairs = staged(pairs.join(done, (F.least("nid", "lead") == F.col("_u")) & (F.greatest("nid", "lead") == F.col("_v")),
                              "left_anti"), "rest")
    found = verified(pairs, sets)
    return classes if found.isEmpty() else merged(classes, found, pairs)


def link_nodes(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(nid, class) of all nodes with a link.

    A round takes the buckets whose members are in several classes.  Each one's
    leader is the member that shares most buckets with others among those that
    have not led it yet: the middle of a group of copies shares more than its
    outer members do.  Further rounds also give a leader, by another order, to
    the members that share a second band, and sweep over blocks of what is left.
    The last step compares exactly what no round has joined.
    """
    rows = nodes.select("nid", F.posexplode("bands").alias("p", "key"))
    some = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = staged(rows.join(some, "key"), "buckets")     # only buckets of two members or more remain
    degree = staged(shared.groupBy("nid").agg(F.sum("n").alias("degree")).join(nodes.select("nid", "bands"), "nid"), "degree")
    sets = sets_of(degree.select("nid"), nodes, docs)
    members = shared.select("key", "p", "nid")
    classes = tested = led = None
    turn, last = 0, False
    while True:
        if classes is None:
            open_rows = members.join(degree, "nid").withColumn("class", F.col("nid"))
        else:
            named = members.join(classes, "nid", "left").withColumn("class", F.coalesce("class", "nid"))
            apart = named.groupBy("key").agg(F.min("class").alias("_lo"), F.max("class").alias("_hi")).filter("_lo < _hi")
            open_rows = named.join(apart.select("key"), "key").join(degree, "nid")
        second = F.get("bands", F.pmod(F.col("p") + F.lit(max(turn, 1)), F.lit(BANDS)))
        open_rows = staged(open_rows.select("key", second.alias("second"), "p", "nid", "class", "degree"), "open")
        if last:
            return finished(classes, open_rows, tested, sets)
        can_lead = open_rows if led is None else open_rows.join(led, ["key", "nid"], "left_anti")
        lead = staged(leaders(can_lead, ["key"], -F.col("degree")), "lead")
        more = candidates(open_rows, lead, ["key"])
        if turn:
            order = F.xxhash64(F.col("nid"), F.lit(turn)) if turn % 2 else -F.col("degree")
            more = (more.union(candidates(open_rows, leaders(open_rows, ["key", "second"], order), ["key", "second"]))
                    .union(block_pairs(open_rows, turn)))
        more = more.distinct()
        more = staged(more if tested is None else more.join(tested, ["nid", "lead"], "left_anti"), "more")
        found = verified(more, sets)
        pairs = more.select("nid", "lead")
        tested = pairs if tested is None else staged(tested.union(pairs), "tested")
        turn += 1
        own = lead.select("key", F.col("lead").alias("nid"))
        led = own if led is None else staged(led.union(own), "led")
        n_found = found.count()
        if n_found:
            classes = merged(classes, found, more)
        last = turn > 1 and n_found <= FEW_LINKS * open_rows.count()


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): doc_id and digest of every row; digest, class_id, class_size and keeper of every distinct text."""
    rows = staged(signed(docs), "signed")
    same = rows.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n"),
                                      F.first("bands").alias("bands"))
    nodes = staged(same.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    worded = nodes.filter(F.col("bands").isNotNull())
    classes = link_nodes(worded, docs)
    named = (worded.select("nid", "digest", "least_id", "n").join(classes, "nid", "left")
             .withColumn("class", F.coalesce("class", "nid")))
    groups = named.groupBy("class").agg(F.min("least_id").alias("class_id"), F.sum("n").alias("class_size"),
                                        F.min(F.struct(F.col("least_id").isNull().alias("o"), "least_id", "digest"))["digest"].alias("keeper"))
    return rows, staged(named.join(groups, "class").select(
        "digest", "least_id", "class_id", "class_size", (F.col("digest") == F.col("keeper")).alias("keeps")), "classes")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and class_size of every document."""
    rows, nodes = near_duplicates(docs.select("doc_id", "text"))
    return rows.select("doc_id", "digest").join(nodes, "digest", "left").select(
        "doc_id", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the least doc_id.

    Of rows that have the same id and text one stays; texts without a word all stay.
    """
    rows, nodes = near_duplicates(docs.select("doc_id", "text"))
    count = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("_w_n"))
    wordless = rows.filter(F.col("bands").isNull()).select("digest").distinct().withColumn("_w_all", F.lit(True))
    keep = (nodes.filter("keeps").select("digest", "least_id").join(
        count.withColumnRenamed("doc_id", "_w_id"), "digest").filter(F.col("_w_id").eqNullSafe(F.col("least_id")))
        .select("digest", F.col("least_id").alias("_w_id"), "_w_n", F.lit(False).alias("_w_all"))
        .unionByName(wordless.select("digest", F.lit(None).cast("long").alias("_w_id"), F.lit(1).cast("long").alias("_w_n"), "_w_all")))
    keep = staged(keep.withColumnRenamed("digest", "_w_digest"), "keep")
    kept = docs.withColumn("_w_text", text_digest()).join(
        keep, (F.col("_w_text") == F.col("_w_digest"))
        & (F.col("_w_all") | F.col("doc_id").cast("long").eqNullSafe(F.col("_w_id"))))
    once = kept.filter("_w_n = 1")
    repeated = kept.filter("_w_n > 1").dropDuplicates(["_w_text"])
    return once.union(repeated).select(*docs.columns)
