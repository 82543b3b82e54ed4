"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ten consecutive words of a benchmark item (a shorter item is one
window).  A window is the set of its word shingles with their places.  Every
shingle of the corpus that occurs in some window is found in one scan; their
counts order the shingles by rarity; of each window only the rarest shingle,
the prefix that any document containing the window must share, is joined.  A
match fixes where the window would start; it must lie inside the document
(length and positional bounds), and the window occurs there exactly if the
shingles that cover all of its words stand at their places, word by word.

The benchmark's shingles are broadcast only if their measured size is at most
``BROADCAST_BYTES``; a larger benchmark is joined by a shuffle.

Defined cases: a null or empty text has no words and is never hit; items
without words have no window; a null item id reads "null"; repeated rows each
get their own result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

WINDOW, SHINGLE = 10, 5            # two shingles cover a window, so WINDOW <= 2 * SHINGLE
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of a text column: A-Z lower-cased, then runs of digits, a-z and anything beyond ASCII."""
    raw = F.coalesce(F.col(text), F.lit(""))
    low = F.when(F.octet_length(raw) == F.length(raw), F.lower(raw)).otherwise(F.translate(raw, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def row_id() -> Column:
    """Identity of a row for this join: rows of equal id and text have equal results."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def run_of(words: str, start: Column, n: Column | int) -> Column:
    return F.concat_ws(" ", F.slice(F.col(words), start + 1, n if isinstance(n, Column) else F.lit(n)))


def windows_of(benchmark: DataFrame) -> DataFrame:
    """item, window (its words), wlen, k (words of its shingles), once for each item and window."""
    n = F.size("_words")
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                              words_of("text").alias("_words")).filter(n > 0)
             .withColumn("wlen", F.least(n, F.lit(WINDOW))))
    return items.select("item", "wlen", F.least("wlen", F.lit(SHINGLE)).alias("k"), F.explode(F.transform(
        F.sequence(F.lit(0), n - F.col("wlen")), lambda i: run_of("_words", i, F.col("wlen")))).alias("window")).distinct()


def placed_shingles(windows: DataFrame) -> DataFrame:
    """window, wlen, k, off, shingle for every place in every distinct window."""
    w = windows.select("window", "wlen", "k").distinct().withColumn("_words", F.split("window", " "))
    return w.select("window", "wlen", "k", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("wlen") - F.col("k")),
        lambda i: F.struct(i.alias("off"), run_of("_words", i, F.col("k")).alias("shingle")))).alias("s")
    ).select("window", "wlen", "k", "s.off", "s.shingle")


def if_small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def found_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """rid, item, start, wlen of every occurrence of every window."""
    windows = staged(windows_of(benchmark), "windows")
    placed = staged(placed_shingles(windows), "placed")
    size = placed.agg(F.coalesce(F.sum(F.octet_length("window") + F.octet_length("shingle") + 64), F.lit(0)),
                      F.collect_set("k")).first()
    small, lengths = size[0] <= BROADCAST_BYTES, sorted(size[1])   # at most SHINGLE lengths

    def places(k: int) -> Column:
        first = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - k + 1, F.lit(0)))
        return F.transform(first, lambda w, i: F.struct(i.alias("p"), F.concat_ws(
            " ", w, *[F.get("_words", i + j) for j in range(1, k)]).alias("shingle")))

    each = [places(k) for k in lengths] or [places(SHINGLE)]
    own = (docs.select(row_id().alias("rid"), words_of("text").alias("_words"))
           .select("rid", F.size("_words").alias("n_words"), F.explode(F.concat(*each)).alias("s"))
           .select("rid", "n_words", "s.p", "s.shingle"))
    known = if_small(placed.select("shingle").distinct(), small)
    hits = staged(own.join(known, "shingle"), "shingles")

    counts = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    prefix = (placed.join(counts, "shingle").groupBy("window", "wlen")
              .agg(F.min(F.struct("n", "shingle", "off")).alias("rarest"))
              .select("window", "wlen", "rarest.shingle", "rarest.off"))
    start = F.col("p") - F.col("off")
    candidates = (hits.join(if_small(prefix, small), "shingle").filter((start >= 0) & (start + F.col("wlen") <= F.col("n_words")))
                  .select("rid", "window", "wlen", start.alias("start")).distinct())
    cover = placed.filter((F.col("off") == 0) | (F.col("off") == F.col("wlen") - F.col("k"))).select("window", "off", "shingle")
    needed = F.when(F.col("wlen") > SHINGLE, 2).otherwise(1)
    exact = (candidates.join(if_small(cover, small), "window")
             .withColumn("p", F.col("start") + F.col("off"))
             .join(hits.select("rid", "p", "shingle").distinct(), ["rid", "p", "shingle"])
             .groupBy("rid", "window", "wlen", "start").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == needed))
    return exact.join(if_small(windows.select("window", "item"), small), "window").select("rid", "item", "start", "wlen")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """rid (see ``row_id``), n_hit, items (sorted) of every row with a hit, one for each rid."""
    found = found_windows(docs, benchmark)
    positions = F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("start", "wlen")), lambda w: F.sequence(w["start"], w["start"] + w["wlen"] - 1))))
    return staged(found.groupBy("rid").agg(F.size(positions).cast("long").alias("n_hit"),
                                           F.sort_array(F.collect_set("item")).alias("items")), "contaminated")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = docs.select("doc_id", "text")
    bad = contamination(docs, benchmark)
    rows = docs.select("doc_id", F.size(words_of("text")).cast("long").alias("n_words"), row_id().alias("rid"))
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return rows.join(bad, "rid", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    bad = contamination(docs.select("doc_id", "text"), benchmark)
    return (docs.withColumn("_w_rid", row_id()).join(bad.select(F.col("rid").alias("_w_rid")), "_w_rid", "left_anti")
            .select(*docs.columns))


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
iw AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
iwin AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM iwin),
dwin AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM dw, lens WHERE len(w) >= k)),
hit AS (SELECT DISTINCT r, item, i, d.k FROM dwin d JOIN iwin USING (k, win)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
