"""Quality rules with a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Base rules count words, symbols and repetition.  The verdict on what passes
them compares two multinomials over hashed word unigrams and bigrams: one of
trusted documents, one of the whole raw corpus.  A document's score is the sum
over its n-grams of log p_trusted - log p_raw, divided by their number, and a
fixed threshold decides for every document.

Raw counts are taken over all documents and every n-gram; trusted ones over
all documents named as trusted (in the query, every row labelled as good).
Both tables have ``BUCKETS`` entries, whatever the corpus.

Defined cases: a null or empty text has no words and fails the base rules;
without trusted documents both multinomials are the corpus', so every ratio is
0 and the base rules decide alone; repeated rows count and are judged one by one.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 8192
BROADCAST_IDS = 1_000_000   # ids of 8 bytes up to which the trusted ones are sent to all tasks; more are shuffled
THRESHOLD = -0.05         # of the mean log-likelihood ratio; good rows lie around 0, junk mostly far below
SMOOTHING = 1.0           # added to every bucket's count
LEAST_WORDS, MOST_REPEATED = 50, 50
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def raw() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def words_of() -> Column:
    return F.array_remove(F.split(raw(), SPACE), "")


def bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def pairs(fn) -> Column:
    """``fn`` of the places 0 .. n - 2, as an array (none for fewer than two words)."""
    n = F.size("_w_words")
    return F.when(n > 1, F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), fn)).otherwise(F.array().cast("array<int>"))


def word_at(i: Column) -> Column:
    return F.get("_w_words", i)


def ngram_buckets() -> Column:
    """Buckets of all unigrams and bigrams of ``_w_words``."""
    return F.concat(F.transform("_w_words", lambda w: bucket(w)),
                    pairs(lambda i: bucket(word_at(i), word_at(i + 1))))


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (and _w_words)."""
    df = docs.withColumn("_w_words", words_of())
    n = F.size("_w_words")
    n_symbols = sum((F.octet_length(raw()) - F.octet_length(F.replace(raw(), F.lit(c), F.lit(""))) for c in SYMBOLS),
                    F.lit(0))
    lines = F.filter(F.split(raw(), "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_w_lines", lines)
    windows = F.when(n > 2, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.struct(
        F.xxhash64(word_at(i), word_at(i + 1), word_at(i + 2)).alias("h"), i.alias("i")))))
    df = df.withColumn("_w_sorted", F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")))
    h = lambda j: F.get("_w_sorted", j)["h"]
    again = F.filter("_w_sorted", lambda s, j: s["h"].eqNullSafe(h(j - 1)) | s["h"].eqNullSafe(h(j + 1)))
    starts = F.transform(again, lambda s: s["i"])
    covered = F.size(F.array_distinct(F.concat(starts, F.transform(starts, lambda i: i + 1), F.transform(starts, lambda i: i + 2))))
    df = (df.withColumn("n_words", n.cast("long"))
          .withColumn("word_chars", F.length(F.array_join("_w_words", "")).cast("long"))
          .withColumn("n_symbols", n_symbols.cast("long"))
          .withColumn("n_dup_lines", (F.size("_w_lines") - F.size(F.array_distinct("_w_lines"))).cast("long"))
          .withColumn("n_repeat_words", covered.cast("long")))
    return df.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).drop("_w_lines", "_w_sorted")


def ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[float]:
    """log p_trusted - log p_raw of every bucket.

    One scan counts both: the trusted ids are broadcast if they are counted to be
    at most ``BROADCAST_IDS``, else a hash join brings them to the documents.
    Every n-gram of every document is counted before the counts are shuffled.
    """
    mark = trusted_ids.select(F.col("doc_id").alias("_w_id")).distinct().withColumn("_w_good", F.lit(1))
    mark = F.broadcast(mark) if trusted_ids.count() <= BROADCAST_IDS else mark.hint("shuffle_hash")
    rows = (docs.select("doc_id", "text").join(mark, F.col("doc_id") == F.col("_w_id"), "left")
            .withColumn("_w_words", words_of())
            .select(F.coalesce("_w_good", F.lit(0)).alias("good"), F.explode(ngram_buckets()).alias("b")))
    counts = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).collect()  # BUCKETS rows
    n, good = [SMOOTHING] * BUCKETS, [SMOOTHING] * BUCKETS
    for r in counts:
        n[r["b"]] += r["n"]
        good[r["b"]] += r["good"]
    if sum(good) == SMOOTHING * BUCKETS:
        return [0.0] * BUCKETS
    log_n, log_good = math.log(sum(n)), math.log(sum(good))
    return [math.log(g) - log_good - math.log(a) + log_n for g, a in zip(good, n, strict=True)]


def with_ratio(df: DataFrame, table: list[float]) -> DataFrame:
    """``df`` (with ``_w_words``) and llr, the mean ratio over its n-grams (0 without words)."""
    lookup = F.split(F.lit(",".join(repr(v) for v in table)), ",").cast("array<double>")
    total = F.aggregate(ngram_buckets(), F.lit(0.0), lambda acc, b: acc + F.get(lookup, b))
    n = F.size("_w_words")
    return df.withColumn("llr", F.when(n > 0, total / (2 * n - 1)).otherwise(0.0))


def judged(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base columns, llr and kept; columns of these names are replaced."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")
    docs = docs.drop(*names)
    df = with_ratio(base_columns(docs), ratios(docs, trusted_ids))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("_w_words")


def trusted(labels: DataFrame) -> DataFrame:
    """doc_id of all rows labelled as good."""
    return labels.filter(F.col("quality") == 1).select("doc_id")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base columns, kept and llr of every document."""
    return judged(docs.select("doc_id", "text"), trusted(labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
