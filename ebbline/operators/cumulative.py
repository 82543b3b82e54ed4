"""Running sums in a global order without a single-task window.

``W.orderBy(x)`` with no partition key gathers every row into one task.
Here the rows are range-partitioned on the order key, each partition sums
its own rows, the per-partition totals (one row per partition and group -
bounded by the partition count, not the data) are turned into offsets, and
those are broadcast back.  The partitioned rows are written once, so that
offsets and rows always belong to the same partitions.  Callers pre-aggregate
ties first (one row per distinct order key), so a range boundary never splits a tie.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import staged


def prefix_sums(df: DataFrame, order_col, sum_cols: list[str], group: str | None = None,
                descending: bool = False, num_partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows up to and including this one,
    in ``order_col`` order (within ``group`` if given).

    ``order_col`` is a column name or a list of sort Columns (a total order
    over the rows, e.g. ending in a unique id)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(order_col, str):
        okeys = [F.col(order_col).desc() if descending else F.col(order_col).asc()]
    else:
        okeys = list(order_col)
    keys = ([F.col(group).asc()] if group else []) + okeys
    # written once with its partition number: the totals and the rows must come from one and the same
    # partitioning, and a second range exchange would sample boundaries of its own
    r = staged(df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))
    gcols = ["_pid"] + ([group] if group else [])
    tot = r.groupBy(*gcols).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wt = (W.partitionBy(group) if group else W.partitionBy(F.lit(0))).orderBy("_pid") \
        .rowsBetween(W.unboundedPreceding, -1)
    off = tot.select(*gcols, *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    r = r.join(F.broadcast(off), gcols)     # rows = partitions x groups
    wp = W.partitionBy(*gcols).orderBy(*okeys).rowsBetween(W.unboundedPreceding, W.currentRow)
    for c in sum_cols:
        r = r.withColumn(f"{prefix}{c}", F.sum(c).over(wp) + F.col(f"_o_{c}"))
    return r.drop("_pid", *[f"_o_{c}" for c in sum_cols])


def sketch_marks(df: DataFrame, value: str, group: str, parts: int) -> DataFrame:
    """(group, marks): values that cut the rows of each group into ``parts`` of about equal size.

    One aggregation with a KLL sketch for each group, whose size does not grow
    with the data.  Written once, since a sketch draws at random: all readers
    must see the same marks.  Values other than numbers have no marks.
    """
    s = df.groupBy(group).agg(F.kll_sketch_agg_double(F.col(value).cast("double")).alias("s"))
    ranks = F.array(*[F.lit((i + 1) / parts) for i in range(parts - 1)]) if parts > 1 else F.array().cast("array<double>")
    some = F.kll_sketch_get_n_double("s") > 0
    marks = F.when(some, F.kll_sketch_get_quantile_double("s", ranks)) if parts > 1 else ranks
    return staged(s.select(group, F.array_distinct(F.coalesce(marks, F.array().cast("array<double>"))).alias("marks")))


def prefix_sums_by_sketch(df: DataFrame, value: str, sum_cols: list[str], group: str, parts: int | None = None,
                          prefix: str = "cum_") -> DataFrame:
    """Running sums as in :func:`prefix_sums`, over a numeric ``value`` that is distinct within each ``group``.

    No range exchange: sketches of all groups give the boundaries in one pass,
    a row finds its part by them, and parts are as even for one group that holds
    nearly all rows as for many.  ``df`` must give the same rows at every read.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = sketch_marks(df, value, group, n)
    v = F.col(value).cast("double")
    r = df.join(F.broadcast(marks), group).withColumn("_part", F.size(F.filter("marks", lambda m: m < v))).drop("marks")
    tot = r.groupBy(group, "_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])       # groups x parts rows
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    off = tot.select(group, "_part", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    r = r.join(F.broadcast(off), [group, "_part"])
    within = W.partitionBy(group, "_part").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    for c in sum_cols:
        r = r.withColumn(f"{prefix}{c}", F.sum(c).over(within) + F.col(f"_o_{c}"))
    return r.drop("_part", *[f"_o_{c}" for c in sum_cols])


def global_row_index(df: DataFrame, order: list, out: str = "idx") -> DataFrame:
    """0-based position of each row in a total order, without a single-task window."""
    r = prefix_sums(df.withColumn("_one", F.lit(1)), order, ["_one"])
    return r.withColumn(out, F.col("cum__one") - 1).drop("_one", "cum__one")


BINS = 4096            # of a column's range in one step of the search for a quantile
FEW = 100_000          # values of a range that are ordered as they are


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], bins: int = BINS, few: int = FEW) -> dict[str, float | None]:
    """Exact quantiles (linear interpolation) of several columns at once: name -> (column, q).

    ``percentile`` keeps a value -> count map in one buffer; over almost
    distinct values that is the whole column.  Here one histogram for all
    columns at a time tells the bin that holds each order statistic, and the
    next one divides that bin only, until few values are left in it, which are
    then ordered.  An exchange has at most ``bins`` rows of every order
    statistic and task.  The columns are written once and read in each step.
    Nulls do not count; NaN is larger than all other values.  Without values: None.
    """
    cols = sorted({c for c, _ in wanted.values()})
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols]))
    values = staged(df.select(pairs.alias("p")).select("p.c", "p.v").filter(F.col("v").isNotNull()))
    sizes = {r["c"]: r for r in values.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    # an order statistic: column, place among the values of the range [lo, hi] that still has n values
    open_, found, places = {}, {}, {}
    for c, q in wanted.values():
        if c in sizes:
            pos = (sizes[c]["n"] - 1) * float(q)
            places[c, q] = pos
            for p in {math.floor(pos), math.ceil(pos)}:
                open_[c, p] = (p, sizes[c]["lo"], sizes[c]["hi"], sizes[c]["n"])
    spark = df.sparkSession
    schema = "c string, p long, lo double, hi double"
    while open_:
        for key, (_, lo, hi, _) in list(open_.items()):
            if lo == hi or (math.isnan(lo) and math.isnan(hi)):
                found[key] = lo
                del open_[key]
        last = {k for k, (_, lo, hi, n) in open_.items() if n <= few or not _splits(lo, hi)}
        if last:
            ranges = spark.createDataFrame([(c, p, *open_[c, p][1:3]) for c, p in last], schema)
            counts = _in_ranges(values, ranges).groupBy("c", "p", "v").agg(F.count(F.lit(1)).alias("n"))
            upto = F.sum("n").over(W.partitionBy("c", "p").orderBy("v"))
            rank = spark.createDataFrame([(c, p, open_[c, p][0]) for c, p in last], "c string, p long, place long")
            hit = (counts.withColumn("upto", upto).join(F.broadcast(rank), ["c", "p"]).filter("upto > place")
                   .groupBy("c", "p").agg(F.min("v").alias("v")))
            found.update({(r["c"], r["p"]): r["v"] for r in hit.collect()})
            open_ = {k: o for k, o in open_.items() if k not in last}
        if open_:
            ranges = spark.createDataFrame([(c, p, *o[1:3]) for (c, p), o in open_.items()], schema)
            half = lambda x: F.greatest(F.least(x, F.lit(1.7e308)), F.lit(-1.7e308)) / 2
            bin_ = F.floor((half(F.col("v")) - half(F.col("lo"))) / (half(F.col("hi")) - half(F.col("lo"))) * (bins - 1))
            hist = (_in_ranges(values, ranges).groupBy("c", "p", F.when(F.isnan("v"), F.lit(bins)).otherwise(bin_).alias("b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
            for key in open_:
                place = open_[key][0]
                for r in sorted((r for r in hist if (r["c"], r["p"]) == key), key=lambda r: r["b"]):
                    if place < r["n"]:
                        open_[key] = (place, r["lo"], r["hi"], r["n"])
                        break
                    place -= r["n"]
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for name, (c, q) in wanted.items():
        if c in sizes:
            pos = places[c, q]
            lo, hi = found[c, math.floor(pos)], found[c, math.ceil(pos)]
            out[name] = lo if lo == hi or pos == math.floor(pos) else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi
    return out


def exact_quantile(df: DataFrame, col, q: float) -> DataFrame:
    """:func:`exact_quantiles` of one column or expression, as a one-row frame with column ``q``."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    return df.sparkSession.createDataFrame([(exact_quantiles(df.select(v.alias("v")), {"q": ("v", q)})["q"],)], "q double")


def _splits(lo: float, hi: float) -> bool:
    """Whether the range can be divided by arithmetic."""
    if math.isnan(hi):
        return not math.isnan(lo)
    return min(hi, 1.7e308) / 2 - max(lo, -1.7e308) / 2 > 0


def _in_ranges(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """c, p, v, lo, hi of the values in each range (a handful of rows)."""
    return values.join(F.broadcast(ranges), "c").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def exact_timestamp_quantile(df: DataFrame, col: str, q: float):
    """Exact ``q``-quantile of a timestamp column in microseconds (float; None without values).

    No value is shuffled: counts per day find the day that holds the order
    statistic, counts per second within that day the second, counts per
    microsecond within that second the value.  Each step scans only the range
    that the one before left (pushed down as a filter on ``col``, and on
    ``event_date`` where the table is partitioned by it) and orders at most as
    many counts as there are days, 86,400 seconds or 1,000,000 microseconds.
    """
    ts = F.col(col)
    us = F.unix_micros(ts)
    n = df.agg(F.count(ts)).first()[0]
    if not n:
        return None
    pos = (n - 1) * float(q)
    lo_pos, hi_pos = math.floor(pos), math.ceil(pos)

    def within(lo: int, hi: int) -> DataFrame:
        a, b = (F.timestamp_micros(F.lit(v)) for v in (lo, hi))
        out = df.filter((ts >= a) & (ts < b))
        if "event_date" in df.columns:   # event_date <= to_date(ts), a day or a month start
            out = out.filter((F.col("event_date") >= F.trunc(F.to_date(a), "month")) & (F.col("event_date") <= F.to_date(b)))
        return out

    part, before, start = df.filter(ts.isNotNull()), 0, 0
    for unit in (86_400_000_000, 1_000_000, 1):
        counts = part.groupBy(F.floor(us / F.lit(unit)).cast("long").alias("k") if unit > 1 else us.alias("k")).agg(
            F.count(F.lit(1)).alias("n"))
        running = counts.withColumn("upto", F.sum("n").over(W.orderBy("k")))
        hit = running.filter(F.col("upto") > lo_pos - before).orderBy("k").limit(1).first()
        start, before = hit["k"] * unit, before + hit["upto"] - hit["n"]
        part = within(start, start + unit)
    lo, last = start, before + hit["n"] - 1      # the value, and the last position that holds it
    hi = lo if hi_pos <= last else df.filter(ts > F.timestamp_micros(F.lit(lo))).agg(F.min(us)).first()[0]
    if hi_pos == lo_pos or hi == lo:
        return float(lo)
    return (hi_pos - pos) * float(lo) + (pos - lo_pos) * float(hi)
