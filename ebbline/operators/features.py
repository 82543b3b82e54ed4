"""The 64 leakage-guarded user features (X1-X14) and windows W1-W4.

Plan shape (no per-user loop, no multi-distinct Expand):

* ``base`` = events up to the cutoff with the reference time ``cref`` as a
  literal; without a cutoff the reference is the user's own max ts (W4), which
  is read off the fine grain, so the events are not joined with it;
* ONE pass over the events: partial aggregates per fine key
  (userId, date, sessionId, page, level) - counts, min/max ts, first/last
  row structs, song length sums, recent-window counts;
* the user, session and day grains are aggregated from that small table;
* distinct artists/songs: (userId, kind, value) pairs, then counted.

Every aggregate combines map-side before its shuffle, so a user holding a
large share of the log does not become one task.  All grains are keyed by
userId and joined on it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import add_days, days_between_floor, first_value_struct, greatest1, location_state, minutes_between
from ..session import staged
from .bits import bit_table, maybe_in
from .prep import contains_downgrade, drop_unlabelled, temporal_cutoff

WINDOW_DAYS = sorted(set(S.RECENT_WINDOWS) | set(S.DECLINE_WINDOWS))


def _song() -> F.Column:
    return F.col("page") == "NextSong"


def _back(days: int) -> F.Column:
    return add_days(F.col("cref"), -days)


# W4 ----------------------------------------------------------------------------
def user_max_broadcast(df: DataFrame, out: str = "cref") -> DataFrame:
    """Attach each user's own max ts to its events (aggregate + join back;
    AQE splits a hot user's partition of the join)."""
    m = df.groupBy("userId").agg(F.max("ts").alias(out))
    return df.join(m, "userId")


def recent_counts(rows: DataFrame, per_day: DataFrame, ref: DataFrame, windows, prefix: str) -> DataFrame:
    """Per user, how many of ``rows`` (userId, date, t) have t >= cref - n days, for every n of ``windows``.

    ``per_day`` has (userId, date, c, lo, hi): count, least and greatest t of
    each day of ``rows``; ``ref`` has (userId, cref).  A day whose least t is
    in the window counts whole, one whose greatest is not counts nothing.  Only
    days that the window's begin cuts in two (at most one a user and window)
    need their rows: a bit table of these (user, date) pairs lets few others
    through, and what it lets through is joined with the pairs.  A table that
    fills up (tens of millions of pairs) lets more narrow rows into the
    exchange and never changes a count.
    """
    days = per_day.join(ref, "userId")
    whole = days.groupBy("userId").agg(
        *[F.coalesce(F.sum(F.when(F.col("lo") >= _back(n), F.col("c"))), F.lit(0)).alias(f"_w{n}") for n in windows])
    cut = (days.select("userId", "date", "lo", "hi", F.explode(F.array(
        *[F.struct(F.lit(n).alias("n"), _back(n).alias("begin")) for n in windows])).alias("w"))
        .select("userId", "date", "lo", "hi", "w.n", "w.begin").filter("lo < begin AND begin <= hi")
        .select("userId", "date", "n", "begin"))
    pair = F.xxhash64("userId", "date").alias("_pair")
    likely = (maybe_in(rows.withColumn("_pair", pair), bit_table(cut.select(pair), "_pair"), "_pair", "_hit")
              .filter("_hit").select("userId", "date", "t"))
    part = (likely.join(cut, ["userId", "date"]).filter("t >= begin").groupBy("userId")
            .agg(*[F.count_if(F.col("n") == n).alias(f"_p{n}") for n in windows]))
    return whole.join(part, "userId", "left").select(
        "userId", *[(F.col(f"_w{n}") + F.coalesce(f"_p{n}", F.lit(0))).alias(f"{prefix}{n}") for n in windows])


# fine grain: the one pass over the events ------------------------------------------
FINE_KEYS = ["userId", "date", "sessionId", "page", "level"]


def _fine_grain(base: DataFrame) -> DataFrame:
    """Partial aggregates per (userId, date, sessionId, page, level).

    Every coarser grain (user, session, day) is derived from this table, so
    the events are scanned and shuffled once; map-side combining shrinks
    them to at most one row per key per task before the shuffle, which also
    spreads a hot user over many keys.
    """
    d = base.withColumn("date", F.to_date("ts"))
    aggs = [F.count(F.lit(1)).alias("c"), F.min("ts").alias("tmin"), F.max("ts").alias("tmax"),
            first_value_struct(None, "registration", "gender", "location").alias("first_row"),
            F.min(F.struct(F.col("ts").alias("o_ts"), F.col("event_id").alias("o_id"))).alias("first_key"),
            F.max(F.struct(F.col("ts").alias("o_ts"), F.col("event_id").alias("o_id"))).alias("last_key"),
            F.sum("length").alias("len_sum"), F.count("length").alias("len_cnt")]
    if "cref" in d.columns:
        aggs.append(F.max("cref").alias("cref"))
        aggs += [F.count_if(F.col("ts") >= _back(n)).alias(f"_e{n}") for n in WINDOW_DAYS]
    return d.groupBy(*FINE_KEYS).agg(*aggs)


def _user_grain(fine: DataFrame) -> DataFrame:
    page, level, c = F.col("page"), F.col("level"), F.col("c")
    paid, free, dg = level == "paid", level == "free", contains_downgrade()
    aggs = [
        F.max("cref" if "cref" in fine.columns else "tmax").alias("cref"),
        F.min("tmin").alias("first_ts"), F.max("tmax").alias("last_ts"),
        F.sum("c").alias("n"),
        F.min("first_row").alias("first_row"),
        F.max(F.struct(F.col("last_key").alias("k"), level.alias("level"))).alias("last_row"),
    ]
    aggs += [F.sum(f"_e{n}").alias(f"_e{n}") for n in WINDOW_DAYS if f"_e{n}" in fine.columns]
    aggs += [F.coalesce(F.sum(F.when(page == p, c)), F.lit(0)).alias(name) for name, p in S.PAGE_COUNT_FEATURES]
    song = page == "NextSong"
    aggs += [
        F.try_divide(F.sum(F.when(song, F.col("len_sum"))), F.sum(F.when(song, F.col("len_cnt")))
                     .cast("double")).alias("avg_song_length"),
        F.coalesce(F.sum(F.when(song, F.col("len_sum"))), F.lit(0.0)).alias("total_listening_time"),
        F.size(F.collect_set("level")).alias("_nlevels"),   # bounded by the level domain
        F.coalesce(F.sum(F.when(paid, c)), F.lit(0)).alias("events_as_paid"),
        F.coalesce(F.sum(F.when(free, c)), F.lit(0)).alias("events_as_free"),
        F.min(F.when(paid, F.col("tmin"))).alias("_pmin"), F.max(F.when(paid, F.col("tmax"))).alias("_pmax"),
        F.min(F.when(free, F.col("tmin"))).alias("_fmin"), F.max(F.when(free, F.col("tmax"))).alias("_fmax"),
        F.min(F.when(paid, F.col("first_key"))).alias("_pfirst"),
        F.min(F.when(free, F.col("first_key"))).alias("_ffirst"),
        F.coalesce(F.sum(F.when(dg, c)), F.lit(0)).alias("downgrade_events"),
        F.max(F.when(dg, F.col("tmax"))).alias("_dglast"),
    ]
    return fine.groupBy("userId").agg(*aggs)


def _sessions(fine: DataFrame) -> DataFrame:
    ref = [F.max("cref").alias("cref")] if "cref" in fine.columns else []
    return (fine.filter(F.col("sessionId").isNotNull())
                .groupBy("userId", "sessionId")
                .agg(F.min("tmin").alias("smin"), F.max("tmax").alias("smax"),
                     F.sum(F.when(F.col("page") == "NextSong", F.col("c")).otherwise(0)).alias("ssongs"), *ref))


def _session_grain(ses: DataFrame) -> DataFrame:
    dur = minutes_between("smin", "smax")
    aggs = [F.count(F.lit(1)).alias("unique_sessions"),
            F.avg(dur).alias("avg_session_duration"),
            F.avg("ssongs").cast("double").alias("avg_songs_per_session"),
            F.max(dur).alias("max_session_duration"),
            F.coalesce(F.stddev_samp(dur), F.lit(0.0)).alias("session_duration_std")]
    if "cref" in ses.columns:
        aggs += [F.count_if(F.col("smax") >= _back(n)).alias(f"sessions_last_{n}d") for n in S.RECENT_WINDOWS]
    return ses.groupBy("userId").agg(*aggs)


def _day_grain(fine: DataFrame, window_days: int = S.TREND_WINDOW_DAYS) -> DataFrame:
    day = (fine.groupBy("userId", "date")
               .agg(F.sum("c").alias("de"), F.count_distinct("sessionId").alias("ds"),
                    F.sum(F.when(F.col("page") == "NextSong", F.col("c")).otherwise(0)).alias("dsg"),
                    F.max("tmax").alias("dmax"),
                    *([F.max("cref").alias("cref")] if "cref" in fine.columns else [])))
    # rows per user = active days (bounded by the calendar, not by the data volume)
    w = W.partitionBy("userId")
    if "cref" not in fine.columns:
        day = day.withColumn("cref", F.max("dmax").over(w))
    day = (day.withColumn("rn", F.row_number().over(w.orderBy(F.col("date").desc())))
              .withColumn("nd", F.count(F.lit(1)).over(w)))
    recent = F.col("rn") <= window_days
    hist = (F.col("rn") > window_days) | (F.col("nd") == window_days)
    aggs = [F.max("nd").alias("_nd")]
    for src, name in (("de", "events"), ("ds", "sessions"), ("dsg", "songs")):
        aggs.append(F.avg(F.when(recent, F.col(src))).alias(f"_r_{name}"))
        aggs.append(F.avg(F.when(hist, F.col(src))).alias(f"_h_{name}"))
    aggs += [F.count_if(F.col("dmax") >= _back(n)).alias(f"days_active_last_{n}d") for n in S.RECENT_WINDOWS]
    out = day.groupBy("userId").agg(*aggs)
    enough = F.col("_nd") >= window_days
    for name in ("events", "sessions", "songs"):
        out = out.withColumn(f"activity_trend_{name}",
                             F.when(enough, F.col(f"_r_{name}") / greatest1(F.col(f"_h_{name}"))))
    return out.select("userId", *S.FEATURES_TRENDS, *[f"days_active_last_{n}d" for n in S.RECENT_WINDOWS])


def _distinct_grain(base: DataFrame) -> DataFrame:
    pairs = (base.filter(_song())
                 .select("userId", F.explode(F.array(
                     F.struct(F.lit("a").alias("k"), F.col("artist").alias("v")),
                     F.struct(F.lit("s").alias("k"), F.col("song").alias("v")))).alias("p"))
                 .select("userId", F.col("p.k").alias("k"), F.col("p.v").alias("v"))
                 .filter(F.col("v").isNotNull())
                 .distinct())
    return pairs.groupBy("userId").agg(F.count_if(F.col("k") == "a").alias("unique_artists"),
                                       F.count_if(F.col("k") == "s").alias("unique_songs"))


def _user_features(u: DataFrame) -> DataFrame:
    n = F.col("n")
    span = days_between_floor("last_ts", "first_ts")
    songs, up, down = F.col("songs_played"), F.col("thumbs_up"), F.col("thumbs_down")
    reg = F.col("first_row.registration")
    gender = F.col("first_row.gender")
    loc = F.col("first_row.location")
    state = F.when(loc.isNotNull() & (loc != ""), location_state(loc))
    both = F.col("_pfirst").isNotNull() & F.col("_ffirst").isNotNull()
    multi = F.col("_nlevels") > 1
    cols = {
        "days_since_registration": days_between_floor("cref", reg),
        "days_since_first_event": days_between_floor("cref", "first_ts"),
        "days_since_last_event": days_between_floor("cref", "last_ts"),
        "user_activity_span_days": span,
        "total_events": n,
        "events_per_day": n / greatest1(span),
        "songs_ratio": songs / n,
        "engagement_ratio": (up + down) / greatest1(songs),
        "positive_feedback_ratio": up / greatest1(up + down),
        "playlist_ratio": F.col("playlist_additions") / greatest1(songs),
        "social_ratio": F.col("friend_additions") / n,
        "current_level_paid": (F.col("last_row.level") == "paid").cast("int"),
        "current_level_free": (F.col("last_row.level") == "free").cast("int"),
        "subscription_changes": F.col("_nlevels") - 1,
        "ever_paid": (F.col("events_as_paid") > 0).cast("int"),
        "ever_free": (F.col("events_as_free") > 0).cast("int"),
        "upgraded_to_paid": F.when(multi, (both & (F.col("_pfirst") > F.col("_ffirst"))).cast("int")),
        "downgraded_to_free": F.when(multi, (both & (F.col("_ffirst") > F.col("_pfirst"))).cast("int")),
        "days_as_paid": F.coalesce(days_between_floor("_pmax", "_pmin"), F.lit(0)),
        "days_as_free": F.coalesce(days_between_floor("_fmax", "_fmin"), F.lit(0)),
        "days_since_downgrade": F.coalesce(days_between_floor("last_ts", "_dglast"), F.lit(S.NO_DOWNGRADE_DAYS)),
        "gender_M": (gender == "M").cast("int"),
        "gender_F": (gender == "F").cast("int"),
        "gender_unknown": (~F.coalesce(gender.isin("M", "F"), F.lit(False))).cast("int"),
        "location_state": state,
        "major_metro": F.when(state.isNotNull(), state.isin(S.MAJOR_METRO_STATES).cast("int")),
    }
    for k in S.RECENT_WINDOWS:
        cols[f"events_last_{k}d"] = F.col(f"_e{k}")
        cols[f"avg_events_per_day_last_{k}d"] = F.col(f"_e{k}") / F.lit(float(k))
    for d in S.DECLINE_WINDOWS:
        expected = F.greatest(n * F.lit(float(d)) / greatest1(span), F.lit(1.0))
        cols[f"activity_decline_{d}d"] = F.lit(1.0) - F.col(f"_e{d}") / expected
    keep = ["userId", "n", "avg_song_length", "total_listening_time", "events_as_paid", "events_as_free",
            "downgrade_events"] + S.FEATURES_PAGES
    return u.select(*keep, *[c.alias(k) for k, c in cols.items()])


def _own_reference(base: DataFrame, fine: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and session grains where each user's own last event is the reference."""
    ref = fine.groupBy("userId").agg(F.max("tmax").alias("cref"))
    per_day = fine.groupBy("userId", "date").agg(F.sum("c").alias("c"), F.min("tmin").alias("lo"), F.max("tmax").alias("hi"))
    events = base.select("userId", F.to_date("ts").alias("date"), F.col("ts").alias("t"))
    u = _user_grain(fine).join(recent_counts(events, per_day, ref, WINDOW_DAYS, "_e"), "userId", "left")
    ends = sessions.select("userId", F.to_date("smax").alias("date"), F.col("smax").alias("t"))
    ended = ends.groupBy("userId", "date").agg(F.count(F.lit(1)).alias("c"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    last = recent_counts(ends, ended, ref, S.RECENT_WINDOWS, "_s")
    ses = _session_grain(sessions).join(last, "userId", "left")
    return u, ses.withColumnsRenamed({f"_s{n}": f"sessions_last_{n}d" for n in S.RECENT_WINDOWS})


# X13 ---------------------------------------------------------------------------
DISTINCT_FEATURES = ("unique_artists", "unique_songs", "artist_diversity", "song_diversity")


def feature_matrix(events: DataFrame, cutoff=None, materialize: bool = True, features=None) -> DataFrame:
    """One row per user of the *uncut* log: userId, 64 doubles, location_state.

    A user without events up to the cutoff gets all zeros (state null).
    With ``materialize`` the fine-grain table is written once to the shared
    folder, so its three consumers read it instead of each re-scanning and
    re-shuffling the events.  It stays dealt out by (user, date, session,
    page, level): every coarser grain combines map-side before its own
    exchange, so a user with a large share of all sessions (a blank id) is
    spread over all tasks and only one row per task and key is exchanged.

    ``features`` limits the columns (and the work) to the ones named; the
    distinct artists and songs are counted only if one of them needs it.
    """
    wanted = list(features) if features is not None else S.NUMERIC_FEATURES
    base = temporal_cutoff(events, cutoff)
    if cutoff is not None:
        base = base.withColumn("cref", F.lit(cutoff).cast("timestamp"))
    fine = _fine_grain(base)
    if materialize:
        fine = staged(fine)
    sessions = _sessions(fine)
    if cutoff is not None:
        u, ses = _user_grain(fine), _session_grain(sessions)
    else:
        u, ses = _own_reference(base, fine, staged(sessions) if materialize else sessions)
    u = _user_features(u)
    day = _day_grain(fine)
    users = events.select("userId").distinct()
    m = users.join(u, "userId", "left").join(ses, "userId", "left").join(day, "userId", "left")
    if any(c in DISTINCT_FEATURES for c in wanted):
        m = m.join(_distinct_grain(temporal_cutoff(events, cutoff)), "userId", "left")
    else:
        m = m.withColumns({c: F.lit(None).cast("long") for c in ("unique_artists", "unique_songs")})
    songs = F.col("songs_played")
    m = (m.withColumn("avg_events_per_session", F.col("n") / greatest1(F.coalesce("unique_sessions", F.lit(0))))
          .withColumn("artist_diversity", F.when(songs > 0, F.coalesce("unique_artists", F.lit(0)) / songs))
          .withColumn("song_diversity", F.when(songs > 0, F.coalesce("unique_songs", F.lit(0)) / songs))
          .withColumn("unique_artists", F.when(songs > 0, F.coalesce("unique_artists", F.lit(0))))
          .withColumn("unique_songs", F.when(songs > 0, F.coalesce("unique_songs", F.lit(0)))))
    feats = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in wanted]
    return m.select("userId", *feats, "location_state")


# X13 + J3/J4 ----------------------------------------------------------------------
def features_with_labels(features: DataFrame, labels: DataFrame, how: str = "inner") -> DataFrame:
    lab = labels.select("userId", "is_churned", "churn_type")
    out = features.join(lab, "userId", how)
    return drop_unlabelled(out) if how == "inner" else out


# X14 / K7 ---------------------------------------------------------------------------
def feature_label_corr(data: DataFrame, label: str = "is_churned", k: int = 15, features=None) -> DataFrame:
    """Pearson correlation of each numeric feature with the label, top ``k`` by |r|.

    One global aggregate row (partial aggregation, no shuffle of the
    matrix), then the row is unpivoted; constant features give null, last.
    """
    features = features or S.NUMERIC_FEATURES
    y = F.col(label).cast("double")
    def pearson(x):  # try_divide: a constant column gives null instead of an ANSI error
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    row = data.agg(*[pearson(F.col(c).cast("double")).alias(c) for c in features])
    long = row.unpivot([], features, "feature", "corr")
    long = long.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))
    w = W.orderBy(F.abs(F.round("corr", 9)).desc_nulls_last(), F.col("feature"))
    return (long.withColumn("rank", F.row_number().over(w))   # 64 rows: a single-partition window is fine
                .filter(F.col("rank") <= k))
