"""Contracts: the canonical event schema, page groups and the feature list.

Fixed values below must equal the reference's for identical results; they
are stated plainly and in their natural order.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical event schema (target of every adapter)
# ---------------------------------------------------------------------------
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("userId", T.StringType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("registration", T.TimestampType(), True),
    T.StructField("sessionId", T.StringType(), True),
    T.StructField("page", T.StringType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("auth", T.StringType(), True),
    T.StructField("method", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("artist", T.StringType(), True),
    T.StructField("song", T.StringType(), True),
    T.StructField("length", T.DoubleType(), True),
])

# Raw JSON-lines record: epoch-millisecond times, loose id types.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType(), True),
    T.StructField("ts", T.LongType(), True),
    T.StructField("registration", T.LongType(), True),
    T.StructField("sessionId", T.StringType(), True),
    T.StructField("page", T.StringType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("auth", T.StringType(), True),
    T.StructField("method", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("artist", T.StringType(), True),
    T.StructField("song", T.StringType(), True),
    T.StructField("length", T.DoubleType(), True),
    T.StructField("itemInSession", T.LongType(), True),
    T.StructField("status", T.LongType(), True),
    T.StructField("userAgent", T.StringType(), True),
    T.StructField("firstName", T.StringType(), True),
    T.StructField("lastName", T.StringType(), True),
])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------
UNKNOWN = "Unknown"
CATEGORICAL_FILL_COLUMNS = ["page", "auth", "method", "level", "location", "gender"]

EXPLICIT_CHURN_PAGES = ["Submit Downgrade", "Downgrade"]
CHURN_TYPES = ["explicit", "subscription_downgrade", "inactivity", "not_churned"]

ENGAGEMENT_PAGES = ["NextSong", "Thumbs Up", "Thumbs Down", "Add to Playlist", "Add Friend"]
NAVIGATION_PAGES = ["Home", "Help", "Settings", "About"]
SUBSCRIPTION_PAGES = ["Submit Downgrade", "Downgrade", "Submit Registration", "Submit Upgrade"]
AUTH_PAGES = ["Login", "Logout", "Register"]
EVENT_CATEGORIES = [
    ("Music Engagement", ENGAGEMENT_PAGES),
    ("Navigation", NAVIGATION_PAGES),
    ("Subscription", SUBSCRIPTION_PAGES),
    ("Authentication", AUTH_PAGES),
]

MAJOR_METRO_STATES = ["CA", "NY", "TX", "FL", "IL"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Page name -> feature name of the per-user page counts
PAGE_COUNT_FEATURES = [
    ("songs_played", "NextSong"),
    ("thumbs_up", "Thumbs Up"),
    ("thumbs_down", "Thumbs Down"),
    ("playlist_additions", "Add to Playlist"),
    ("friend_additions", "Add Friend"),
    ("roll_adverts", "Roll Advert"),
]

RECENT_WINDOWS = [7, 14, 30]
DECLINE_WINDOWS = [3, 7, 14]
TREND_WINDOW_DAYS = 7
NO_DOWNGRADE_DAYS = 999

# Columns that are never model inputs
NON_FEATURE_COLUMNS = ["userId", "is_churned", "churn_type", "churn_timestamp", "location_state"]

# ---------------------------------------------------------------------------
# Feature contract, in order: 64 numeric features, then location_state.
# ---------------------------------------------------------------------------
FEATURES_TEMPORAL = [
    "days_since_registration", "days_since_first_event", "days_since_last_event",
    "user_activity_span_days", "total_events", "events_per_day", "unique_sessions",
    "avg_events_per_session",
]
FEATURES_RECENT = [
    name
    for n in RECENT_WINDOWS
    for name in (f"events_last_{n}d", f"sessions_last_{n}d", f"days_active_last_{n}d",
                 f"avg_events_per_day_last_{n}d")
]
FEATURES_PAGES = [name for name, _ in PAGE_COUNT_FEATURES]
FEATURES_RATIOS = ["songs_ratio", "engagement_ratio", "positive_feedback_ratio", "playlist_ratio", "social_ratio"]
FEATURES_LISTENING = ["unique_artists", "unique_songs", "avg_song_length", "total_listening_time",
                      "artist_diversity", "song_diversity"]
FEATURES_SESSIONS = ["avg_session_duration", "avg_songs_per_session", "max_session_duration",
                     "session_duration_std"]
FEATURES_LEVELS = ["current_level_paid", "current_level_free", "subscription_changes", "ever_paid",
                   "ever_free", "upgraded_to_paid", "downgraded_to_free"]
FEATURES_LEVEL_TIME = ["days_as_paid", "days_as_free", "events_as_paid", "events_as_free"]
FEATURES_DOWNGRADE = ["downgrade_events", "days_since_downgrade"]
FEATURES_TRENDS = ["activity_trend_events", "activity_trend_sessions", "activity_trend_songs"]
FEATURES_DECLINE = [f"activity_decline_{d}d" for d in DECLINE_WINDOWS]
FEATURES_DEMOGRAPHIC = ["gender_M", "gender_F", "gender_unknown", "major_metro"]

NUMERIC_FEATURES = (FEATURES_TEMPORAL + FEATURES_RECENT + FEATURES_PAGES + FEATURES_RATIOS
                    + FEATURES_LISTENING + FEATURES_SESSIONS + FEATURES_LEVELS + FEATURES_LEVEL_TIME
                    + FEATURES_DOWNGRADE + FEATURES_TRENDS + FEATURES_DECLINE + FEATURES_DEMOGRAPHIC)
FEATURE_COLUMNS = NUMERIC_FEATURES + ["location_state"]

assert len(NUMERIC_FEATURES) == 64, len(NUMERIC_FEATURES)
