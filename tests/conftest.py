import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ebbline.session import local_session
    s = local_session(cores=4, shuffle_partitions=4)
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


EVENT_DDL = ("event_id long, userId string, ts timestamp, registration timestamp, sessionId string, page string, "
             "level string, auth string, method string, gender string, location string, artist string, song string, "
             "length double")


def make_events(spark, rows):
    """rows: dicts with at least event_id, userId, ts; other columns default."""
    base = dict(registration=None, sessionId="s1", page="NextSong", level="free", auth="Logged In", method="PUT",
                gender="M", location="Tampa, FL", artist="A", song="S", length=200.0)
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        if isinstance(d["ts"], str):
            d["ts"] = ts(d["ts"])
        if isinstance(d.get("registration"), str):
            d["registration"] = ts(d["registration"])
        out.append(tuple(d[c.split()[0]] for c in EVENT_DDL.split(", ")))
    return spark.createDataFrame(out, EVENT_DDL)
