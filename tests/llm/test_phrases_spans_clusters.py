"""Phrases, repeated spans and exact clustering against plain Python and SQL versions, on odd and skewed inputs."""
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from ebbline.llm import fm_phrases, hilbert_kmeans, rlz_spans
from ebbline.llm.common import prepare

DDL = "doc_id long, text string, lang string, n_words string, n_removed string, phrase string, gram string, _shard string"
RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 6))) for _ in range(60)]
WORDS = ["".join(RNG.choice("klmnopqrst") for _ in range(RNG.randint(3, 8))) for _ in range(3000)]


def make(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, lang, *["x"] * 5) for i, t, lang in rows], DDL).repartition(3)


def words(n, vocab=WORDS):
    return [RNG.choice(vocab) for _ in range(n)]


def in_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con.sql(sql).fetchall()


# -- phrases ------------------------------------------------------------------------------------------------------

def phrase_texts():
    out = [(1, None, "en"), (2, "", "en"), (3, "  ;; \n", None), (4, "One ONE one one one", None), (5, "ÄB\x0bÄB\x00 äb", "de")]
    for i in range(60):
        lines = ["Of The People " + " ".join(words(RNG.randint(0, 9), VOCAB)) + RNG.choice([".", "!", "", "\t", "\r"])
                 for _ in range(RNG.randint(0, 12))]
        out.append((10 + i, " ".join(lines), RNG.choice(["en", "en", "fr", None, "und"])))
    return out + out[-3:]


def plain_phrases(rows, least, longest, top):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for d in range(1, longest + 1):
                for i in range(len(ws) - d + 1):
                    key = (lang, tuple(ws[i:i + d]))
                    f[key] = f.get(key, 0) + 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    rows = {}
    for (lang, p), a in cands.items():
        inside = any(lg == lang and len(q) > len(p) and 100 * b >= 100 * a and
                     any(q[i:i + len(p)] == p for i in range(len(q))) for (lg, q), b in cands.items())
        if not inside:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                        for k in range(1, len(p)))
            rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, found in rows.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize("size,least,top,bits", [(1, 4, 2000, 1 << 27), (300, 3, 2000, 1 << 15), (10 ** 6, 5, 7, 1 << 27)])
def test_phrases(spark, monkeypatch, size, least, top, bits):
    monkeypatch.setattr(fm_phrases, "MOST_BITS", bits)
    rows = phrase_texts()
    df = make(spark, rows)
    got = sorted(tuple(r) for r in fm_phrases.collocations(df, least, 5, top, size).collect())
    want = plain_phrases(rows, least, 5, top)
    assert got == want and len(want) > 5
    assert got == sorted(in_sql(fm_phrases.oracle(least, 5, top), documents=df))


def test_places_miss_no_frequent_phrase(spark, monkeypatch):
    monkeypatch.setattr(fm_phrases, "HELD_CELLS", 50)
    prepare(spark)
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    total, parts = Counter(), []
    for _ in range(12):
        some = rng.choice(300, 120, replace=False)
        n = rng.integers(1, 9, 120)
        total.update(dict(zip(some.tolist(), n.tolist())))
        parts += [tuple(r.values()) for r in fm_phrases.counted(hashes[some], n, 7).to_pylist()]
    rows = spark.createDataFrame(parts, "block int, cells binary, counts binary").repartition(5)
    places = fm_phrases.frequent_places(rows, 25)
    want = sum(v >= 25 for v in total.values())
    assert places.count() == want and 0 < want < 300
    held = fm_phrases.Places(places).hold(hashes, 7)
    assert all(held[k] for k, v in total.items() if v >= 25) and held.sum() < want + 10
    monkeypatch.setattr(fm_phrases, "MOST_BITS", 1 << 15)
    assert all(fm_phrases.Places(places).hold(hashes, 7)[k] for k, v in total.items() if v >= 25)


def test_phrases_of_nothing(spark):
    assert fm_phrases.query(make(spark, [])).collect() == []
    assert fm_phrases.query(make(spark, [(1, None, None), (2, "a b", "en")])).collect() == []


def test_interval_extension_counts_every_phrase():
    rng = np.random.default_rng(5)
    text = np.r_[0, rng.integers(0, 5, 400), 0]
    ahead, behind = fm_phrases.Index.of(text), fm_phrases.Index.of(text[::-1])
    first, second, a, b, count = fm_phrases.pairs_of(ahead, behind)
    seq = text.tolist()
    plain = lambda d: Counter(tuple(seq[i:i + d]) for i in range(len(seq) - d + 1) if 0 not in seq[i:i + d])
    assert dict(zip(zip(first.tolist(), second.tolist()), count.tolist())) == plain(2)
    columns = [first, second]
    for d in (3, 4, 5):
        if d % 2 == 0:
            phrase, symbol, a, b, count = fm_phrases.extended(ahead, a, b, count)
            columns = [symbol, *(c[phrase] for c in columns)]
        else:
            phrase, symbol, b, a, count = fm_phrases.extended(behind, b, a, count)
            columns = [*(c[phrase] for c in columns), symbol]
        assert dict(zip(zip(*(c.tolist() for c in columns)), count.tolist())) == plain(d)


def test_large_products_are_exact(spark):
    big = 10 ** 13
    counts = spark.createDataFrame([("en", "a", 3 * big + 1), ("en", "b", 7 * big + 3), ("en", "a b", big + 7)], "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", 991 * big + 13)], "lang string, n long")
    cands = spark.createDataFrame([("en", "a b", big + 7, ["a", "b"])], "lang string, phrase string, a long, words array<string>")
    assert fm_phrases.scored(cands, counts, totals).first()["score"] == 1000 * (big + 7) * (991 * big + 13) // ((3 * big + 1) * (7 * big + 3))


# -- repeated spans -----------------------------------------------------------------------------------------------

def plain_spans(rows, window=50):
    docs = [(math.inf if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows]
    least = {}
    for o, _, ws in docs:
        for s in range(len(ws) - window + 1):
            k = tuple(ws[s:s + window])
            least[k] = min(o, least.get(k, math.inf))
    out = []
    for o, i, ws in docs:
        gone = set()
        for s in range(len(ws) - window + 1):
            if least[tuple(ws[s:s + window])] < o:
                gone.update(range(s, s + window))
        kept = [w for k, w in enumerate(ws) if k not in gone]
        out.append((i, len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def span_texts():
    passage, other, line = words(60), words(50), words(9)
    prose = words(400)
    out = [(1, None, "en"), (2, "", "en"), (3, " \n ", "en"), (4, "few words", "en"), (5, "few words", "en"),
           (6, " ".join(prose), "en"), (7, " ".join(prose), "en"), (8, "  ".join(prose), "en"),
           (9, " ".join(prose[:200] + ["odd"] + prose[200:]), "en"), (30, " ".join(prose[100:180] + words(30) + prose[20:71]), "en"),
           (10, " ".join(line * 40), "en"), (11, " ".join(line * 60 + ["end"]), "en"), (12, " ".join(["a"] * 500), "en"),
           (13, " ".join(["a"] * 49), "en"), (14, " ".join(["a"] * 50), "en"), (None, " ".join(prose), "en"), (None, " ".join(passage), "en"),
           (15, "é " * 70 + " ".join(words(60)) + " " + " ".join(passage), "en")]
    for i in range(40):                       # one passage in many texts, with few contexts before and behind it
        head, tail = words(RNG.randint(0, 40)), words(RNG.randint(0, 40))
        out.append((100 + i, " ".join(head + RNG.choice([[], ["x"], other[:20]]) + passage + RNG.choice([[], ["y"], other[20:]]) + tail), "en"))
    twice = words(120)                        # texts that share an id, and windows that only they and later ones have
    out += [(200, " ".join(passage[:40] + twice), "en"), (200, " ".join(passage + twice[:70]), "en"), (201, " ".join(passage[:45] + twice), "en"),
            (201, " ".join(passage + twice[:75]), "en"), (202, " ".join(twice[10:] + passage), "en")]
    return out + out[5:8]


@pytest.mark.parametrize("share", [2048, 3])
def test_spans(spark, monkeypatch, share):
    monkeypatch.setattr(rlz_spans, "SHARE", share)
    rows = span_texts()
    df = make(spark, rows)
    want = plain_spans(rows)
    assert sorted((tuple(r) for r in rlz_spans.query(df).collect()), key=repr) == want
    assert sum(r[2] > 0 for r in want) > 40
    assert sorted(in_sql(rlz_spans.ORACLE, documents=df), key=repr) == want


def test_spans_tell_what_is_removed(spark):
    prose = words(80)
    df = make(spark, [(1, " ".join(prose), "en"), (2, " ".join(["x", "y", *prose[10:70], "z"]), "en")])
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rlz_spans.repeated_spans(df).collect()}
    assert got == {1: [], 2: [(2, 62)]}


def test_spans_of_nothing(spark):
    assert rlz_spans.query(make(spark, [])).collect() == []


def test_spans_of_one_long_periodic_text(spark):
    text = " ".join(words(25) * 4000)
    rows = [(1, text, "en"), (2, text + " end", "en"), (3, "start " + text, "en")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in rlz_spans.query(make(spark, rows)).collect()}
    assert got == {1: (100000, 0), 2: (100001, 100000), 3: (100001, 100000)}


# -- clustering ---------------------------------------------------------------------------------------------------

def plain_clusters(vectors, components, scale, n, rounds, seed):
    kept = [(i, [math.floor(scale * x) if abs(x) < 2 ** 40 else int(x) * scale for x in v]) for i, v in vectors
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:n]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for t in range(rounds + 1):
        who = [min(range(len(cents)), key=lambda k: (dist(v, cents[k]), k)) for _, v in kept]
        if t < rounds:
            for k in range(len(cents)):
                mine = [v for (_, v), w in zip(kept, who) if w == k]
                if mine:
                    cents[k] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((i, k, min(dist(v, cents[k]), 2 ** 63 - 1)) for (i, v), k in zip(kept, who)), cents


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string, place string").repartition(3)


def some_vectors(components, far=False):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, components))
    rows = [(i, [float(np.float32(x)) for x in centre[i % 6] + rng.normal(scale=0.2, size=components)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [rows[5], rows[5]]                      # equal vectors, repeated rows
    rows += [(2000, None), (2001, []), (2002, [1.0] * (components + 1)), (2003, [float("nan")] + [0.0] * (components - 1)),
             (2004, [None] + [0.0] * (components - 1)), (2005, [float("inf")] + [0.0] * (components - 1)), (2006, [0.0] * components)]
    if far:
        rows += [(3000, [2.0 ** 100] * components), (3001, [-(2.0 ** 50)] + [0.5] * (components - 1))]
    return rows


@pytest.mark.parametrize("far", [False, True])
def test_clusters(spark, far):
    rows = some_vectors(8, far)
    got, cents = hilbert_kmeans.clustered(vectors_of(spark, rows), 8, 256, 7, 4, "2", block=16)
    want, want_cents = plain_clusters(rows, 8, 256, 7, 4, "2")
    assert sorted(tuple(r) for r in got.collect()) == want and cents == want_cents


def test_clusters_against_sql(spark):
    df = vectors_of(spark, some_vectors(64))
    got = sorted(tuple(r) for r in hilbert_kmeans.query(df).collect())
    assert got == sorted(in_sql(hilbert_kmeans.ORACLE, embeddings=df)) and len(got) > 400


def test_clusters_of_few_or_none(spark):
    assert hilbert_kmeans.query(vectors_of(spark, [])).collect() == []
    got = hilbert_kmeans.query(vectors_of(spark, [(1, [0.5] * 64), (2, [1.0] * 64)])).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2] and {r["inertia"] for r in got} == {0}


def test_box_bounds_never_drop_the_nearest():
    rng = np.random.default_rng(7)
    for _ in range(200):
        part, cents = rng.integers(-9, 9, (20, 3)), rng.integers(-9, 9, (12, 3))
        cluster, distance = hilbert_kmeans.nearest(part, part.min(0), part.max(0), cents)
        table = np.square(part[:, None] - cents[None]).sum(2)
        assert (cluster == table.argmin(1)).all() and (distance == table.min(1)).all()


def test_curve_visits_neighbours():
    cells = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    keys = hilbert_kmeans.hilbert_keys(cells, 3)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
