"""Secret scans over a trigram inverted index.

Each Arrow batch of documents is one index segment.  Every rule's regular
expression is turned once into a Boolean query over trigrams that any match
must contain; the segment's postings (trigram to documents) are built for the
trigrams that some query names, the query intersects and unites postings, and
the regular expression verifies the documents that remain.  A rule from which
no mandatory trigram follows scans every document.

Segments need no shuffle: a posting list never leaves the task that holds its
documents, so its length is bounded by the batch.

Spans are in code points, end exclusive, leftmost and non-overlapping for each
kind.  Trigrams are taken over lower-cased ASCII, so one index serves rules of
either case.

Defined cases: a null text counts as empty and has no span; repeated rows are
scanned one by one.
"""
from __future__ import annotations

import hashlib
import re
from re import _constants as rc
from re import _parser as rp
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import raw_bytes, texts_of


class Rule(NamedTuple):
    kind: str
    pattern: str
    flags: int = re.ASCII
    checked_group: int = 0   # this group of a match must have
    least: int = 0           # so many characters, or the match is dropped
    once_a_run: str = ""     # characters of a class: of a run of them only the pattern's first start can match


# The rules whose spans are always reported, in the order that settles ties.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.ASCII | re.IGNORECASE, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 16),
    Rule("hex", r"[0-9a-f]+", re.ASCII, 0, 32),
)
# Public formats of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", once_a_run="A-Za-z0-9_-"),
)
RULES = BASE_RULES + MORE_RULES

SMALL_CLASS, SMALL_SET = 8, 64   # larger character classes and string sets end a literal run


# -- Boolean trigram queries: True (anything), ("and", [...]), ("or", [...]) or a trigram --------------------------

def both(a, b):
    if a is True or b is True:
        return b if a is True else a
    return ("and", [a, b])


def any_of(parts):
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", list(parts))


def of_strings(strings: set[str]):
    """Some one of these strings occurs."""
    def one(s: str):
        grams = sorted({s[i:i + 3] for i in range(len(s) - 2)})
        return True if not grams else grams[0] if len(grams) == 1 else ("and", grams)
    return any_of([one(s) for s in sorted(strings)])


def class_members(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(chr(arg).lower())
        elif op is rc.RANGE and arg[1] - arg[0] < SMALL_CLASS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= SMALL_CLASS else None


def required(parsed):
    """(exact strings or None, query) of a parsed expression; the query holds for every match."""
    run: set[str] = {""}
    exact, query = True, True

    def end_run():
        nonlocal run, exact, query
        query, run, exact = both(query, of_strings(run)), {""}, False

    def append(strings: set[str]):
        nonlocal run
        if len(run) * len(strings) > SMALL_SET:
            end_run()
        run = {a + b for a in run for b in strings}

    for op, arg in parsed:
        if op is rc.LITERAL:
            append({chr(arg).lower()})
        elif op is rc.IN and (members := class_members(arg)):
            append(members)
        elif op is rc.SUBPATTERN:
            strings, sub = required(arg[3])
            if strings is None:
                end_run()
                query = both(query, sub)
            else:
                append(strings)
        elif op is rc.BRANCH:
            parts = [required(p) for p in arg[1]]
            if all(s is not None for s, _ in parts):
                append(set().union(*(s for s, _ in parts)))
            else:
                end_run()
                query = both(query, any_of([q if s is None else of_strings(s) for s, q in parts]))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, sub = arg
            strings, inner = required(sub)
            if (low, high) == (0, 1) and strings is not None:
                append(strings | {""})
            elif low == high and low <= 8 and strings is not None and len(strings) == 1:
                append({next(iter(strings)) * low})
            else:
                end_run()
                if low:
                    query = both(query, inner if strings is None else of_strings(strings))
        elif op is not rc.AT:
            end_run()
    if exact:
        return run, of_strings(run)
    return None, both(query, of_strings(run))


def trigram_query(rule: Rule):
    return required(rp.parse(rule.pattern, rule.flags))[1]


def named(query) -> set[str]:
    """The trigrams that a query names (only ASCII ones are indexed)."""
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(named(q) for q in query[1]))


def code_of(gram: str) -> int:
    a, b, c = gram.encode("ascii")
    return a << 16 | b << 8 | c


class Segment:
    """Postings of one batch: for each indexed trigram the sorted documents that contain it."""

    def __init__(self, column: pa.Array, wanted: np.ndarray):
        data, offsets = raw_bytes(column)
        self.n = len(offsets) - 1
        self.postings: dict[int, np.ndarray] = {}
        if len(data) < 3:
            return
        low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        code = low[:-2].astype(np.uint32) << 16
        code |= low[1:-1].astype(np.uint32) << 8
        code |= low[2:]
        at = np.flatnonzero(wanted[code])
        doc = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 2 < offsets[doc + 1]
        pairs = np.unique(code[at[inside]].astype(np.int64) * self.n + doc[inside])
        grams, where = np.divmod(pairs, self.n)
        cut = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else []
        for g, docs in zip(grams[cut], np.split(where, cut[1:]), strict=True) if len(grams) else ():
            self.postings[int(g)] = docs

    def find(self, query) -> np.ndarray:
        """Documents that satisfy a query, ascending."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, str):
            return self.postings.get(code_of(query), np.zeros(0, np.int64))
        found = [self.find(q) for q in query[1]]
        out = found[0]
        for more in found[1:]:
            out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
        return out


def compiled(rule: Rule) -> re.Pattern:
    # a run of one class that must have a least length can be asked for as such: the same maximal runs match
    plain_run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    if plain_run and rule.least and not rule.checked_group:
        return re.compile(f"{plain_run[1]}{{{rule.least},}}", rule.flags)
    return re.compile(rule.pattern, rule.flags)


def matches(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    if rule.once_a_run:
        return matches_once_a_run(rule, pattern, text)
    out = []
    for m in pattern.finditer(text):
        a, b = m.span(rule.checked_group)
        if b - a >= rule.least:
            out.append(m.span())
    return out


def matches_once_a_run(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Matches of a pattern whose literal head is followed by a greedy run of the rule's class.

    The run ends at the same place whatever head in it a match starts at, and a
    later start leaves fewer characters, so after the first head has failed the
    search goes on behind the run: each run is read once.
    """
    head, run, at, out = pattern.pattern.partition("[")[0], re.compile(f"[{rule.once_a_run}]*+"), 0, []
    while (start := text.find(head, at)) >= 0:
        if m := pattern.match(text, start):
            out.append(m.span())
            at = max(m.end(), start + 1)
        else:
            at = run.match(text, start).end()
    return out


def scan(column: pa.Array, rules: tuple[Rule, ...], queries: list, wanted: np.ndarray,
         patterns: list[re.Pattern]) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) of every secret of each document, in order."""
    segment, texts = Segment(column, wanted), texts_of(column)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for i in segment.find(query):
            found[i] += [(a, k, b) for a, b in matches(rule, patterns[k], texts[i])]
    return [sorted(f) for f in found]


def scanner(rules: tuple[Rule, ...]):
    """A function from a text column to its spans, with queries derived once."""
    queries = [trigram_query(r) for r in rules]
    grams = set().union(*(named(q) for q in queries))
    state: list = []

    def run(column: pa.Array):
        if not state:
            wanted = np.zeros(1 << 24, bool)
            wanted[[code_of(g) for g in grams]] = True
            state.extend([wanted, [compiled(r) for r in rules]])
        return scan(column, rules, queries, *state)

    return run


def joined(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` and secrets, an array of (kind, start, end); such a column is replaced."""
    docs = docs.drop("secrets")
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("secrets", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    at, find = docs.columns.index("text"), scanner(rules)

    def run(batches):
        for b in batches:
            rows = [[{"kind": rules[k].kind, "start": a, "end": e} for a, k, e in spans]
                    for spans in find(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=[*b.schema.names, "secrets"])

    return docs.mapInArrow(run, schema)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; overlapping spans become one mask.

    ``n_chars``, where there is one, is counted anew for the texts that changed.
    """
    at, find = docs.columns.index("text"), scanner(rules)
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def hide(text: str, spans) -> str:
        out, last = [], 0
        for a, _, b in spans:
            if a >= last:
                out += [text[last:a], mask]
            last = max(last, b)
        return "".join([*out, text[last:]])

    def run(batches):
        for b in batches:
            found, columns = find(b.column(at)), list(b.columns)
            texts = columns[at].to_pylist()
            fresh = [hide(t, s) if s else t for t, s in zip(texts, found, strict=True)]
            columns[at] = pa.array(fresh, columns[at].type)
            if count_at is not None:
                old = columns[count_at].to_pylist()
                columns[count_at] = pa.array([len(t) if s else c for t, s, c in zip(fresh, found, old, strict=True)],
                                             columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans of every document."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    find, base = scanner(RULES), len(BASE_RULES)

    def run(batches):
        for b in batches:
            out = []
            for doc_id, spans in zip(b.column(0).to_pylist(), find(b.column(1)), strict=True):
                own = [s for s in spans if s[1] < base]
                count = [sum(k == i for _, k, _ in own) for i in range(base)]
                out.append((doc_id, *count, hashlib.sha256(joined(own, RULES).encode()).hexdigest(),
                            joined(spans, RULES)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
