"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are tokenised and cut in one pass over the corpus.  Packing then
works in bulk-synchronous rounds over two sorted lists, the pieces that wait
and the gaps of open sequences: a sweep matches every piece with its successor
(the smallest gap that holds it), a gap that several pieces want goes to the
first in rank (the longest), the gaps are updated, and the next round starts
with what is left.  Pieces that no gap holds open sequences of their own.

Pieces of one length are interchangeable, so both lists are kept as runs of
equal length: whatever the corpus, a round's lists have at most one piece run
for each length.  The runs' counts come from a distributed aggregation; the
sweeps yield, for intervals of ranks of a length, intervals of sequences; the
pieces themselves are numbered within their length and looked up in that plan,
all in parallel.  No piece and no length is gathered in one task.

Defined cases: a null or empty text is the single id 0; repeated rows are
packed one by one; an empty table has no sequences.
"""
from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, texts_of
from .jump_shard import numbered, with_rank

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


def encoder(vocabulary: str = VOCABULARY):
    """A function from a list of texts to their ids.

    The same byte-level BPE exists as a tokenizers file and as plain ranks.
    The ranks encode several times faster and give the same ids; a text with
    the special token's string, or one that the faster library refuses, goes
    through the tokenizers file, which defines the ids.
    """
    state: dict = {}

    def slow(text: str) -> list[int]:
        if "slow" not in state:
            import public_tokenizers
            from tokenizers import Tokenizer
            state["slow"] = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        return state["slow"].encode(text, add_special_tokens=False).ids

    def encode(texts: list[str]) -> list[np.ndarray]:
        if "fast" not in state:
            import base64

            import public_tokenizers
            import tiktoken
            with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            state["fast"] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                              special_tokens={})
        out = []
        for text in texts:
            ids = None
            if SPECIAL not in text:
                try:
                    ids = state["fast"].encode_ordinary(text)
                except (KeyboardInterrupt, SystemExit, MemoryError):
                    raise
                except BaseException:  # noqa: BLE001  a panic of the native regex engine is no Exception
                    ids = None
            out.append(np.array(slow(text) if ids is None else ids, np.uint32))
        return out

    return encode


PIECE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
                      T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("ids_crc32", T.LongType())])


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones but for the first, which may be shorter."""
    head = (len(ids) - 1) % capacity + 1
    return [(0, head)] + [(s, capacity) for s in range(head, len(ids), capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece with its checksum, numbered within its task and length."""
    encode = encoder(vocabulary)

    def tokenise(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, ids in zip(b.column(0).to_pylist(), encode(texts_of(b.column(1))), strict=True):
            ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
            rows += [(doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cut(ids, capacity))]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=PIECE.names)

    return numbered(docs.select(F.col("doc_id").cast("long"), "text"), "length", (PIECE, tokenise))


class Runs:
    """Intervals of sequence numbers, kept by the size of their gap."""

    def __init__(self):
        self.sizes: list[int] = []
        self.by: dict[int, list[tuple[int, int]]] = {}

    def add(self, size: int, first: int, n: int) -> None:
        if size not in self.by:
            bisect.insort(self.sizes, size)
            self.by[size] = []
        self.by[size].append((first, n))

    def successor(self, length: int) -> int | None:
        at = bisect.bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, size: int, n: int) -> tuple[int, int]:
        """At most n sequences of one interval with that gap."""
        first, have = self.by[size].pop()
        if have > n:
            self.by[size].append((first + n, have - n))
        elif not self.by[size]:
            del self.by[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))
        return first, min(n, have)


def plan_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int, int]:
    """(length, first rank, first sequence, offset) sorted, number of sequences, number of rounds.

    ``counts`` has the number of pieces of each length.  In a round every open
    gap takes one piece at most: the sweep goes down both sorted lists, so the
    longest pieces choose first, each the smallest gap that holds it.
    """
    waiting = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(waiting, 0)
    gaps, plan, sequences, rounds = Runs(), [], 0, 0

    def place(length: int, first: int, n: int, gap: int, into: Runs) -> None:
        plan.append((length, rank[length], first, capacity - gap))
        rank[length] += n
        waiting[length] -= n
        if gap > length:
            into.add(gap - length, first, n)

    while waiting:
        rounds += 1
        fresh = Runs()          # gaps as this round leaves them; they take part in the next one
        for length in sorted(waiting, reverse=True):
            while waiting[length] and (size := gaps.successor(length)) is not None:
                first, n = gaps.take(size, waiting[length])
                place(length, first, n, size, fresh)
            if waiting[length] and fresh.successor(length) is None:
                # gaps only shrink, so none will ever hold it: open as many sequences as its equals fill
                n = -(-waiting[length] // (capacity // length))
                place(length, sequences, n, capacity, fresh)
                sequences += n
        for size in gaps.sizes:
            for first, n in gaps.by[size]:
                fresh.add(size, first, n)
        gaps = fresh
        waiting = {k: c for k, c in waiting.items() if c}
    out = np.array(sorted(plan), np.int64).reshape(-1, 4)
    return out, sequences, rounds


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = staged(pieces(docs, capacity, vocabulary), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}   # capacity rows at most
    plan, _, _ = plan_rounds(counts, capacity)
    ranked = with_rank(rows, "length", "_w_rank")
    schema = T.StructType([*PIECE.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    most = max(counts.values(), default=0) + 1
    if most * (capacity + 1) >= 1 << 63:
        raise ValueError("too many pieces of one length for 64-bit plan keys")
    key = plan[:, 0] * most + plan[:, 1] if len(plan) else np.zeros(0, np.int64)

    def look_up(batches):
        for b in batches:
            length, rank = np.asarray(b.column(3)), np.asarray(b.column(5))
            at = np.searchsorted(key, length * most + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(plan[at, 2] + rank - plan[at, 1]), pa.array(plan[at, 3])],
                names=schema.names)

    return ranked.select(*PIECE.names, "_w_rank").mapInArrow(look_up, schema)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return packed(docs.select("doc_id", "text"))
