"""Packing into near-equal windows by Karmarkar-Karp multiway differencing.

Every piece starts as a partial partition: itself in one window, the others empty. The two partitions
that are least even are merged, the fullest windows of one with the emptiest of the other, until one
is left. If a window of it exceeds the capacity, the number of windows rises and the pieces are divided anew.

A task takes documents as they come, in groups of some windows, and shuffles nothing. Documents longer than
a window are cut. A group's load stays a little below its windows' room, and what room is left in each is
filled with the documents that come next, cut to fit. At the end of a task the rest goes to windows of a power of
two, which need no padding.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.word_ids import VOCABULARY, word_ids

END = 2
CONTEXT = 4096
#: Windows of a group, and the share of their room that is left for later documents at first.
WINDOWS, ROOM = 128, 1 / 64


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Piece numbers for each of `windows` windows, by multiway differencing; ties by order."""
    if not sizes:
        return [[] for _ in range(windows)]
    # A partial partition lists its windows from full to empty, empty ones left out, sums less the least.
    partial = [(-size, k, [(size, [k])]) for k, size in enumerate(sizes)]
    if windows == 1:
        return [list(range(len(sizes)))]
    heapq.heapify(partial)
    serial = len(sizes)
    while len(partial) > 1:
        a, b = heapq.heappop(partial)[2], heapq.heappop(partial)[2]
        spare = max(windows - len(b), 0)
        # Windows of `a` before `spare` meet an empty one of `b`; the others meet `b` from its least on.
        met = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[spare:], reversed(b))]
        merged = a[:spare] + met + b[: len(b) - len(met)]
        merged.sort(key=lambda window: -window[0])
        if len(merged) == windows and merged[-1][0]:
            least = merged[-1][0]
            merged = [(total - least, pieces) for total, pieces in merged]
        heapq.heappush(partial, (-merged[0][0], serial, merged))
        serial += 1
    found = [pieces for _, pieces in partial[0][2]]
    return found + [[] for _ in range(windows - len(found))]


def near_equal(sizes: list[int], capacity: int, windows: int = 1) -> list[list[int]]:
    """Near-equal windows, `windows` or as many more as hold all pieces; no piece may exceed the capacity."""
    windows = max(windows, -(-sum(sizes) // capacity))
    while True:
        found = differenced(sizes, windows)
        if max(sum(sizes[k] for k in pieces) for pieces in found) <= capacity:
            return found
        windows += 1


class Piece(NamedTuple):
    """Some ids of a document, from `start` on."""

    doc: object
    start: int
    ids: np.ndarray
    total: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


class Stream:
    """Pieces to come: those in sight or given back, then those of the input."""

    def __init__(self, pieces: Iterator[Piece]):
        self.pieces, self.near, self.size = pieces, deque(), 0

    def ahead(self, most: int) -> int:
        """How many ids are in sight, after looking for `most` of them."""
        while self.size < most and (piece := next(self.pieces, None)):
            self.near.append(piece)
            self.size += len(piece.ids)
        return self.size

    def take(self, most: int) -> Piece | None:
        """The next piece, of at most `most` ids; the rest of it comes next."""
        if not self.ahead(1):
            return None
        piece = self.near.popleft()
        if len(piece.ids) > most:
            piece, rest = piece.cut(most)
            self.near.appendleft(rest)
        self.size -= len(piece.ids)
        return piece

    def give_back(self, pieces: list[Piece]) -> None:
        """Puts pieces before all others, whole again where they were cut."""
        for piece in reversed(pieces):
            self.size += len(piece.ids)
            if self.near and self.near[0].start and self.near[0].start == piece.start + len(piece.ids):
                piece = piece._replace(ids=np.concatenate((piece.ids, self.near.popleft().ids)))
            self.near.appendleft(piece)

    def load(self, most: int, capacity: int) -> list[Piece]:
        """Pieces of at most `capacity` ids and `most` in all."""
        found = []
        while most and (piece := self.take(min(capacity, most))):
            found.append(piece)
            most -= len(piece.ids)
        return found


def filled(load: list[Piece], found: list[list[int]], stream: Stream, capacity: int) -> Iterator[list[Piece]]:
    """Windows of a load; what room they have is filled from the stream."""
    for pieces in found:
        window = [load[k] for k in pieces]
        room = capacity - sum(len(p.ids) for p in window)
        while room and (piece := stream.take(room)):
            window.append(piece)
            room -= len(piece.ids)
        yield window


def packed(pieces: Iterator[Piece], capacity: int, windows: int = WINDOWS) -> Iterator[list[Piece]]:
    """Windows of `capacity` ids each, and at the end some of a power of two."""
    stream = Stream(pieces)
    group = windows * capacity
    # What room a group leaves is far less than another group, which is in sight.
    while stream.ahead(2 * group) >= 2 * group:
        load = stream.load(group - int(group * ROOM), capacity)
        found = near_equal([len(p.ids) for p in load], capacity, windows)
        yield from filled(load, found, stream, capacity)
    while stream.size >= capacity:
        many = min(windows, stream.size // capacity)
        step = max(1, int(many * capacity * ROOM))
        most = many * capacity - step
        while True:
            load = stream.load(most, capacity)
            found = near_equal([len(p.ids) for p in load], capacity, many)
            if len(found) * capacity <= stream.size + most:
                break
            # There are not ids enough to fill so many windows: a smaller load needs fewer.
            stream.give_back(load)
            most -= step
        yield from filled(load, found, stream, capacity)
    while stream.size:
        yield stream.load(1 << (stream.size.bit_length() - 1), capacity)


def _row(number: int, window: list[Piece]) -> tuple:
    lengths = [len(p.ids) for p in window]
    ids = np.concatenate([p.ids for p in window]).astype("<u4").tobytes()
    return number, sum(lengths), ids, [p.doc for p in window], [p.start for p in window], lengths, [p.total for p in window]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    context: int = CONTEXT,
    vocabulary: str = VOCABULARY,
    end: int = END,
    windows: int = WINDOWS,
) -> DataFrame:
    """Packed windows: sequence_id, n_tokens, ids, doc_ids, starts, lengths, doc_tokens.

    `ids`: the window's ids, little-endian and of 32 bits, without padding. The other lists say for each piece
    in the window, in order, its document, the document's ids before it, its length and the document's ids in all.
    Every document's ids are followed by `end`, so a null, empty or blank text is that one id; ids may be null,
    and rows that repeat are packed as often as they occur. All windows have `context` ids but for a few of a power of
    two at the end of each task. `context` must be a power of two. Windows follow the input's partitions. Empty input
    gives no rows; extra columns are ignored.
    """
    if context & (context - 1):
        raise ValueError("context must be a power of two")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(vocabulary).of
        last = np.array([end], "<u4")
        names = None

        def pieces() -> Iterator[Piece]:
            nonlocal names
            for batch in batches:
                names = batch.column("doc_id").type
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    ids = np.concatenate((encode(text.as_py() or b""), last))
                    yield Piece(doc, 0, ids, len(ids))

        first = TaskContext.get().partitionId() << 40
        held = []
        for k, window in enumerate(packed(pieces(), context, windows)):
            held.append(_row(first + k, window))
            if len(held) == 64:
                yield _batch(held, names)
                held = []
        if held:
            yield _batch(held, names)

    return rows.mapInArrow(
        run,
        f"sequence_id long, n_tokens int, ids binary, doc_ids array<{kind}>, starts array<long>, "
        "lengths array<long>, doc_tokens array<long>",
    )


def _batch(rows: list[tuple], names: pa.DataType) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(names), longs, longs, longs]
    labels = ["sequence_id", "n_tokens", "ids", "doc_ids", "starts", "lengths", "doc_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], labels)


def pieces_of(sequences: DataFrame) -> DataFrame:
    """A row for each piece of packed windows: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    each = sequences.select(
        "sequence_id",
        F.col("ids").alias("all_ids"),
        F.posexplode(F.arrays_zip("doc_ids", "starts", "lengths", "doc_tokens")).alias("k", "p"),
        "lengths",
    ).withColumn("offset", F.expr("aggregate(slice(lengths, 1, k), 0L, (a, x) -> a + x)"))
    return each.select(
        F.col("p.doc_ids").alias("doc_id"),
        F.col("p.starts").alias("start"),
        F.col("p.lengths").alias("length"),
        F.expr("substring(all_ids, CAST(4 * offset + 1 AS INT), CAST(4 * p.lengths AS INT))").alias("ids"),
        F.col("p.doc_tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )
