"""Token-ID output: best-fit-decreasing packing into rows of one context length.

Each task encodes its documents and packs them in groups of some million tokens, so nothing is
shuffled, and a lost task is simply run again. In a group, pieces are placed from long to
short, each into the fullest row that has room. The rows' free places are the leaves of a
segment tree, in which the least sufficient one is found in log2(context) steps.

Documents that are longer than a row are split losslessly: their pieces, in order, are the document's ids.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.tokens import RANKS, encoder, ids_of

#: An id that the vocabulary leaves free; it ends every document and fills what is left of a row.
END = 50256
CONTEXT = 2048
GROUP_TOKENS = 1 << 21


class Capacity:
    """A segment tree over 0 ... most: which free capacities occur among the open rows."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = bytearray(2 * self.size)

    def mark(self, free: int, there: bool) -> None:
        i = free + self.size
        self.tree[i] = there
        while i > 1:
            i >>= 1
            now = self.tree[2 * i] | self.tree[2 * i + 1]
            if self.tree[i] == now:
                return
            self.tree[i] = now

    def least(self, need: int) -> int | None:
        """The least capacity there is of `need` or more."""
        i = need + self.size
        if self.tree[i]:
            return need
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit(sizes: list[int], context: int) -> list[list[int]]:
    """Rows of piece numbers, by best fit decreasing; pieces of equal size in their order."""
    rows: list[list[int]] = []
    open_rows: dict[int, list[int]] = defaultdict(list)
    tree = Capacity(context)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        free = tree.least(sizes[i])
        if free is None:
            row, free = len(rows), context
            rows.append([])
        else:
            row = open_rows[free].pop()
            if not open_rows[free]:
                tree.mark(free, False)
        rows[row].append(i)
        free -= sizes[i]
        if free:
            open_rows[free].append(row)
            tree.mark(free, True)
    return rows


def _rows(first: int, ids: list, docs: list, pieces: list[int], context: int, wide, end: int, kind) -> pa.RecordBatch:
    """One packed group as rows."""
    size = [len(x) for x in ids]
    packed = best_fit(size, context)
    matrix = np.full((len(packed), context), end, wide)
    place = np.zeros((len(packed), context), np.int32)
    cuts = []
    steps = np.arange(context, dtype=np.int32)
    for r, row in enumerate(packed):
        cut = np.cumsum([0] + [size[i] for i in row])
        for i, at in zip(row, cut.tolist()):
            matrix[r, at : at + size[i]] = ids[i]
            place[r, at : at + size[i]] = steps[: size[i]]
        cuts.append(cut.tolist())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(first + np.arange(len(packed))),
            pa.array([c[-1] for c in cuts], pa.int32()),
            pa.array([x.tobytes() for x in matrix], pa.binary()),
            pa.array(cuts, pa.list_(pa.int32())),
            pa.array([x.tobytes() for x in place], pa.binary()),
            pa.array([[docs[i] for i in row] for row in packed], pa.list_(kind)),
            pa.array([[pieces[i] for i in row] for row in packed], pa.list_(pa.int32())),
        ],
        ["row_id", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "pieces"],
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    context: int = CONTEXT,
    ranks: str = RANKS,
    end: int = END,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Packed rows: row_id, n_tokens, ids, cu_seqlens, positions, doc_ids, pieces.

    `ids`: `context` little-endian ids, of 2 bytes if all ids fit, else 4: one row of the matrix.
    `cu_seqlens`: where segments begin, and the end of the last. `positions`: `context` 4-byte
    integers that start again at 0 with each segment. Every document's ids are followed by `end`,
    so a null or empty text is that one id. Rows that repeat are packed as often as they occur. Ids
    may be null. `row_id` is unique; rows follow the input's partitions. `group_tokens` bounds a
    task's memory and has little effect on how full rows are. Empty input gives no rows.
    """
    most = max(encoder(ranks).n_vocab, end + 1)
    wide = np.dtype("<u2" if most <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], wide)
        first = TaskContext.get().partitionId() << 40
        ids, names, pieces, held, kind = [], [], [], 0, pa.null()
        for batch in batches:
            kind = batch.column("doc_id").type
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                found = ids_of(text, ranks).astype(wide) if text else last[:0]
                found = np.concatenate((found, last))
                for k, at in enumerate(range(0, len(found), context)):
                    piece = found[at : at + context]
                    ids.append(piece)
                    names.append(name)
                    pieces.append(k)
                    held += len(piece)
                    if held >= group_tokens:
                        out = _rows(first, ids, names, pieces, context, wide, end, kind)
                        first += out.num_rows
                        ids, names, pieces, held = [], [], [], 0
                        yield from _small(out)
        if ids:
            yield from _small(_rows(first, ids, names, pieces, context, wide, end, kind))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        "row_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
        f"doc_ids array<{kind}>, pieces array<int>",
    )


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
