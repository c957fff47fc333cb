"""Benchmark decontamination by template canonicalisation.

A text becomes a row of tokens; numbers, names and units of measure become typed placeholders.
Windows of eight template tokens of every document are looked up among those of the benchmark,
by a hash join. Matches of one document and item on one alignment are put together: they must
agree on what each placeholder stands for (the same value in the item is the same value in the
document; two values may become one), and cover enough of the item. Windows that repeat the item's own
values need not agree with others where they alone cover the share asked for. So a question whose numbers or names
were exchanged is caught, and one that merely has the same shape is not. Windows of nearly nothing
but placeholders, and items shorter than a window, are looked up by their own words.

The documents' windows never leave their task unless a bitmap of the benchmark's hashes has their
bit. The bitmap has a fixed size, whatever the benchmark's; the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.shared import among, bitmap, free_names, stored

WIDTH = 8
#: A window with fewer tokens that are no placeholders is compared word by word.
LITERALS = 3
LITERAL, NUMBER, NAME, UNIT = range(4)
SIGNS = ("", "<number>", "<name>", "<unit>")
#: Units of measure, recognised after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce "
    "ounces pound pounds ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day "
    "days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees kmh mph"
).split()

_BLOCK = 1 << 19
_GROW = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20260101)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SIGN = _rng.integers(1, 1 << 63, 4, dtype=np.uint64)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT = _table(b"0123456789")
_DOT = _table(b".,")
_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_WORD = _DIGIT | _UPPER | _LOWER | _table(bytes(range(128, 256)))
_MARK = _table(b".!?:;\"\n")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass
class Tokens:
    """Tokens of several texts in a row; `low` is the folded buffer that start and end point into."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    kind: np.ndarray
    value: np.ndarray

    def word(self, i: int) -> str:
        return self.low[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def _hashes(folded: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.arange(len(folded)) - np.repeat(first, size)
    return np.add.reduceat(_BYTE[folded] * _PLACE[at & 255], first)


def tokens(texts: list[bytes | None]) -> Tokens:
    """Letters (ASCII and Latin-1) are folded; other bytes from 128 up belong to words as they are."""
    parts = [t or b"" for t in texts]
    raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    begins = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]]) if parts else np.zeros(0, np.int64)
    empty = np.zeros(0, np.int64)
    if not len(raw):
        return Tokens(raw, empty, empty, empty, empty, np.zeros(0, np.uint64))
    digit, dot = _DIGIT[raw], _DOT[raw]
    word = _WORD[raw]
    word[1:-1] |= dot[1:-1] & digit[:-2] & digit[2:]
    low = _FOLD[raw]
    accent = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    low[1:][accent] += 32
    step = np.diff(word.view(np.int8), prepend=0)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(start):
        return Tokens(low, empty, empty, empty, empty, np.zeros(0, np.uint64))
    size = end - start
    first = np.cumsum(size) - size
    value = _hashes(low[word], first, size)
    numeric = np.add.reduceat((digit | dot)[word].astype(np.int64), first) == size
    small = np.add.reduceat((_LOWER[raw] | (raw >= 0x80))[word].astype(np.int64), first) > 0
    capital = _UPPER[raw[start]] | (np.append(accent, False)[start])
    marks = np.concatenate(([0], np.cumsum(_MARK[raw])))
    opens = np.ones(len(start), bool)
    opens[1:] = marks[start[1:]] > marks[end[:-1]]
    text = np.searchsorted(begins, start, "right") - 1
    kind = np.zeros(len(start), np.int64)
    kind[capital & small & ~opens & ~numeric] = NAME
    kind[numeric] = NUMBER
    after = np.zeros(len(start), bool)
    after[1:] = numeric[:-1] & (text[1:] == text[:-1])
    kind[after & (kind == LITERAL) & np.isin(value, _UNIT_VALUES)] = UNIT
    return Tokens(low, start, end, text, kind, value)


def _values_of(words: list[str]) -> np.ndarray:
    raw = [np.frombuffer(w.encode(), np.uint8) for w in words]
    size = np.array([len(r) for r in raw])
    return _hashes(np.concatenate(raw), np.cumsum(size) - size, size)


_UNIT_VALUES = _values_of(UNITS)


def windows(t: Tokens, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, hash, whether of the words themselves) of every window of one text.

    Windows of less than `WIDTH` tokens are always of words.
    """
    n = len(t.start) - width + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    sign = np.where(t.kind == LITERAL, t.value, _SIGN[t.kind])
    plain = np.zeros(n, np.int64)
    for k in range(width):
        plain += t.kind[k : n + k] == LITERAL
    exact = (plain < LITERALS) | (width < WIDTH)
    h = np.where(exact, np.uint64(width), np.uint64(0))
    for k in range(width):
        h = h * _GROW + np.where(exact, t.value[k : n + k], sign[k : n + k])
    h ^= h >> np.uint64(32)
    h *= _GROW
    at = np.flatnonzero(t.text[:n] == t.text[width - 1 :])
    return at, h[at], exact[at]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.diff(np.cumsum(size) // _BLOCK)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def _windows_of(keys: list[str], hashes=None, short: tuple[int, ...] = ()):
    """For mapInArrow: (keys, place, hash, template, slots, n_tokens) of each window, or of those in the bitmap.

    With a bitmap, also of windows of the `short` widths; without one, a short text is a window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                t = tokens(block.column("text").cast(pa.binary()).to_pylist())
                count = np.bincount(t.text, minlength=block.num_rows)
                found = []
                for size in (WIDTH, *(range(1, WIDTH) if hashes is None else short)):
                    at, h, exact = windows(t, size)
                    if size < WIDTH and hashes is None:
                        hit = count[t.text[at]] == size
                    else:
                        hit = slice(None) if hashes is None or not len(at) else among(hashes.value, h)
                    found.append((at[hit], h[hit], exact[hit], np.full(len(at), size)[hit]))
                at, h, exact, width = (np.concatenate(x) for x in zip(*found))
                first = np.searchsorted(t.text, np.arange(block.num_rows))
                template, slots = [], []
                for i, n, own in zip(at.tolist(), width.tolist(), exact.tolist()):
                    span = range(i, i + n)
                    kinds = t.kind[i : i + n].tolist()
                    if own:
                        template.append("=" + " ".join(map(t.word, span)))
                    else:
                        template.append(" ".join(SIGNS[k] or t.word(j) for j, k in zip(span, kinds)))
                    slots.append([] if n < WIDTH else [SIGNS[k] + t.word(j) for j, k in zip(span, kinds) if k])
                row = t.text[at]
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[block.column(k).take(taken) for k in keys],
                        pa.array((at - first[row]).astype(np.int32)),
                        pa.array(h.view(np.int64)),
                        pa.array(template, pa.string()),
                        pa.array(slots, pa.list_(pa.string())),
                        pa.array(count[row].astype(np.int32)),
                    ],
                    [*keys, "place", "hash", "template", "slots", "n_tokens"],
                )

    return run


_OUT = "place int, hash long, template string, slots array<string>, n_tokens int"


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """Per (document, item): windows, tokens of the item covered, and whether values are the item's own."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    known = stored(items.mapInArrow(_windows_of(["item_id"]), f"item_id {kind}, {_OUT}"))
    hashes = bitmap(known.select("hash"))
    short = tuple(r[0] for r in known.where(F.col("n_tokens") < WIDTH).select("n_tokens").distinct().collect())
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(1), text).alias("d2"),
        text.alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = rows.mapInArrow(
        _windows_of(["doc_id", "d1", "d2"], hashes, short), f"doc_id {kind}, d1 long, d2 long, {_OUT}"
    ).withColumnsRenamed({"place": "at", "slots": "values", "n_tokens": "doc_tokens"})
    same = seen.join(known, ["hash", "template"])
    pair = F.transform(F.arrays_zip("slots", "values"), lambda x: F.struct(x["slots"].alias("a"), x["values"].alias("b")))
    lined = same.groupBy("doc_id", "d1", "d2", "item_id", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.collect_set("place").alias("places"),
        F.collect_set(F.when(F.col("slots") == F.col("values"), F.col("place"))).alias("own"),
        F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs"),
        F.first("n_tokens").alias("n_tokens"),
    )
    size = F.least(F.lit(WIDTH), "n_tokens")
    spread = lambda places: F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + size - 1)))))
    judged = lined.withColumns(
        {
            "consistent": F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))) == F.size("pairs"),
            "covered": spread("places"),
            "own_covered": spread("own"),
            "same_values": F.forall("pairs", lambda p: p["a"] == p["b"]),
        }
    )
    return judged


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    min_covered: int = 13,
    min_share: float = 0.8,
) -> DataFrame:
    """One row per leaked item of a document: doc_id, item_id, windows, covered, item_tokens, same_values.

    An item is leaked if one alignment covers `min_covered` of its tokens, or `min_share` of
    all, and its placeholders agree; or if windows with the item's own values cover `min_share`. Windows with fewer than three literals count where their words are the item's own, and
    items with fewer than eight tokens are found where all their words are. Null and empty texts have no tokens. Rows of equal id and text give one row, equal ids of
    unlike texts one row each. `same_values` is false for an item whose numbers, names or units
    were exchanged. An empty table on either side gives no rows.
    """
    found = _matches(docs, benchmark, id_col, text_col, item_col, item_text)
    enough = (F.col("covered") >= min_covered) | (F.col("covered") >= min_share * F.col("n_tokens"))
    verbatim = F.col("own_covered") >= min_share * F.col("n_tokens")
    places = F.when(F.col("consistent"), F.col("places")).otherwise(F.col("own"))
    covered = F.when(F.col("consistent"), F.col("covered")).otherwise(F.col("own_covered"))
    return (
        found.where((F.col("consistent") & enough) | verbatim)
        .withColumns({"same_values": F.col("same_values") | ~F.col("consistent"), "places": places, "covered": covered})
        .groupBy("doc_id", "d1", "d2", "item_id")
        .agg(
            F.max(F.size("places")).alias("windows"),
            F.max("covered").alias("covered"),
            F.first("n_tokens").alias("item_tokens"),
            F.bool_or("same_values").alias("same_values"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` in which no item leaked, with all their columns, whatever their names.

    Null and empty texts hold no item and stay, repeated rows stay or go together. An empty
    benchmark takes nothing away.
    """
    d1, d2 = free_names(docs, "_llm_d1", "_llm_d2")
    marked = docs.withColumns({d1: F.xxhash64(text_col), d2: F.xxhash64(F.lit(1), F.col(text_col))})
    bad = leaks(docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")), benchmark, **options)
    bad = stored(bad.select("d1", "d2").distinct())
    return marked.join(
        bad, (marked[d1] == bad["d1"]) & (marked[d2] == bad["d2"]), "left_anti"
    ).select(*docs.columns)
