"""Removal of repeated byte strings by prefix-free parsing.

A byte is removed if a string of `length` bytes that covers it starts anywhere else, in the same
document or another. The texts are parsed at triggers of a rolling hash: of the hashes of the
8-byte strings in the first half of a window of `length` bytes, the smallest is its trigger.
Equal windows have the trigger at the same place, so windows need comparing only where they
hang on equal triggers. Consecutive windows of a text share a trigger; together they are a
phrase. A phrase is known by the class of what follows its trigger for half a length (`m`, which
all its windows contain) and by the class of all its bytes (`f`).

In the order of all suffixes of the corpus, strings that share `length` bytes stand next to each
other. Only these classes of equal beginnings matter here, not their order, so suffixes of the
parse are put together by class:

1. Phrases whose `m` occurs once have no repeated window. This is settled for nearly all text,
   and by partial aggregation, with one row per hundred bytes.
2. A phrase whose `f` occurs twice or more is repeated as a whole.
3. Where unlike phrases share an `m`, one phrase of each class `f` is cut into runs of 16
   windows, and these are judged in the same way, by what all windows of the run contain and by all
   its bytes. Only of unlike runs is every window compared. These are the edges of repeated passages.

Removed ranges go back to the texts by digest. Copies of a text share their rows, ranges and
digest. A repeated class is never gathered: counts, least and greatest are all it takes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.shared import among, batches_among, bitmap, rows_among, stored

GRAM = 8
_RUN = 16
_BLOCK = 1 << 19
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_PHRASE = "m long, f long, t int, lo int, hi int, n int, more array<int>"


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    rest = width - have
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def phrases(raw: bytes, begin: np.ndarray, size: np.ndarray, length: int):
    """(text, m, f, t, lo, hi) of each phrase of the texts in `raw`, t being the trigger's place in its text.

    The phrase's windows start at t - hi ... t - lo.
    """
    none = [np.zeros(0, np.int64)] * 6
    width = length // 2 - GRAM + 1
    long = np.flatnonzero(size >= length)
    if not len(long):
        return none
    grams = np.ndarray(len(raw) - GRAM + 1, np.uint64, raw, strides=(1,))
    key = grams * _SPREAD
    key ^= key >> np.uint64(29)
    key *= _SPREAD
    key &= _HIGH
    key |= np.arange(len(key), dtype=np.uint64)
    trigger = (_sliding_least(key, width) & _LOW).astype(np.int64)
    count = size[long] - length + 1
    text = np.repeat(long, count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[text]
    trigger = trigger[start]
    opens = np.flatnonzero(np.append(True, (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])))
    closes = np.append(opens[1:], len(start)) - 1
    at, first, last, text = trigger[opens], start[opens], start[closes], text[opens]
    digest, after = xxhash.xxh64_intdigest, length - width + 1
    m = np.array([digest(raw[i : i + after]) for i in at.tolist()], np.uint64)
    f = np.array(
        [digest(raw[i : k + length], (j - i) * length + k - i) for i, j, k in zip(first.tolist(), at.tolist(), last.tolist())],
        np.uint64,
    )
    return text, m.view(np.int64), f.view(np.int64), at - begin[text], at - last, at - first


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, bytes, np.ndarray, np.ndarray]]:
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = (np.flatnonzero(np.diff(np.cumsum(size) // _BLOCK)) + 1).tolist()
    for a, b in zip([0, *cut], [*cut, batch.num_rows]):
        if b > a:
            block = batch.slice(a, b - a)
            raw = b"".join(t or b"" for t in block.column("text").cast(pa.binary()).to_pylist())
            yield block, raw, np.cumsum(size[a:b]) - size[a:b], size[a:b]


def _parse(length: int, bits: Broadcast[bytes] | None = None):
    """For mapInArrow: the distinct phrases of every text, with all their places; of those in the bitmap if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, begin, size in _blocks(batch):
                text, m, f, t, lo, hi = phrases(raw, begin, size, length)
                if not len(text):
                    continue
                order = np.lexsort((t, f, m, text))
                text, m, f, t, lo, hi = (x[order] for x in (text, m, f, t, lo, hi))
                new = np.append(True, (text[1:] != text[:-1]) | (m[1:] != m[:-1]) | (f[1:] != f[:-1]))
                one = np.flatnonzero(new)
                n = np.diff(np.append(one, len(text)))
                if bits is not None:
                    hit = among(bits.value, m[one])
                    one, n = one[hit], n[hit]
                more = [t[i : i + k].tolist() if k > 1 else None for i, k in zip(one.tolist(), n.tolist())]
                rows = pa.array(text[one])
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("d1").take(rows),
                        block.column("d2").take(rows),
                        pa.array(m[one]),
                        pa.array(f[one]),
                        *[pa.array(x[one].astype(np.int32)) for x in (t, lo, hi)],
                        pa.array(n.astype(np.int32)),
                        pa.array(more, pa.list_(pa.int32())),
                    ],
                    ["d1", "d2", "m", "f", "t", "lo", "hi", "n", "more"],
                )

    return run


def _take_apart(length: int, run_of: int):
    """For mapInArrow: the phrases listed with a text, cut into runs of windows.

    (m, f, lo, hi, m2, f2): the phrase's class, the run's windows, the class of what all of them
    contain and of all their bytes. Copies of a text that follow each other count as one.
    """
    digest = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, key in enumerate(zip(batch.column("d1").to_pylist(), batch.column("d2").to_pylist())):
                if key == last:
                    continue
                last = key
                parts = batch.column("parts")[i].values
                raw = texts[i].as_py()
                for at in range(0, len(parts), 1000):
                    out = []
                    some = parts.slice(at, 1000)
                    for m, f, t, first, end in zip(*(some.field(name).to_numpy().tolist() for name in ("m", "f", "t", "lo", "hi"))):
                        for a in range(first - first % run_of, end + 1, run_of):
                            lo, hi = max(first, a), min(end, a + run_of - 1)
                            inner = digest(raw[t - a : t - a - run_of + 1 + length], a)
                            out.append((m, f, lo, hi, inner, digest(raw[t - hi : t - lo + length], lo * length + hi)))
                    m, f, lo, hi, m2, f2 = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(m, pa.int64()),
                            pa.array(f, pa.int64()),
                            pa.array(lo, pa.int32()),
                            pa.array(hi, pa.int32()),
                            pa.array(np.array(m2, np.uint64).view(np.int64)),
                            pa.array(np.array(f2, np.uint64).view(np.int64)),
                        ],
                        ["m", "f", "lo", "hi", "m2", "f2"],
                    )

    return run


def _runs(rows: DataFrame, classes: DataFrame, length: int, run_of: int) -> DataFrame:
    """The listed phrases (m, f, d1, d2, t, lo, hi), taken apart beside their texts."""
    parts = classes.groupBy("d1", "d2").agg(F.collect_list(F.struct("m", "f", "t", "lo", "hi")).alias("parts"))
    parts = stored(parts)
    texts = rows_among(rows.select("d1", "d2", "text"), "d1", bitmap(parts.select("d1")))
    return texts.join(parts, ["d1", "d2"]).mapInArrow(
        _take_apart(length, run_of), "m long, f long, lo int, hi int, m2 long, f2 long"
    )


def _merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Disjoint ranges, (k, 2), from overlapping ones."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, starts[1:] > reach[:-1])
    return np.stack([starts[opens], np.append(reach[:-1][opens[1:]], reach[-1])], axis=1).astype(np.int64)


def _cut(keep: bool):
    """For mapInArrow: texts with the listed ranges taken out; the bytes left are handed on if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _cut_rows(batch.slice(at, 256), keep)

    return run


def _cut_rows(batch: pa.RecordBatch, keep: bool) -> pa.RecordBatch:
    texts = batch.column("text").cast(pa.binary())
    ranges = batch.column("parts")
    n_bytes, removed, spans, sha, kept = [], [], [], [], []
    for i in range(batch.num_rows):
        raw = texts[i].as_py() or b""
        parts = ranges[i].values
        if parts is None:
            out = _merged(np.zeros(0), np.zeros(0))
        else:
            out = _merged(parts.field("start").to_numpy(), parts.field("end").to_numpy())
        gaps = np.concatenate(([0], out.ravel(), [len(raw)])).reshape(-1, 2).tolist()
        left = b"".join(raw[a:b] for a, b in gaps)
        n_bytes.append(len(raw))
        removed.append(len(raw) - len(left))
        spans.append(len(out))
        sha.append(hashlib.sha256(left).hexdigest())
        kept.append(left if keep else None)
    columns = [
        batch.column("doc_id"),
        pa.array(n_bytes, pa.int64()),
        pa.array(removed, pa.int64()),
        pa.array(spans, pa.int64()),
        pa.array(sha, pa.string()),
    ]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if keep:
        columns.append(pa.array(kept, pa.binary()))
        names.append("kept")
    return pa.RecordBatch.from_arrays(columns, names)


def _edges(rows: DataFrame, phrases: DataFrame, length: int) -> DataFrame:
    """(m, f, places): which windows are repeated, of phrases that occur once but share their `m`.

    `phrases`: one of each class, (m, f, d1, d2, t, lo, hi, n).
    """
    runs = stored(_runs(rows, phrases.drop("n"), length, _RUN))
    again = runs.groupBy("m", "m2").agg(F.count("*").alias("all"), F.min("f2").alias("least"), F.max("f2").alias("most"))
    again = again.where("`all` > 1").select("m", "m2", (F.col("least") != F.col("most")).alias("unlike"))
    runs = stored(runs.join(again, ["m", "m2"]))
    alike = runs.groupBy("m", "m2", "f2").agg(
        F.count("*").alias("n"), F.first("unlike").alias("unlike"), F.min(F.struct("f", "lo", "hi")).alias("one")
    )
    alike = stored(alike)
    places = phrases.select("m", F.col("f").alias("of"), "d1", "d2", "t")
    one = alike.where("unlike").select("m", "m2", "f2", F.col("one.f").alias("of"), "one.lo", "one.hi")
    one = one.join(places, ["m", "of"]).select(
        F.col("m2").alias("m"), F.col("f2").alias("f"), "d1", "d2", "t", "lo", "hi"
    )
    windows = stored(_runs(rows, one, length, 1).select("m", "f", "lo", "m2"))
    twice = windows.groupBy("m", "lo", "m2").agg(F.min("f").alias("least"), F.max("f").alias("most"))
    twice = twice.where("least <> most").select("m", "lo", "m2")
    some = windows.join(twice, ["m", "lo", "m2"]).groupBy("m", "f").agg(F.collect_set("lo").alias("places"))
    some = some.select(F.col("m").alias("m2"), F.col("f").alias("f2"), "places")
    all_of = alike.where("n > 1").select("m2", "f2", F.lit(None).cast("array<int>").alias("places"))
    some = some.join(all_of.select("m2", "f2"), ["m2", "f2"], "left_anti").unionByName(all_of)
    hit = runs.join(some, ["m2", "f2"]).select("m", "f", F.coalesce("places", F.sequence("lo", "hi")).alias("places"))
    hit = hit.groupBy("m", "f").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    return hit.join(phrases.where("n > 1").select("m", "f"), ["m", "f"], "left_anti")


def _ranges(found: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Removed ranges per text digest, from phrases and their repeated classes.

    `places` null: all the phrase's windows are repeated. Neighbouring places make one range.
    """
    places = F.array_sort("places")
    firsts = F.filter("places", lambda a, k: (k == 0) | (a > F.get("places", k - 1) + 1))
    lasts = F.filter("places", lambda a, k: (k == F.size("places") - 1) | (F.get("places", k + 1) > a + 1))
    found_places = F.arrays_zip(firsts.alias("first"), lasts.alias("last"))
    t = F.coalesce("more", F.array("t"))
    whole = F.transform(t, lambda x: F.struct((x - F.col("hi")).alias("start"), (x - F.col("lo") + length).alias("end")))
    some = F.flatten(
        F.transform(
            t,
            lambda x: F.transform(
                "near", lambda a: F.struct((x - a["last"]).alias("start"), (x - a["first"] + length).alias("end"))
            ),
        )
    )
    classes = classes.withColumn("places", places).select("m", "f", "places", found_places.alias("near"))
    spans = found.join(classes, ["m", "f"]).select(
        "d1", "d2", F.explode(F.when(F.col("places").isNull(), whole).otherwise(some)).alias("span")
    )
    return spans.groupBy("d1", "d2").agg(F.collect_set("span").alias("parts"))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep: bool = True
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left, if wanted).

    Texts are UTF-8 bytes, null is empty; shorter ones than `length` are left whole. Rows that
    repeat are copies like any other, each other's repeats. What is left need not be valid UTF-8. Other columns
    are ignored; an empty table gives no rows. `length` must be 32 or more.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(1), text).alias("d2"),
        text.alias("text"),
    )
    texts, phrase = rows.select("d1", "d2", "text"), f"d1 long, d2 long, {_PHRASE}"
    parsed = texts.mapInArrow(_parse(length), phrase)
    again = parsed.groupBy("m").agg(F.sum("n").alias("all"), F.min("f").alias("least"), F.max("f").alias("most"))
    again = stored(again.where("`all` > 1").select("m", (F.col("least") != F.col("most")).alias("unlike")))
    parsed = texts.mapInArrow(_parse(length, bitmap(again.select("m"))), phrase)
    found = stored(parsed.join(again, "m"))
    classes = found.groupBy("m", "f").agg(
        F.sum("n").alias("n"),
        F.first("unlike").alias("unlike"),
        F.min(F.struct("d1", "d2", "t", "lo", "hi")).alias("one"),
    )
    classes = stored(classes)
    whole = classes.where("n > 1").select("m", "f", F.lit(None).cast("array<int>").alias("places"))
    edges = _edges(rows, classes.where("unlike").select("m", "f", "one.*", "n"), length)
    ranges = _ranges(found, whole.unionByName(edges), length)
    ranges = stored(ranges)
    touched = bitmap(ranges.select("d1"))
    cut = rows_among(rows, "d1", touched).join(ranges, ["d1", "d2"], "left").select("doc_id", "text", "parts")
    # Texts that no range can belong to are not shuffled.
    none = F.lit(None).cast(ranges.schema["parts"].dataType).alias("parts")
    whole = rows.select("doc_id", "d1", "text", none)
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out += ", kept binary" if keep else ""
    whole = whole.mapInArrow(lambda batches: _cut(keep)(batches_among(batches, "d1", touched.value, False)), out)
    return cut.mapInArrow(_cut(keep), out).unionByName(whole)
