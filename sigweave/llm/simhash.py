"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits; texts are linked where 4 or fewer bits differ. Fingerprints are cut
into m segments. With r = m * q + s errors, one of the first s + 1 segments has at most q of
them, or one of the others at most q - 1. So each fingerprint asks, per segment, for all values
in that small Hamming ball, an equi-join fetches the table's matches, and the join condition
compares complete fingerprints. Every link is found, whatever m is; m only balances the number
of questions against the size of a table entry, and follows 64 / log2(number of fingerprints).

Exact copies share a fingerprint and take part once, so a huge group of copies costs one row.

`keep_one`, for cleaning, links texts by the Jaccard similarity of five-word shingles: the rarest shingles of
each text find all candidates, the sets of shingles decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.llm.shared import bitmap, components, free_names, rows_among, stored

BITS = 64
_CHUNK = 1 << 16


def _fingerprint(text: str | None, width: int) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(size + 1) - size - 1
    n = max(1, len(words) - width + 1)
    last = (first + size)[-n:].tolist()
    first = first[:n].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        some = zip(first[at : at + _CHUNK], last[at : at + _CHUNK])
        h = np.array([digest(line[i:j], 42) for i, j in some], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    """SimHash of the lower-cased text's word shingles, as a signed long; no words (null): 0.

    Named not deterministic only so that Spark makes it once, not again for each filter on it.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return of.asNondeterministic()(text)


def _layout(m: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each segment."""
    q, s = divmod(radius, m)
    edges = [BITS * i // m for i in range(m + 1)]
    return [
        (lo, hi - lo, q if i <= s else q - 1)
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
        if (q if i <= s else q - 1) >= 0
    ]


def _masks(bits: int, radius: int) -> list[int]:
    """Differences of at most `radius` of `bits` bits."""
    balls = [{0}]
    for _ in range(radius):
        balls.append({x ^ (1 << b) for x in balls[-1] for b in range(bits)})
    return sorted(set().union(*balls))


def _ball(seg: int, value: Column, masks: list[int]) -> Column:
    """The keys (seg, value) that a segment's value asks for."""
    around = F.array(*[F.lit(x).cast("long") for x in masks])
    return F.transform(around, lambda x: F.struct(F.lit(seg).alias("seg"), value.bitwiseXOR(x).alias("value")))


def links(fingerprints: DataFrame, radius: int = 4, segments: int | None = None) -> DataFrame:
    """(a, b), a > b, of distinct fingerprints `fp` at most `radius` bits apart.

    `segments`: how many to cut into; None follows the number of fingerprints.
    """
    if segments is None:
        n = max(2, fingerprints.count())
        segments = min(radius, max(2, round(BITS / math.log2(n))))
    asked, table = [], []
    for i, (shift, bits, near) in enumerate(_layout(segments, radius)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
        table.append(F.struct(F.lit(i).alias("seg"), value.alias("value")))
        asked.append(_ball(i, value, _masks(bits, near)))
    asked = fingerprints.select(F.col("fp").alias("a"), F.explode(F.flatten(F.array(*asked))).alias("k"))
    table = fingerprints.select(F.col("fp").alias("b"), F.explode(F.array(*table)).alias("k"))
    asked = asked.select("a", F.col("k.seg").alias("seg"), F.col("k.value").alias("value"))
    table = table.select("b", F.col("k.seg").alias("tseg"), F.col("k.value").alias("tvalue"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return asked.join(
        table, (F.col("seg") == F.col("tseg")) & (F.col("value") == F.col("tvalue")) & (F.col("a") > F.col("b")) & near
    ).select("a", "b")


def groups(fingerprints: DataFrame, radius: int = 4, segments: int | None = None) -> DataFrame:
    """(fp, root) of every distinct fingerprint; root is the same within a component."""
    found = components(links(fingerprints, radius, segments))
    return fingerprints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4
) -> DataFrame:
    """One row per row of `docs`: its id, fingerprint (hex) and component_id.

    component_id is the smallest id reachable over links. Null and empty texts have fingerprint
    zero and are linked like any other. A null id is never the smallest unless its component has
    no other; then component_id is null. Repeated rows stay repeated. Other columns are ignored.
    No rows in, no rows out.
    """
    thin = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), width).alias("fp")))
    each = stored(thin.groupBy("fp").agg(F.min("doc_id").alias("least")))
    group = groups(each.select("fp"), radius).join(each, "fp")
    least = group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = group.join(least, "root").select("fp", "component_id")
    return thin.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct hashes of the lower-cased text's word shingles, ascending; fewer words: one of the whole sequence."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(size + 1) - size - 1
    n = max(1, len(words) - width + 1)
    last = (first + size)[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(first[:n].tolist(), last)
    return np.unique(np.fromiter((digest(line[i:j], 42) for i, j in spans), np.uint64, n))


#: Shingles are counted by so many leading bits of their hash, in pages of 2 ** _PAGE counts.
_SLOT, _PAGE = 18, 12


def commonness(texts: DataFrame, width: int = 5) -> Broadcast[np.ndarray]:
    """In how many of the texts (column `text`) a shingle occurs, summed over those that share their leading bits.

    Of fixed size. The order that it gives is the same for all texts, which is all that results need.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _SLOT, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total[_shingles(text.as_py(), width) >> np.uint64(64 - _SLOT)] += 1
        pages = total.reshape(-1, 1 << _PAGE)
        some = np.flatnonzero(pages.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array([pages[i].tobytes() for i in some], pa.binary())], ["page", "counts"]
        )

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in rows["counts"])
        return pa.table({"page": rows["page"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((1 << (_SLOT - _PAGE), 1 << _PAGE), np.int64)
    shape = "page long, counts binary"
    for row in texts.mapInArrow(count, shape).groupBy("page").applyInArrow(add, shape).collect():
        out[row.page] = np.frombuffer(row.counts, np.int64)
    return texts.sparkSession.sparkContext.broadcast(out.ravel())


#: Longs of a sketch; a set's sketch has a bit for whether an odd number of its hashes fall on it.
_SKETCH = 8


def _sketch(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes % np.uint64(64 * _SKETCH)).astype(np.int64), minlength=64 * _SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def signature(text: Column, common: Broadcast[np.ndarray], alike: float = 0.8, width: int = 5) -> Column:
    """(n, rare, sketch) of a text: how many distinct shingles, its rarest ones, so many that similar texts share
    one, and the sketch of all. Each shingle that only one of two texts has changes one bit between their sketches.

    Of two texts at least `alike`, n shingles of the one lack at most n - alike * n in the other. So if one
    more than that is taken of each, rarest first in one order for all texts, they have one in common. No
    words (null): 0 and a zero.
    """

    @F.arrow_udf("n int, rare array<long>, sketch array<long>")
    def of(texts: pa.Array) -> pa.Array:
        sizes, rare, sketches = [], [], []
        for text in texts:
            h = _shingles(text.as_py(), width)
            take = len(h) - math.ceil(alike * len(h) - 1e-6) + 1
            order = np.lexsort((h, common.value[h >> np.uint64(64 - _SLOT)]))[:take]
            sizes.append(len(h))
            rare.append(h[order].view(np.int64) if len(h) else np.zeros(1, np.int64))
            sketches.append(_sketch(h))
        longs = pa.list_(pa.int64())
        columns = pa.array(sizes, pa.int32()), pa.array(rare, longs), pa.array(sketches, longs)
        return pa.StructArray.from_arrays(columns, ["n", "rare", "sketch"])

    return of.asNondeterministic()(text)


_ROUNDS = 3


def places(signed: DataFrame) -> DataFrame:
    """(shingle, node, n, at): the rare shingles that two or more `node`s have, from one row (node, n, rare) each.

    Of shingles that the same nodes have, only the first in the order of `signature` stays: it makes the same
    pairs, and is the first that they share if one of the others is.
    """
    each = signed.select(F.explode("rare").alias("shingle"))
    shared = stored(each.groupBy("shingle").count().where("count > 1").select("shingle"))
    rows = signed.select("node", "n", F.posexplode("rare").alias("at", "shingle")).select("shingle", "node", "n", "at")
    # What a full bitmap lets through beside them occurs once.
    who = [F.count("*").alias("nodes"), *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"who_{i}") for i in (0, 1)]]
    held = rows_among(rows, "shingle", bitmap(shared)).groupBy("shingle").agg(F.sum("at").alias("at"), *who)
    first = F.min(F.struct("at", "shingle")).alias("first")
    held = held.where("nodes > 1").groupBy("nodes", "who_0", "who_1").agg(first)
    chosen = stored(held.select(F.col("first.shingle").alias("shingle")))
    return stored(rows_among(rows, "shingle", bitmap(chosen)).join(chosen, "shingle", "left_semi"))


def _possible(alike: float) -> Column:
    """Whether texts a and b can be `alike`, if the shingle they meet at is the first that they share."""
    sizes = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(alike) - 1e-6
    most = 1 + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) - 1
    return sizes & ((F.col("n_a") == 0) | (most * (1 + alike) >= alike * (F.col("n_a") + F.col("n_b")) - 1e-6))


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "at", "root")])


def _pairs(met: DataFrame, alike: float) -> DataFrame:
    """(a, b), a > b, of the nodes that met and may be `alike`."""
    return met.where(_possible(alike)).select(
        F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")
    ).distinct()


def _with_one(rows: DataFrame, turn: int, alike: float) -> DataFrame:
    """Pairs of each node in another component with one node of each shingle, drawn alike for all shingles."""
    drawn = F.min_by(F.struct("node", "n", "at", "root"), F.xxhash64("node", F.lit(turn)))
    one = rows.groupBy("shingle").agg(drawn.alias("one")).select("shingle", "one.*")
    met = _side(rows, "a").join(_side(one, "b"), "shingle").where("root_a <> root_b")
    return _pairs(met, alike)


def _with_all(rows: DataFrame, signed: DataFrame, alike: float) -> DataFrame:
    """Pairs of all nodes of a shingle that are in different components. One of each pair is not in its largest.

    Sketches that differ in more bits than similar texts have shingles apart leave a pair out.
    """
    sizes = rows.groupBy("shingle", "root").count()
    largest = sizes.groupBy("shingle").agg(F.max(F.struct("count", "root")).alias("m")).select("shingle", F.col("m.root").alias("main"))
    bits = signed.select("node", *[F.col("sketch")[i].alias(f"bits_{i}") for i in range(_SKETCH)])
    rows = stored(rows.join(bits, "node"))
    rest = rows.join(largest, "shingle").where("root <> main").select(rows.columns)
    left, right = (
        some.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "shingle"])
        for some, side in ((rest, "a"), (rows, "b"))
    )
    apart = sum(F.bit_count(F.col(f"bits_{i}_a").bitwiseXOR(F.col(f"bits_{i}_b"))) for i in range(_SKETCH))
    near = apart * F.lit(1 + alike) <= (F.col("n_a") + F.col("n_b")) * F.lit(1 - alike) + 1e-6
    return _pairs(left.join(right, "shingle").where((F.col("root_a") != F.col("root_b")) & near), alike)


def _shingle_set(text: Column, width: int) -> Column:
    """The distinct hashes of a text's shingles, as bytes."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_shingles(t.as_py(), width).tobytes() for t in texts], pa.binary())

    return of(text)


def _jaccard_at_least(a: Column, b: Column, alike: float) -> Column:
    """Whether two sets of `_shingle_set` are `alike`."""

    @F.arrow_udf("boolean")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= alike * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return of(a, b)


def similar_groups(docs: DataFrame, text_col: str = "text", alike: float = 0.8, width: int = 5) -> DataFrame:
    """(node, root) of every distinct text, `node` its xxhash64; root is the same within a component.

    Texts are linked if the Jaccard similarity of their sets of shingles is at least `alike`; no link is left out.
    Candidates share one of their rarest shingles, see `signature`. In each of `_ROUNDS`, the texts that share one
    are compared with one of them. Shingles whose texts are all in one component by then can add
    nothing and are left out; after the rounds all texts of a shingle that are in different components are compared. So
    a group of near copies costs a few comparisons a text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("node"), text.alias("text"))
    common = commonness(texts.select("text"), width)
    signed = texts.select("node", signature(F.col("text"), common, alike, width).alias("s"))
    signed = stored(signed.groupBy("node").agg(F.any_value("s").alias("s")).select("node", "s.*"))
    rows = places(signed).withColumn("root", F.col("node"))

    def compared(some: DataFrame) -> DataFrame:
        """The pairs that are alike. Only texts in a pair are cut into shingles again and shuffled."""
        some = stored(some)
        nodes = some.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = rows_among(texts, "node", bitmap(nodes)).join(nodes, "node", "left_semi")
        wanted = wanted.groupBy("node").agg(F.any_value("text").alias("text"))
        wanted = wanted.select("node", _shingle_set(F.col("text"), width).alias("set"))
        left = wanted.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
        right = wanted.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
        both = some.join(left, "a").join(right, "b")
        return both.where(_jaccard_at_least(F.col("set_a"), F.col("set_b"), alike)).select("a", "b")

    found = rows.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for turn in range(_ROUNDS + 1):
        some = _with_one(rows, turn, alike) if turn < _ROUNDS else _with_all(rows, signed, alike)
        found = stored(found.unionByName(compared(some)))
        whole = components(found)
        if turn == _ROUNDS:
            break
        rows = rows.drop("root").join(whole, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_ = rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        rows = stored(rows.join(open_.select("shingle"), "shingle", "left_semi").select("shingle", "node", "n", "at", "root"))
        if rows.isEmpty():
            break
    return signed.select("node").join(whole, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row of the smallest id.

    Components as in `similar_groups`. Rows of equal id count as copies if they are in one component: one of
    them stays, the one with the smallest text. A component whose ids are all null keeps one row too. All
    columns stay as they are, whatever their names. Null, empty and blank texts are copies of each other. No
    rows in, no rows out.
    """
    node, rank, root, lowest = free_names(docs, "_llm_node", "_llm_rank", "_llm_root", "_llm_best")
    r, again_id = free_names(docs, "_llm_r", "_llm_id")
    marked = docs.withColumn(node, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    group = stored(similar_groups(docs, text_col, alike, width))
    thin = marked.select(F.col(node).alias("node"), F.col(id_col).alias("id")).join(group, "node")
    # Counted per id first, so that no hot group meets in one task.
    thin = stored(thin.groupBy("root", "node", "id").count())
    best = thin.groupBy("root").agg(F.min("id").alias("best")).withColumnRenamed("root", "r")
    # A text without its component's smallest id has no row to keep.
    best = thin.join(best, (F.col("root") == F.col("r")) & F.col("id").eqNullSafe(F.col("best")))
    best = best.select(F.col("node").alias(node), F.col("root").alias(root), F.col("best").alias(lowest))
    kept = marked.join(best, node).where(F.col(id_col).eqNullSafe(F.col(lowest)))
    # Ids seldom repeat within a component; only rows of those that do are put in an order.
    again = thin.groupBy("root", "id").agg(F.sum("count").alias("rows")).where("rows > 1")
    again = stored(again.select(F.col("root").alias(r), F.col("id").alias(again_id)))
    same = (F.col(root) == F.col(r)) & F.col(id_col).eqNullSafe(F.col(again_id))
    one = W.partitionBy(root, id_col).orderBy(F.col(text_col).asc_nulls_last())
    several = kept.join(again, same, "left_semi").withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    single = kept.join(again, same, "left_anti")
    return single.select(*docs.columns).unionByName(several.select(*docs.columns))
