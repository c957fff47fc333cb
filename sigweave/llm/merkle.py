"""Merkle manifest of a table: a tree of hashes for each group of rows, and one over the groups.

A parent hashes its children's digests one after the other and keeps a copy of the hash state before
each child's place. To fold a changed child, the state of its place is resumed with the new digest and
the siblings to its right; those to its left are never hashed again.

Rows are ranked inside their group without bringing a group to one task: they are sorted by range, and
only counts for each range and group are added up. Blocks of 3 ** LEVELS neighbours are hashed in one
task each, then their digests in blocks again, so a group of any size takes a few rounds and no task
more than a block. On the way down every block is handed the path above it, states and all.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from sigweave.llm.shared import stored

WIDTH = 3
#: Levels of the tree that one task hashes at once: a block has WIDTH ** LEVELS nodes at most.
LEVELS = 6

_PATH = "left array<string>, right array<string>"


class Parent:
    """The digest of a run of children, with the hash state before each of them."""

    __slots__ = ("digest", "lefts", "rights", "states")

    def __init__(self, children: list[bytes]):
        state = sha256()
        self.states = []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.lefts = [b"".join(children[:k]) for k in range(len(children))]
        self.rights = [b"".join(children[k + 1 :]) for k in range(len(children))]

    def folded(self, place: int, child: bytes) -> bytes:
        """The digest with another child at one place."""
        return resumed(self.states[place], child, self.rights[place])


def resumed(state, child: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(child)
    state.update(right)
    return state.hexdigest().encode()


def levels_of(n: int) -> int:
    """Levels of parents above `n` nodes, until one remains."""
    levels = 0
    while n > 1:
        n = -(-n // WIDTH)
        levels += 1
    return levels


def climbed(digests: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents of some nodes, level by level; the last level has one."""
    found = []
    for _ in range(levels):
        found.append([Parent(digests[k : k + WIDTH]) for k in range(0, len(digests), WIDTH)])
        digests = [p.digest for p in found[-1]]
    return found


def digest_of(*columns: str | Column) -> Column:
    """Hexadecimal SHA-256 of a row: each value as its UTF-8 byte count, a colon and the value; null as `-`."""
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds `g`, the rank of the row's group, `i`, its rank in the group, both from 0, and `n`, the group's rows.

    Groups and rows go up, nulls first; strings by their bytes. Rows equal in all of `order` are told
    apart by their place in the input, so that copies without end spread over ranges as well.
    """
    keys = [group, *order, "_serial"]
    dealt = stored(
        rows.withColumn("_serial", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_serial")
        .select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    )
    counts = stored(dealt.groupBy("_range", group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first")))
    whole = W.partitionBy(group)
    order_of = whole.orderBy("_range")
    counts = counts.select(
        "*",
        (F.sum("_n").over(order_of) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("n"),
        F.min("_range").over(whole).alias("_start"),
    )
    # Groups are numbered where they start: those of earlier ranges, then those before it in its own.
    starts = counts.where("_range = _start")
    earlier = starts.groupBy("_range").agg(F.count("*").alias("_here"))
    earlier = earlier.select("_range", (F.sum("_here").over(W.orderBy("_range")) - F.col("_here")).alias("_earlier"))
    numbers = (
        starts.join(earlier, "_range")
        .select(
            F.col(group).alias("_group"),
            (F.col("_earlier") + F.row_number().over(W.partitionBy("_range").orderBy(group)) - 1).alias("g"),
        )
    )
    counts = counts.join(numbers, F.col(group).eqNullSafe(F.col("_group"))).select(
        F.col("_range").alias("_r"), "_group", "g", "n", (F.col("_before") - F.col("_first")).alias("_shift")
    )
    found = dealt.join(counts, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.withColumn("i", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_r", "_group", "_shift")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("b", F.expr(f"i div {WIDTH**LEVELS}"))


def _with_paths(nodes: DataFrame, paths: DataFrame):
    """Blocks of nodes, each with its path; new column ids, as both sides may come from one table."""
    return nodes.groupBy("g", "b").cogroup(paths.toDF(*paths.columns).groupBy("g", "b"))


def _levels(n: int) -> int:
    return LEVELS if n > WIDTH**LEVELS else levels_of(n)


def _digests(block: pa.Table) -> list[bytes]:
    return [x.encode() for x in block["digest"].to_pylist()]


def rise(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round, from (g, i, n, digest), and the roots (g, digest)."""
    rounds, roots = [_in_blocks(nodes)], None

    def block_root(block: pa.Table) -> pa.Table:
        block = block.sort_by("i")
        first = {name: block[name][0].as_py() for name in ("g", "b", "n")}
        digests = _digests(block)
        parents = climbed(digests, _levels(first["n"]))
        root = parents[-1][0].digest if parents else digests[0]
        n = -(-first["n"] // WIDTH**LEVELS)
        return pa.table({"g": [first["g"]], "i": [first["b"]], "n": [n], "digest": [root.decode()]})

    while True:
        last = rounds[-1].select("g", "b", "i", "n", "digest")
        made = stored(last.groupBy("g", "b").applyInArrow(block_root, "g long, i long, n long, digest string"))
        done = made.where("n = 1").select("g", "digest")
        roots = done if roots is None else roots.unionByName(done)
        more = made.where("n > 1")
        if more.isEmpty():
            return rounds, roots
        rounds.append(_in_blocks(more))


def _paths(parents: list[list[Parent]], at: int) -> tuple[list[str], list[str]]:
    left, right = [], []
    for level in parents:
        at, place = divmod(at, WIDTH)
        left.append(level[at].lefts[place].decode())
        right.append(level[at].rights[place].decode())
    return left, right


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """For each block of the first round (g, b) its path to the very top, from `tops` (g, left, right).

    A path has the digests left and right of each level's node, from low to high.
    """

    def children(block: pa.Table, path: pa.Table) -> pa.Table:
        block = block.sort_by("i")
        parents = climbed(_digests(block), _levels(block["n"][0].as_py()))
        above = path["left"][0].as_py(), path["right"][0].as_py()
        found = [_paths(parents, at) for at in range(block.num_rows)]
        kind = pa.list_(pa.string())
        return pa.table(
            {
                "g": block["g"],
                "b": block["i"],
                "left": pa.array([low[0] + above[0] for low in found], kind),
                "right": pa.array([low[1] + above[1] for low in found], kind),
            }
        )

    paths = None
    for k in range(len(rounds) - 1, -1, -1):
        ending = rounds[k].where(f"n <= {WIDTH**LEVELS}").select("g").distinct()
        mine = ending.join(tops, "g").select("g", F.lit(0).cast("long").alias("b"), "left", "right")
        paths = mine if paths is None else mine.unionByName(paths)
        if k:
            nodes = rounds[k].select("g", "b", "i", "n", "digest")
            paths = stored(_with_paths(nodes, paths).applyInArrow(children, f"g long, b long, {_PATH}"))
    return paths


def manifest(leaves: DataFrame, group: str, order: list[str], digest: str = "leaf", changed: str = "changed") -> DataFrame:
    """Adds to each leaf `subroot`, `root`, `proof`, `proof_sha256` and `folded_root`.

    `leaves` has a digest and, where a row is to be checked with another one, that in `changed`, else null.
    In each group leaves go up by `order` (nulls first, rows equal in it by digest); every three in a row get
    a parent, the last run may be shorter, until one node remains: the subroot, for a lone leaf the leaf.
    Subroots, by group (null first, by bytes), make the root in the same way. `proof` is the siblings'
    digests joined, one string a level, from the leaf to the root; a row alone in its run has an empty string there.
    `folded_root` is the root with `changed` in place of the leaf. Empty input gives no rows. Rows that repeat are
    leaves of their own. Other columns are kept; names that the result uses must not be among them.
    """
    taken = {"g", "i", "n", "b", "subroot", "root", "proof", "proof_sha256", "folded_root"} | {"_range", "_at", "_serial"}
    if clash := taken.intersection(leaves.columns):
        raise ValueError(f"columns with names of the result: {sorted(clash)}")
    rows = stored(ranked(stored(leaves), group, [*order, digest]))
    rounds, subroots = rise(rows.select("g", "i", "n", F.col(digest).alias("digest")))
    subroots = stored(subroots)
    n_groups = subroots.count()
    upper = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(n_groups).cast("long").alias("n"), "digest")
    above, top = rise(upper)
    root = top.first()
    root = root.digest if root else ""
    empty = F.array().cast("array<string>")
    start = above[0].sparkSession.range(1).select(F.lit(0).cast("long").alias("g"), empty.alias("left"), empty.alias("right"))

    def of_groups(block: pa.Table, path: pa.Table) -> pa.Table:
        block = block.sort_by("i")
        digests = _digests(block)
        parents = climbed(digests, _levels(block["n"][0].as_py()))
        up = path["left"][0].as_py(), path["right"][0].as_py()
        found = [_paths(parents, at) for at in range(block.num_rows)]
        kind = pa.list_(pa.string())
        left = pa.array([x[0] + up[0] for x in found], kind)
        right = pa.array([x[1] + up[1] for x in found], kind)
        return pa.table({"g": block["i"], "left": left, "right": right})

    top_nodes = above[0].select("g", "b", "i", "n", "digest")
    tops = stored(_with_paths(top_nodes, descend(above, start)).applyInArrow(of_groups, f"g long, {_PATH}"))
    paths = descend(rounds, tops).join(subroots.withColumnRenamed("digest", "subroot"), "g")

    kept = leaves.columns
    out = rows.select(*kept).schema
    names = {"digest": digest, "changed": changed}

    def of_leaves(block: pa.Table, path: pa.Table) -> pa.Table:
        block = block.sort_by("i")
        digests = [x.encode() for x in block[names["digest"]].to_pylist()]
        parents = climbed(digests, _levels(block["n"][0].as_py()))
        left, right = ([x.encode() for x in path[side][0].as_py()] for side in ("left", "right"))
        above = [(sha256(x), y) for x, y in zip(left, right)]
        others = [(x + y).decode() for x, y in zip(left, right)]
        proofs, hashes, folds = [], [], []
        for at, (old, new) in enumerate(zip(digests, block[names["changed"]].to_pylist())):
            now = new.encode() if new is not None else old
            proof = []
            for level in parents:
                at, place = divmod(at, WIDTH)
                parent = level[at]
                proof.append((parent.lefts[place] + parent.rights[place]).decode())
                now = parent.folded(place, now)
            for state, after in above:
                now = resumed(state, now, after)
            proof += others
            proofs.append(proof)
            hashes.append(sha256("".join(proof).encode()).hexdigest())
            folds.append(now.decode())
        found = block.select(kept)
        many = block.num_rows
        found = found.append_column("subroot", pa.array([path["subroot"][0].as_py()] * many, pa.string()))
        found = found.append_column("root", pa.array([root] * many, pa.string()))
        found = found.append_column("proof", pa.array(proofs, pa.list_(pa.string())))
        found = found.append_column("proof_sha256", pa.array(hashes, pa.string()))
        return found.append_column("folded_root", pa.array(folds, pa.string()))

    for name in ("subroot", "root", "proof", "proof_sha256", "folded_root"):
        out = out.add(name, ArrayType(StringType()) if name == "proof" else StringType())
    return _with_paths(_in_blocks(rows), paths).applyInArrow(of_leaves, out)


def holds(leaf: str, place: Iterator[int], proof: list[list[str]], root: str) -> bool:
    """Whether a leaf, its place in each run and its siblings by level give the root."""
    now = leaf.encode()
    for at, siblings in zip(place, proof):
        run = [x.encode() for x in siblings]
        now = Parent([*run[:at], now, *run[at:]]).digest
    return now.decode() == root
