"""Helpers of the operators: written tables, word patterns, shares, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word in Java's regular expressions: what lies between ASCII blanks and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """The shared folder for written tables: `spark.checkpoint.dir`, or one set here if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """`df`, written once as Parquet into the shared folder and reread.

    Cuts the lineage: work below it is done once, and a lost executor costs no recomputation.
    """
    path = f"{scratch(df.sparkSession).rstrip('/')}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as keep it apart from the columns of `df`."""
    taken = {c.lower() for c in df.columns}
    return [name + "_" * next(k for k in range(len(taken) + 1) if (name + "_" * k).lower() not in taken) for name in names]


def words_in(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_of(*columns: str) -> Column:
    """One string that is equal where all columns are equal, nulls included."""
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat_ws("|", *parts)


#: A bitmap has 2 ** BITS bits (8 MB) in pages of 2 ** _PAGE, however many hashes it stands for.
BITS = 26
_PAGE = 15


def bitmap(hashes: DataFrame) -> Broadcast[bytes]:
    """Broadcast bitmap of the leading bits of a column of hashes: what is not in it is not in the column.

    Its size is fixed. More hashes fill it up, and then it spares less work; results never hang on it.
    """
    (name,) = hashes.columns
    spot = F.shiftrightunsigned(name, 64 - BITS)
    spots = hashes.select(
        F.shiftright(spot, _PAGE).cast("int").alias("page"), spot.bitwiseAND((1 << _PAGE) - 1).cast("int").alias("bit")
    ).distinct()

    def page(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _PAGE, bool)
        bits[rows["bit"].to_numpy()] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"page": rows["page"].slice(0, 1), "bits": pa.array([packed], pa.binary())})

    whole = bytearray(1 << (BITS - 3))
    size = 1 << (_PAGE - 3)
    for row in spots.groupBy("page").applyInArrow(page, "page int, bits binary").collect():
        whole[row.page * size : (row.page + 1) * size] = row.bits
    return hashes.sparkSession.sparkContext.broadcast(bytes(whole))


def among(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be in a bitmap."""
    spot = (hashes.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)
    return (np.frombuffer(bits, np.uint8)[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0


def batches_among(batches: Iterator[pa.RecordBatch], column: str, bits: bytes, there: bool = True) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches whose hash may be in the bitmap, or, if not `there`, cannot be."""
    for batch in batches:
        hit = among(bits, batch.column(column).to_numpy(zero_copy_only=False))
        yield batch.filter(pa.array(hit if there else ~hit))


def rows_among(df: DataFrame, column: str, bits: Broadcast[bytes]) -> DataFrame:
    """The rows whose hash may be in the bitmap."""
    return df.mapInArrow(lambda batches: batches_among(batches, column, bits.value), df.schema)


def water_levels(shares: DataFrame, group: list[str], weight: str, cap: str, total: str) -> DataFrame:
    """Adds `share`: `total` of the group split by `weight`, where no row gets more than `cap`.

    What a full row cannot take goes to the others by weight, until none is above its cap. The
    row with the least cap per weight fills first, so the fixed point is read off running sums:
    with the k smallest rows full, the rest get weight * (total - caps of the full) / weights
    of the rest. One row a source or size class is expected, not one a document.
    """
    ratio = F.col(cap) / F.col(weight)
    order = W.partitionBy(*group).orderBy(ratio, F.col(weight))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    full = F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    rest = F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
    level = (F.col(total) - full) / rest
    # `level` is right for the first row that it does not fill; for later rows it is less.
    fits = F.when(level < ratio, level)
    return (
        shares.withColumn("_fits", fits)
        .withColumn("_level", F.max("_fits").over(whole))
        .withColumn(
            "share",
            F.coalesce(F.least(F.col(cap), F.col(weight) * F.col("_level")), F.col(cap)).cast("double"),
        )
        .drop("_fits", "_level")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b): root is the smallest node reachable.

    Alternates two steps on the edge table until it stops changing: every node hands its larger
    neighbours, then its smaller ones, to the smallest neighbour it knows. The number of rounds
    grows with the logarithm of the longest chain. Only a count and a checksum reach the driver.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                    F.struct(F.col("b").alias("x"), F.col("m").alias("y")),
                )
            ).alias("e")
        )
        edges = stored(
            small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct()
        )
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
