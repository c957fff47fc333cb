"""Finding hot groups and cutting them into ordered slices.

An order-dependent operator over a group normally puts the whole group into one task. A group
that outgrows a task is cut here into slices that follow the order of the operator, so that
every row of slice n precedes every row of slice n + 1. The operator then runs per slice and
hands its (small) state from slice to slice.
"""

import re
import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Skew:
    """When and how to cut groups.

    min_rows: a group up to this size is never cut.
    slice_seconds: length of the slices of a hot group. A slice of more than `min_rows` rows is
    cut further, down to blocks of about `id_block` rows, by ranges of ids, inside one instant.
    """

    min_rows: int = 2_000_000
    slice_seconds: int = 60
    id_block: int = 1_000_000


# Buckets per shuffle partition in the search for hot values.
_BUCKETS_PER_SHARE = 64

# Most hot values that are named one by one, and the bits that stand for more of them.
_NAMED = 1000
_MARKS = 1 << 18


@dataclass(frozen=True)
class Marked:
    """Hot values too many to name: a bitmap of fixed size of their hashes, as numbers of 64 bits in text.

    A value that shares a bit with a hot one counts as hot, too. Cutting never changes a result, so it is
    only cut without need.
    """

    bits: str


def _spot(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(_MARKS))


def is_hot(value: Column, hot: list | Marked) -> Column:
    """Whether a value is among the hot ones, as `hot_values` gives them; never null."""
    if isinstance(hot, Marked):
        words, spot = F.split(F.lit(hot.bits), ",").cast("array<bigint>"), _spot(value.cast("string"))
        bit = F.getbit(F.get(words, F.shiftright(spot, 6).cast("int")), spot.bitwiseAND(63).cast("int"))
        return value.isNotNull() & (bit == 1)
    return F.coalesce(value.isin(hot), F.lit(False))


def _marked(values: DataFrame) -> Marked:
    spot = _spot(F.col("v"))
    bit = F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")
    words = values.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = dict(words.collect())
    return Marked(",".join(str(found.get(i, 0)) for i in range(_MARKS >> 6)))


def hot_values(
    df: DataFrame, value: Column, min_rows: int, total: int | None = None
) -> list | Marked:
    """Values of `value` held by more than `min_rows` rows, for `is_hot`.

    Rows are first counted per hash bucket of the value. That needs hardly any shuffle, as
    each task hands on no more rows than there are buckets, and a hot value makes its bucket
    heavy. Only the values of heavy buckets are then counted one by one. Neither list that
    reaches the driver can have more than one entry per `min_rows` rows. Where that may be more than
    `_NAMED`, all values are counted, and if so many are hot, only a bitmap reaches the driver.
    `total` saves the count of all rows where it is known.
    """
    if df.isStreaming:
        return []
    if total is None:
        total = df.select(F.lit(1)).count()
    if total <= min_rows:
        return []
    # Cold buckets must stay below the limit, so there are more of them the more rows there are.
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shares * _BUCKETS_PER_SHARE, 4 * total // min_rows)
    bucket = F.pmod(F.xxhash64("v"), F.lit(buckets))
    keyed = df.select(value.cast("string").alias("v")).where(F.col("v").isNotNull())
    if total // max(1, min_rows) > _NAMED:
        found = held(keyed.groupBy("v").count().where(F.col("count") > min_rows).select("v"))
        some = [r["v"] for r in found.limit(_NAMED + 1).collect()]
        return some if len(some) <= _NAMED else _marked(found)

    def beyond(rows: DataFrame, by: Column) -> list:
        counts = rows.groupBy(by.alias("g")).count().where(F.col("count") > min_rows)
        return [r["g"] for r in counts.collect()]

    heavy = beyond(keyed, bucket)
    return beyond(keyed.where(bucket.isin(heavy)), F.col("v")) if heavy else []


def held(df: DataFrame) -> DataFrame:
    """Writes a result that several branches of a plan read, into the shared folder that
    `spark.checkpoint.dir` names. Only a local session may go without one and gets its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if re.fullmatch(r"local(\[[^]]*\])?", context.master) is None:
            raise RuntimeError("hot groups are cut through a shared folder: set spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sigweave-"))
    return df.checkpoint()


# Equal spans that a slice is counted in before it is cut into pieces.
_SPANS = 1024


def with_slices(
    df: DataFrame,
    key: str,
    hot: list | Marked,
    skew: Skew,
    ts: str,
    minor: list[Column],
    name: str = "slice",
    id_: str = "id",
) -> DataFrame:
    """Adds the slice of each row as an ordered struct; rows of cold groups share one slice.

    A hot group is cut by time. A slice of more than `min_rows` rows is counted in short spans,
    and neighbouring spans are put together into pieces of about `min_rows`; so is a span that
    alone has more, by its instants. Only the rows of one instant that has more are cut by
    `minor` and then by equal ranges of their ids, as many as it has `id_block` rows, whether the ids are
    serial numbers or hashes. So there are about rows / `min_rows` pieces besides the slices that have any rows.
    """
    zero = F.lit(0).cast("bigint")
    minors = [f"minor{i}" for i in range(len(minor) + 1)]
    names = ["major", "piece", "part", "crowd", *minors]
    if not hot:
        return df.withColumn(name, F.struct(*[zero.alias(n) for n in names]))
    to_cut = is_hot(F.col(key), hot)
    micros = F.unix_micros(ts)
    length = skew.slice_seconds * 1_000_000
    major = F.floor(micros / length).cast("bigint")
    span = F.floor((micros - F.col("_major") * length) * _SPANS / length).cast("bigint")
    marked = df.withColumn("_major", F.when(to_cut, major).otherwise(zero)).withColumn(
        "_span", F.when(to_cut, span)
    )
    limit = skew.min_rows
    slice_ = [key, "_major"]
    spans = marked.where(to_cut).groupBy(*slice_, "_span").agg(F.count(F.lit(1)).alias("_n"))
    pieces = held(
        spans.withColumn("_all", F.sum("_n").over(W.partitionBy(*slice_)))
        .where(F.col("_all") > limit)
        .select(*slice_, "_span", *_filled(slice_, "_span", limit, "_piece", "_full"))
    )
    dense, full = pieces.agg(F.count(F.lit(1)), F.bool_or("_full")).first()
    own = [F.lit(False).alias("_full"), zero.alias("_piece")]
    cut = marked.join(pieces, [*slice_, "_span"], "left") if dense else marked.select("*", *own)
    none = F.lit(0.0)
    own = [F.lit(False).alias("_crowd"), zero.alias("_part"), none.alias("_low"), none.alias("_range")]
    if full:
        cut = cut.withColumn("_micros", F.when(F.col("_full"), micros))
        spans = [*slice_, "_span"]
        instants = (
            cut.where("_full")
            .groupBy(*spans, "_micros")
            .agg(F.count(F.lit(1)).alias("_n"), F.min(id_).cast("double").alias("_low"), F.max(id_).cast("double").alias("_high"))
        )
        blocks = F.ceil(F.col("_n") / skew.id_block)
        parts = instants.select(
            *spans,
            "_micros",
            "_low",
            ((F.col("_high") - F.col("_low")) / blocks).alias("_range"),
            *_filled(spans, "_micros", limit, "_part", "_crowd"),
        )
        cut = cut.join(held(parts), [*spans, "_micros"], "left").drop("_micros")
    else:
        cut = cut.select("*", *own)
    crowd = F.coalesce("_crowd", F.lit(False))
    # Doubles keep the order of ids, and those that fall together share a block.
    block = F.when(F.col("_range") > 0, F.floor((F.col(id_).cast("double") - F.col("_low")) / F.col("_range")))
    block = F.coalesce(block, zero).cast("bigint")
    fields = [
        F.col("_major"),
        F.coalesce("_piece", zero),
        F.coalesce("_part", zero),
        crowd.cast("bigint"),
        *[F.when(crowd, c).otherwise(zero) for c in [*minor, block]],
    ]
    built = F.struct(*[c.alias(n) for c, n in zip(fields, names)])
    return cut.select(*df.columns, built.alias(name))


def _filled(group: list[str], order: str, limit: int, number: str, over: str) -> list[Column]:
    """Which piece of about `limit` rows each counted part falls into, and whether it alone has
    more. What follows such a part has a higher number."""
    before = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return [
        F.floor(filled / limit).cast("bigint").alias(number),
        (F.col("_n") > limit).alias(over),
    ]
