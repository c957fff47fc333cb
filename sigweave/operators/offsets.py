"""Source positions: JSON form, start positions, merging, ledger.

An OFFSETS table has topic, partition, offset. All operators reduce to one row per partition,
before the shuffle where there is more than one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.schema import OFFSETS
from sigweave.sources.paths import exists

# Fixed value: stands for "no saved position".
LATEST = "latest"

_JSON = "map<string,map<string,bigint>>"
_PARTITION = ["topic", "partition"]


def decode_offsets(saved: DataFrame, column: str = "checkpoint") -> DataFrame:
    """OFFSETS rows of `{"topic": {"partition": offset}}` texts; `latest` gives none.

    A text that is neither fails the query: taken for "nothing saved" it would skip a backlog.
    """
    text = F.col(column)
    broken = F.raise_error(F.concat(F.lit("not a saved position: "), text))
    # A value of the wrong type leaves a NULL behind, so the result is looked at as a whole.
    parsed = F.from_json(text, _JSON)
    whole = F.forall(
        F.map_values(parsed),
        lambda parts: parts.isNotNull()
        & F.forall(F.map_values(parts), lambda v: v.isNotNull())
        & F.forall(F.map_keys(parts), lambda k: k.rlike("^[0-9]+$")),
    )
    checked = F.when(F.coalesce(whole, F.lit(False)), parsed).otherwise(broken)
    return (
        saved.where(text != LATEST)
        .select(F.explode(checked).alias("topic", "parts"))
        .select("topic", F.explode("parts").alias("partition", "offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )


def encode_offsets(offsets: DataFrame) -> DataFrame:
    """One JSON text per topic, its partitions in order."""
    entries = F.array_sort(F.collect_list(F.struct("partition", "offset")))
    parts = F.map_from_entries(
        F.transform(
            entries, lambda e: F.struct(e["partition"].cast("string").alias("k"), e["offset"])
        )
    )
    return (
        offsets.groupBy("topic")
        .agg(parts.alias("parts"))
        .select("topic", F.to_json(F.create_map("topic", "parts")).alias("checkpoint"))
    )


def earliest_offsets(records: DataFrame) -> DataFrame:
    return records.groupBy(*_PARTITION).agg(F.min("offset").alias("offset"))


def until_offsets(records: DataFrame) -> DataFrame:
    """Position after the last record of each partition."""
    return records.groupBy(*_PARTITION).agg((F.max("offset") + 1).alias("offset"))


def current_offsets(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(*_PARTITION).agg(F.max("offset").alias("offset"))


def start_offsets(saved: DataFrame, earliest: DataFrame) -> DataFrame:
    """A position for every partition that there is, and for no other: the saved one, moved up to
    the earliest record, or the earliest record of a partition that has none saved. Partitions
    that are gone are left out. If nothing is saved at all for a topic, it has no rows."""
    floor = earliest.withColumnRenamed("offset", "floor")
    topics = saved.select("topic").distinct()
    return (
        floor.join(topics, "topic", "left_semi")
        .join(saved, _PARTITION, "left")
        .select(*_PARTITION, F.greatest("offset", "floor").alias("offset"))
    )


def merge_offsets(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The later position of each partition, topic by topic. If both sides do not have the
    same number of partitions (none for `latest`), the incoming one holds."""
    both = current.withColumnRenamed("offset", "old").join(
        incoming.withColumnRenamed("offset", "new"), _PARTITION, "full"
    )
    sizes = both.groupBy("topic").agg(
        (F.count("old") == F.count("new")).alias("same_size")
    )
    later = F.when(F.col("same_size"), F.greatest("new", "old")).otherwise(F.col("new"))
    return (
        both.join(sizes, "topic")
        .where(F.col("new").isNotNull())
        .select(*_PARTITION, later.alias("offset"))
    )


def append_ledger(offsets: DataFrame, path: str) -> None:
    offsets.select(*OFFSETS.names).write.mode("append").parquet(path)


# Steps of a ledger after which its positions are put together.
_TAIL = 16


def save_ledger(offsets: DataFrame, path: str, step: int, every: int = _TAIL) -> None:
    """Notes the positions reached in a step, over those that the same step noted before.

    Each step has a file in a ring; every so many steps the latest position of each partition is written to
    one of two tables in turn. So there is always a whole table beside the one being written, a reader
    needs no order, and the number of files does not grow with the steps.
    """
    spark = offsets.sparkSession
    tail = f"{path}/tail/slot={step % (2 * every)}"
    offsets.select(*OFFSETS.names).write.mode("overwrite").parquet(tail)
    if step % every == every - 1:
        turn = step // every % 2
        other = f"{path}/whole/slot={1 - turn}"
        parts = [f"{path}/tail/slot={k % (2 * every)}" for k in range(step - every + 1, step + 1)]
        known = [p for p in [*parts, other] if exists(spark, p)]
        rows = spark.read.schema(OFFSETS).option("recursiveFileLookup", "true").parquet(*known)
        current_offsets(rows).write.mode("overwrite").parquet(f"{path}/whole/slot={turn}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The latest position of each partition; a ledger that does not exist has none saved."""
    if not exists(spark, path):
        return spark.createDataFrame([], OFFSETS)
    return current_offsets(spark.read.schema(OFFSETS).option("recursiveFileLookup", "true").parquet(path))


def starting_offsets_json(offsets: DataFrame) -> str | None:
    """Value for the `startingOffsets` option of a stream; None if nothing is saved. Reads one
    short text per topic."""
    texts = [r["checkpoint"] for r in encode_offsets(offsets).collect()]
    return "{" + ",".join(t[1:-1] for t in texts) + "}" if texts else None

