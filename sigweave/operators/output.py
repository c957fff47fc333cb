"""Publishing form of pairs: one key and one value each."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.functions.keys import unique_key
from sigweave.functions.text import message_text, pair_json, pair_text
from sigweave.schema import FIELDS


def digest_key() -> Column:
    first = F.col("first")
    return unique_key(first["sequence_number"], first["source_ip"], first["dest_ip"])


def pair_output(pairs: DataFrame, format: str = "text") -> DataFrame:
    """OUTPUT rows: `key`, `value`. JSON carries the response time and is keyed by the
    sequence number, text by the digest."""
    first, second = F.col("first"), F.col("second")
    if format == "text":
        return pairs.select(digest_key().alias("key"), pair_text(first, second).alias("value"))
    if format == "json":
        seq = first["sequence_number"].cast("string")
        return pairs.where(F.col("latency_ms").isNotNull()).select(
            seq.alias("key"), pair_json(first, second, F.col("latency_ms"), seq).alias("value")
        )
    raise ValueError(f"unknown output format: {format}")


def unpaired_output(unpaired: DataFrame) -> DataFrame:
    """OUTPUT rows of messages without a partner, in the text form of pairs. A message that
    lacks a part of its key has a NULL key."""
    key = unique_key(F.col("sequence_number"), F.col("source_ip"), F.col("dest_ip"))
    fields = F.struct(*FIELDS)
    return unpaired.select(key.alias("key"), fields.alias("m")).select(
        "key", message_text(F.col("m")).alias("value")
    )


def span_of(ts: str, within_seconds: float) -> Column:
    """Number of the span of event time that a time falls into."""
    return F.floor(F.unix_micros(ts) / round(within_seconds * 1_000_000)).cast("bigint")


def drop_sent(pairs: DataFrame, within_seconds: float) -> DataFrame:
    """First pair of each digest key per span of `within_seconds` of event time.

    A pair that is published again has its old times, so it always falls into its old span. A
    sequence number that is used again later makes a new pair and is kept. The repeats of a
    hot key collapse before the shuffle.
    """
    keyed = pairs.withColumn("key", digest_key()).withColumn("_span", span_of("t1", within_seconds))
    order = W.partitionBy("key", "_span").orderBy("t1", "t0", "_id")
    numbered = keyed.withColumn("_id", F.col("first.id")).withColumn("_n", F.row_number().over(order))
    return numbered.where("_n = 1").select("key", *pairs.columns)


def drop_sent_stream(pairs: DataFrame, delay: str) -> DataFrame:
    """Streaming form: a key is sent once within the watermark delay."""
    keyed = pairs.withColumn("key", digest_key())
    return keyed.withWatermark("t1", delay).dropDuplicatesWithinWatermark(["key"])
