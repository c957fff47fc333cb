"""Kafka as source and sink; needs the Spark Kafka connector on the class path."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.operators.offsets import (
    save_ledger,
    start_offsets,
    starting_offsets_json,
    until_offsets,
)
from sigweave.operators.validation import blank_to_null, valid, with_time
from sigweave.sources.protobuf import decode, encode

# Receive buffer of the source, and delivery settings of the sink.
SOURCE_DEFAULTS = {"kafka.receive.buffer.bytes": "102400"}
SINK_DEFAULTS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.retries": "2147483647",
}

_OFFSET_BITS = 44


def record_id() -> Column:
    """A unique number of each record of a topic, growing with the offset in a partition."""
    return F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS).bitwiseOR(F.col("offset"))


def record_positions(messages: DataFrame, topic: str) -> DataFrame:
    """OFFSETS rows of messages numbered by `record_id`."""
    return messages.select(
        F.lit(topic).alias("topic"),
        F.shiftright("id", _OFFSET_BITS).cast("int").alias("partition"),
        F.col("id").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)).alias("offset"),
    )


def ledger_sink(path: str, topic: str):
    """For `SessionJob(after_step=...)`: notes the position reached after each step."""

    def write(messages: DataFrame, step: int) -> None:
        save_ledger(until_offsets(record_positions(messages, topic)), path, step)

    return write


def start_position(saved: DataFrame, earliest: DataFrame) -> str:
    """Where to start without a checkpoint: a position for each partition, see `start_offsets`;
    the end of the topic if none is saved."""
    return starting_offsets_json(start_offsets(saved, earliest)) or "latest"


def source_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    start: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_loss: bool = True,
) -> dict[str, str]:
    """`fail_on_loss`: stop when records were removed before they were read, instead of going on."""
    options = {
        **SOURCE_DEFAULTS,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_records(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(**options)).load()


def messages_of(records: DataFrame) -> DataFrame:
    """Decoded messages of Kafka records; the record key is not used."""
    values = records.select(record_id().alias("id"), "value")
    return with_time(blank_to_null(decode(values)))


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {**SINK_DEFAULTS, "kafka.bootstrap.servers": servers, "topic": topic}


def record_columns(output: DataFrame) -> list[str]:
    """The columns of a record that the sink takes over."""
    return [c for c in ("key", "value", "partition") if c in output.columns]


def pair_sink(servers: str, topic: str):
    """Sink of the streaming job: writes `key` and `value` of each step to a topic, to the `partition`
    that the output names where it has such a column."""

    def write(output: DataFrame, step: int) -> None:
        output.select(*record_columns(output)).write.format("kafka").options(
            **sink_options(servers, topic)
        ).save()

    return write


def message_records(messages: DataFrame, partition: int | None = None) -> DataFrame:
    """Messages as Kafka records: key is the sequence number as four bytes, value the encoded
    message. A fixed partition is possible, spreading them by key is the default."""
    digits = F.lpad(F.hex(F.col("sequence_number").cast("bigint")), 16, "0")
    records = valid(messages).select(
        F.unhex(F.right(digits, F.lit(8))).alias("key"), encode().alias("value")
    )
    return records if partition is None else records.withColumn("partition", F.lit(partition))
