"""From options to a running job: source, pairing and sessions, sinks, ledger."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigweave.operators.offsets import read_ledger
from sigweave.operators.validation import blank_to_null, with_time
from sigweave.options import JobOptions
from sigweave.schema import MESSAGE
from sigweave.sources import kafka
from sigweave.sources.kv_lines import parse_lines, stream_lines
from sigweave.streaming.job import SessionJob, Sink, table_sink


def stream_messages(spark: SparkSession, o: JobOptions, earliest: DataFrame | None = None) -> DataFrame:
    """The stream of messages that the options name. `earliest`: OFFSETS rows of the first record
    of each partition of the topic, to start from the ledger where there is no checkpoint yet; where
    nothing is saved, at the end of the topic. A ledger without them would skip what came in between."""
    if o.source == "kafka":
        start = "latest"
        if o.ledger is not None:
            if earliest is None:
                raise ValueError("to start from a ledger, give the earliest positions of the topic")
            start = kafka.start_position(read_ledger(spark, o.ledger), earliest)
        records = kafka.stream_records(
            spark, servers=o.servers, topic=o.location, start=start, max_per_trigger=o.max_per_trigger
        )
        return kafka.messages_of(records)
    if o.source == "lines":
        lines = stream_lines(spark, o.location, o.max_per_trigger)
        # A line has no number of its own; the job numbers those of each step.
        numbered = lines.withColumn("id", F.xxhash64("_metadata.file_path", "_metadata.file_block_start"))
        return with_time(blank_to_null(parse_lines(numbered)))
    if o.source == "messages":
        reader = spark.readStream.schema(MESSAGE)
        if o.max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", o.max_per_trigger)
        return reader.parquet(o.location)
    raise ValueError(f"unknown source: {o.source}")


def _sink(o: JobOptions, topic: str | None, folder: str, format: str) -> Sink:
    if topic is None:
        return table_sink(folder)
    if format == "rows":
        raise ValueError("a topic takes key and value: choose a format other than rows")
    return kafka.pair_sink(o.servers, topic)


def make_job(o: JobOptions) -> SessionJob:
    after = None
    if o.ledger is not None:
        if o.source != "kafka":
            raise ValueError("a ledger holds positions of a topic: only a kafka source has them")
        after = kafka.ledger_sink(o.ledger, o.location)
    return SessionJob(
        o,
        pair_sink=_sink(o, o.pair_topic, o.pair_out, o.output_format),
        unpaired_sink=_sink(o, o.unpaired_topic, o.unpaired_out, o.unpaired_format),
        after_step=after,
        number_rows=o.source == "lines",
    )


def start_job(spark: SparkSession, o: JobOptions, earliest: DataFrame | None = None) -> StreamingQuery:
    """Starts the whole job; the query runs until it is stopped."""
    return make_job(o).start(stream_messages(spark, o, earliest))
