"""Queries that replay the `events` messages through the streaming job."""

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigweave.functions.keys import pair_key
from sigweave.operators import output
from sigweave.options import JobOptions
from sigweave.plans.reports import SESSION_TTL, pair_ids
from sigweave.schema import MESSAGE
from sigweave.sources.events import event_messages
from sigweave.streaming import processor
from sigweave.streaming.job import SessionJob

_PARTS = 4


def work_folder(spark: SparkSession) -> str:
    """A new folder below the shared one of the cluster, or below a local one in its absence."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        # Local mode only: a cluster names its shared folder.
        return tempfile.mkdtemp(prefix="sigweave-")
    return f"{shared}/{uuid.uuid4().hex}"


def write_parts(messages: DataFrame, folder: str, parts: range, of: int) -> None:
    """Time-ordered parts of the messages, one folder each, in one pass."""
    span = messages.agg(
        F.min(F.unix_micros("ts")).alias("low"), F.max(F.unix_micros("ts")).alias("high")
    ).first()
    width = (span["high"] - span["low"]) // of + 1
    part = F.floor((F.unix_micros("ts") - span["low"]) / width).cast("int")
    wanted = messages.withColumn("part", part).where(F.col("part").isin(list(parts)))
    wanted.write.mode("append").partitionBy("part").parquet(folder)


def _job(folder: str, now=None, **options) -> SessionJob:
    given = {"trigger": None, "session_ttl": SESSION_TTL, **options}
    return SessionJob(
        JobOptions(
            checkpoint=f"{folder}/checkpoint",
            pair_out=f"{folder}/pairs",
            unpaired_out=f"{folder}/unpaired",
            **given,
        ),
        **({"now": now} if now else {}),
    )


def _run(spark: SparkSession, folder: str, **options) -> int:
    """Runs the job over the parts that are there; the number of its last step."""
    query = _job(folder, **options).start(spark.readStream.schema(MESSAGE).parquet(f"{folder}/in/*"))
    query.awaitTermination()
    return query.lastProgress["batchId"]


def replay(spark: SparkSession, sf_dir: str, stops: tuple[int, ...], **options) -> str:
    """Replays the messages in steps, each up to one of the stops, with a restart from the
    saved positions and state in between."""
    folder = work_folder(spark)
    messages = event_messages(spark, sf_dir)
    step, done = -1, 0
    for stop in stops:
        write_parts(messages, f"{folder}/in", range(done, stop), _PARTS)
        step, done = _run(spark, folder, **options), stop
    _job(folder, **options).drain(spark, step)
    return folder


def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_ids(spark.read.parquet(f"{replay(spark, sf_dir, (2, 4))}/pairs"))


def stream_unpaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    alone = spark.read.parquet(f"{replay(spark, sf_dir, (2, 4))}/unpaired")
    return alone.select("id", "reason")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.parquet(f"{folder}/pairs")
        .where(F.col("teid").isNotNull())
        .select(
            "teid",
            F.col("session_start").cast("timestamp_ntz").alias("session_start"),
            F.col("first.id").alias("first_id"),
            F.col("second.id").alias("second_id"),
            "imsi",
            "msisdn",
        )
    )


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, replay(spark, sf_dir, (2, 4)))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more restarts."""
    return _enriched(spark, replay(spark, sf_dir, (1, 2, 3, 4)))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key once a day, with the repeats of other steps and restarts in between."""
    folder = replay(spark, sf_dir, (1, 2, 3, 4), dedup=86_400.0, compact_every=2)
    return spark.read.parquet(f"{folder}/pairs").select(
        output.digest_key().alias("key"), F.col("first.id").alias("first_id"), F.col("second.id").alias("second_id")
    )


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request with its first response, and those that got none."""
    folder = replay(spark, sf_dir, (2, 4), pairing="response")
    pairs = spark.read.parquet(f"{folder}/pairs").select(
        "pair_key", F.col("first.id").alias("request_id"), F.col("second.id").alias("response_id")
    )
    none = F.lit(None).cast("bigint").alias("response_id")
    alone = spark.read.parquet(f"{folder}/unpaired").where("reason = 'unanswered'")
    return pairs.unionByName(alone.select(pair_key().alias("pair_key"), F.col("id").alias("request_id"), none))


def _results(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs and unpaired messages in one table."""
    pairs = spark.read.parquet(f"{folder}/pairs").select(
        F.col("first.id").alias("first_id"), F.col("second.id").alias("second_id"), F.lit("pair").alias("kind")
    )
    alone = spark.read.parquet(f"{folder}/unpaired")
    none = F.lit(None).cast("bigint").alias("second_id")
    return pairs.unionByName(alone.select(F.col("id").alias("first_id"), none, F.col("reason").alias("kind")))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drawn order of arrival: of each part, every tenth message comes a step later, with its old time, and
    what the clock has settled by then is reported."""
    folder = work_folder(spark)
    messages = event_messages(spark, sf_dir)
    write_parts(messages, f"{folder}/all", range(_PARTS), _PARTS)
    step = -1
    for now in range(_PARTS + 1):
        parts = spark.read.option("basePath", f"{folder}/all").parquet(f"{folder}/all")
        held = F.col("id") % 10 == 0
        arrives = F.when(held, F.col("part") + 1).otherwise(F.col("part"))
        parts.where(arrives == now).drop("part").write.parquet(f"{folder}/in/step={now}")
        step = _run(spark, folder)
    _job(folder).drain(spark, step)
    return _results(spark, folder)


IDLE_SECONDS = 3600


class _Clock:
    """A time of day that a replay moves by hand."""

    def __init__(self):
        self.at = 0

    def __call__(self) -> int:
        return self.at


def _until(query: StreamingQuery, done: Callable[[int], bool], limit: float = 600) -> None:
    """Waits until `done` says so of the last step that is over."""
    end = time.monotonic() + limit
    while True:
        if (error := query.exception()) is not None:
            raise error
        last = query.lastProgress
        if last is not None and done(last["batchId"]):
            return
        if time.monotonic() > end:
            raise TimeoutError("the stream did not get there")
        time.sleep(0.2)


def _stop(query: StreamingQuery) -> None:
    """Stops a stream between two steps, or after a while in one: that step would be repeated later."""
    end = time.monotonic() + 60
    while query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.02)
    query.stop()


def stream_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input stops half way for an hour and then for good; the ticks of a running stream settle what is open,
    and what comes after its time was settled is reported. Nothing is drained."""
    folder, clock = work_folder(spark), _Clock()
    messages = event_messages(spark, sf_dir)
    for parts in (range(0, 2), range(2, _PARTS)):
        write_parts(messages, f"{folder}/in", parts, _PARTS)
        job = _job(folder, clock, trigger=2.0, idle_after=IDLE_SECONDS / 2)
        newest = spark.read.parquet(f"{folder}/in").agg(F.max(F.unix_micros("ts"))).first()[0]
        query = job.start(spark.readStream.schema(MESSAGE).parquet(f"{folder}/in/*"))
        try:
            _until(query, lambda step: job.clock(spark, step)["newest"] == newest)
            clock.at += IDLE_SECONDS * 1_000_000
            _until(query, lambda step: job.clock(spark, step)["settled"] > newest)
        finally:
            _stop(query)
    return _results(spark, folder)


def stream_pairs_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by the keyed stateful operator, restarted half way. A copy of the last message,
    a day ahead and under another key, lets the watermark pass all others."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(
        name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        return _pairs_keyed(spark, sf_dir)
    finally:
        spark.conf.set(name, before)


def _pairs_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    messages = event_messages(spark, sf_dir)
    for done, stop in ((0, 2), (2, _PARTS)):
        write_parts(messages, f"{folder}/in", range(done, stop), _PARTS)
        if stop == _PARTS:
            newest = messages.agg(F.max("ts").alias("ts")).scalar()
            last = messages.where(F.col("ts") == newest).withColumns(
                {"ts": F.col("ts") + F.expr("INTERVAL 1 DAY"), "sequence_number": F.lit(-1)}
            )
            last.write.parquet(f"{folder}/in/part=end")
        stream = spark.readStream.schema(MESSAGE).parquet(f"{folder}/in/*")
        query = (
            processor.stream_pairs(stream)
            .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{folder}/pairs")
        )
        query.awaitTermination()
    return pair_ids(spark.read.parquet(f"{folder}/pairs"))


STREAMS = {
    "stream_pairs": stream_pairs,
    "stream_unpaired": stream_unpaired,
    "stream_sessions": stream_sessions,
    "stream_restart": stream_restart,
    "stream_dedup": stream_dedup,
    "stream_interval": stream_interval,
    "stream_late": stream_late,
    "stream_idle": stream_idle,
    "stream_pairs_keyed": stream_pairs_keyed,
}
