"""The streaming job: messages in, enriched pairs and unpaired messages out.

Each micro-batch runs the batch operators on the new messages and the few still open, so
stream and batch agree by construction and a hot key is cut into slices here too. Time is
event time. What no later message can change any more is final and written once; the rest
waits in a small state table. A message that comes after its time was settled goes to the
unpaired output with the reason 'late'.

State lies in the checkpoint folder, either in two slots in turn or as changes (see `state`), so a
step that is repeated after a failure finds the state of its predecessor untouched, and overwrites
its own outputs. Sessions and sent keys are written by their changes: a step costs what it touches.

With `idle_after`, a stream of ticks runs along. Once no message has moved the clock for that long,
it goes on with the time of day, so what is open is settled though nothing comes any more.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sigweave.functions.keys import pair_key
from sigweave.functions.times import seconds
from sigweave.operators.interval import settle_requests
from sigweave.operators.output import digest_key, drop_sent, pair_output, span_of, unpaired_output
from sigweave.operators.pairing import hot_pair_keys, pair_columns, settle_messages
from sigweave.operators.sessions import (
    continue_sessions,
    open_session_columns,
    sessions_touched,
)
from sigweave.operators.validation import with_reason
from sigweave.options import JobOptions
from sigweave.schema import MESSAGE
from sigweave.streaming.state import KeyedState, SentKeys

Sink = Callable[[DataFrame, int], None]

_STEP = T.StructType(
    [
        T.StructField("first", MESSAGE),
        T.StructField("second", MESSAGE),
        T.StructField("kind", T.StringType()),
    ]
)
# In microseconds: event time of the newest message seen, event time settled so far, and the time of day at
# which `newest` last moved. `seq` counts the steps that had something to do; state is numbered by it.
_CLOCK = "newest long, settled long, moved long, seq long"
_TICK = "tick"

# Fixed value: microseconds of the year 9999, later than any message.
_END_OF_TIME = 253_370_764_800_000_000


def table_sink(path: str) -> Sink:
    """Writes each step to a folder of its own, which a repeated step overwrites."""

    def write(df: DataFrame, step: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/step={step}")

    return write


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Runs independent writes at the same time, as jobs of the same query."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            done.result()


def _now() -> int:
    return time.time_ns() // 1000


def _latest(*times: int | None) -> int | None:
    return max((t for t in times if t is not None), default=None)


class SessionJob:
    """Pairs messages and enriches sessions, step by step."""

    def __init__(
        self,
        options: JobOptions,
        pair_sink: Sink | None = None,
        unpaired_sink: Sink | None = None,
        after_step: Sink | None = None,
        now: Callable[[], int] = _now,
        number_rows: bool = False,
    ):
        """Sinks get the results of each step and its number; `after_step` gets the messages
        read in it, once all results are written. `now`: the time of day in microseconds.
        `number_rows`: ids tell no more than where rows come from; make them unique by the place in the
        step's input, which is the same when a step is repeated."""
        if options.pairing not in ("next", "response"):
            raise ValueError(f"unknown pairing: {options.pairing}")
        self.options = options
        self.number_rows = number_rows
        self.now = now
        folder = f"{options.checkpoint}/state"
        self.sessions = KeyedState(f"{folder}/sessions", ["teid"], self._open_schema(), options.compact_every)
        self.sent = SentKeys(f"{folder}/sent", options.compact_every)
        self.pair_sink = pair_sink or table_sink(options.pair_out)
        self.unpaired_sink = unpaired_sink or table_sink(options.unpaired_out)
        self.after_step = after_step

    def start(self, messages: DataFrame) -> StreamingQuery:
        """Starts on a streaming DataFrame of messages, see `schema.MESSAGE`. A column `reason`
        tells why the source could not read a message."""
        given = ["reason"] if "reason" in messages.columns else []
        rows = messages.select(*MESSAGE.names, *given)
        if self.options.idle_after is not None and self.options.trigger is not None:
            ticks = messages.sparkSession.readStream.format("rate").option("numPartitions", 1).load()
            ticks = ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGE], F.lit(_TICK).alias("reason"))
            rows = rows.unionByName(ticks, allowMissingColumns=True)
        writer = (
            rows.writeStream.option("checkpointLocation", f"{self.options.checkpoint}/source")
            .foreachBatch(self._on_batch)
        )
        if self.options.trigger is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{self.options.trigger} seconds").start()

    def _on_batch(self, batch: DataFrame, step: int) -> None:
        if self.number_rows:
            batch = batch.withColumn("id", F.xxhash64("id", F.lit(step), F.monotonically_increasing_id()))
        batch = batch.persist()
        try:
            messages = batch
            if "reason" in batch.columns:
                messages = batch.where(~F.col("reason").eqNullSafe(F.lit(_TICK)))
            self._run(messages, step)
            if self.after_step is not None:
                self.after_step(messages, step)
        finally:
            batch.unpersist()

    def drain(self, spark: SparkSession, after_step: int) -> None:
        """Settles everything still open, as the step after the given one. For inputs that
        have an end, once the query has stopped: a later start on the same checkpoint would call
        every message late."""
        self._run(spark.createDataFrame([], MESSAGE), after_step + 1, _END_OF_TIME)

    def _state(self, step: int, name: str) -> str:
        return f"{self.options.checkpoint}/state/{name}/slot={step % 2}"

    def _load(self, spark: SparkSession, step: int, name: str, schema) -> DataFrame:
        if step < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._state(step, name))

    def _save(self, df: DataFrame, step: int, name: str, schema, *by: str) -> DataFrame:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*by).parquet(self._state(step, name))
        return self._load(df.sparkSession, step, name, schema)

    def _open_schema(self) -> T.StructType:
        texts = open_session_columns(self.options.carry_all)[3:]
        return T.StructType(
            [
                T.StructField("teid", T.StringType()),
                T.StructField("start_in", T.TimestampType()),
                T.StructField("oldest_in", T.TimestampType()),
                *[T.StructField(c, T.StringType()) for c in texts],
            ]
        )

    def clock(self, spark: SparkSession, step: int) -> dict:
        """The clock after a step."""
        row = self._load(spark, step, "clock", _CLOCK).first()
        return row.asDict() if row else {"newest": None, "settled": None, "moved": None, "seq": 0}

    def _run(self, batch: DataFrame, step: int, end: int | None = None) -> None:
        o, spark = self.options, batch.sparkSession
        clock = self.clock(spark, step - 1)
        newest, settled, seq = clock["newest"], clock["settled"], clock["seq"] + 1

        late = F.unix_micros("ts") < F.lit(settled)
        # One wrong date must not move the clock, or all that follows would be late.
        ahead = F.col("ts") > F.current_timestamp() + seconds(o.max_ahead)
        judged = with_reason(batch)
        judged = judged.withColumn(
            "reason", F.coalesce("reason", F.when(late, "late"), F.when(ahead, "ahead"))
        )
        usable = judged.where("reason IS NULL").drop("reason")
        seen = judged.agg(
            F.count(F.lit(1)).alias("read"),
            F.count(F.when(F.col("reason").isNull(), 1)).alias("rows"),
            F.max(F.when(F.col("reason").isNull(), F.unix_micros("ts"))).alias("newest"),
        ).first()
        now, moved = self.now(), clock["moved"]
        if seen["newest"] is not None and (newest is None or seen["newest"] > newest):
            newest, moved = seen["newest"], now
        going = newest
        if newest is not None and o.idle_after is not None and now - moved >= o.idle_after * 1_000_000:
            going = newest + now - moved
        settled = end or _latest(settled, going and going - round(o.delay * 1_000_000))
        until = None if settled is None else F.timestamp_micros(F.lit(settled))

        held = self._load(spark, seq - 1 or -1, "steps", _STEP).where("kind = 'open'")
        if not seen["read"] and end is None and (settled == clock["settled"] or held.isEmpty()):
            # A tick with nothing to settle costs no more than the clock.
            self._save(spark.createDataFrame([(newest, settled, moved, seq - 1)], _CLOCK), step, "clock", _CLOCK)
            return
        messages = held.select("first.*").unionByName(usable)
        if o.pairing == "response":
            settled_now = settle_requests(messages, until, o.ttl, o.skew)
        else:
            # Few messages are held, so a hot key of the step shows in the new ones.
            hot = hot_pair_keys(usable, o.skew, seen["rows"])
            settled_now = settle_messages(messages, until, o.ttl, o.skew, hot)
        unusable = judged.where("reason IS NOT NULL").select(
            F.struct(*MESSAGE.names).alias("first"),
            F.lit(None).cast(MESSAGE).alias("second"),
            F.col("reason").alias("kind"),
        )
        steps = self._save(settled_now.unionByName(unusable), seq, "steps", _STEP, "kind")
        _together(
            spark,
            lambda: self._write_unpaired(steps, step),
            lambda: self._write_pairs(steps, step, seq, until, clock["settled"]),
        )
        self._save(spark.createDataFrame([(newest, settled, moved, seq)], _CLOCK), step, "clock", _CLOCK)

    def _write_unpaired(self, steps: DataFrame, step: int) -> None:
        unpaired = steps.where("kind NOT IN ('pair', 'open')")
        unpaired = unpaired.select("first.*", F.col("kind").alias("reason"))
        if self.options.unpaired_format == "text":
            unpaired = unpaired_output(unpaired)
        self.unpaired_sink(unpaired, step)

    def _write_pairs(self, steps: DataFrame, step: int, seq: int, until: Column | None, before: int | None) -> None:
        """Enriches the pairs of the step, going on from the open sessions, and writes both."""
        o, spark = self.options, steps.sparkSession
        keyed = steps.where("kind = 'pair'").withColumn(
            "pair_key", pair_key("first.sequence_number", "first.source_ip", "first.dest_ip")
        )
        pairs = keyed.select(*pair_columns())
        touched = pairs.select("teid").where("teid IS NOT NULL")
        known = self.sessions.load(spark, seq - 1, touched)
        continued = continue_sessions(pairs, known, o.session_ttl, o.ttl, o.carry_all, o.skew)
        enriched = self._save(continued, seq, "enriched", continued.schema)
        alive = None if until is None else F.col("oldest_in") + seconds(o.session_ttl) > until

        rows = enriched.drop("_oldest", "session_no")
        no_session = pairs.where(F.col("teid").isNull())
        everything = rows.unionByName(no_session, allowMissingColumns=True)
        writes = [lambda: self.sessions.save(sessions_touched(enriched, o.carry_all), seq, alive)]
        if o.dedup is not None:
            # Pairs settle in the order of time: none falls into a span that ended before.
            first_span = 0 if before is None else before // round(o.dedup * 1_000_000)
            fresh = self._unsent(everything, seq, first_span)
            everything = self._save(fresh, seq, "published", fresh.schema)
            sent = everything.select(digest_key().alias("key"), span_of("t1", o.dedup).alias("span"))
            writes.append(lambda: self.sent.save(sent, seq, first_span))
        if o.output_format != "rows":
            everything = pair_output(everything, o.output_format)
        _together(spark, *writes, lambda: self.pair_sink(everything, step))

    def _unsent(self, pairs: DataFrame, seq: int, first_span: int) -> DataFrame:
        """The first pair of each key and span, unless an earlier step sent that key in that span."""
        within = self.options.dedup
        fresh = drop_sent(pairs, within).withColumn("span", span_of("t1", within))
        wanted = fresh.select("key", "span")
        # What was sent is met with the few keys of the step, not the other way round.
        repeated = self.sent.load(pairs.sparkSession, seq - 1, first_span).join(wanted, ["key", "span"], "left_semi")
        return fresh.join(repeated, ["key", "span"], "left_anti").select(*pairs.columns)
