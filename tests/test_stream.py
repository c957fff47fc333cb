import dataclasses
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigweave.operators.offsets import read_ledger
from sigweave.operators.pairing import pair_messages, unpaired_messages
from sigweave.operators.sessions import enrich_sessions
from sigweave.operators.skew import Skew
from sigweave.options import JobOptions
from sigweave.schema import MESSAGE
from sigweave.sources import kafka
from sigweave.sources.kafka import ledger_sink
from sigweave.sources.tap import tap
from sigweave.streaming import launch
from sigweave.streaming.job import SessionJob
from sigweave.streaming.state import KeyedState, SentKeys
from tests.sequences import first_answers, messages, random_messages

GAPS = [0, 0.5, 3, 20, 59.999999, 60]


def write_parts(spark, rows, folder, parts, delay):
    """Time-ordered files, with rows up to `delay` seconds late moved to the next file."""
    rng = random.Random(4)
    size = len(rows) // parts + 1
    groups = [rows[i * size : (i + 1) * size] for i in range(parts)]
    for i in range(parts - 1):
        group = groups[i]
        late = [r for r in group if r["at"] > group[-1]["at"] - delay and rng.random() < 0.5]
        groups[i] = [r for r in group if r not in late]
        groups[i + 1] = late + groups[i + 1]
    for i, group in enumerate(groups):
        rng.shuffle(group)
        messages(spark, group).coalesce(1).write.parquet(f"{folder}/part{i}")


def job(folder, **options):
    hooks = {k: options.pop(k) for k in ("after_step", "pair_sink") if k in options}
    return SessionJob(
        JobOptions(
            checkpoint=f"{folder}/state",
            pair_out=f"{folder}/pairs",
            unpaired_out=f"{folder}/unpaired",
            trigger=None,
            **options,
        ),
        **hooks,
    )


def run(spark, made, folder):
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1)
    query = made.start(stream.parquet(f"{folder}/in/*"))
    query.awaitTermination()
    return query.lastProgress["batchId"]


@pytest.mark.parametrize("skew", [Skew(), Skew(min_rows=20, slice_seconds=60, id_block=3)])
def test_stream_equals_batch(spark, tmp_path, skew):
    rows = random_messages(11, 200, GAPS)
    write_parts(spark, rows, f"{tmp_path}/in", 3, delay=10.0)
    made = job(tmp_path, delay=10.0, session_ttl=120.0, skew=skew)
    last = run(spark, made, tmp_path)
    assert last == 2
    made.drain(spark, last)

    whole = messages(spark, rows)
    batch = pair_messages(whole)
    got = spark.read.parquet(f"{tmp_path}/pairs").cache()
    ids = lambda df: sorted(tuple(r) for r in df.select("first.id", "second.id").collect())
    assert ids(got) == ids(batch)
    fields = ["first.id", "session_start", "first.imsi", "second.imsi"]
    held = lambda df: sorted(
        (str(tuple(r)) for r in df.where(F.col("teid").isNotNull()).select(*fields).collect())
    )
    assert held(got) == held(enrich_sessions(batch, 120.0))
    alone = spark.read.parquet(f"{tmp_path}/unpaired")
    assert sorted(r["id"] for r in alone.collect()) == sorted(
        r["id"] for r in unpaired_messages(whole).collect()
    )


def test_late_and_unusable_messages_are_kept(spark, tmp_path):
    write = lambda i, rows: messages(spark, rows).write.parquet(f"{tmp_path}/in/part{i}")
    made = job(tmp_path, delay=5.0)
    write(0, [{"at": 1000, "id": 0}])
    run(spark, made, tmp_path)
    write(1, [{"at": 900, "id": 1}, {"at": 1001, "id": 2, "q": False}, {"at": 1, "id": 3, "dest_ip": None}])
    made.drain(spark, run(spark, made, tmp_path))
    reasons = {r["id"]: r["reason"] for r in spark.read.parquet(f"{tmp_path}/unpaired").collect()}
    assert reasons == {1: "late", 3: "missing_field"}
    assert spark.read.parquet(f"{tmp_path}/pairs").count() == 1


def test_repeated_step_changes_nothing(spark, tmp_path):
    made = job(tmp_path, delay=0.0)
    first = messages(spark, [{"at": 0, "id": 0}, {"at": 100, "id": 1, "seq": 2}])
    second = messages(spark, [{"at": 101, "id": 2, "seq": 2, "q": False, "teid": "T"}])
    made._on_batch(first, 0)
    for _ in range(2):
        made._on_batch(second, 1)
    made.drain(spark, 1)
    assert spark.read.parquet(f"{tmp_path}/pairs").count() == 1
    assert spark.read.parquet(f"{tmp_path}/unpaired").count() == 1


def test_ledger_and_sink(spark, tmp_path):
    out = []
    made = job(
        tmp_path,
        delay=0.0,
        output_format="json",
        pair_sink=lambda df, step: out.extend(df.collect()),
        after_step=ledger_sink(f"{tmp_path}/ledger", "t"),
    )
    made._on_batch(messages(spark, [{"at": 0, "id": 8}, {"at": 1, "id": 9, "q": False}]), 0)
    made.drain(spark, 0)
    assert [r["key"] for r in out] == ["1"]
    assert [tuple(r) for r in read_ledger(spark, f"{tmp_path}/ledger").collect()] == [("t", 0, 10)]


def test_tap(spark, tmp_path):
    messages(spark, [{"at": 0}]).write.parquet(f"{tmp_path}/in")
    query = tap(spark.readStream.schema(MESSAGE).parquet(f"{tmp_path}/in"), "tapped")
    query.processAllAvailable()
    query.stop()
    assert spark.table("tapped").count() == 1


def test_stateful_operator_equals_batch(spark, tmp_path):
    from sigweave.streaming.processor import settled_messages

    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    rows = random_messages(12, 120, GAPS)
    write_parts(spark, rows, f"{tmp_path}/in", 3, delay=10.0)
    # A message far ahead lets the watermark pass all others.
    messages(spark, [{"at": 1e6, "id": -1, "seq": 99}]).write.parquet(f"{tmp_path}/in/part9")
    broken = messages(spark, [{"at": 5, "id": -2, "seq": 98}])
    broken.withColumn("dest_ip", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/in/part1x")
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1)
    query = (
        settled_messages(stream.parquet(f"{tmp_path}/in/*"), delay=10.0)
        .writeStream.format("memory")
        .queryName("settled")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.table("settled")
    whole = messages(spark, rows)
    pairs = got.where("kind = 'pair'").select("first.id", "second.id").collect()
    expected = pair_messages(whole).select("first.id", "second.id").collect()
    assert sorted(map(tuple, pairs)) == sorted(map(tuple, expected))
    alone = got.where("kind = 'expired'").select("first.id", "first.imsi").collect()
    expected = unpaired_messages(whole).select("id", "imsi").collect()
    key = lambda r: r[0]
    assert sorted(map(tuple, alone), key=key) == sorted(map(tuple, expected), key=key)
    rest = got.where("kind NOT IN ('pair', 'expired')").select("first.id", "kind").collect()
    assert [tuple(r) for r in rest] == [(-2, "missing_field")]


def test_stateful_operator_holds_batches(spark, tmp_path):
    """Many messages of one key are few rows of state, and settle as one by one."""
    from sigweave.streaming.processor import _CHUNK, _HELD, PairProcessor

    class Held:
        def __init__(self):
            self.rows = []

        def appendList(self, rows):
            self.rows += rows

        put = lambda self, rows: setattr(self, "rows", list(rows))
        get = lambda self: iter(self.rows)
        clear = lambda self: self.rows.clear()

    class Handle:
        timers = []
        getListState = lambda self, name, schema: Held()
        listTimers = lambda self: iter(list(self.timers))
        registerTimer = lambda self, ms: self.timers.append(ms)
        deleteTimer = lambda self, ms: self.timers.remove(ms)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    rng = random.Random(8)
    n = _CHUNK + 500
    times = [rng.choice([0, 1, 20_000_000, 59_999_999, 60_000_000]) for _ in range(n)]
    us = [sum(times[:1])]
    for gap in times[1:]:
        us.append(us[-1] + gap)
    ids = [(1 << 60) + i for i in range(n)]
    rows = pd.DataFrame({c: None for c in _HELD}, index=range(n), dtype=object).assign(id=ids, us=us)
    made, handle = PairProcessor(), Handle()
    made.init(handle)
    mixed = rows.sample(frac=1, random_state=1)
    list(made.handleInputRows(("k",), iter([mixed[: n // 2], mixed[n // 2 :]]), None))
    assert len(made.held.rows) <= 4
    got = []
    for settled in (us[n // 3] // 1000, us[n // 2] // 1000, us[-1] // 1000 + 1, us[-1] // 1000 + 60_001):
        for frame in made.handleExpiredTimer(("k",), At(settled), At(min(handle.timers))):
            got += [
                (k, int(a), None if pd.isna(b) else int(b))
                for k, a, b in zip(frame["kind"], frame["first_id"], frame["second_id"])
            ]
    expected, waiting = [], None
    for message in zip(us, ids):
        if waiting is None:
            waiting = message
        elif message[0] < waiting[0] + 60_000_000:
            expected.append(("pair", waiting[1], message[1]))
            waiting = None
        else:
            expected.append(("expired", waiting[1], None))
            waiting = message
    if waiting is not None:
        expected.append(("expired", waiting[1], None))
    assert sorted(got, key=lambda r: r[1]) == expected
    assert not made.held.rows


def test_a_date_far_ahead_does_not_move_the_clock(spark, tmp_path):
    rows = [{"id": 0, "at": 0}, {"id": 1, "at": 1, "q": False}, {"id": 9, "at": 40 * 365 * 86400.0}]
    messages(spark, rows[:1] + rows[2:]).write.parquet(f"{tmp_path}/in/part0")
    messages(spark, rows[1:2]).write.parquet(f"{tmp_path}/in/part1")
    made = job(tmp_path)
    made.drain(spark, run(spark, made, tmp_path))
    alone = spark.read.parquet(f"{tmp_path}/unpaired").select("id", "reason").collect()
    assert [tuple(r) for r in alone] == [(9, "ahead")]
    pairs = spark.read.parquet(f"{tmp_path}/pairs").select("first.id", "second.id").collect()
    assert [tuple(r) for r in pairs] == [(0, 1)]


def test_whole_job_from_options(spark, tmp_path, monkeypatch):
    """Lines in, key and value out to stand-ins for topics, positions in a ledger."""
    line = "source-ip=1.1.1.1,dest-ip=2.2.2.2,sequence-number=%d,message-type=%s,teid=T"
    texts = [line % (5, "A Request"), line % (5, "A Response"), line % (6, "A Request"), "junk"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{tmp_path}/in")
    sent = []

    def stand_in(servers, topic):
        def write(output, step):
            sent.extend((topic, r["key"], r["value"]) for r in output.select("key", "value").collect())

        return write

    monkeypatch.setattr(kafka, "pair_sink", stand_in)
    options = JobOptions(
        checkpoint=f"{tmp_path}/state", pair_out="", unpaired_out="", trigger=None, source="lines",
        location=f"{tmp_path}/in", servers="h:1", pair_topic="pairs", unpaired_topic="alone",
        output_format="json", unpaired_format="text",
    )
    query = launch.start_job(spark, options)
    query.awaitTermination()
    launch.make_job(options).drain(spark, query.lastProgress["batchId"])
    assert sorted((t, "5" in v) for t, _, v in sent if t == "pairs") == [("pairs", True)]
    assert sum(t == "alone" for t, _, _ in sent) == 2
    with pytest.raises(ValueError, match="key and value"):
        launch.make_job(dataclasses.replace(options, output_format="rows"))
    with pytest.raises(ValueError, match="unknown source"):
        launch.stream_messages(spark, dataclasses.replace(options, source="pigeon"))


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_state_by_changes(spark, tmp_path):
    """Against a dictionary, over several rounds of the ring; steps are repeated and keys taken away."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    state, plain, rng = KeyedState(f"{tmp_path}/s", ["k"], schema, every=3), {}, random.Random(3)
    assert state.load(spark, 0).count() == 0
    for seq in range(1, 15):
        rows = {f"k{rng.randrange(9)}": (seq * 100 + i, rng.random() < 0.2) for i in range(rng.randrange(4))}
        table = spark.createDataFrame([(k, v, gone) for k, (v, gone) in rows.items()], "k string, v long, gone boolean")
        for _ in range(rng.randrange(1, 3)):
            state.save(table, seq, F.col("v") > seq * 100 - 600)
        plain |= {k: v for k, (v, _) in rows.items()}
        plain = {k: v for k, v in plain.items() if not rows.get(k, (0, False))[1]}
        if seq % 3 == 0:
            plain = {k: v for k, v in plain.items() if v > seq * 100 - 600}
        assert {r.k: r.v for r in state.load(spark, seq).collect()} == plain
        some = spark.createDataFrame([("k1",), ("k2",), ("k1",)], "k string")
        assert {r.k: r.v for r in state.load(spark, seq, some).collect()} == {k: plain[k] for k in ("k1", "k2") if k in plain}


def test_a_step_writes_what_it_touches(spark, tmp_path):
    made = job(tmp_path, delay=0.0)
    pairs = lambda at, ids: [
        {"id": 2 * i + q, "at": at + q, "seq": i, "q": q == 0, "teid": f"T{i}" if q else None, "imsi": f"I{i}" * 20}
        for i in ids
        for q in (0, 1)
    ]
    made._on_batch(messages(spark, pairs(0, range(3000)) + [{"id": -1, "at": 10, "seq": -1}]), 0)
    made._on_batch(messages(spark, pairs(20, [1, 2]) + [{"id": -2, "at": 30, "seq": -2}]), 1)
    many, few = (size_of(tmp_path / f"state/state/sessions/change/slot={k}") for k in (1, 2))
    assert made.sessions.load(spark, 2).count() == 3000
    assert few < many / 5


def test_sent_keys_in_spans(spark, tmp_path):
    sent, table = SentKeys(f"{tmp_path}/sent", every=2), {}
    for seq in range(1, 12):
        first = seq // 2
        rows = [(f"k{seq}{i}", first + i) for i in range(3)]
        for _ in range(2):
            sent.save(spark.createDataFrame(rows, "key string, span long"), seq, first)
        table |= dict(rows)
        want = {(k, s) for k, s in table.items() if s >= first}
        assert {tuple(r) for r in sent.load(spark, seq, first).collect()} == want
    assert min(int(p.name[5:]) for p in (tmp_path / "sent/spans").glob("span=*")) >= 5


def test_keys_are_sent_once_a_span(spark, tmp_path):
    made = job(tmp_path, delay=0.0, dedup=1000.0, compact_every=2)
    for step, at in enumerate([100, 300, 900, 1100, 1500]):
        rows = [{"id": 9 * step, "at": at, "seq": 5}, {"id": 9 * step + 1, "at": at + 1, "seq": 5, "q": False}]
        end = {"id": 9 * step + 2, "at": at + 5, "seq": 1000 + step}
        for _ in range(1 + step % 2):
            made._on_batch(messages(spark, [*rows, end]), step)
    made.drain(spark, 4)
    shift = 1_700_000_000 % 1000
    want, seen = [], set()
    for step, at in enumerate([100, 300, 900, 1100, 1500]):
        span = (at + 1 + shift) // 1000
        if span not in seen:
            want.append(9 * step)
        seen.add(span)
    got = spark.read.parquet(f"{tmp_path}/pairs").select("first.id").collect()
    assert sorted(r["id"] for r in got) == want


def test_idle_clock_settles_what_is_open(spark, tmp_path):
    at = [0]
    made = job(tmp_path, delay=5.0, idle_after=30.0)
    made.now = lambda: at[0] * 1_000_000
    none = messages(spark, []).withColumn("reason", F.lit("tick"))
    made._on_batch(messages(spark, [{"id": 0, "at": 0}, {"id": 1, "at": 50, "seq": 2}, {"id": 2, "at": 51, "seq": 2, "q": False}]), 0)
    settled, numbers = [], []
    for step, now in enumerate([10, 29, 40, 100, 200], start=1):
        at[0] = now
        made._on_batch(none, step)
        settled.append(made.clock(spark, step)["settled"] // 1_000_000 - 1_700_000_000)
        numbers.append(made.clock(spark, step)["seq"])
    assert settled == [46, 46, 86, 146, 246]
    # Only the third tick had anything to settle.
    assert numbers == [1, 1, 2, 2, 2]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/unpaired").collect()] == [0]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/pairs").select("first.id").collect()] == [1]
    made._on_batch(messages(spark, [{"id": 3, "at": 100}, {"id": 4, "at": 300}]), 6)
    late = spark.read.parquet(f"{tmp_path}/unpaired").where("reason = 'late'").collect()
    assert [r["id"] for r in late] == [3] and made.clock(spark, 6)["newest"] == (1_700_000_000 + 300) * 1_000_000


def test_start_with_a_ledger(spark, tmp_path):
    options = JobOptions(checkpoint=f"{tmp_path}/state", pair_out="", unpaired_out="", ledger=f"{tmp_path}/none", source="kafka")
    with pytest.raises(ValueError, match="earliest"):
        launch.stream_messages(spark, options)
    assert read_ledger(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError, match="kafka"):
        launch.make_job(dataclasses.replace(options, source="lines"))


def test_equal_lines_have_ids_of_their_own(spark, tmp_path):
    line = "source-ip=1.1.1.1,dest-ip=2.2.2.2,sequence-number=5,message-type=A Request,teid=T"
    spark.createDataFrame([(line,)] * 50, "value string").write.text(f"{tmp_path}/in")
    options = JobOptions(checkpoint=f"{tmp_path}/state", pair_out="", unpaired_out="", source="lines", location=f"{tmp_path}/in")
    made, ids = launch.make_job(dataclasses.replace(options, trigger=None, pair_out=f"{tmp_path}/p", unpaired_out=f"{tmp_path}/u")), []
    made.after_step = lambda df, step: ids.append(sorted(r["id"] for r in df.select("id").collect()))
    made.start(launch.stream_messages(spark, options)).awaitTermination()
    assert [len(set(x)) for x in ids] == [50]


def test_records_keep_their_partition(spark):
    assert kafka.record_columns(spark.sql("SELECT 1 AS x, 'a' AS value, 3 AS partition, 'k' AS key")) == ["key", "value", "partition"]
    assert kafka.record_columns(spark.sql("SELECT 'a' AS value, 'k' AS key")) == ["key", "value"]


@pytest.mark.parametrize("skew", [Skew(), Skew(min_rows=20, slice_seconds=60, id_block=3)])
def test_typed_pairing_equals_batch(spark, tmp_path, skew):
    """Late arrivals inside the delay, repeated steps, and requests that share a response."""
    rows = random_messages(21, 160, GAPS)
    write_parts(spark, rows, f"{tmp_path}/in", 3, delay=10.0)
    made = job(tmp_path, delay=10.0, session_ttl=120.0, skew=skew, pairing="response")
    last = run(spark, made, tmp_path)
    made.drain(spark, last)
    pairs = spark.read.parquet(f"{tmp_path}/pairs").select("first.id", "second.id").collect()
    alone = spark.read.parquet(f"{tmp_path}/unpaired").collect()
    assert {r["reason"] for r in alone} == {"unanswered"}
    assert sorted([tuple(r) for r in pairs] + [(r["id"], None) for r in alone], key=str) == sorted(first_answers(rows), key=str)
    with pytest.raises(ValueError, match="unknown pairing"):
        job(tmp_path, pairing="any")
