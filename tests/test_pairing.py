import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigweave.functions.keys import pair_key
from sigweave.operators.interval import answer_requests, answered
from sigweave.operators.pairing import hot_pair_keys, pair_messages, unpaired_messages
from sigweave.operators.skew import Skew, hot_values, with_slices
from sigweave.operators.validation import blank_to_null, with_time
from tests.sequences import first_answers, greedy, messages, random_messages

SPARSE = [0, 0, 0.001, 20, 59.999999, 60, 61]
DENSE = [0, 0, 0, 0.001, 1, 30]


def pair_ids(df):
    return sorted(tuple(r) for r in df.select("first.id", "second.id").collect())


def alone_ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_basic(spark):
    m = messages(spark, [{"at": 0}, {"at": 10, "q": False, "teid": "T"}])
    row = pair_messages(m).first()
    assert (row["first"]["id"], row["second"]["id"]) == (0, 1)
    assert row["latency_ms"] == 10_000 and row["teid"] == "T"
    assert unpaired_messages(m).count() == 0


@pytest.mark.parametrize("gap, pairs", [(59.999, 1), (59.999999, 1), (60.0, 0)])
def test_limit_is_strict(spark, gap, pairs):
    m = messages(spark, [{"at": 0}, {"at": gap, "q": False}])
    assert pair_messages(m).count() == pairs
    assert unpaired_messages(m).count() == 2 - 2 * pairs
    assert answered(m).count() == pairs


def test_addresses_in_string_order(spark):
    m = messages(spark, [{"at": 0, "seq": 7}, {"at": 1, "seq": 7, "q": False}])
    keys = {r[0] for r in m.select(pair_key()).collect()}
    assert keys == {"7-10.0.0.1-9.0.0.1"}


def test_retransmission(spark):
    m = messages(spark, [{"at": 0}, {"at": 2}, {"at": 3, "q": False, "teid": "T"}])
    rows = pair_messages(m).collect()
    assert [(r["first"]["id"], r["second"]["id"], r["teid"]) for r in rows] == [(0, 1, None)]
    assert alone_ids(unpaired_messages(m)) == [2]
    found = answered(m).select("request.id", "response.id").collect()
    assert sorted(map(tuple, found)) == [(0, 2), (1, 2)]


def test_runs_pair_by_two(spark):
    m = messages(spark, [{"at": i} for i in range(6)])
    assert pair_ids(pair_messages(m)) == [(0, 1), (2, 3), (4, 5)]
    m = messages(spark, [{"at": i} for i in range(3)])
    assert pair_ids(pair_messages(m)) == [(0, 1)]
    assert alone_ids(unpaired_messages(m)) == [2]


def test_response_first_and_blank_teid(spark):
    m = messages(spark, [{"at": 0, "q": False, "teid": "T"}, {"at": 1}])
    assert pair_messages(m).first()["teid"] == "T"
    m = messages(spark, [{"at": 0}, {"at": 1, "q": False, "teid": ""}])
    assert pair_messages(m).first()["teid"] is None


def test_unusable_messages_are_reported(spark):
    m = messages(spark, [{"at": 0}, {"at": 1, "q": False}, {"at": 2, "dest_ip": None}, {"at": 3}])
    bad = F.when(F.col("id") == 3, F.lit("2024/13/45 00:00:00.000")).otherwise(F.col("timestamp"))
    m = with_time(blank_to_null(m.withColumn("timestamp", bad)))
    assert pair_ids(pair_messages(m)) == [(0, 1)]
    reasons = {r["id"]: r["reason"] for r in unpaired_messages(m).collect()}
    assert reasons == {2: "missing_field", 3: "invalid_ts"}


@pytest.mark.parametrize("gaps", [SPARSE, DENSE])
@pytest.mark.parametrize(
    "skew",
    [
        Skew(),
        Skew(min_rows=50, slice_seconds=60, id_block=3),
        Skew(min_rows=5, slice_seconds=7, id_block=2),
    ],
)
def test_same_as_loop(spark, gaps, skew):
    rows = random_messages(3, 1000, gaps)
    shuffled = list(rows)
    random.Random(1).shuffle(shuffled)
    m = messages(spark, shuffled).cache()
    assert bool(hot_pair_keys(m, skew)) == (skew.min_rows < 1000)
    pairs, alone = greedy(rows)
    assert pair_ids(pair_messages(m, skew=skew)) == pairs
    assert alone_ids(unpaired_messages(m, skew=skew)) == alone
    found = answer_requests(m, skew=skew).select("request.id", "response.id").collect()
    assert sorted(map(tuple, found)) == first_answers(rows)
    m.unpersist()


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.sampled_from([0, 0.5, 30, 59.999999, 60, 90]), st.integers(0, 2), st.booleans()),
        max_size=30,
    )
)
def test_every_message_comes_out_once(spark, steps):
    at, rows = 0.0, []
    for i, (gap, seq, q) in enumerate(steps):
        at += gap
        rows.append({"id": i, "at": at, "seq": seq, "q": q})
    if not rows:
        return
    m = messages(spark, rows)
    pairs, alone = pair_ids(pair_messages(m)), alone_ids(unpaired_messages(m))
    assert (pairs, alone) == greedy(rows)
    assert sorted([i for p in pairs for i in p] + alone) == list(range(len(rows)))


@pytest.mark.parametrize("step", [0.001, 0.01, 0.0, 1.0])
@pytest.mark.parametrize("hashed", [False, True])
def test_slices_stay_few(spark, step, hashed):
    """A dense key has about one slice per `min_rows` rows, and one per minute, whatever its ids."""
    rows = [{"id": i, "at": i * step, "seq": 1, "q": True} for i in range(4000)]
    m = messages(spark, rows).withColumn("k", F.lit("hot"))
    if hashed:
        m = m.withColumn("id", F.xxhash64("id"))
    skew = Skew(min_rows=500, id_block=400)
    cut = with_slices(m, "k", ["hot"], skew, "ts", [])
    sizes = [r["count"] for r in cut.groupBy("slice").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 1000
    assert len(sizes) <= 2 * 4000 / 400 + 4000 * step / 60 + 2
    ordered = [r["id"] for r in cut.orderBy("slice", "ts", "id").collect()]
    assert ordered == [r["id"] for r in m.orderBy("ts", "id").collect()]


def test_hot_values_are_exact(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert hot_values(df, F.col("k"), 1000) == ["hot"]
    assert hot_values(df, F.col("k"), 5000) == []
    assert hot_values(df, F.col("k"), 20_000) == []
