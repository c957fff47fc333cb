import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import sigweave.operators.sessions as S
import sigweave.operators.skew as K
from sigweave.operators.pairing import pair_messages
from sigweave.operators.skew import Skew, hot_values
from tests.sequences import folded, messages, pair_table, random_pairs


def placed(df):
    rows = df.select(
        "first.id",
        "teid",
        "session_no",
        F.unix_micros("session_start").alias("start"),
        F.col("first.imsi").alias("a"),
        F.col("second.imsi").alias("b"),
    ).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize(
    "gaps",
    [
        [0, 0, 1000, 20_000_000, 59_999_999, 60_000_000, 61_000_000],
        [0, 0, 0, 1000, 1_000_000, 7_000_000],
        [0, 0, 0, 1],
    ],
)
@pytest.mark.parametrize("skew", [Skew(), Skew(min_rows=50, slice_seconds=60, id_block=3)])
def test_same_as_loop(spark, gaps, skew, monkeypatch):
    monkeypatch.setattr(S, "_LIFETIMES_PER_SLICE", 4)
    monkeypatch.setattr(S, "_INSTANTS_PER_SLICE", 100)
    rows = random_pairs(5, 500, gaps)
    expected = folded(rows)
    random.Random(2).shuffle(rows)
    pairs = pair_table(spark, rows).repartition(3)
    assert placed(S.enrich_sessions(pairs, skew=skew)) == expected


def two(at, seq, teid, q=None, r=None):
    """A request at `at` and its response one second later."""
    return [
        {"at": at, "seq": seq, **(q or {})},
        {"at": at + 1, "seq": seq, "q": False, "teid": teid, **(r or {})},
    ]


def test_identity_is_carried_and_nothing_else(spark):
    rows = two(0, 1, "T", {"imsi": "I", "msisdn": "M"}, {"cause": "16"}) + two(20, 2, "T")
    pairs = pair_messages(messages(spark, rows))
    got = S.enrich_sessions(pairs).orderBy("t1").collect()
    for r in got:
        assert r["imsi"] == "I" and r["msisdn"] == "M"
        assert r["first"]["imsi"] == r["second"]["imsi"] == "I"
    assert got[1]["second"]["cause"] is None
    everything = S.enrich_sessions(pairs, carry_all=True).orderBy("t1").collect()
    assert everything[1]["first"]["cause"] == "16" and everything[1]["second"]["cause"] == "16"


def test_session_lives_from_its_oldest_message(spark):
    rows = [r for i, at in enumerate([0, 29, 58, 60]) for r in two(at, i, "T")]
    got = S.sessions(pair_messages(messages(spark, rows))).orderBy("t1").collect()
    assert [r["session_no"] for r in got] == [1, 1, 1, 2]


def test_identity_ends_with_the_session(spark):
    rows = two(0, 1, "T", {"imsi": "I"}) + two(100, 2, "T")
    got = S.enrich_sessions(pair_messages(messages(spark, rows))).orderBy("t1").collect()
    assert [r["imsi"] for r in got] == ["I", None]


def test_pairs_without_tunnel_are_no_session(spark):
    pairs = pair_messages(messages(spark, two(0, 1, None)))
    assert pairs.count() == 1 and S.sessions(pairs).count() == 0


def test_profile_and_delete_marker(spark):
    rows = two(0, 1, "T", {"imsi": "I"}, {"cause": "16"})
    rows += two(20, 2, "T", {"imsi": "J"}, {"message_type": "Delete Session Response"})
    pairs = pair_messages(messages(spark, rows))
    placed_pairs = S.sessions(pairs)
    profile = S.session_profiles(S.enrich_sessions(pairs, carry_all=True)).first()
    assert (profile["imsi"], profile["cause"], profile["pairs"]) == ("J", "16", 2)
    assert S.mark_deletes(placed_pairs).first()["closed_by_delete"]
    assert placed_pairs.select("session_no").distinct().count() == 1


def test_session_must_outlive_a_pair(spark):
    pairs = pair_messages(messages(spark, two(0, 1, "T")))
    with pytest.raises(ValueError):
        S.sessions(pairs, ttl=30)


def test_filter_above_the_fold_does_not_change_it(spark):
    rows = [r for i, at in enumerate([0, 40, 70]) for r in two(at, i, "T")]
    placed_pairs = S.sessions(pair_messages(messages(spark, rows)))
    kept = placed_pairs.where(F.col("first.id") >= 2).orderBy("t1").collect()
    assert [r["session_no"] for r in kept] == [1, 2]


def sliced(rows, length):
    """Tables of instants for the worker functions, one per slice of a tunnel."""
    least = {}
    for _, t0, t1, *_ in rows:
        least[t1] = min(t0, least.get(t1, t0))
    slices = {}
    for t1, t0 in least.items():
        slices.setdefault(t1 // length, []).append((t1, t0))
    ahead, tables = S._END, {}
    for k in sorted(slices, reverse=True):
        t1, t0 = zip(*slices[k])
        size = len(t1)
        tables[k] = pa.table({"teid": ["T0"] * size, "slice": [k] * size, "t1": t1, "t0": t0, "ahead": [ahead] * size})
        ahead = min(ahead, *t0)
    return tables


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("lifetimes", [2, 0.03])
def test_slice_links_are_exact(seed, lifetimes):
    """The worker functions of the sliced fold, run on one long tunnel without Spark."""
    rng = random.Random(seed)
    ttl = 60_000_000
    gaps = rng.choice(
        [[0, 1000, 5_000_000], [20_000_000, 59_999_999, 60_000_000], [1, 7, 300_000], [90_000_000, 0, 1]]
    )
    rows = [("T0", *r[1:]) for r in random_pairs(seed, 6000, gaps)]
    expected = folded(rows)
    tables = sliced(rows, round(lifetimes * ttl))
    links = {k: S._links(ttl)(t) for k, t in tables.items()}
    at, number, start, places = 0, 0, S._NONE, {}
    for k in sorted(links):
        own = links[k].to_pylist()
        entry = next((r for r in own if r["t1"] >= at), None)
        extra = {"entry": entry and entry["t1"], "number_in": number, "start_in": start}
        given = pa.table({c: links[k][c] for c in ("teid", "slice", "t1", "ends")})
        for name, value in extra.items():
            given = given.append_column(name, pa.array([value] * len(own), pa.int64()))
        places |= {r["_t1"]: (r["session_no"], r["session_start"]) for r in S._places(given).to_pylist()}
        if entry:
            at, number, start = entry["leaves"], number + entry["opened"], entry["last"]
    for _, t0, t1, i, *_ in rows:
        assert places[t1] == expected[i][1:3]


def test_orbit_by_doubling(spark):
    jumps = [("A", k, k + 3 if k < 200 else None) for k in range(0, 203)] + [("B", 5, None), ("C", 1, 2), ("C", 2, None)]
    table = spark.createDataFrame(jumps, "teid string, node long, next long")
    starts = spark.createDataFrame([("A", 1), ("B", 5), ("C", 2)], "teid string, node long")
    got = [tuple(r) for r in S._orbit(starts, table).collect()]
    assert sorted(got) == [("A", k) for k in range(1, 203, 3)] + [("B", 5), ("C", 2)]


@pytest.mark.parametrize("gap", [1, 900, 12_000])
def test_all_pairs_in_few_lifetimes(spark, gap, monkeypatch):
    """One tunnel, far more pairs in one lifetime than a slice may have."""
    monkeypatch.setattr(S, "_INSTANTS_PER_SLICE", 400)
    rng = random.Random(gap)
    rows, t1 = [], 1_700_000_000_000_000
    for i in range(6000):
        t1 += rng.choice([0, gap, 2 * gap])
        t0 = t1 - rng.choice([0, 1000, 59_999_999])
        rows.append(("T0", t0, t1, i, f"I{i}" if i % 97 == 0 else None, None))
    pairs = pair_table(spark, rows)
    timed = pairs.withColumn("_t1", F.unix_micros("t1"))
    length = S._slice_length(timed, 60_000_000)
    assert length < 60_000_000
    largest = timed.select("_t1").distinct().groupBy(F.floor(F.col("_t1") / length)).count().agg(F.max("count")).first()[0]
    # Slices are bounded but for what is dated in the same grain of a lifetime.
    grain = timed.select("_t1").distinct().groupBy(F.floor(F.col("_t1") / (60_000_000 // S._GRAINS))).count()
    assert largest <= max(400, grain.agg(F.max("count")).first()[0])
    got = S.enrich_sessions(pairs, skew=Skew(min_rows=1000, slice_seconds=1, id_block=100))
    assert placed(got) == folded(rows)


def test_many_hot_tunnels_are_marked_not_named(spark, monkeypatch):
    """More hot values than may be named reach the driver as a bitmap of fixed size; sessions stay the same."""
    monkeypatch.setattr(K, "_NAMED", 5)
    rows = random_pairs(11, 400, [0, 1000, 20_000_000, 59_999_999, 60_000_000])
    rows = [(f"T{i % 40}", *r[1:]) for i, r in enumerate(rows)]
    pairs = pair_table(spark, rows).repartition(3)
    skew = Skew(min_rows=2, slice_seconds=60, id_block=3)
    hot = hot_values(pairs, F.col("teid"), skew.min_rows)
    assert isinstance(hot, K.Marked) and len(hot.bits) < 100_000
    marked = {r[0] for r in pairs.where(K.is_hot(F.col("teid"), hot)).select("teid").distinct().collect()}
    counts = Counter(r[0] for r in rows)
    assert {t for t, n in counts.items() if n > 2} <= marked
    assert placed(S.enrich_sessions(pairs, skew=skew)) == folded(rows)
    none = spark.createDataFrame([(None,), ("x",)], "teid string")
    assert [r[0] for r in none.select(K.is_hot(F.col("teid"), K.Marked("0," * 4095 + "0"))).collect()] == [False, False]
