"""Sessions of a tunnel, and the subscriber identity carried along in them.

The pairs of a tunnel id are walked in the order (t1, t0, id). A pair joins the open session
if its `t1` is less than `ttl` after the oldest message of that session, otherwise it opens
the next one. The limit moves with every older message, so this is a fold, not a window.

Built-in operators do the shuffle, the sort and the carrying of identity. Only three numbers
per pair visit Python, and the fold keeps four numbers, whatever the size of the tunnel.
Tunnels that outgrow a task are cut into slices of time, see `_hot_sessions`.
"""

from typing import Iterator, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.functions.keys import is_response
from sigweave.functions.times import seconds
from sigweave.operators.skew import Marked, Skew, held, hot_values, is_hot, with_slices
from sigweave.schema import CARRIED, DELETE_RESPONSE, FIELDS, MESSAGE, OPTIONAL, TTL_SECONDS

_NONE = -(1 << 62)
_PLACE = "session_no long, session_start long, first_n long"

_END = 1 << 61

# A slice of a hot tunnel is at most this many session lifetimes long, and as much shorter, down to a
# grain of a lifetime, as it takes to hold no more instants than a task should.
_LIFETIMES_PER_SLICE = 64
_INSTANTS_PER_SLICE = 1_000_000
_GRAINS = 1024
# Slices go to Python many at a time, as many as have a part of the instants of the largest one.
_CALLS_PER_SLICE = 4
_CALLS_PER_SHARE = 4


def _fold(ttl_us: int):
    """Session of each row, fed with rows sorted inside each tunnel.

    The state outlives a batch and is reset where `n` restarts. Not deterministic in Spark's
    sense: the rows a call sees must not be filtered beforehand. Inside a batch all is done for
    all rows at once, but for one short step from each session to the next.
    """

    @F.pandas_udf(_PLACE)
    def place(
        batches: Iterator[Tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        open_session = (0, _NONE, _NONE, 1)
        for batch in batches:
            columns = [s.to_numpy(dtype="int64") for s in batch]
            if len(columns[0]):
                out, open_session = _place_batch(columns, open_session, ttl_us)
                yield pd.DataFrame(out, columns=["session_no", "session_start", "first_n"])

    return place.asNondeterministic()


def _place_batch(columns: list[np.ndarray], before: tuple, ttl_us: int) -> tuple:
    """Places of the rows of a batch, and the session open at its end.

    `before`: number, start, oldest message and first row of the session that the first tunnel
    brings along from the batch before.
    """
    n, t0, t1, oldest_in, start_in = columns
    size = len(n)
    heads = np.flatnonzero(n == 1)
    if not len(heads) or heads[0] > 0:
        heads = np.append(0, heads)
    low = int(min(t0.min(), t1.min()))
    width = int(t1.max()) - low + 2 * ttl_us + 1
    if width * len(heads) > 1 << 62:
        half = size // 2
        left, middle = _place_batch([c[:half] for c in columns], before, ttl_us)
        right, after = _place_batch([c[half:] for c in columns], middle, ttl_us)
        return np.concatenate([left, right]), after
    ends = np.append(heads[1:], size)
    tunnel = np.repeat(np.arange(len(heads)), ends - heads)
    # Tunnels are laid one after the other on one axis of time, far enough apart.
    shift = tunnel * width - low
    at = t1 + shift
    # A pair's own latency is below `ttl`, so later pairs never shorten a session that they are
    # not part of: the oldest message to come decides where a session that opens here ends.
    oldest = np.minimum.accumulate((t0 + shift)[::-1])[::-1]
    follows = np.minimum(np.searchsorted(at, oldest + ttl_us), ends[tunnel])
    # What each tunnel brings along: nothing, or the open session of a stream or a batch before.
    number, start = np.zeros(len(heads), dtype="int64"), start_in[heads]
    known, first = oldest_in[heads], np.ones(len(heads), dtype="int64")
    if n[0] != 1:
        number[0], start[0], known[0], first[0] = before
    limit = np.minimum(np.maximum(known, low - ttl_us) + shift[heads], oldest[heads])
    enters = np.clip(np.searchsorted(at, limit + ttl_us), heads, ends)
    enters = np.where(known == _NONE, heads, enters)
    step, opened = follows.tolist(), []
    for i, end in zip(enters.tolist(), ends.tolist()):
        while i < end:
            opened.append(i)
            i = step[i]
    opened = np.array(opened, dtype="int64")
    latest = np.searchsorted(opened, np.arange(size), "right") - 1
    row = np.append(opened, -1)[latest]
    inside = row >= heads[tunnel]
    places = np.stack(
        [
            number[tunnel] + np.maximum(latest + 1 - np.searchsorted(opened, heads)[tunnel], 0),
            np.where(inside, t1[row], start[tunnel]),
            np.where(inside, n[row], first[tunnel]),
        ],
        axis=1,
    )
    if inside[-1]:
        last = int(t0[row[-1] :].min())
    else:
        last = min(int(known[-1]), int(t0[heads[-1] :].min()))
    return places, (places[-1, 0], places[-1, 1], last, places[-1, 2])


_ORDER = ["t1", "t0", "_id"]


def _with_id(pairs: DataFrame) -> DataFrame:
    """The last sort key as a column, so that every window shares one sort."""
    return pairs.withColumn("_id", F.col("first.id"))


def _own(field: str) -> Column:
    """A field's newest value in a pair."""
    return F.coalesce(F.col("second")[field], F.col("first")[field])


def _micros_or_none(pairs: DataFrame, column: str) -> Column:
    if column not in pairs.columns:
        return F.lit(_NONE)
    return F.coalesce(F.unix_micros(column), F.lit(_NONE))


def _cold_sessions(pairs: DataFrame, ttl_us: int, fields: list[str], lone: bool) -> DataFrame:
    """One shuffle and one sort by tunnel. The value to carry is looked up together with the
    position it stands at, and counts only if that lies inside the session. `lone`: pairs
    without a tunnel are among them, each a group of its own and in no session."""
    own = F.concat(F.lit("\u0001"), F.col("_id").cast("string"))
    group = "_group" if lone else "teid"
    w = W.partitionBy(group).orderBy(*_ORDER)
    earlier = w.rowsBetween(W.unboundedPreceding, -1)
    found = {
        f"_{f}": F.last(
            F.when(_own(f).isNotNull(), F.struct("_n", _own(f).alias("v"))), ignorenulls=True
        ).over(earlier)
        for f in fields
    }
    opening = [_micros_or_none(pairs, c) for c in ("oldest_in", "start_in")]
    place = _fold(ttl_us)(
        F.col("_n").cast("bigint"),
        F.unix_micros("t0"),
        F.unix_micros("t1"),
        *opening,
    )
    grouped = _with_id(pairs)
    if lone:
        grouped = grouped.withColumn("_group", F.coalesce("teid", own))
    placed = (
        grouped.withColumn("_n", F.row_number().over(w))
        .withColumns(found)
        .withColumn("_place", place)
    )
    carried = {
        f"prev_{f}": F.when(F.col(f"_{f}")["_n"] >= F.col("_place.first_n"), F.col(f"_{f}")["v"])
        for f in fields
    }
    number, start = F.col("_place.session_no"), F.timestamp_micros("_place.session_start")
    if lone:
        number, start = (F.when(F.col("teid").isNotNull(), c) for c in (number, start))
    return placed.select(
        *pairs.columns,
        number.alias("session_no"),
        start.alias("session_start"),
        *[c.alias(name) for name, c in carried.items()],
    )


def _by_slice(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Instants of some slices in order, the slice that each row is in, and where each slice begins and is over."""
    tunnel = pc.dictionary_encode(rows["teid"].combine_chunks()).indices.to_numpy()
    slice_ = rows["slice"].to_numpy()
    order = np.lexsort((rows["t1"].to_numpy(), slice_, tunnel))
    tunnel, slice_ = tunnel[order], slice_[order]
    heads = np.flatnonzero(np.append(True, (tunnel[1:] != tunnel[:-1]) | (slice_[1:] != slice_[:-1])))
    over = np.append(heads[1:], len(order))
    return rows.take(pa.array(order)), np.repeat(np.arange(len(heads)), over - heads), heads, over


def _reached(which: np.ndarray, t1: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For each row the first row of its slice at or after `times`, or where the slice is over."""
    size = len(t1)
    order = np.lexsort((np.repeat([0, 1], size), np.append(times, t1), np.append(which, which)))
    found = np.empty(2 * size, dtype="int64")
    found[order] = np.cumsum(order >= size)
    return found[:size]


def _links(ttl_us: int):
    """For each instant of some slices, as the opening of a session: where that session ends (`ends`), and
    for the sessions that follow up to the end of the slice how many there are with it (`opened`), when the
    last one begins (`last`) and where that one ends (`leaves`)."""

    def links(rows: pa.Table) -> pa.Table:
        rows, which, _, over = _by_slice(rows)
        t1 = rows["t1"].to_numpy()
        # A pair's own latency is below `ttl`, so later pairs never shorten a session that they are
        # not part of: the oldest message to come decides where a session that opens here ends.
        coming = pd.Series(rows["t0"].to_numpy()[::-1]).groupby(which[::-1]).cummin().to_numpy()[::-1]
        ends = np.minimum(coming, rows["ahead"].to_numpy()) + ttl_us
        follows = _reached(which, t1, ends)
        inside = follows < over[which]
        last, opened = np.where(inside, follows, np.arange(len(t1))), inside.astype("int64")
        while opened[last].any():
            opened, last = opened + opened[last], last[last]
        found = {"ends": ends, "leaves": ends[last], "last": t1[last], "opened": opened + 1}
        return pa.table({"teid": rows["teid"], "slice": rows["slice"], "t1": t1, **found})

    return links


def _places(rows: pa.Table) -> pa.Table:
    """Session of each instant of some slices, given the instant `entry` that opens the first one in each."""
    rows, which, heads, over = _by_slice(rows)
    t1, entry = rows["t1"].to_numpy(), pc.fill_null(rows["entry"], _END).to_numpy()
    step, opened = _reached(which, t1, rows["ends"].to_numpy()).tolist(), []
    for at, end in zip(_reached(which, t1, entry)[heads].tolist(), over.tolist()):
        while at < end:
            opened.append(at)
            at = step[at]
    opened = np.array(opened, dtype="int64")
    latest = np.searchsorted(opened, np.arange(len(t1)), "right")
    inside = latest - np.searchsorted(opened, heads)[which]
    starts = np.append(0, t1[opened])[latest]
    starts = np.where(inside > 0, starts, rows["start_in"].to_numpy())
    number = rows["number_in"].to_numpy() + inside
    return pa.table({"teid": rows["teid"], "_t1": t1, "session_no": number, "session_start": starts})


def _slice_length(timed: DataFrame, ttl_us: int) -> int:
    """Length of the slices, by the busiest grain of any tunnel: however uneven a tunnel is, no slice has
    more than `_INSTANTS_PER_SLICE` instants. A grain is far shorter than a lifetime and can have no more
    instants than microseconds."""
    grain = max(1, ttl_us // _GRAINS)
    busiest = timed.groupBy("teid", F.floor(F.col("_t1") / grain)).count().agg(F.max("count")).first()[0]
    most = _LIFETIMES_PER_SLICE * _GRAINS
    return grain * max(1, min(most, int(_INSTANTS_PER_SLICE / (busiest or 1))))


def _first_instants(probes: DataFrame, instants: DataFrame, slices: DataFrame, length: int) -> DataFrame:
    """`node`: the first instant of the tunnel at or after each time `x`, NULL if there is none."""
    placed = probes.withColumn("slice", F.floor(F.col("x") / length).cast("bigint"))
    rows = instants.select("teid", "slice", F.col("t1").alias("x"), F.lit(False).alias("probe"))
    rows = rows.unionByName(placed.withColumn("probe", F.lit(True)))
    backwards = W.partitionBy("teid", "slice").orderBy(F.col("x").desc(), "probe")
    node = F.last(F.when(~F.col("probe"), F.col("x")), ignorenulls=True)
    found = rows.withColumn("node", node.over(backwards.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # Where the rest of the slice has none, it is the head of the next slice that has any.
    none = placed.select("teid", "slice", F.lit(None).cast("bigint").alias("head"))
    heads = slices.select("teid", "slice", "head").unionByName(none)
    heads = heads.groupBy("teid", "slice").agg(F.min("head").alias("head"))
    later = W.partitionBy("teid").orderBy(F.col("slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    ahead = heads.select("teid", "slice", F.last("head", ignorenulls=True).over(later).alias("next_head"))
    return (
        found.where("probe")
        .join(ahead, ["teid", "slice"])
        .select("teid", "x", F.coalesce("node", "next_head").alias("node"))
    )


def _orbit(reached: DataFrame, jumps: DataFrame) -> DataFrame:
    """All nodes that repeated jumps lead to from the first ones, those included, by pointer doubling.

    After round k, 2 ** k nodes of each tunnel are known, and a jump goes 2 ** k nodes far.
    """
    jumps = held(jumps.where(F.col("next").isNotNull()))
    while True:
        new = held(reached.join(jumps, ["teid", "node"]).select("teid", F.col("next").alias("node")))
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        onward = jumps.select("teid", F.col("node").alias("next"), F.col("next").alias("far"))
        jumps = held(jumps.join(onward, ["teid", "next"]).select("teid", "node", F.col("far").alias("next")))


def _hot_sessions(pairs: DataFrame, ttl_us: int, fields: list[str], skew: Skew) -> DataFrame:
    """Sessions of tunnels too large for one task, all of whose pairs may lie in one lifetime.

    The pairs are first reduced to one row per tunnel and instant. Where a session that opens at an instant
    ends does not hang on how the instant was reached, so each instant has one successor, and the
    openings of sessions are the orbit of the first one. Inside a slice of time, of bounded size and possibly
    far shorter than a lifetime, the walk is done from all its instants at once; what leaves a slice leads
    to the instant at which another is entered. From entry to entry the orbit is found by doubling the
    jumps, in as many joins of narrow rows as the number of slices has binary digits. Then each slice
    knows its entry, and the sessions in it follow.
    """
    timed = pairs.withColumn("_t1", F.unix_micros("t1"))
    length = _slice_length(timed, ttl_us)
    instants = held(
        timed.withColumn("slice", F.floor(F.col("_t1") / length).cast("bigint"))
        .groupBy("teid", "slice", F.col("_t1").alias("t1"))
        .agg(F.min(F.unix_micros("t0")).alias("t0"))
    )
    slices = held(
        instants.groupBy("teid", "slice").agg(F.min("t1").alias("head"), F.min("t0").alias("low"))
    )
    shares = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calls = max(_CALLS_PER_SHARE * shares, -(-_CALLS_PER_SLICE * instants.count() // _INSTANTS_PER_SLICE))
    call = F.pmod(F.xxhash64("teid", "slice"), F.lit(calls)).alias("call")
    of_tunnel = W.partitionBy("teid")
    later = of_tunnel.orderBy(F.col("slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    ahead = F.coalesce(F.min("low").over(later), F.lit(_END))
    shape = "teid string, slice long, t1 long, ends long, leaves long, last long, opened long"
    links = held(
        instants.join(slices.select("teid", "slice", ahead.alias("ahead")), ["teid", "slice"])
        .groupBy(call)
        .applyInArrow(_links(ttl_us), shape)
    )

    # The first session opens at the first instant, or where the one that a stream left open ends.
    begins = slices.groupBy("teid").agg(F.min("head").alias("head"), F.min("low").alias("low"))
    opening = pairs.groupBy("teid").agg(
        *[F.first(_micros_or_none(pairs, c)).alias(c) for c in ("start_in", "oldest_in")]
    )
    ends = F.when(F.col("oldest_in") != _NONE, F.least("oldest_in", "low") + ttl_us)
    begins = held(begins.join(opening, "teid").select("teid", "start_in", F.coalesce(ends, "head").alias("x")))
    probes = links.select("teid", F.col("leaves").alias("x")).unionByName(begins.select("teid", "x"))
    targets = held(_first_instants(probes.distinct(), instants, slices, length))
    nodes = targets.where(F.col("node").isNotNull()).select("teid", F.col("node").alias("t1")).distinct()
    entries = held(links.join(nodes, ["teid", "t1"]).withColumnRenamed("t1", "node"))
    jumps = entries.join(targets.select("teid", F.col("x").alias("leaves"), F.col("node").alias("next")), ["teid", "leaves"])
    first = begins.join(targets, ["teid", "x"]).where(F.col("node").isNotNull()).select("teid", "node")
    visited = entries.join(_orbit(held(first), jumps.select("teid", "node", "next")), ["teid", "node"])

    before = of_tunnel.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    entered = (
        slices.select("teid", "slice")
        .join(visited.select("teid", "slice", F.col("node").alias("entry"), "opened", "last"), ["teid", "slice"], "left")
        .join(begins.select("teid", "start_in"), "teid")
        .select(
            "teid",
            "slice",
            "entry",
            F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("number_in"),
            F.coalesce(F.last("last", ignorenulls=True).over(before), "start_in").alias("start_in"),
        )
    )
    places = (
        links.select("teid", "slice", "t1", "ends")
        .join(entered, ["teid", "slice"])
        .groupBy(call)
        .applyInArrow(_places, "teid string, _t1 long, session_no long, session_start long")
        .withColumn("session_start", F.timestamp_micros("session_start"))
    )
    placed = timed.join(places, ["teid", "_t1"]).drop("_t1")
    return _carry_in_slices(placed, fields, skew) if fields else placed


def _carry_in_slices(placed: DataFrame, fields: list[str], skew: Skew) -> DataFrame:
    """`prev_*` inside a session, for sessions that may themselves outgrow a task: the last
    value of each slice is found by a pre-aggregated max and handed on to the next slices."""
    tag = F.concat_ws("\u0001", "session_no", "teid")
    tagged = _with_id(placed).withColumn("_tag", tag)
    hot = hot_values(tagged, F.col("_tag"), skew.min_rows)
    minor = [F.unix_micros("t0")]
    sliced = with_slices(tagged, "_tag", hot, skew, "t1", minor, "_slice", "_id")
    by = ["_tag", "_slice"]
    if hot:
        order = F.struct(*_ORDER)
        lasts = (
            sliced.where(is_hot(F.col("_tag"), hot))
            .groupBy(*by)
            .agg(
                *[
                    F.max_by(_own(f), F.when(_own(f).isNotNull(), order)).alias(f"_{f}")
                    for f in fields
                ]
            )
        )
        later = W.partitionBy("_tag").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
        handed = lasts.select(
            *by, *[F.last(f"_{f}", ignorenulls=True).over(later).alias(f"_{f}") for f in fields]
        )
        sliced = sliced.join(handed, by, "left")
    w = W.partitionBy(*by).orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, -1)
    carried = {f: F.last(_own(f), ignorenulls=True).over(w) for f in fields}
    if hot:
        carried = {f: F.coalesce(c, F.col(f"_{f}")) for f, c in carried.items()}
    return sliced.select(*placed.columns, *[c.alias(f"prev_{f}") for f, c in carried.items()])


def _placed(
    pairs: DataFrame,
    ttl: float,
    pair_ttl: float,
    fields: list[str],
    skew: Skew,
    hot: list | Marked | None,
    lone: bool = False,
) -> DataFrame:
    """Pairs with their session and, for each of `fields`, `prev_<field>`: the last value
    before the pair in its session.

    A stream adds what it knows of the session open before these rows: `oldest_in`, `start_in`
    and `<field>_in`. Pairs that join it get number 0.
    """
    if ttl < pair_ttl:
        raise ValueError("a session must live at least as long as a message waits")
    ttl_us = round(ttl * 1_000_000)
    known = pairs if lone else pairs.where(F.col("teid").isNotNull())
    if hot is None:
        hot = hot_values(known, F.col("teid"), skew.min_rows)
    if not hot:
        placed = _cold_sessions(known, ttl_us, fields, lone)
    else:
        known, to_cut = held(known), is_hot(F.col("teid"), hot)
        placed = _cold_sessions(known.where(~to_cut), ttl_us, fields, lone).unionByName(
            _hot_sessions(known.where(to_cut), ttl_us, fields, skew)
        )
    # A session open before these rows (number 0) holds what it has carried so far.
    opening = {
        f"prev_{f}": F.coalesce(f"prev_{f}", F.when(F.col("session_no") == 0, F.col(f"{f}_in")))
        for f in fields
        if f"{f}_in" in pairs.columns
    }
    return placed.withColumns(opening) if opening else placed


def hot_tunnels(messages: DataFrame, skew: Skew = Skew()) -> list | Marked:
    """Tunnels that may need cutting, found in one narrow scan of the messages before any
    pairing: a pair has its tunnel id from one response, so no tunnel has more pairs."""
    total = messages.select(F.lit(1)).count()
    responses = messages.where(is_response(F.col("message_type")))
    return hot_values(responses, F.col("teid"), skew.min_rows, total)


def sessions(
    pairs: DataFrame,
    ttl: float = TTL_SECONDS,
    pair_ttl: float = TTL_SECONDS,
    skew: Skew = Skew(),
    hot: list | Marked | None = None,
) -> DataFrame:
    """SESSION rows: the pair and its session_no, counted from 1 in each tunnel, and
    session_start, the time at which the pair that opened the session was complete. Pairs
    without a tunnel id belong to no session and are left out.

    `hot` names the tunnels to cut into slices. Left out, they are searched for in `pairs`; a
    caller who has the messages finds them there for less, see `hot_tunnels`."""
    return _placed(pairs, ttl, pair_ttl, [], skew, hot)


def _filled(side: str, value: dict[str, Column]) -> Column:
    return F.struct(
        *[value.get(c, F.col(side)[c]).alias(c) for c in MESSAGE.names]
    ).alias(side)


def fill_messages(placed: DataFrame, fields: list[str], lone: bool = False) -> DataFrame:
    """Puts the carried values into both messages of each pair, and drops `prev_*`. `lone`: pairs
    without a tunnel are among them and stay as they are."""
    first = {f: F.coalesce(F.col("first")[f], F.col(f"prev_{f}")) for f in fields}
    second = {f: F.coalesce(F.col("second")[f], first[f]) for f in fields}
    if lone:
        known = F.col("teid").isNotNull()
        second = {f: F.when(known, c).otherwise(F.col("second")[f]) for f, c in second.items()}
    kept = [
        c
        for c in placed.columns
        if c not in ("first", "second") and not c.startswith("prev_")
    ]
    return placed.select(
        *kept,
        _filled("first", first),
        _filled("second", second),
        *[second[f].alias(f) for f in CARRIED],
    )


def enrich_sessions(
    pairs: DataFrame,
    ttl: float = TTL_SECONDS,
    carry_all: bool = False,
    pair_ttl: float = TTL_SECONDS,
    skew: Skew = Skew(),
    hot: list | Marked | None = None,
    lone: bool = False,
) -> DataFrame:
    """`sessions` with identity carried forward: each message lacking a carried field takes
    the latest value before it in its session. `carry_all` does so for all optional fields.
    `lone`: keep the pairs without a tunnel id, which are in no session."""
    fields = OPTIONAL if carry_all else CARRIED
    return fill_messages(_placed(pairs, ttl, pair_ttl, fields, skew, hot, lone), fields, lone)


def continue_sessions(
    pairs: DataFrame,
    open_sessions: DataFrame,
    ttl: float,
    pair_ttl: float,
    carry_all: bool,
    skew: Skew,
) -> DataFrame:
    """One step of a stream: `enrich_sessions` of new pairs, all later than any pair before,
    going on from the open sessions."""
    fields = OPTIONAL if carry_all else CARRIED
    known = pairs.where(F.col("teid").isNotNull())
    hot = hot_values(known, F.col("teid"), skew.min_rows)
    joined = known.join(open_sessions, "teid", "left")
    if hot:
        # Hot tunnels have one open session each: a side that Spark can broadcast or split by itself.
        to_cut = is_hot(F.col("teid"), hot)
        joined = joined.where(~to_cut).unionByName(
            known.where(to_cut).join(open_sessions.where(to_cut), "teid", "left")
        )
    placed = _placed(joined, ttl, pair_ttl, fields, skew, hot)
    oldest = F.least("t0", F.when(F.col("session_no") == 0, F.col("oldest_in")))
    known_oldest = placed.withColumn("_oldest", oldest)
    return fill_messages(known_oldest.drop(*open_session_columns(carry_all)[1:]), fields)


def open_session_columns(carry_all: bool) -> list[str]:
    fields = OPTIONAL if carry_all else CARRIED
    return ["teid", "start_in", "oldest_in", *[f"{f}_in" for f in fields]]


def sessions_touched(enriched: DataFrame, carry_all: bool) -> DataFrame:
    """The latest session of each tunnel in the result of `continue_sessions`, as later pairs go on from it."""
    order = F.struct("t1", "t0", "first.id")
    fields = OPTIONAL if carry_all else CARRIED
    return (
        enriched.groupBy("teid", F.col("session_start").alias("start_in"))
        .agg(
            F.min("_oldest").alias("oldest_in"),
            *[F.max_by(F.col("second")[f], order).alias(f"{f}_in") for f in fields],
        )
        .groupBy("teid")
        .agg(F.max_by(F.struct(*open_session_columns(carry_all)[1:]), "start_in").alias("s"))
        .select("teid", "s.*")
    )


def session_profiles(enriched: DataFrame) -> DataFrame:
    """Field-wise merge of a session's messages, the last present value of each field. Takes
    `enrich_sessions(carry_all=True)`, where the last message of a session has them all. One
    shuffle and one sort."""
    fields = [f for f in FIELDS if f != "teid"]
    session = ["teid", "session_no", "session_start"]
    last = [F.col("second")[f].alias(f) for f in fields]
    newest = W.partitionBy(*session).orderBy(*[F.col(c).desc() for c in _ORDER])
    # Ordered from the end, the first row is the last pair, and has been counted to by the others.
    whole = newest.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        enriched.select(*session, "t1", "t0", F.col("first.id").alias("_id"), *last)
        .withColumn("pairs", F.count(F.lit(1)).over(whole))
        .withColumn("_n", F.row_number().over(newest))
        .where("_n = 1")
        .select(*session, "pairs", *fields)
    )


def mark_deletes(placed: DataFrame) -> DataFrame:
    """Sessions with the time of their first delete response; it does not end them."""
    deleted = [
        F.when(F.col(side)["message_type"] == DELETE_RESPONSE, F.col(side)["ts"])
        for side in ("first", "second")
    ]
    return (
        placed.groupBy("teid", "session_no", "session_start")
        .agg(F.min(F.least(*deleted)).alias("deleted_at"))
        .withColumn("closed_by_delete", F.col("deleted_at").isNotNull())
    )
