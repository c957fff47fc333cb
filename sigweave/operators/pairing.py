"""Greedy pairing of messages that share a pair key.

The messages of a key are walked in time order. A waiting message pairs with the next one if
that comes less than `ttl` later; otherwise it stays alone and the next one waits. The waiting
message is always the neighbour just before, so runs without a gap of `ttl` or more can be
paired by parity of the position in the run, without any recursion.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.functions.keys import pair_key, pair_teid
from sigweave.functions.times import elapsed_ms, seconds
from sigweave.operators.skew import Marked, Skew, hot_values, is_hot, with_slices
from sigweave.operators.validation import rejected, valid
from sigweave.schema import MESSAGE, TTL_SECONDS

_COLUMNS = MESSAGE.names

# Role of a row inside a slice of a hot key.
_OWN, _WAITING, _AHEAD = 0, 1, 2


def _at(ts="ts", id_="id") -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(id_).alias("id"))


def _slice_summary(own: DataFrame, ttl: float) -> DataFrame:
    """One row per slice: first and last message, and the length of its last run."""
    w = W.partitionBy("pair_key", "slice").orderBy("ts", "id")
    steps = own.select(
        "pair_key",
        "slice",
        _at().alias("at"),
        F.row_number().over(w).alias("n"),
        (F.col("ts") >= F.lag("ts").over(w) + seconds(ttl)).alias("breaks"),
    )
    return steps.groupBy("pair_key", "slice").agg(
        F.min("at").alias("head"),
        F.max("at").alias("tail"),
        F.count(F.lit(1)).alias("rows"),
        F.max(F.when(F.col("breaks"), F.col("n"))).alias("last_break"),
    )


def _handover(own: DataFrame, ttl: float) -> DataFrame:
    """Neighbours of each slice, and whether a message waits for it in the one before."""
    w = W.partitionBy("pair_key").orderBy("slice")
    linked = _slice_summary(own, ttl).select(
        "*",
        F.lag("slice").over(w).alias("prev_slice"),
        F.lag("tail").over(w).alias("prev_tail"),
        F.lead("head").over(w).alias("next_head"),
        F.coalesce(F.col("rows") - F.col("last_break") + 1, "rows").alias("run_rows"),
    )
    continues = F.coalesce(
        F.col("head.ts") < F.col("prev_tail.ts") + seconds(ttl), F.lit(False)
    )
    running = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = linked.withColumn("continues", continues).withColumn(
        "total", F.sum("run_rows").over(running)
    )
    restarts = ~F.col("continues") | F.col("last_break").isNotNull()
    open_rows = F.col("total") - F.max(
        F.when(restarts, F.col("total") - F.col("run_rows"))
    ).over(running)
    return (
        counted.withColumn("open_rows", open_rows)
        .withColumn("prev_open", F.lag("open_rows").over(w))
        .select(
            "pair_key",
            "slice",
            "prev_slice",
            "next_head",
            (F.col("continues") & (F.col("prev_open") % 2 == 1)).alias("awaited"),
        )
    )


def _linked_slices(keyed: DataFrame, hot: list | Marked, ttl: float, skew: Skew) -> DataFrame:
    """Adds to each slice of a hot key the message waiting for it, and a look-ahead row."""
    own = with_slices(
        keyed, "pair_key", hot, skew, "ts", []
    ).withColumn("role", F.lit(_OWN))
    cut = own.where(is_hot(F.col("pair_key"), hot))
    handover = _handover(cut, ttl)
    tails = cut.groupBy("pair_key", F.col("slice").alias("prev_slice")).agg(
        F.max_by(F.struct(*_COLUMNS), _at()).alias("message")
    )
    waiting = (
        handover.where("awaited")
        .select("pair_key", "prev_slice", "slice")
        .join(tails, ["pair_key", "prev_slice"])
        .select("pair_key", "slice", "message.*", F.lit(_WAITING).alias("role"))
    )
    ahead = handover.where(F.col("next_head").isNotNull()).select(
        "pair_key", "slice", "next_head.ts", "next_head.id", F.lit(_AHEAD).alias("role")
    )
    return own.unionByName(waiting).unionByName(ahead, allowMissingColumns=True)


def hot_pair_keys(
    messages: DataFrame, skew: Skew = Skew(), total: int | None = None
) -> list | Marked:
    """Pair keys to cut into slices. Unusable messages count for the total only, so that a
    columnar table is counted without reading it."""
    if total is None and not messages.isStreaming:
        total = messages.select(F.lit(1)).count()
    return hot_values(valid(messages), pair_key(), skew.min_rows, total)


def _walk(messages: DataFrame, ttl: float, skew: Skew, hot: list | Marked | None) -> DataFrame:
    """Each message that waits (odd position in its run), with its successor `next_*` if that
    pairs with it. One shuffle and one sort by pair key."""
    keyed = valid(messages).select(*_COLUMNS, pair_key().alias("pair_key"))
    if hot is None:
        hot = hot_pair_keys(messages, skew)
    if hot:
        rows, by = _linked_slices(keyed, hot, ttl, skew), ["pair_key", "slice"]
    else:
        rows, by = keyed.withColumn("role", F.lit(_OWN)), ["pair_key"]
    w = W.partitionBy(*by).orderBy("ts", "id")
    starts_run = F.coalesce(F.col("ts") >= F.lag("ts").over(w) + seconds(ttl), F.lit(True))
    placed = rows.select(
        "*",
        F.row_number().over(w).alias("n"),
        starts_run.alias("starts_run"),
        *[F.lead(c).over(w).alias(f"next_{c}") for c in [*_COLUMNS, "role"]],
    )
    run_start = F.max(F.when(F.col("starts_run"), F.col("n"))).over(
        w.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        placed.withColumn("run_start", run_start)
        .where((F.col("n") - F.col("run_start")) % 2 == 0)
        .withColumn(
            "met", F.coalesce(F.col("next_ts") < F.col("ts") + seconds(ttl), F.lit(False))
        )
    )


def pair_columns() -> list[Column]:
    first, second = F.col("first"), F.col("second")
    return [
        F.col("pair_key"),
        first,
        second,
        first["ts"].alias("t0"),
        second["ts"].alias("t1"),
        pair_teid(first, second).alias("teid"),
        elapsed_ms(first["ts"], second["ts"]).alias("latency_ms"),
    ]


def pair_messages(
    messages: DataFrame,
    ttl: float = TTL_SECONDS,
    skew: Skew = Skew(),
    hot: list | Marked | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """PAIR rows: pair_key, first, second, t0, t1, teid, latency_ms.

    `hot` names the pair keys to cut into slices; left out, they are searched for. `keep`: the
    fields wanted in both messages, besides the id and those that pairs are made with; others
    are not read."""
    kept = _COLUMNS
    if keep is not None:
        kept = [c for c in _COLUMNS if c in {"id", "ts", "message_type", "teid", *keep}]
    met = _walk(messages, ttl, skew, hot).where(F.col("met") & (F.col("next_role") == _OWN))
    return met.select(
        "pair_key",
        F.struct(*kept).alias("first"),
        F.struct(*[F.col(f"next_{c}").alias(c) for c in kept]).alias("second"),
    ).select(*pair_columns())


def settle_messages(
    messages: DataFrame,
    until: Column | None,
    ttl: float,
    skew: Skew,
    hot: list | Marked | None = None,
) -> DataFrame:
    """One step of a stream: `kind`, `first`, `second` of all messages held so far.

    No message older than `until` will come any more. Pairs of messages older than that are
    final ('pair'), and so are those that waited in vain ('expired'). All others, and those
    still waiting, are 'open' and belong to the next step.
    """
    message = F.struct(*_COLUMNS).alias("first")
    none = F.lit(None).cast(MESSAGE).alias("second")
    if until is None:
        return messages.select(F.lit("open").alias("kind"), message, none)
    walked = _walk(messages.where(F.col("ts") < until), ttl, skew, hot)
    paired = F.col("met") & (F.col("next_role") == _OWN)
    over = F.col("ts") + seconds(ttl) <= until
    kind = F.when(paired, "pair").when(over, "expired").otherwise("open")
    second = F.struct(*[F.col(f"next_{c}").alias(c) for c in _COLUMNS])
    settled = walked.where(paired | (~F.col("met") & (F.col("role") == _OWN))).select(
        kind.alias("kind"), message, F.when(paired, second).alias("second")
    )
    ahead = messages.where(F.col("ts") >= until)
    return settled.unionByName(ahead.select(F.lit("open").alias("kind"), message, none))


def unpaired_messages(
    messages: DataFrame,
    ttl: float = TTL_SECONDS,
    skew: Skew = Skew(),
    hot: list | Marked | None = None,
) -> DataFrame:
    """UNPAIRED rows: pair_key, the message, reason. Rejected messages are among them."""
    alone = _walk(messages, ttl, skew, hot).where(~F.col("met") & (F.col("role") == _OWN))
    expired = alone.select("pair_key", *_COLUMNS, F.lit("expired").alias("reason"))
    no_key = F.lit(None).cast("string").alias("pair_key")
    return expired.unionByName(rejected(messages).select(no_key, *_COLUMNS, "reason"))
