"""Typed pairing: each request with the first response that follows it within `ttl`.

A join of requests and responses on the key and a time range would give every combination in
a key; a dense key would then grow with the square of its rows. Here the responses are carried
back to the requests by one window pass, which is linear in the rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.functions.keys import is_response, pair_key
from sigweave.functions.times import elapsed_ms, seconds
from sigweave.operators.skew import Skew, hot_values, is_hot, with_slices
from sigweave.operators.validation import valid
from sigweave.schema import MESSAGE, REQUEST_MARK, TTL_SECONDS

_COLUMNS = MESSAGE.names


def _next_of_slices(own: DataFrame) -> DataFrame:
    """The first response after each slice, as a row of that slice."""
    order = F.struct("ts", "id")
    heads = own.groupBy("pair_key", "slice").agg(
        F.min_by(
            F.when(F.col("responds"), F.struct(*_COLUMNS)),
            F.when(F.col("responds"), order),
        ).alias("response")
    )
    later = W.partitionBy("pair_key").orderBy(F.col("slice").desc())
    following = F.last("response", ignorenulls=True).over(
        later.rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        heads.select("pair_key", "slice", following.alias("response"))
        .where(F.col("response").isNotNull())
        .select("pair_key", "slice", "response.*", F.lit(True).alias("responds"))
    )


def answer_requests(
    messages: DataFrame, ttl: float = TTL_SECONDS, skew: Skew = Skew()
) -> DataFrame:
    """Every request, with `response` NULL and `latency_ms` NULL if none came in time."""
    mtype = F.col("message_type")
    keyed = (
        valid(messages)
        .where(is_response(mtype) | mtype.contains(REQUEST_MARK))
        .select(*_COLUMNS, pair_key().alias("pair_key"), is_response(mtype).alias("responds"))
    )
    hot = hot_values(keyed, F.col("pair_key"), skew.min_rows)
    if hot:
        # At one instant a response follows every request, whatever the ids.
        minor = [F.col("responds").cast("bigint")]
        own = with_slices(keyed, "pair_key", hot, skew, "ts", minor)
        ahead = _next_of_slices(own.where(is_hot(F.col("pair_key"), hot)))
        rows, by = own.unionByName(ahead), ["pair_key", "slice"]
    else:
        rows, by = keyed, ["pair_key"]
    backwards = W.partitionBy(*by).orderBy(
        F.col("ts").desc(), F.col("responds").desc(), F.col("id").desc()
    )
    # Field by field: what nobody asks for is pruned, down to the scan.
    running = backwards.rowsBetween(W.unboundedPreceding, W.currentRow)
    upcoming = {
        f"_{c}": F.last(F.when(F.col("responds"), F.col(c)), ignorenulls=True).over(running)
        if c in ("ts", "id")
        else F.last(
            F.when(F.col("responds"), F.struct(F.col(c).alias("v"))), ignorenulls=True
        ).over(running)["v"]
        for c in _COLUMNS
    }
    requests = rows.withColumns(upcoming).where(~F.col("responds"))
    response = F.when(
        F.col("_ts") < F.col("ts") + seconds(ttl),
        F.struct(*[F.col(f"_{c}").alias(c) for c in _COLUMNS]),
    )
    return requests.select(
        "pair_key", F.struct(*_COLUMNS).alias("request"), response.alias("response")
    ).withColumn("latency_ms", elapsed_ms(F.col("request.ts"), F.col("response.ts")))


def settle_requests(messages: DataFrame, until: Column | None, ttl: float, skew: Skew) -> DataFrame:
    """One step of a stream: `kind`, `first`, `second` of all messages held so far.

    No message older than `until` will come any more. So a request whose first response is older than that is
    final ('pair'), and one that has waited for `ttl` in vain ('unanswered'). Other requests are 'open', and so are
    responses that a request still to come may be answered by; earlier responses are done with. A key
    holds its open requests and such responses, never combinations of them. Messages of other types are left out.
    """
    none = F.lit(None).cast(MESSAGE)
    if until is None:
        return messages.select(F.lit("open").alias("kind"), F.struct(*_COLUMNS).alias("first"), none.alias("second"))
    found = F.coalesce(F.col("response.ts") < until, F.lit(False))
    over = F.col("request.ts") + seconds(ttl) <= until
    requests = answer_requests(messages, ttl, skew).select(
        F.when(found, "pair").when(over, "unanswered").otherwise("open").alias("kind"),
        F.col("request").alias("first"),
        F.when(found, F.col("response")).otherwise(none).alias("second"),
    )
    responses = messages.where(is_response(F.col("message_type")) & (F.col("ts") >= until))
    return requests.unionByName(
        responses.select(F.lit("open").alias("kind"), F.struct(*_COLUMNS).alias("first"), none.alias("second"))
    )


def answered(messages: DataFrame, ttl: float = TTL_SECONDS, skew: Skew = Skew()) -> DataFrame:
    return answer_requests(messages, ttl, skew).where(F.col("response").isNotNull())


def unanswered(messages: DataFrame, ttl: float = TTL_SECONDS, skew: Skew = Skew()) -> DataFrame:
    return answer_requests(messages, ttl, skew).where(F.col("response").isNull())
