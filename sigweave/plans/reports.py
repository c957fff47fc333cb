"""The queries of this package over the `events` table, one per operator.

Each takes a session and a data folder and gives a flat DataFrame. Times are given without a
zone, as the table has them.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.functions import keys, times
from sigweave.operators import interval, offsets, output, pairing, sessions, validation
from sigweave.operators.skew import Skew
from sigweave.plans.publish import enriched_pairs
from sigweave.schema import FIELDS, OPTIONAL
from sigweave.sources.events import event_messages
from sigweave.sources.kv_lines import LINE_KEYS, parse_lines

TOPIC = "signals"
SESSION_TTL = 3600.0

# Limits so low that the cutting of hot groups runs on any table.
CUT = Skew(min_rows=2, slice_seconds=3600, id_block=50)
CUT_TUNNELS = Skew(min_rows=1, slice_seconds=3600, id_block=50)


def _ntz(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    return messages.select("id", keys.pair_key().alias("pair_key"))


def message_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    groups = messages.groupBy(keys.composite_key().alias("k")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    return groups.select("k.*", "messages")


def digest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = keys.unique_key(F.col("sequence_number"), F.col("source_ip"), F.col("dest_ip"))
    return event_messages(spark, sf_dir).select("id", key.alias("unique_key"))


def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth message has month 13, every seventh no time at all."""
    bad = F.when(F.col("id") % 5 == 0, F.regexp_replace("timestamp", r"/\d\d/", "/13/"))
    text = F.coalesce(F.when(F.col("id") % 7 == 0, F.lit("never")), bad, F.col("timestamp"))
    messages = event_messages(spark, sf_dir).select("id", text.alias("timestamp"))
    return messages.select("id", "timestamp", _ntz(times.parse_ts("timestamp")).alias("parsed"))


def fresh_messages(spark: SparkSession, sf_dir: str, age: float = 6 * 3600.0) -> DataFrame:
    """Messages younger than `age` at the time of the newest one."""
    messages = event_messages(spark, sf_dir)
    newest = messages.agg(F.max("ts").alias("ts")).scalar()
    fresh = messages.where(times.is_fresh(F.col("ts"), newest, age))
    return fresh.select("id", _ntz("ts").alias("ts"))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some lack an address, a type or a number, or have a bad time."""
    messages = event_messages(spark, sf_dir).drop("ts")
    lost = {
        "dest_ip": F.when(F.col("id") % 7 != 0, F.col("dest_ip")),
        "message_type": F.when(F.col("id") % 11 == 0, F.lit("")).otherwise(F.col("message_type")),
        "sequence_number": F.when(F.col("id") % 13 != 0, F.col("sequence_number")),
        "timestamp": F.when(F.col("id") % 17 == 0, F.lit("2024/13/45 00:00:00.000")).otherwise(
            F.col("timestamp")
        ),
    }
    return validation.with_time(validation.blank_to_null(messages.withColumns(lost)))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.rejected(_damaged(spark, sf_dir)).select("id", "reason")


def pair_ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "pair_key",
        F.col("first.id").alias("first_id"),
        F.col("second.id").alias("second_id"),
        _ntz("t0").alias("t0"),
        _ntz("t1").alias("t1"),
        "teid",
        "latency_ms",
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_ids(pairing.pair_messages(event_messages(spark, sf_dir)))


def pairs_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_ids(pairing.pair_messages(event_messages(spark, sf_dir), skew=CUT))


def unpaired(spark: SparkSession, sf_dir: str, skew: Skew = Skew()) -> DataFrame:
    alone = pairing.unpaired_messages(event_messages(spark, sf_dir), skew=skew)
    return alone.select("pair_key", "id", _ntz("ts").alias("ts"), *FIELDS, "reason")


def unpaired_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpaired(spark, sf_dir, CUT)


def unpaired_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages and those that lost their partner to rejection."""
    damaged = _damaged(spark, sf_dir)
    return pairing.unpaired_messages(damaged).select("id", "pair_key", "reason")


def pair_teids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tunnel id by the pair form and by the array form."""
    found = pairing.pair_messages(event_messages(spark, sf_dir))
    both = keys.teid_of_messages(F.array("first", "second"))
    return found.select(F.col("first.id").alias("first_id"), "teid", both.alias("array_teid"))


def pair_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pairing.pair_messages(event_messages(spark, sf_dir))
    return found.groupBy(F.col("first.message_type").alias("message_type")).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.sum("latency_ms").alias("total_ms"),
    )


def answered_requests(spark: SparkSession, sf_dir: str, skew: Skew = Skew()) -> DataFrame:
    return interval.answered(event_messages(spark, sf_dir), skew=skew).select(
        "pair_key",
        F.col("request.id").alias("request_id"),
        F.col("response.id").alias("response_id"),
        "latency_ms",
    )


def answered_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered_requests(spark, sf_dir, CUT)


def unanswered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval.unanswered(event_messages(spark, sf_dir)).select(
        "pair_key", F.col("request.id").alias("request_id")
    )


def _sessions_of(
    spark: SparkSession,
    sf_dir: str,
    operator: Callable,
    keep: list[str] | None = None,
    **options,
) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    hot = sessions.hot_tunnels(messages, options.get("skew", Skew()))
    return operator(pairing.pair_messages(messages, keep=keep), SESSION_TTL, hot=hot, **options)


def session_pairs(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _sessions_of(spark, sf_dir, sessions.sessions, keep=[], **options).select(
        "teid",
        "session_no",
        _ntz("session_start").alias("session_start"),
        F.col("first.id").alias("first_id"),
        F.col("second.id").alias("second_id"),
    )


def _sides(enriched: DataFrame, fields: list[str]) -> DataFrame:
    return enriched.select(
        "teid",
        "session_no",
        F.col("first.id").alias("first_id"),
        *[F.col(s)[f].alias(f"{s}_{f}") for f in fields for s in ("first", "second")],
        "imsi",
        "msisdn",
    )


def session_enriched(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    enriched = _sessions_of(spark, sf_dir, sessions.enrich_sessions, **options)
    return _sides(enriched, ["imsi", "msisdn", "cause"])


def sessions_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_pairs(spark, sf_dir, skew=CUT_TUNNELS)


def session_enriched_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_enriched(spark, sf_dir, skew=CUT_TUNNELS)


def session_enriched_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = _sessions_of(spark, sf_dir, sessions.enrich_sessions, carry_all=True)
    return _sides(enriched, OPTIONAL)


def session_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = _sessions_of(spark, sf_dir, sessions.enrich_sessions, carry_all=True)
    profiles = sessions.session_profiles(enriched)
    return profiles.withColumn("session_start", _ntz("session_start"))


def session_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = sessions.mark_deletes(_sessions_of(spark, sf_dir, sessions.sessions, keep=[]))
    return marked.select(
        "teid", "session_no", "closed_by_delete", _ntz("deleted_at").alias("deleted_at")
    )


def _all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs, of which some belong to no tunnel because their response names none."""
    messages = event_messages(spark, sf_dir)
    named = messages.withColumn("teid", F.when(F.col("id") % 9 != 1, F.col("teid")))
    return enriched_pairs(named, session_ttl=SESSION_TTL)


def pair_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.pair_output(_all_pairs(spark, sf_dir))


def pair_output_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.pair_output(_all_pairs(spark, sf_dir), format="json")


def unpaired_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a partner in publishing form."""
    return output.unpaired_output(pairing.unpaired_messages(event_messages(spark, sf_dir)))


def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that are published twice come out once; the day is the span of a key."""
    found = pairing.pair_messages(event_messages(spark, sf_dir))
    return output.drop_sent(found.unionByName(found), 86400).select(
        "key", F.col("first.id").alias("first_id"), F.col("second.id").alias("second_id")
    )


def render_lines(messages: DataFrame) -> DataFrame:
    """Messages as lines, some with a mark at the start, blanks, junk or a repeated key."""
    parts = [
        F.when(
            F.col(f).isNotNull(), F.concat(F.lit(k), F.lit(" = "), F.col(f).cast("string"))
        )
        for f, k in LINE_KEYS.items()
    ]
    mark = F.when(F.col("id") % 10 == 0, F.lit("﻿")).otherwise(F.lit(""))
    junk = F.when(F.col("id") % 3 == 0, F.lit("junk, sequence-number=1, dpi-ip=ignored"))
    extra = F.when(F.col("id") % 4 == 0, F.lit("note=a=b"))
    line = F.concat(mark, F.concat_ws(", ", junk, *parts, extra))
    return messages.select("id", "ts", line.alias("value"))


def kv_lines_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = render_lines(event_messages(spark, sf_dir))
    return parse_lines(lines, at=F.col("ts")).select("id", *FIELDS)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "event_type",
    )


def offsets_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.earliest_offsets(_records(spark, sf_dir))


def offsets_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.until_offsets(_records(spark, sf_dir))


def offsets_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved positions of even partitions lie before the earliest record, of odd ones after.
    Partition 3 is new, so nothing is saved for it; a saved one, 13, is gone."""
    records = _records(spark, sf_dir)
    known = F.when(F.col("partition") == 3, 13).otherwise(F.col("partition")).cast("int")
    reached = F.when(F.col("partition") % 2 == 0, F.lit(-1)).otherwise(F.max("offset"))
    renamed = records.withColumn("partition", known)
    saved = renamed.groupBy("topic", "partition").agg(reached.alias("offset"))
    texts = offsets.encode_offsets(saved)
    return offsets.start_offsets(
        offsets.decode_offsets(texts), offsets.earliest_offsets(records)
    )


def offsets_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics; the second has lost a partition on the incoming side."""
    records = _records(spark, sf_dir)
    second = records.withColumn("topic", F.lit(f"{TOPIC}-2"))
    both = records.unionByName(second)
    current = offsets.current_offsets(both.where("event_type = 'click'"))
    incoming = offsets.current_offsets(both.where("event_type = 'view'")).where(
        (F.col("topic") == TOPIC) | (F.col("partition") != 3)
    )
    return offsets.merge_offsets(current, incoming)


def offsets_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger entries of one commit per event type."""
    records = _records(spark, sf_dir)
    ledger = records.groupBy("topic", "partition", "event_type").agg(
        (F.max("offset") + 1).alias("offset")
    )
    return offsets.current_offsets(ledger)


REPORTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pair_key": message_keys,
    "composite_key": message_groups,
    "unique_key": digest_keys,
    "parse_ts": parsed_times,
    "ttl_filter": fresh_messages,
    "missing_required": rejects,
    "pairs": pairs,
    "pairs_cut": pairs_cut,
    "unpaired": unpaired,
    "unpaired_cut": unpaired_cut,
    "unpaired_damaged": unpaired_damaged,
    "pair_teid": pair_teids,
    "pair_latency": pair_latency,
    "pairs_interval": answered_requests,
    "interval_cut": answered_cut,
    "unanswered_interval": unanswered_requests,
    "sessions": session_pairs,
    "sessions_cut": sessions_cut,
    "session_enriched": session_enriched,
    "session_enriched_cut": session_enriched_cut,
    "session_enriched_all": session_enriched_all,
    "session_profile": session_profile,
    "session_deletes": session_deletes,
    "pair_output": pair_output,
    "pair_output_all": pair_output,
    "pair_output_json": pair_output_json,
    "unpaired_output": unpaired_output,
    "dedup_keys": dedup_keys,
    "kv_lines_parse": kv_lines_parse,
    "offsets_earliest": offsets_earliest,
    "offsets_until": offsets_until,
    "offsets_start": offsets_start,
    "offsets_merge": offsets_merge,
    "offsets_ledger": offsets_ledger,
}
