"""From messages to published pairs, and from `key=value` lines to message records."""

from pyspark.sql import Column, DataFrame

from sigweave.operators.pairing import pair_messages
from sigweave.operators.sessions import enrich_sessions, hot_tunnels
from sigweave.operators.skew import Skew
from sigweave.operators.validation import blank_to_null, with_time
from sigweave.schema import TTL_SECONDS
from sigweave.sources.kafka import message_records
from sigweave.sources.kv_lines import parse_lines


def records_of_lines(
    lines: DataFrame, at: Column | None = None, partition: int | None = None
) -> DataFrame:
    """Key and value of each usable line; batch and streaming alike."""
    messages = with_time(blank_to_null(parse_lines(lines, at)))
    return message_records(messages, partition)


def enriched_pairs(
    messages: DataFrame,
    ttl: float = TTL_SECONDS,
    session_ttl: float = TTL_SECONDS,
    carry_all: bool = False,
    skew: Skew = Skew(),
) -> DataFrame:
    """All pairs of the messages: those of a tunnel with session and identity, the others as
    they are. They take one way together, so pairing is done once."""
    hot = hot_tunnels(messages, skew)
    pairs = pair_messages(messages, ttl, skew)
    return enrich_sessions(pairs, session_ttl, carry_all, ttl, skew, hot, lone=True)
