"""Key expressions of messages and pairs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigweave.schema import RESPONSE_MARK


def pair_key(seq="sequence_number", src="source_ip", dst="dest_ip") -> Column:
    """`seq-lo-hi`, the two addresses in string order, so both directions agree."""
    return F.concat_ws("-", F.col(seq).cast("string"), F.least(src, dst), F.greatest(src, dst))


def composite_key(seq="sequence_number", src="source_ip", dst="dest_ip") -> Column:
    """The same identity as `pair_key`, as a struct that compares and hashes by value."""
    return F.struct(
        F.col(seq).alias("seq"),
        F.least(src, dst).alias("ip1"),
        F.greatest(src, dst).alias("ip2"),
    )


def unique_key(seq: Column, src: Column, dst: Column) -> Column:
    """Base64 of the SHA-256 of sequence number, source and destination, unseparated."""
    return F.base64(F.unhex(F.sha2(F.concat(seq.cast("string"), src, dst), 256)))


def is_response(message_type: Column) -> Column:
    return message_type.contains(RESPONSE_MARK)


def pair_teid(first: Column, second: Column) -> Column:
    """Tunnel id of the first response of the pair; NULL if there is none or it is blank."""
    responder = F.when(is_response(first["message_type"]), first["teid"]).when(
        is_response(second["message_type"]), second["teid"]
    )
    return F.nullif(responder, F.lit(""))


def teid_of_messages(messages: Column) -> Column:
    """Array form of `pair_teid` for a time-ordered array of messages."""
    responses = F.filter(messages, lambda m: is_response(m["message_type"]))
    return F.nullif(F.get(responses, F.lit(0))["teid"], F.lit(""))
