"""The message schema and the schemas derived from it."""

from pyspark.sql import types as T

# Field names, order and presence of a message.
REQUIRED = ["timestamp", "source_ip", "dest_ip", "message_type", "sequence_number"]
OPTIONAL = ["imsi", "msisdn", "teid", "cause", "user_location", "bearer_context", "dpi_ip"]
FIELDS = REQUIRED + OPTIONAL

# Fixed value: time format of the `timestamp` field.
TIME_FORMAT = "yyyy/MM/dd HH:mm:ss.SSS"

# Message types with a meaning of their own.
REQUEST_MARK = "Request"
RESPONSE_MARK = "Response"
DELETE_RESPONSE = "Delete Session Response"

# Fixed value: a message waits this long for its partner, and a session lives this long.
TTL_SECONDS = 60.0

# Identity that a session carries from one message to the next.
CARRIED = ["imsi", "msisdn"]

# `id` is a unique source position and breaks ties in time, `ts` is the parsed time.
MESSAGE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())]
    + [
        T.StructField(f, T.IntegerType() if f == "sequence_number" else T.StringType())
        for f in FIELDS
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
