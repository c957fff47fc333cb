"""Lines of `key=value` fragments as a message source."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.functions.times import stamp

# Line key of each message field. `dpi_ip` alone is spelt with an underscore.
LINE_KEYS = {
    "source_ip": "source-ip",
    "dest_ip": "dest-ip",
    "message_type": "message-type",
    "sequence_number": "sequence-number",
    "imsi": "imsi",
    "msisdn": "msisdn",
    "teid": "teid",
    "cause": "cause",
    "user_location": "user-location",
    "bearer_context": "bearer-context",
    "dpi_ip": "dpi_ip",
}

# Blanks and control characters up to U+0020, stripped from both ends of keys and values.
_BLANKS = "".join(map(chr, range(0x21)))


def _fragments(line: Column) -> Column:
    """Last fragment first, so that the first hit is the last of a repeated key."""
    return F.reverse(F.split(F.regexp_replace(line, r"^\uFEFF", ""), r",\s*"))


def _key(fragment: Column) -> Column:
    """NULL for a fragment that has no `=`."""
    key = F.trim(F.substring_index(fragment, "=", 1), F.lit(_BLANKS))
    return F.when(F.contains(fragment, F.lit("=")), key)


def _value(fragment: Column) -> Column:
    """All after the first `=`; a value may hold more of them."""
    return F.trim(F.substr(fragment, F.locate("=", fragment) + 1), F.lit(_BLANKS))


def parse_lines(lines: DataFrame, at: Column | None = None) -> DataFrame:
    """Message fields of each line in `value`; other columns are kept.

    `at` is the time stamped on the messages, the current time if not given. A repeated key
    takes its last value. A sequence number that is no integer gives NULL, which validation
    rejects later.
    """
    cut = lines.withColumn("_fragments", _fragments(F.col("value")))
    cut = cut.withColumn("_keys", F.transform("_fragments", _key))

    def value(key: str) -> Column:
        place = (F.array_position("_keys", key) - 1).cast("int")
        return _value(F.get("_fragments", place))

    fields = {f: value(k) for f, k in LINE_KEYS.items()}
    fields["sequence_number"] = F.when(
        fields["sequence_number"].rlike(r"^[+-]?[0-9]+$"),
        fields["sequence_number"].try_cast("int"),
    )
    when = F.current_timestamp() if at is None else at
    made = {"timestamp": stamp(when), **fields}
    return cut.withColumns(made).drop("value", "_fragments", "_keys")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)
