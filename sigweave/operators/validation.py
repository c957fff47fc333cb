"""Splits raw messages into usable ones and rejects."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions.times import parse_ts
from sigweave.schema import FIELDS, REQUIRED


def blank_to_null(df: DataFrame) -> DataFrame:
    """An empty text field counts as absent."""
    texts = [f for f in FIELDS if f != "sequence_number"]
    return df.withColumns({f: F.nullif(F.col(f), F.lit("")) for f in texts})


def with_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", parse_ts("timestamp"))


def is_complete() -> Column:
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in REQUIRED])


def reject_reason() -> Column:
    """NULL for a usable message."""
    return F.when(~is_complete(), F.lit("missing_field")).when(
        F.col("ts").isNull(), F.lit("invalid_ts")
    )


def valid(df: DataFrame) -> DataFrame:
    """Usable messages; plain null checks, which a columnar source can take over."""
    return df.where(is_complete() & F.col("ts").isNotNull())


def with_reason(df: DataFrame) -> DataFrame:
    """Adds `reason`; one that the source has given comes first."""
    given = [F.col("reason")] if "reason" in df.columns else []
    return df.withColumn("reason", F.coalesce(*given, reject_reason()))


def rejected(df: DataFrame) -> DataFrame:
    """Unusable messages with `reason`. The filter is made of plain null checks, so a columnar
    source skips every block of rows that lacks nothing."""
    unusable = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in [*REQUIRED, "ts"]])
    if "reason" in df.columns:
        unusable = unusable | F.col("reason").isNotNull()
    return with_reason(df.where(unusable))
