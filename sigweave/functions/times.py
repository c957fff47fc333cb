"""Time expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigweave.schema import TIME_FORMAT, TTL_SECONDS


def seconds(n: float) -> Column:
    return F.make_dt_interval(secs=F.lit(f"{n:.6f}").cast("decimal(18,6)"))


def parse_ts(text) -> Column:
    """Strict parse; anything that is no such time gives NULL."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(TIME_FORMAT))


def stamp(at: Column) -> Column:
    """The text form that `parse_ts` reads."""
    return F.date_format(at, TIME_FORMAT)


def is_fresh(ts: Column, reference: Column, ttl: float = TTL_SECONDS) -> Column:
    """Younger than `ttl` at the reference time; a message from the future is fresh."""
    return ts > reference - seconds(ttl)


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)
