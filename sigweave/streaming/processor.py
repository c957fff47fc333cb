"""Pairing as a keyed stateful operator: a streaming DataFrame in, a streaming DataFrame out.

Needs the RocksDB state store provider. Messages are held until the watermark has passed them,
so arrival order does not matter; those that come after it are dropped and counted by Spark, which
gives no operator the chance to see them. Unusable messages come out with their reason. All open
messages of a key are in one task: use the job where a key may be hot. They are held as Arrow batches,
one state row for many messages, and paired in arrays.
"""

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sigweave.functions.keys import pair_key
from sigweave.operators.pairing import pair_columns
from sigweave.operators.validation import rejected, valid
from sigweave.schema import FIELDS, MESSAGE, TTL_SECONDS

_HELD = ["id", "us", *FIELDS]


def _held_schema(prefix: str = "") -> list[T.StructField]:
    times = [T.StructField(f"{prefix}{c}", T.LongType()) for c in ("id", "us")]
    return times + [T.StructField(f"{prefix}{f}", MESSAGE[f].dataType) for f in FIELDS]


_OUTPUT = T.StructType(
    [T.StructField("pair_key", T.StringType()), T.StructField("kind", T.StringType())]
    + _held_schema("first_")
    + _held_schema("second_")
)


_ARROW = to_arrow_schema(T.StructType(_held_schema()))
#: Messages in a row of state, and in a frame of the output.
_CHUNK = 1 << 15


def _settle(
    us: np.ndarray, settled: int, ttl: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(first, second, expired, waiting) of the messages at times `us`, in order: places of the pairs,
    of those that waited in vain, and of the one that still waits at `settled`, or -1.

    A gap of `ttl` ends a run; inside a run each message of even place waits for the next.
    """
    n = int(np.searchsorted(us, settled, "right"))
    opens = np.ones(n, bool)
    opens[1:] = np.diff(us[:n]) >= ttl
    place = np.arange(n)
    waits = (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
    met = np.zeros(n, bool)
    met[:-1] = waits[:-1] & ~opens[1:]
    first, alone = np.flatnonzero(met), np.flatnonzero(waits & ~met)
    # Only the last message can be alone without one that came too late for it.
    if len(alone) and alone[-1] == n - 1 and us[n - 1] + ttl > settled:
        return first, first + 1, alone[:-1], n - 1
    return first, first + 1, alone, -1


class PairProcessor(StatefulProcessor):
    """Holds the messages of one pair key that are not settled, or wait for a partner."""

    def __init__(self, ttl: float = TTL_SECONDS):
        self.ttl_us = round(ttl * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        batch = T.StructType([T.StructField("batch", T.BinaryType())])
        self.held = handle.getListState("held_batches", batch)

    def _wake(self, us: int, gone: int = -1) -> None:
        """One timer per key, the earliest but for those up to `gone`, which have rung. Timers
        count milliseconds; the watermark must have passed the whole one."""
        wanted, later = -(-us // 1000), []
        for timer in self.handle.listTimers():
            if timer <= gone:
                continue
            if timer <= wanted:
                return
            later.append(timer)
        for timer in later:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(wanted)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator:
        batches, least = [], []
        for pdf in rows:
            batches.append(pa.Table.from_pandas(pdf[_HELD], _ARROW, preserve_index=False))
            least.append(int(pdf["us"].min()))
        if batches:
            self.held.appendList(self._rows(pa.concat_tables(batches)))
            self._wake(min(least))
        return iter(())

    def _rows(self, messages: pa.Table) -> list[tuple[bytes]]:
        batches = messages.combine_chunks().to_batches(max_chunksize=_CHUNK)
        return [(batch.serialize().to_pybytes(),) for batch in batches]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled = timerValues.getCurrentWatermarkInMs() * 1000
        batches = [pa.ipc.read_record_batch(pa.py_buffer(row[0]), _ARROW) for row in self.held.get()]
        held = pa.Table.from_batches(batches, _ARROW).combine_chunks()
        held = held.sort_by([("us", "ascending"), ("id", "ascending")])
        us = held["us"].to_numpy()
        first, second, alone, waiting = _settle(us, settled, self.ttl_us)
        ahead = int(np.searchsorted(us, settled, "right"))
        due = us[ahead : ahead + 1].tolist()
        left = held.slice(ahead)
        if waiting >= 0:
            due.append(int(us[waiting]) + self.ttl_us)
            left = pa.concat_tables([held.slice(waiting, 1), left])
        if due:
            self._wake(min(due), expiredTimerInfo.getExpiryTimeInMs())
        if left.num_rows:
            self.held.put(self._rows(left))
        else:
            self.held.clear()
        for at in range(0, len(first), _CHUNK):
            some = slice(at, at + _CHUNK)
            yield self._output(key, "pair", held.take(first[some]), held.take(second[some]))
        for at in range(0, len(alone), _CHUNK):
            some = held.take(alone[at : at + _CHUNK])
            yield self._output(key, "expired", some, held.take(pa.nulls(some.num_rows, pa.int64())))

    def _output(self, key, kind: str, first: pa.Table, second: pa.Table) -> pd.DataFrame:
        names = [pa.repeat(key[0], first.num_rows), pa.repeat(kind, first.num_rows)]
        found = pa.table([*names, *first.columns, *second.columns], _OUTPUT.names)
        return found.to_pandas(integer_object_nulls=True)

    def close(self) -> None:
        pass


def settled_messages(
    messages: DataFrame, delay: float = 10.0, ttl: float = TTL_SECONDS
) -> DataFrame:
    """`pair_key`, `kind` ('pair', 'expired' or the reason of an unusable message), `first` and
    `second` of a stream of messages."""
    usable = valid(messages).withWatermark("ts", f"{delay} seconds")
    keyed = usable.withColumns({"pair_key": pair_key(), "us": F.unix_micros("ts")})
    found = keyed.groupBy("pair_key").transformWithStateInPandas(
        PairProcessor(ttl), outputStructType=_OUTPUT, outputMode="Append", timeMode="EventTime"
    )

    def message(side: str):
        time = F.timestamp_micros(f"{side}_us").alias("ts")
        fields = [F.col(f"{side}_{f}").alias(f) for f in FIELDS]
        whole = F.struct(F.col(f"{side}_id").alias("id"), time, *fields)
        return F.when(F.col(f"{side}_id").isNotNull(), whole).alias(side)

    settled = found.select("pair_key", "kind", message("first"), message("second"))
    own = F.struct(*[F.col(c) for c in MESSAGE.names])
    unusable = rejected(messages).select(
        F.lit(None).cast("string").alias("pair_key"),
        F.col("reason").alias("kind"),
        own.alias("first"),
        F.lit(None).cast(settled.schema["second"].dataType).alias("second"),
    )
    return settled.unionByName(unusable)


def stream_pairs(
    messages: DataFrame, delay: float = 10.0, ttl: float = TTL_SECONDS
) -> DataFrame:
    """PAIR rows of a stream of messages."""
    pairs = settled_messages(messages, delay, ttl).where("kind = 'pair'")
    return pairs.select(*pair_columns())
