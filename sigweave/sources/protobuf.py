"""Messages in protobuf form.

With the Spark protobuf module on the class path `decode` and `encode` stay in the JVM. Without it
they do the same in Arrow batches with the Python package `protobuf`; only the binary value
crosses over, other columns do not.
"""

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigweave.schema import FIELDS, MESSAGE, REQUIRED

MESSAGE_NAME = "SignalMessage"

_DECODED = T.StructType(
    [MESSAGE[f] for f in FIELDS] + [T.StructField("readable", T.BooleanType())]
)


def _file_descriptor(strict: bool = True):
    """Fields are numbered from 1 in schema order, in proto2 syntax. Not `strict`: all
    fields are optional, so that a message that lacks one can be read, and judged afterwards."""
    from google.protobuf import descriptor_pb2

    field_type = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="signal.proto", syntax="proto2")
    message = file.message_type.add(name=MESSAGE_NAME)
    for number, name in enumerate(FIELDS, start=1):
        message.field.add(
            name=name,
            number=number,
            label=field_type.LABEL_REQUIRED
            if strict and name in REQUIRED
            else field_type.LABEL_OPTIONAL,
            type=field_type.TYPE_INT32 if name == "sequence_number" else field_type.TYPE_STRING,
        )
    return file


def descriptor_set(strict: bool = True) -> bytes:
    from google.protobuf import descriptor_pb2

    return descriptor_pb2.FileDescriptorSet(file=[_file_descriptor(strict)]).SerializeToString()


def has_native() -> bool:
    """Whether the active session has Spark's protobuf module on its class path."""
    spark = SparkSession.getActiveSession()
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
    except Exception:
        return False
    return True


@lru_cache(maxsize=1)
def message_class():
    from google.protobuf import descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    pool.Add(_file_descriptor())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(MESSAGE_NAME))


def _to_row(value) -> tuple:
    """Fields, absent ones None, and whether the bytes could be read at all."""
    from google.protobuf.message import DecodeError

    try:
        message = message_class()()
        message.ParseFromString(bytes(value))
    except (DecodeError, TypeError):
        return (*[None] * len(FIELDS), False)
    return (*[getattr(message, f) if message.HasField(f) else None for f in FIELDS], True)


@F.pandas_udf(_DECODED)
def _decode(values: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([_to_row(v) for v in values], columns=[*FIELDS, "readable"], dtype=object)
    out["sequence_number"] = out["sequence_number"].astype("Int32")
    out["readable"] = out["readable"].astype(bool)
    return out


@F.pandas_udf(T.BinaryType())
def _encode(rows: pd.DataFrame) -> pd.Series:
    def one(row) -> bytes:
        present = {f: v for f, v in zip(FIELDS, row) if not pd.isna(v)}
        present["sequence_number"] = int(present["sequence_number"])
        return message_class()(**present).SerializeToString()

    return pd.Series([one(r) for r in rows.itertuples(index=False)], dtype=object)


def decode(records: DataFrame, value: str = "value") -> DataFrame:
    """Fields of the message in `value`, and `reason`, 'undecodable' for bytes that are none.
    Messages that lack a required field are read; validation tells them."""
    if has_native():
        return decode_native(records, value)
    decoded = records.withColumn("_message", _decode(F.col(value)))
    return decoded.select(
        *[c for c in records.columns if c != value],
        *[F.col(f"_message.{f}").alias(f) for f in FIELDS],
        F.when(~F.col("_message.readable"), F.lit("undecodable")).alias("reason"),
    )


def decode_native(records: DataFrame, value: str = "value") -> DataFrame:
    from pyspark.sql.protobuf.functions import from_protobuf

    message = from_protobuf(
        value,
        MESSAGE_NAME,
        options={"mode": "PERMISSIVE"},
        binaryDescriptorSet=descriptor_set(strict=False),
    )
    decoded = records.withColumn("_message", message)
    return decoded.select(
        *[c for c in records.columns if c != value],
        *[F.col(f"_message.{f}").alias(f) for f in FIELDS],
        F.when(F.col("_message").isNull(), F.lit("undecodable")).alias("reason"),
    )


def encode() -> Column:
    """The message fields of a row as bytes. Rows lacking a required field have no such form
    and must be filtered before."""
    fields = F.struct(*FIELDS)
    if has_native():
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(fields, MESSAGE_NAME, binaryDescriptorSet=descriptor_set())
    return _encode(fields)
