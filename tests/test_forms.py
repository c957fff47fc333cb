import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sigweave.functions.text import message_text
from sigweave.operators.output import drop_sent, drop_sent_stream, pair_output, unpaired_output
from sigweave.operators.pairing import pair_messages, unpaired_messages
from sigweave.operators.validation import blank_to_null, with_time
from sigweave.plans.publish import records_of_lines
from sigweave.schema import FIELDS
from sigweave.sources.kv_lines import parse_lines
from tests.sequences import messages

protobuf = pytest.importorskip("google.protobuf")


def lines(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")


def test_lines(spark):
    base = "source-ip=1.1.1.1, dest-ip=2.2.2.2,message-type=A Request,sequence-number=5"
    df = lines(
        spark,
        "﻿" + base,
        base.replace("=", "\t = "),
        base + ",cause=a=b",
        base + ",junk",
        base + ",sequence-number=6, sequence-number = 7",
        base + ",imsi=",
        base.replace("dest-ip", "dest"),
        base.replace("=5", "=five"),
        base + ",dpi-ip=3.3.3.3",
        base + ",dpi_ip=3.3.3.3",
    )
    rows = parse_lines(df, F.lit("2024-01-02 03:04:05.678").cast("timestamp")).orderBy("id").collect()
    assert all(r["source_ip"] == "1.1.1.1" for r in rows)
    assert rows[0]["timestamp"] == "2024/01/02 03:04:05.678"
    assert rows[1]["message_type"] == "A Request" and rows[1]["sequence_number"] == 5
    assert rows[2]["cause"] == "a=b"
    assert rows[3]["sequence_number"] == 5 and rows[4]["sequence_number"] == 7
    assert rows[5]["imsi"] == "" and rows[6]["dest_ip"] is None
    assert rows[7]["sequence_number"] is None
    assert rows[8]["dpi_ip"] is None and rows[9]["dpi_ip"] == "3.3.3.3"


def test_records_of_lines(spark):
    from sigweave.sources.protobuf import decode

    good = "source-ip=1.1.1.1,dest-ip=2.2.2.2,message-type=A Request,sequence-number=258,imsi=9"
    df = records_of_lines(lines(spark, good, "imsi=1"), partition=0)
    row = df.first()
    assert df.count() == 1 and bytes(row["key"]) == b"\x00\x00\x01\x02" and row["partition"] == 0
    back = decode(df).first()
    assert back["sequence_number"] == 258 and back["imsi"] == "9" and back["reason"] is None


def test_protobuf_round_trip_and_bad_bytes(spark):
    from sigweave.operators.validation import rejected, with_time
    from sigweave.sources.protobuf import decode, encode, message_class

    m = messages(spark, [{"at": 0, "imsi": "ü"}, {"at": 1, "q": False, "teid": "T"}])
    back = decode(m.select("id", encode().alias("value"))).select("id", *FIELDS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.select("id", *FIELDS).collect()))

    good = m.select(encode().alias("value")).first()["value"]
    part = message_class()(imsi="1").SerializePartialToString()
    raw = spark.createDataFrame(
        [(0, bytearray(good[:-1])), (1, bytearray(b"")), (2, bytearray(part)), (3, None)],
        "id long, value binary",
    )
    reasons = {r["id"]: r["reason"] for r in rejected(with_time(decode(raw))).collect()}
    assert reasons == {
        0: "undecodable", 1: "missing_field", 2: "missing_field", 3: "undecodable"
    }


def test_jvm_form_comes_first(spark, monkeypatch):
    from google.protobuf import descriptor_pb2

    from sigweave.sources import protobuf as source

    assert not source.has_native()
    monkeypatch.setattr(source, "has_native", lambda: True)
    monkeypatch.setattr(source, "decode_native", lambda records, value: (records, value))
    assert source.decode("records", "v") == ("records", "v")
    read = descriptor_pb2.FileDescriptorSet.FromString(source.descriptor_set(strict=False))
    labels = {f.label for f in read.file[0].message_type[0].field}
    assert labels == {descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL}


def test_text_is_protobuf_text(spark):
    from google.protobuf import text_format

    from sigweave.sources.protobuf import message_class

    odd = ["plain", 'q"q', "it's", "back\\slash", "tab\tline\nret\r", "ü€", "a\x01b\x7f", "ü'\"\\\n"]
    m = messages(spark, [{"at": i, "imsi": t} for i, t in enumerate(odd)])
    whole = F.struct(*m.columns)
    for row in m.select(message_text(whole).alias("text"), *FIELDS).collect():
        present = {f: row[f] for f in FIELDS if row[f] is not None}
        expected = text_format.MessageToString(message_class()(**present), as_utf8=False)
        assert row["text"] == expected


def test_control_characters_have_short_escapes(spark):
    """The Java form: \\a \\b \\v \\f, where the Python form writes octal numbers."""
    m = messages(spark, [{"at": 0, "imsi": "a\a\b\v\f\n"}, {"at": 1, "imsi": "ü\a\v\x01"}])
    texts = [r[0] for r in m.orderBy("id").select(message_text(F.struct(*m.columns))).collect()]
    assert 'imsi: "a\\a\\b\\v\\f\\n"\n' in texts[0]
    assert 'imsi: "\\303\\274\\a\\v\\001"\n' in texts[1]


def test_unpaired_output(spark):
    m = messages(spark, [{"at": 0, "seq": 3}, {"at": 5, "seq": 4}])
    broken = m.withColumn("dest_ip", F.when(F.col("id") == 0, F.col("dest_ip")))
    rows = unpaired_output(unpaired_messages(with_time(blank_to_null(broken)))).collect()
    assert sorted(r["key"] is None for r in rows) == [False, True]
    assert all("sequence_number: " in r["value"] for r in rows)


def test_output(spark):
    rows = [{"at": 0, "seq": 3}, {"at": 1, "seq": 3, "q": False, "teid": "T"}]
    pairs = pair_messages(messages(spark, rows))
    out = pair_output(pairs).first()
    raw = "310.0.0.19.0.0.1".encode()
    assert out["key"] == base64.b64encode(hashlib.sha256(raw).digest()).decode()
    first, second = out["value"].split("\n\n")
    assert first.startswith("timestamp: ") and second.endswith('teid: "T"\n')
    value = json.loads(pair_output(pairs, "json").first()["value"])
    assert value["response_time"] == 1000 and value["seq_id"] == "3"
    assert value["second"]["teid"] == "T" and "imsi" not in value["first"]
    with pytest.raises(ValueError):
        pair_output(pairs, "xml")


def test_repeats_are_dropped_and_reuse_is_kept(spark):
    rows = [{"at": at, "q": at not in (1, 501)} for at in (0, 1, 500, 501)]
    pairs = pair_messages(messages(spark, rows))
    again = pairs.unionByName(pairs).unionByName(pairs)
    kept = drop_sent(again, 60)
    assert sorted(r[0] for r in kept.select("first.id").collect()) == [0, 2]
    assert kept.select("key").distinct().count() == 1


def test_repeats_are_dropped_in_a_stream(spark, tmp_path):
    pairs = pair_messages(messages(spark, [{"at": 0}, {"at": 1, "q": False}]))
    pairs.unionByName(pairs).write.parquet(f"{tmp_path}/pairs")
    stream = spark.readStream.schema(pairs.schema).parquet(f"{tmp_path}/pairs")
    query = (
        drop_sent_stream(stream, "1 minute")
        .writeStream.format("memory")
        .queryName("kept")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("kept").count() == 1
