import json

import pytest

from sigweave.operators import offsets as O
from sigweave.sources import kafka


def table(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long")


def as_dict(df):
    return {(r["topic"], r["partition"]): r["offset"] for r in df.collect()}


def test_json(spark):
    text = '{"a":{"0":23,"1":5}}'
    saved = spark.createDataFrame([(text,), ("latest",)], "checkpoint string")
    decoded = O.decode_offsets(saved)
    assert as_dict(decoded) == {("a", 0): 23, ("a", 1): 5}
    assert O.encode_offsets(decoded).first()["checkpoint"] == text
    both = decoded.unionByName(table(spark, [("b", 0, 7)]))
    assert json.loads(O.starting_offsets_json(both)) == {"a": {"0": 23, "1": 5}, "b": {"0": 7}}
    assert O.starting_offsets_json(decoded.where("false")) is None


@pytest.mark.parametrize("text", ["", "{", "[1]", '{"a":{"0":"x"}}', '{"a":5}', '{"a":{"zero":5}}'])
def test_broken_text_fails(spark, text):
    saved = spark.createDataFrame([(text,)], "checkpoint string")
    with pytest.raises(Exception, match="not a saved position"):
        O.decode_offsets(saved).collect()


def test_start_is_moved_up(spark):
    saved = table(spark, [("a", 0, 3), ("a", 1, 9), ("a", 9, 4)])
    earliest = table(spark, [("a", 0, 5), ("a", 1, 5), ("a", 2, 7), ("other", 0, 1)])
    # Partition 9 is gone, partition 2 is new.
    assert as_dict(O.start_offsets(saved, earliest)) == {("a", 0): 5, ("a", 1): 9, ("a", 2): 7}
    assert json.loads(kafka.start_position(saved, earliest)) == {"a": {"0": 5, "1": 9, "2": 7}}
    assert kafka.start_position(saved.where("false"), earliest) == "latest"


def test_merge(spark):
    current = table(spark, [("a", 0, 9), ("a", 1, 1)])
    same = table(spark, [("a", 0, 5), ("a", 1, 5)])
    more = table(spark, [("a", 0, 5), ("a", 1, 5), ("a", 2, 5)])
    none = current.where("false")
    assert as_dict(O.merge_offsets(current, same)) == {("a", 0): 9, ("a", 1): 5}
    assert as_dict(O.merge_offsets(current, more)) == as_dict(more)
    assert as_dict(O.merge_offsets(none, more)) == as_dict(more)


def test_ledger(spark, tmp_path):
    for rows in ([("a", 0, 3)], [("a", 0, 7), ("a", 1, 1)], [("a", 0, 5)]):
        O.append_ledger(table(spark, rows), f"{tmp_path}/ledger")
    assert as_dict(O.read_ledger(spark, f"{tmp_path}/ledger")) == {("a", 0): 7, ("a", 1): 1}
    assert as_dict(O.until_offsets(table(spark, [("a", 0, 3), ("a", 0, 4)]))) == {("a", 0): 5}


def test_ledger_has_a_bounded_number_of_files(spark, tmp_path):
    """Positions survive the ring; a repeated step changes nothing."""
    path, counts = f"{tmp_path}/ledger", []
    assert as_dict(O.read_ledger(spark, path)) == {}
    for step in range(14):
        rows = [("a", step % 3, step + 1), ("b", 0, 7)][: 1 + (step == 0)]
        for _ in range(1 + (step % 4 == 1)):
            O.save_ledger(table(spark, rows).coalesce(1), path, step, every=2)
        want = {("a", k): max(s + 1 for s in range(step + 1) if s % 3 == k) for k in range(min(3, step + 1))}
        assert as_dict(O.read_ledger(spark, path)) == {**want, ("b", 0): 7}
        counts.append(len(list((tmp_path / "ledger").rglob("slot=*"))))
    assert counts[-1] == counts[7] == 6


def test_record_ids_hold_positions(spark):
    rows = table(spark, [("a", 0, 3), ("a", 7, (1 << 43) + 1)])
    ids = rows.select(kafka.record_id().alias("id"))
    assert as_dict(kafka.record_positions(ids, "a")) == as_dict(rows)


def test_options():
    options = kafka.source_options("h:1", "t", group_id="g", start='{"t":{"0":1}}', max_per_trigger=5)
    assert options["subscribe"] == "t" and options["kafka.group.id"] == "g"
    assert options["maxOffsetsPerTrigger"] == "5"
    assert options["failOnDataLoss"] == "true"
    assert kafka.source_options("h:1", "t", fail_on_loss=False)["failOnDataLoss"] == "false"
    assert kafka.sink_options("h:1", "t")["kafka.acks"] == "all"
