"""The plans must keep their shape: few shuffles, narrow scans, no Python where none is due."""

import pytest

from sigweave.operators.pairing import pair_messages, unpaired_messages
from sigweave.operators.interval import answered
from sigweave.operators.output import drop_sent, pair_output
from sigweave.operators.sessions import enrich_sessions, mark_deletes, session_profiles, sessions
from sigweave.operators.validation import rejected
from sigweave.plans.publish import enriched_pairs
from tests.sequences import messages


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages"))
    messages(spark, [{"at": i} for i in range(4)]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairing_shuffles_and_sorts_once(table):
    for operator in (pair_messages, unpaired_messages):
        text = plan(operator(table).where("pair_key IS NOT NULL"))
        assert text.count("Exchange hashpartitioning") == 1
        assert text.count("Sort [") == 1 and "Python" not in text


def test_sessions_shuffle_once_more(table):
    for operator in (sessions, enrich_sessions):
        text = plan(operator(pair_messages(table)))
        assert text.count("Exchange hashpartitioning") == 2
        assert text.count("Sort [") == 2 and text.count("ArrowEvalPython") == 1


def test_publishing_pairs_once(table):
    text = plan(pair_output(enriched_pairs(table)))
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 2


def test_profiles_and_dedup_sort_once(table):
    for result in (
        session_profiles(enrich_sessions(pair_messages(table), carry_all=True)),
        drop_sent(pair_messages(table), 60),
    ):
        assert "SortAggregate" not in plan(result)
    # One of the sorts lets repeats of a key collapse before the shuffle.
    assert plan(drop_sent(pair_messages(table), 60)).count("Sort [") == 3


def test_sessions_carry_what_is_asked_for(table):
    text = plan(mark_deletes(sessions(pair_messages(table, keep=[]))))
    assert "user_location" not in text and "imsi" not in text
    text = plan(answered(table).select("request.id", "response.id"))
    assert "imsi" not in text and text.count("Exchange hashpartitioning") == 1


def test_unused_fields_are_not_read(table):
    text = plan(pair_messages(table).select("pair_key", "t0", "latency_ms"))
    assert "imsi" not in text and "user_location" not in text
    assert "IsNotNull(source_ip)" in text


def test_rejects_are_sought_by_null_checks(table):
    text = plan(rejected(table))
    assert "PushedFilters: [Or(" in text and "IsNull(dest_ip)" in text
