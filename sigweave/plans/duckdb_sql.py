"""The same queries as SQL for DuckDB, over whole tables, to check the Spark results."""

from sigweave.plans.reports import TOPIC
from sigweave.schema import CARRIED, FIELDS, OPTIONAL
from sigweave.sources.events import FIELD_SQL, TXN_SQL

_COLUMNS = ["id", "ts", *FIELDS]

_M = (
    "m AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in FIELD_SQL.items())
    + ", strftime(ts, '%Y/%m/%d %H:%M:%S.%g') AS timestamp"
    + f" FROM (SELECT *, {TXN_SQL} AS txn FROM events WHERE event_type <> 'error') e)"
)
_KEY = (
    "CONCAT(sequence_number, '-', LEAST(source_ip, dest_ip), '-', GREATEST(source_ip, dest_ip))"
)


def _walk(source: str) -> str:
    return f"""
k AS (SELECT *, {_KEY} AS pair_key FROM {source}),
g AS (SELECT *, CASE WHEN ts - LAG(ts) OVER w < INTERVAL 60 SECOND THEN 0 ELSE 1 END AS gap
      FROM k WINDOW w AS (PARTITION BY pair_key ORDER BY ts, id)),
r AS (SELECT *, SUM(gap) OVER (PARTITION BY pair_key ORDER BY ts, id
                               ROWS UNBOUNDED PRECEDING) AS run FROM g),
n AS (SELECT *, ROW_NUMBER() OVER w AS pos, COUNT(*) OVER (PARTITION BY pair_key, run) AS size
      FROM r WINDOW w AS (PARTITION BY pair_key, run ORDER BY ts, id))"""


_PAIR_ROWS = (
    ", p AS (SELECT a.pair_key, a.ts AS t0, b.ts AS t1, epoch_us(b.ts) // 1000 - epoch_us(a.ts) // 1000 AS "
    "latency_ms, CASE WHEN contains(a.message_type, 'Response') THEN NULLIF(a.teid, '') "
    "WHEN contains(b.message_type, 'Response') THEN NULLIF(b.teid, '') END AS teid, "
    + ", ".join(f"{s}.{c} AS {side}_{c}" for c in _COLUMNS for s, side in (("a", "first"), ("b", "second")))
    + " FROM n a JOIN n b ON a.pair_key = b.pair_key AND a.run = b.run AND b.pos = a.pos + 1 "
    "WHERE a.pos % 2 = 1)"
)
_PAIRS = _walk("m") + _PAIR_ROWS

_SESSIONS = (
    ", o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY teid ORDER BY t1, t0, first_id) AS rn "
    "FROM p WHERE teid IS NOT NULL), "
    "f AS (SELECT teid, rn, 1::BIGINT AS session_no, t1 AS session_start, t0 AS oldest "
    "FROM o WHERE rn = 1 UNION ALL "
    "SELECT o.teid, o.rn, "
    "CASE WHEN o.t1 < f.oldest + INTERVAL 3600 SECOND THEN f.session_no ELSE f.session_no + 1 END, "
    "CASE WHEN o.t1 < f.oldest + INTERVAL 3600 SECOND THEN f.session_start ELSE o.t1 END, "
    "CASE WHEN o.t1 < f.oldest + INTERVAL 3600 SECOND THEN LEAST(f.oldest, o.t0) ELSE o.t0 END "
    "FROM f JOIN o ON o.teid = f.teid AND o.rn = f.rn + 1), "
    "s AS (SELECT o.*, f.session_no, f.session_start FROM o JOIN f USING (teid, rn))"
)


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + _M + "".join(parts) + " "


def _after(part: str) -> str:
    return ", " + part.lstrip()


def _enriched(fields: list[str]) -> str:
    """Both messages of each pair with the carried fields filled in."""
    before = ", ".join(
        f"LAST_VALUE(COALESCE(second_{f}, first_{f}) IGNORE NULLS) OVER b AS before_{f}"
        for f in fields
    )
    filled = ", ".join(
        f"COALESCE(first_{f}, before_{f}) AS f_{f}, "
        f"COALESCE(second_{f}, first_{f}, before_{f}) AS s_{f}"
        for f in fields
    )
    return (
        f", c AS (SELECT *, {before} FROM s WINDOW b AS (PARTITION BY teid, session_no "
        "ORDER BY t1, t0, first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        f"e AS (SELECT *, {filled} FROM c)"
    )


def _sides(fields: list[str], carried: list[str]) -> str:
    shown = []
    for f in fields:
        names = (f"f_{f}", f"s_{f}") if f in carried else (f"first_{f}", f"second_{f}")
        shown += [f"{names[0]} AS first_{f}", f"{names[1]} AS second_{f}"]
    return (
        "SELECT teid, session_no, first_id, "
        + ", ".join(shown)
        + ", s_imsi AS imsi, s_msisdn AS msisdn FROM e"
    )


def _message_text(side: str, filled: bool = True) -> str:
    short = "f" if side == "first" else "s"
    lines = []
    for f in FIELDS:
        name = f"{short}_{f}" if filled and f in CARRIED else f"{side}_{f}".lstrip("_")
        quote = "" if f == "sequence_number" else '"'
        lines.append(
            f"CASE WHEN {name} IS NULL THEN '' ELSE '{f}: {quote}' || {name} || '{quote}' || chr(10) END"
        )
    return " || ".join(lines)


def _message_json(side: str, filled: bool = True) -> str:
    short = "f" if side == "first" else "s"
    parts = []
    for f in FIELDS:
        name = f"{short}_{f}" if filled and f in CARRIED else f"{side}_{f}"
        quote = "" if f == "sequence_number" else '"'
        parts.append(f"CASE WHEN {name} IS NOT NULL THEN '\"{f}\":{quote}' || {name} || '{quote}' END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_DIGEST = "to_base64(unhex(sha256(concat({p}sequence_number, {p}source_ip, {p}dest_ip))))"

_DAMAGED = (
    ", d0 AS (SELECT * REPLACE (CASE WHEN id % 7 <> 0 THEN dest_ip END AS dest_ip, "
    "CASE WHEN id % 11 <> 0 THEN message_type END AS message_type, "
    "CASE WHEN id % 13 <> 0 THEN sequence_number END AS sequence_number, "
    "date_trunc('millisecond', ts) AS ts) FROM m), "
    "d AS (SELECT *, CASE WHEN dest_ip IS NULL OR message_type IS NULL OR sequence_number IS NULL "
    "THEN 'missing_field' WHEN id % 17 = 0 THEN 'invalid_ts' END AS reason FROM d0), "
    "ok AS (SELECT * EXCLUDE (reason) FROM d WHERE reason IS NULL)"
)

_RECORDS = (
    f"rec AS (SELECT '{TOPIC}' AS topic, CAST(event_id % 4 AS INT) AS partition, "
    'event_id AS "offset", event_type FROM events)'
)
_EARLIEST = 'SELECT topic, partition, MIN("offset") AS "offset" FROM rec GROUP BY topic, partition'

_PAIR_IDS = "SELECT pair_key, first_id, second_id, t0, t1, teid, latency_ms FROM p"

_INTERVAL = (
    f", k AS (SELECT *, {_KEY} AS pair_key FROM m), "
    "x AS (SELECT q.pair_key, q.id AS request_id, q.ts AS qts, r.id AS response_id, r.ts AS rts, "
    "ROW_NUMBER() OVER (PARTITION BY q.id ORDER BY r.ts, r.id) AS nth "
    "FROM k q LEFT JOIN k r ON q.pair_key = r.pair_key AND r.message_type LIKE '%Response%' "
    "AND r.ts >= q.ts AND r.ts < q.ts + INTERVAL 60 SECOND WHERE q.message_type LIKE '%Request%') "
)

_PROFILE = ", ".join(
    f"ARG_MAX(COALESCE(second_{f}, first_{f}), ROW(t1, t0, first_id)) "
    f"FILTER (WHERE COALESCE(second_{f}, first_{f}) IS NOT NULL) AS {f}"
    for f in FIELDS
    if f != "teid"
)

# Every ninth response names no tunnel.
_ALL_PAIRS = _with(
    ", m2 AS (SELECT * REPLACE (CASE WHEN id % 9 <> 1 THEN teid END AS teid) FROM m)",
    _after(_walk("m2") + _PAIR_ROWS),
    _SESSIONS,
    _enriched(CARRIED),
)

ORACLES: dict[str, str] = {
    "pair_key": _with() + f"SELECT id, {_KEY} AS pair_key FROM m",
    "composite_key": _with()
    + "SELECT sequence_number AS seq, LEAST(source_ip, dest_ip) AS ip1, "
    "GREATEST(source_ip, dest_ip) AS ip2, COUNT(*) AS messages FROM m GROUP BY ALL",
    "unique_key": _with() + f"SELECT id, {_DIGEST.format(p='')} AS unique_key FROM m",
    "parse_ts": _with(
        ", t AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'never' WHEN id % 5 = 0 "
        "THEN regexp_replace(timestamp, '/\\d\\d/', '/13/') ELSE timestamp END AS timestamp FROM m)"
    )
    + "SELECT id, timestamp, TRY_STRPTIME(timestamp, '%Y/%m/%d %H:%M:%S.%g') AS parsed FROM t",
    "ttl_filter": _with()
    + "SELECT id, ts FROM m WHERE ts > (SELECT MAX(ts) FROM m) - INTERVAL 6 HOUR",
    "missing_required": _with(_DAMAGED) + "SELECT id, reason FROM d WHERE reason IS NOT NULL",
    "pairs": _with(_after(_PAIRS)) + _PAIR_IDS,
    "unpaired": _with(_after(_walk("m")))
    + f"SELECT pair_key, id, ts, {', '.join(FIELDS)}, 'expired' AS reason FROM n "
    "WHERE pos % 2 = 1 AND pos = size",
    "unpaired_damaged": _with(_DAMAGED, _after(_walk("ok")))
    + "SELECT id, pair_key, 'expired' AS reason FROM n WHERE pos % 2 = 1 AND pos = size "
    "UNION ALL SELECT id, NULL, reason FROM d WHERE reason IS NOT NULL",
    "pair_teid": _with(_after(_PAIRS)) + "SELECT first_id, teid, teid AS array_teid FROM p",
    "pair_latency": _with(_after(_PAIRS))
    + "SELECT first_message_type AS message_type, COUNT(*) AS pairs, MIN(latency_ms) AS min_ms, "
    "MAX(latency_ms) AS max_ms, CAST(SUM(latency_ms) AS BIGINT) AS total_ms FROM p GROUP BY ALL",
    "pairs_interval": _with(_INTERVAL)
    + "SELECT pair_key, request_id, response_id, epoch_us(rts) // 1000 - epoch_us(qts) // 1000 AS latency_ms "
    "FROM x WHERE nth = 1 AND response_id IS NOT NULL",
    "unanswered_interval": _with(_INTERVAL)
    + "SELECT pair_key, request_id FROM x WHERE response_id IS NULL",
    "sessions": _with(_after(_PAIRS), _SESSIONS)
    + "SELECT teid, session_no, session_start, first_id, second_id FROM s",
    "session_enriched": _with(_after(_PAIRS), _SESSIONS, _enriched(CARRIED))
    + _sides(["imsi", "msisdn", "cause"], CARRIED),
    "session_enriched_all": _with(_after(_PAIRS), _SESSIONS, _enriched(OPTIONAL))
    + _sides(OPTIONAL, OPTIONAL),
    "session_profile": _with(_after(_PAIRS), _SESSIONS)
    + f"SELECT teid, session_no, session_start, COUNT(*) AS pairs, {_PROFILE} FROM s "
    "GROUP BY teid, session_no, session_start",
    "session_deletes": _with(_after(_PAIRS), _SESSIONS)
    + "SELECT teid, session_no, deleted_at IS NOT NULL AS closed_by_delete, deleted_at FROM ("
    "SELECT teid, session_no, MIN(LEAST("
    "CASE WHEN first_message_type = 'Delete Session Response' THEN first_ts END, "
    "CASE WHEN second_message_type = 'Delete Session Response' THEN second_ts END)) AS deleted_at "
    "FROM s GROUP BY teid, session_no) z",
    "pair_output": _ALL_PAIRS
    + f"SELECT {_DIGEST.format(p='first_')} AS key, "
    f"{_message_text('first')} || chr(10) || {_message_text('second')} AS value FROM e "
    f"UNION ALL SELECT {_DIGEST.format(p='first_')}, {_message_text('first', False)} || chr(10) "
    f"|| {_message_text('second', False)} FROM p WHERE teid IS NULL",
    "pair_output_json": _ALL_PAIRS
    + "SELECT CAST(first_sequence_number AS VARCHAR) AS key, '{\"seq_id\":\"' || "
    "first_sequence_number || '\",\"response_time\":' || latency_ms || ',\"first\":' || "
    f"{_message_json('first')} || ',\"second\":' || {_message_json('second')} || '}}' AS value FROM e "
    "UNION ALL SELECT CAST(first_sequence_number AS VARCHAR), '{\"seq_id\":\"' || "
    "first_sequence_number || '\",\"response_time\":' || latency_ms || ',\"first\":' || "
    f"{_message_json('first', False)} || ',\"second\":' || {_message_json('second', False)} || '}}' "
    "FROM p WHERE teid IS NULL",
    "unpaired_output": _with(_after(_walk("m")))
    + f"SELECT {_DIGEST.format(p='')} AS key, {_message_text('', False)} AS value FROM n "
    "WHERE pos % 2 = 1 AND pos = size",
    "dedup_keys": _with(_after(_PAIRS))
    + ", u AS (SELECT *, "
    + _DIGEST.format(p="first_")
    + " AS key FROM p) SELECT key, first_id, second_id FROM u QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY key, CAST(t1 AS DATE) ORDER BY t1, t0, first_id) = 1",
    "kv_lines_parse": _with() + f"SELECT id, {', '.join(FIELDS)} FROM m",
    "offsets_earliest": f"WITH {_RECORDS} {_EARLIEST}",
    "offsets_until": f'WITH {_RECORDS} SELECT topic, partition, MAX("offset") + 1 AS "offset" '
    "FROM rec GROUP BY topic, partition",
    "offsets_start": f"WITH {_RECORDS}, low AS ({_EARLIEST}), saved AS (SELECT topic, "
    "CASE WHEN partition = 3 THEN 13 ELSE partition END AS part, "
    'CASE WHEN part % 2 = 0 THEN -1 ELSE MAX("offset") END AS "offset" FROM rec GROUP BY topic, part) '
    'SELECT low.topic, low.partition, GREATEST(COALESCE(saved."offset", low."offset"), low."offset") '
    'AS "offset" FROM low LEFT JOIN saved ON saved.topic = low.topic AND saved.part = low.partition',
    "offsets_merge": f"WITH {_RECORDS}, c AS (SELECT partition, MAX(\"offset\") AS v FROM rec "
    "WHERE event_type = 'click' GROUP BY partition), i AS (SELECT partition, MAX(\"offset\") AS v "
    "FROM rec WHERE event_type = 'view' GROUP BY partition) "
    f"SELECT '{TOPIC}' AS topic, i.partition, CASE WHEN (SELECT COUNT(*) FROM c) = "
    '(SELECT COUNT(*) FROM i) THEN GREATEST(i.v, c.v) ELSE i.v END AS "offset" '
    f"FROM i LEFT JOIN c USING (partition) UNION ALL SELECT '{TOPIC}-2', partition, v FROM i "
    "WHERE partition <> 3",
    "offsets_ledger": f'WITH {_RECORDS} SELECT topic, partition, MAX("offset") + 1 AS "offset" '
    "FROM rec GROUP BY topic, partition",
}

_STREAM_SESSIONS = (
    _with(_after(_PAIRS), _SESSIONS, _enriched(CARRIED))
    + "SELECT teid, session_start, first_id, second_id, s_imsi AS imsi, s_msisdn AS msisdn FROM e"
)

# A stream must give what one pass over the whole table gives.
ORACLES |= {
    "stream_pairs": ORACLES["pairs"],
    "stream_pairs_keyed": ORACLES["pairs"],
    "stream_unpaired": f"SELECT id, reason FROM ({ORACLES['unpaired']}) u",
    "stream_sessions": _STREAM_SESSIONS,
    "stream_restart": _STREAM_SESSIONS,
}

_PARTS = (
    ", b AS (SELECT MIN(epoch_us(ts)) AS low, (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) // 4 + 1 AS width FROM m), "
    "h AS (SELECT m.*, (epoch_us(ts) - low) // width AS part FROM m, b)"
)
_ALL_SETTLED = (
    "SELECT first_id, second_id, 'pair' AS kind FROM p UNION ALL "
    "SELECT id, NULL, 'expired' FROM n WHERE pos % 2 = 1 AND pos = size UNION ALL "
    "SELECT id, NULL, 'late' FROM a WHERE late"
)
_ON_TIME = _after("ok AS (SELECT * EXCLUDE (late) FROM a WHERE NOT late), " + _walk("ok").lstrip() + _PAIR_ROWS)

ORACLES |= {
    "stream_dedup": ORACLES["dedup_keys"],
    "stream_interval": _with(_INTERVAL) + "SELECT pair_key, request_id, response_id FROM x WHERE nth = 1",
    # What arrives after a step is late if it is older than all that came before, less the ten seconds of delay.
    "stream_late": _with(_PARTS)
    + ", h2 AS (SELECT * EXCLUDE (part), part + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END AS step FROM h), "
    "c AS (SELECT step, MAX(ts) AS newest FROM h2 GROUP BY step), "
    "v AS (SELECT step, MAX(newest) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "- INTERVAL 10 SECOND AS settled FROM c), "
    "a AS (SELECT h2.* EXCLUDE (step), COALESCE(ts < settled, FALSE) AS late FROM h2 JOIN v USING (step))"
    + _ON_TIME
    + _ALL_SETTLED,
    # An hour without input, then the second half.
    "stream_idle": _with(_PARTS)
    + ", a AS (SELECT * EXCLUDE (part), part >= 2 AND ts < (SELECT MAX(ts) FROM h WHERE part < 2) "
    "+ INTERVAL 3590 SECOND AS late FROM h)" + _ON_TIME + _ALL_SETTLED,
}

# Cutting hot groups changes nothing.
ORACLES |= {
    "pairs_cut": ORACLES["pairs"],
    "unpaired_cut": ORACLES["unpaired"],
    "interval_cut": ORACLES["pairs_interval"],
    "pair_output_all": ORACLES["pair_output"],
    "sessions_cut": ORACLES["sessions"],
    "session_enriched_cut": ORACLES["session_enriched"],
}
