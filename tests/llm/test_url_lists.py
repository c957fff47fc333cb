import datetime as dt

from sigweave.llm.queries import CAPTURES, ENTRIES, HOSTS, ORACLES, QUERIES
from sigweave.llm.url_lists import intervals, judged
from tests.oracle import compare, duck

D = dt.date


def day(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


def brute(captures, entries, allow=("trusted",)):
    """captures: (id, url, day); entries: (list, kind, pattern, day, action, seq). Replays the history for each capture."""
    out = []
    for i, url, when in captures:
        rest = url.split("//", 1)[1] if url and "//" in url else ""
        rest = rest.split("?")[0].split("#")[0]
        authority, _, path = rest.partition("/")
        host = authority.split("@")[-1].split(":")[0].lower().rstrip(".")
        parts = host.split(".")
        steps = [s for s in path.split("/") if s]
        mine = {("host", host)} | {("domain", ".".join(parts[k:])) for k in range(len(parts))}
        mine |= {("prefix", host + "/" + "/".join(steps[: k + 1])) for k in range(len(steps))}
        on = set()
        if host and when is not None:
            now = {}
            known = [e for e in entries if None not in (e[0], e[1], e[2], e[3]) and e[4] in ("add", "remove")]
            for e in sorted(known, key=lambda e: (e[3], -1 if e[5] is None else e[5], e[4] == "remove")):
                if e[3] <= when and (e[1], e[2]) in mine:
                    now[e[0], e[1], e[2]] = e[4] == "add"
            on = {k for k, v in now.items() if v}
        hit = " ".join(sorted(":".join(k) for k in on))
        out.append((i, host, when, hit, bool(on) and not any(k[0] in allow for k in on)))
    return sorted(out, key=str)


def run(spark, captures, entries):
    c = spark.createDataFrame([(*x, "x") for x in captures], "page_id long, url string, fetched date, matched string")
    e = spark.createDataFrame([(*x, 0) for x in entries], "list string, kind string, pattern string, day date, action string, seq int, url int")
    got = judged(c, e)
    return sorted(map(tuple, got.collect()), key=str), e


ENTRIES_HERE = [
    ("spam", "host", "bad.example.com", day(10), "add", 1),
    ("spam", "host", "bad.example.com", day(20), "remove", 2),
    ("spam", "host", "bad.example.com", day(20), "add", 1),
    ("spam", "host", "bad.example.com", day(15), "add", 9),
    ("spam", "host", "bad.example.com", day(30), "add", 1),
    ("ads", "domain", "example.com", day(5), "add", None),
    ("ads", "domain", "example.com", day(5), "remove", None),
    ("ads", "domain", "example.com", day(12), "add", 1),
    ("paths", "prefix", "bad.example.com/en", day(1), "add", 1),
    ("trusted", "domain", "good.example.com", day(0), "add", 1),
    ("trusted", "domain", "good.example.com", day(40), "remove", 1),
    (None, "host", "x", day(1), "add", 1),
    ("odd", "host", "bad.example.com", day(1), "rename", 1),
    ("odd", "host", "bad.example.com", None, "add", 1),
    ("late", "host", "never.example.org", day(900), "add", 1),
]


def test_like_replaying_the_history(spark):
    urls = [
        "http://bad.example.com/en/1?x=//y", "https://u:p@BAD.example.com.:8080/en", "http://bad.example.com", "//good.example.com/a/b#c",
        "http://sub.good.example.com/", "http://never.example.org/en", "no url", "", None, "http:///x", "ftp://notexample.com/bad.example.com/en",
    ]
    captures = [(k * 100 + n, u, day(n)) for k, u in enumerate(urls) for n in (0, 1, 4, 5, 9, 10, 14, 19, 20, 29, 30, 39, 40, 400)]
    captures += [(None, urls[0], None), (None, urls[0], day(11)), (None, urls[0], day(11))]
    got, entries = run(spark, captures, ENTRIES_HERE)
    assert got == brute(captures, ENTRIES_HERE)
    spans = sorted(tuple(r) for r in intervals(entries).where("list = 'spam'").collect())
    assert [s[3:] for s in spans] == [(day(10), day(20)), (day(30), None)]


def test_empty_tables(spark):
    assert run(spark, [], ENTRIES_HERE)[0] == []
    assert run(spark, [(1, "http://a.b/c", day(1))], [])[0] == [(1, "a.b", day(1), "", False)]


def test_query_like_replaying_the_history(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages.createOrReplaceTempView("pages")
    spark.sql(HOSTS).createOrReplaceTempView("hosts")
    captures = [tuple(r) for r in spark.sql(CAPTURES).collect()]
    entries = [tuple(r) for r in spark.sql(ENTRIES).collect()]
    want = brute(captures, entries)
    assert sorted(map(tuple, QUERIES["op1_url_lists"](spark, sf_dir).collect()), key=str) == want
    assert 0.05 < sum(r[4] for r in want) / len(want) < 0.95


def test_query_like_its_sql(spark, sf_dir):
    left, right = compare(spark, duck(sf_dir), QUERIES["op1_url_lists"], ORACLES["op1_url_lists"], sf_dir)
    assert left == right


def test_native_plan(spark, sf_dir):
    plan = QUERIES["op1_url_lists"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_very_long_urls(spark):
    deep = "http://a.example.com/" + "/".join(f"p{i}" for i in range(20000))
    wide = "http://" + "x." * 5000 + "example.com/a"
    urls = [deep, wide, "http://a.example.com/" + "q" * 500_000, "http://example.com//", "http://com"]
    captures = [(i, u, day(12)) for i, u in enumerate(urls)]
    entries = [
        ("spam", "prefix", "a.example.com/p0/p1/p2", day(1), "add", 1),
        ("spam", "prefix", "a.example.com/p0/p2", day(1), "add", 1),
        ("ads", "domain", "example.com", day(1), "add", 1),
        ("ads", "host", "com", day(1), "add", 1),
    ]
    for some in (entries, entries[:2], entries[2:3], entries[3:], []):
        got, _ = run(spark, captures, some)
        short = [(i, u.replace("/" + "/".join(f"p{k}" for k in range(3, 20000)), ""), d) for i, u, d in captures]
        assert got == brute(short, some)
