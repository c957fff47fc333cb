"""Small message and pair tables, and the plain loops they are checked against."""

import random

from pyspark.sql import functions as F

from sigweave.functions.times import stamp
from sigweave.schema import FIELDS, MESSAGE

START = 1_700_000_000_000_000


def messages(spark, rows):
    """Rows are dicts: `at` in seconds, `seq`, `q` for a request, and any message field."""
    schema = ["id long", "us long"] + [
        f"{f} {'int' if f == 'sequence_number' else 'string'}" for f in FIELDS if f != "timestamp"
    ]
    filled = []
    for i, r in enumerate(rows):
        a, b = r.get("ips", ("10.0.0.1", "9.0.0.1"))
        request = r.get("q", True)
        row = {
            "id": r.get("id", i),
            "us": START + round(r["at"] * 1_000_000),
            "source_ip": a if request else b,
            "dest_ip": b if request else a,
            "message_type": "Create Session " + ("Request" if request else "Response"),
            "sequence_number": r.get("seq", 1),
            **{k: v for k, v in r.items() if k in FIELDS},
        }
        filled.append(tuple(row.get(c.split()[0]) for c in schema))
    made = spark.createDataFrame(filled, ", ".join(schema)).withColumn(
        "ts", F.timestamp_micros("us")
    )
    return made.withColumn("timestamp", stamp(F.col("ts"))).select(*MESSAGE.names)


def random_messages(seed, count, gaps, keys=5):
    """Seven of ten messages share one key."""
    rng = random.Random(seed)
    at, rows = 0.0, []
    for i in range(count):
        at += rng.choice(gaps)
        seq = 0 if rng.random() < 0.7 else rng.randrange(keys)
        rows.append({"id": i, "at": at, "seq": seq, "q": rng.random() < 0.5})
        if not rows[-1]["q"] and rng.random() < 0.8:
            rows[-1]["teid"] = f"T{rng.randrange(3)}"
        if rng.random() < 0.2:
            rows[-1]["imsi"] = f"I{rng.randrange(50)}"
    return rows


def greedy(rows, ttl=60.0):
    """Pairs and unpaired messages by a loop over time."""
    waiting, pairs, alone = {}, [], []
    for r in sorted(rows, key=lambda r: (round(r["at"] * 1e6), r["id"])):
        first = waiting.pop(r["seq"], None)
        if first is None:
            waiting[r["seq"]] = r
        elif round(r["at"] * 1e6) < round(first["at"] * 1e6) + round(ttl * 1e6):
            pairs.append((first["id"], r["id"]))
        else:
            alone.append(first["id"])
            waiting[r["seq"]] = r
    return sorted(pairs), sorted(alone + [r["id"] for r in waiting.values()])


def first_answers(rows, ttl=60.0):
    out = []
    for q in (r for r in rows if r["q"]):
        later = [
            r
            for r in rows
            if not r["q"]
            and r["seq"] == q["seq"]
            and q["at"] <= r["at"]
            and round(r["at"] * 1e6) < round(q["at"] * 1e6) + round(ttl * 1e6)
        ]
        best = min(later, key=lambda r: (r["at"], r["id"]), default=None)
        out.append((q["id"], best["id"] if best else None))
    return sorted(out)


def random_pairs(seed, count, gaps):
    rng = random.Random(seed)
    t1, rows = START, []
    for i in range(count):
        t1 += rng.choice(gaps)
        t0 = t1 - rng.choice([0, 1, 1000, 5_000_000, 59_999_999])
        teid = "T0" if rng.random() < 0.7 else f"T{rng.randrange(1, 6)}"
        ids = [f"I{rng.randrange(99)}" if rng.random() < 0.1 else None for _ in range(2)]
        rows.append((teid, t0, t1, i, *ids))
    return rows


def pair_table(spark, rows):
    def message(us, imsi):
        given = {"id": F.col("id"), "ts": F.timestamp_micros(us), "imsi": F.col(imsi)}
        given["sequence_number"] = F.lit(1)
        return F.struct(
            *[given.get(c, F.lit(None).cast("string")).alias(c) for c in MESSAGE.names]
        )

    raw = spark.createDataFrame(rows, "teid string, u0 long, u1 long, id long, i0 string, i1 string")
    return raw.select(
        "teid",
        F.timestamp_micros("u0").alias("t0"),
        F.timestamp_micros("u1").alias("t1"),
        message("u0", "i0").alias("first"),
        message("u1", "i1").alias("second"),
    )


def folded(rows, ttl=60.0):
    """Session number, start and identities of each pair by a loop over time."""
    out, state, ttl_us = {}, {}, round(ttl * 1e6)
    for teid, t0, t1, i, a, b in sorted(rows, key=lambda r: (r[2], r[1], r[3])):
        s = state.setdefault(teid, {"no": 0, "oldest": -(10**30), "start": None, "imsi": None})
        if t1 >= s["oldest"] + ttl_us:
            s.update(no=s["no"] + 1, oldest=t0, start=t1, imsi=None)
        else:
            s["oldest"] = min(s["oldest"], t0)
        a = s["imsi"] if a is None else a
        b = a if b is None else b
        s["imsi"] = b
        out[i] = (teid, s["no"], s["start"], a, b)
    return out
