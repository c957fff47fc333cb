import hashlib
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigweave.llm.personal_data import masked, mod97, personal_data
from sigweave.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), rank, kind, m.end()))
    found.sort()
    return [f"{k}:{s}:{e}" for s, _, k, e in found]


TEXTS = [
    None,
    "",
    "plain words only",
    "mail a.b+c@x-y.example.org, or @no.one or a@b or a@b.c_d@e.f.g@h.i",
    "a@b.c-d@e.f x@y.z..w@q.r.",
    "hosts 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8 0000255.1.1.1 256.0.0.1 1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559 1 2 3",
    "call +49 (30) 1234-5678 9 or +1 2, +123456789012345678 +1.2.3.4.5.6.7.8.9.0",
    "é ñ 日本 𝒳 a@b.cd 𝒳𝒳 10.1.2.3",
    "1" * 30000 + " " + "1.2.3" * 5000,
    "x" * 50000 + "@" + "y" * 10 + ".z" * 20000,
    ("q@w.er " * 3000) + "+49 30 1234567 " * 700,
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 not GB82WEST12345698765431",
    "ssn 123-45-6789 but order 123-45-6789-1",
]


def test_base_spans_like_plain_matching(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = personal_data(df.withColumns({"spans": F.lit(1), "start": F.lit(2)})).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for i, t in enumerate(TEXTS):
        want = brute(t)
        r = by[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t[:60] if t else t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(w.startswith(k) for w in want) for k in BASE
        ]
        kept = [s for s in r.spans.split(",") if s and s.split(":")[0] in BASE]
        assert kept == want


def test_added_kinds(spark):
    df = spark.createDataFrame([(0, TEXTS[-2]), (1, TEXTS[-1]), (2, "123-45-6789")], "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data(df).collect()}
    assert got[0].n_iban == 2 and got[1].n_ssn == 1 and got[2].n_ssn == 0
    ok = spark.createDataFrame([("DE89370400440532013000",), ("DE88370400440532013000",)], "c string")
    assert [r[0] for r in ok.select(mod97(F.col("c"))).collect()] == [True, False]


def test_iban_before_other_words_and_numbers(spark):
    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    texts = [
        f"{plain} Please pay", f"{spaced} BIC COBADEFF", f"{plain} 2024", f"{spaced} {plain} GB82WEST12345698765432 A",
        f"{plain}0", f"x{plain}", f"NO93 8601 1117 947 AND MT84MALT011000012345MTLCAST001S 7", f"AB12 {spaced}",
        f"{spaced[:-1]}1 BIC", f"{plain} " * 3000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data(df).collect()}
    assert [got[i].n_iban for i in range(len(texts))] == [1, 1, 1, 3, 0, 0, 2, 1, 0, 3000]
    spans = lambda i: [s for s in got[i].spans.split(",") if s.startswith("iban")]
    assert spans(0) == ["iban:0:22"] and spans(1) == ["iban:0:27"] and spans(2) == ["iban:0:22"] and spans(7) == ["iban:5:32"]


def test_masked(spark):
    df = spark.createDataFrame([(0, "a@b.cd é 10.1.2.3!", 5), (1, None, 6)], "doc_id long, text string, x int")
    got = sorted(masked(df).collect())
    assert [tuple(r) for r in got] == [(0, "<email> é <ip>!", 5), (1, None, 6)]


def test_empty_table(spark):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_like_plain_matching(spark, sf_dir):
    texts = pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id").text
    got = QUERIES["op6_personal_data"](spark, sf_dir).toPandas()
    assert len(got) == len(texts)
    for r in got.itertuples():
        assert r.base_sha256 == hashlib.sha256(",".join(brute(texts[r.doc_id])).encode()).hexdigest()


@pytest.mark.parametrize("name", ["op6_personal_data"])
def test_native_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
