import hashlib
import random
from collections import Counter

import pandas as pd
import pytest

from sigweave.llm.queries import QUERIES
from sigweave.llm.repeats import without_repeats


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def check(spark, texts, length, extra=()):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, m string, parts int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(df, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def words(rng, n):
    return " ".join(rng.choice(["an", "the", "é", "wörd", "x" * rng.randint(1, 9), str(rng.random())]) for _ in range(n))


@pytest.mark.parametrize("length", [40, 64])
def test_like_every_substring(spark, length):
    rng = random.Random(length)
    texts = [None, "", "short", "a" * 300, "a" * 700, "ab" * 200, "abc" * 50 + "xyz" * 70]
    base = [words(rng, 60) for _ in range(12)]
    texts += base + base[:2]
    for _ in range(40):
        a, b = rng.choice(base), rng.choice(base)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        mixed = a[i : i + rng.randint(20, 200)] + words(rng, 5) + b[j : j + rng.randint(20, 200)]
        if rng.random() < 0.3:
            k = rng.randrange(len(mixed))
            mixed = mixed[:k] + "#" + mixed[k + 1 :]
        texts.append(mixed)
    check(spark, texts, length)


def test_at_the_edges(spark):
    rng = random.Random(1)
    s = "".join(rng.choice("abcdefghij") for _ in range(400))
    texts = [s, "q" + s, s[:399], s + s[:10], "zz" + s[1:] + "yy", "w" * 399, "v" * 400, "u" * 401]
    check(spark, texts, 400)


def test_repeated_rows_and_null_ids(spark):
    t = "".join(random.Random(2).choice("abcdefghij") for _ in range(500))
    df = spark.createDataFrame([(None, t), (None, t), (1, None)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in without_repeats(df).collect())
    assert got == [(0, 0), (500, 500), (500, 500)]
    assert without_repeats(df.limit(0)).count() == 0


def test_query_like_every_substring(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op7_repeats"](spark, sf_dir).toPandas().set_index("doc_id").loc[docs.doc_id]
    want = brute(docs.text.tolist(), 400)
    assert [tuple(r) for r in got[["n_bytes", "n_removed", "n_spans", "kept_sha256"]].itertuples(index=False)] == want
