import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigweave.llm.outliers import _chi2_below, chi2_quantile, estimates, keep_good, quality
from sigweave.llm.queries import QUERIES


def brute(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    again = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    n = len(words)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, chars, symbols, len(lines) - len(set(lines)), len(again), n < 10 or 100 * len(again) > 20 * n


def base_of(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_chi2():
    assert chi2_quantile(5, 0.95) == pytest.approx(11.0705, abs=1e-3)
    assert chi2_quantile(2, 0.5) == pytest.approx(1.3863, abs=1e-3)


def test_query_statistics_and_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    got = QUERIES["op10_outliers"](spark, folder).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert [base_of(r) for r in got.itertuples()] == [brute(t) for t in docs.text]
    assert not (got.kept & got.base_failed).any()
    labels = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id")
    both = got.join(labels, how="inner")
    passed = both[~both.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.99
    junk = passed[(passed.quality == 0) & (passed.n_symbols > 0.05 * passed.word_chars)]
    assert len(junk) and junk.kept.mean() < 0.1


def test_estimates_ignore_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(0)
    good = rng.multivariate_normal([1, 2], [[1, 0.6], [0.6, 1]], 3000)
    bad = rng.normal([9, -9], 0.3, (700, 2))
    rows = [("g", float(a), float(b)) for a, b in np.vstack((good, bad))] + [("h", 5.0, 5.0)]
    found = {r.grp: r for r in estimates(spark.createDataFrame(rows, "grp string, v0 double, v1 double"), 2, floor=(0.01, 0.01)).collect()}
    assert np.allclose(found["g"].mean, [1, 2], atol=0.15)
    a, b2, d = found["g"].inverse
    cov = np.linalg.inv([[a, b2 / 2], [b2 / 2, d]])
    # Nine tenths of the good rows are kept, where the rescaling expects three quarters.
    assert 0.9 < cov[0, 0] < 1.7 and 0.9 < cov[1, 1] < 1.7
    assert 0.5 < cov[0, 1] / np.sqrt(cov[0, 0] * cov[1, 1]) < 0.7
    assert np.allclose(found["h"].mean, [5, 5])


def plain_search(x, floor, share=0.75, tries=200):
    """Least log determinant over concentration steps from many random starts, as the operator measures it."""
    rng, (n, p) = np.random.default_rng(1), x.shape
    scale = share / _chi2_below(p + 2, chi2_quantile(p, share))
    least, h = np.diag(np.square(floor)), int(np.ceil(n * share))
    best = (np.inf, None)
    for _ in range(tries):
        some, last = x[rng.choice(n, p + 2, replace=False)], np.inf
        while True:
            cov = (len(some) * scale * np.cov(some.T, bias=True) + 20 * least) / (len(some) + 20) + least
            now, mean = np.linalg.slogdet(cov)[1], some.mean(axis=0)
            if len(some) == h and now >= last - 1e-9:
                break
            last = now if len(some) == h else np.inf
            gap = x - mean
            some = x[np.argsort(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap), kind="stable")[:h]]
        if now < best[0]:
            best = (now, np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap))
    return best


def test_determinant_and_verdict_like_a_search_from_many_starts(spark):
    rng, groups = np.random.default_rng(7), {}
    turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
    for k, bad in enumerate((0, 40, 90)):
        good = rng.normal(size=(400 - bad, 3)) * [1, 0.3, 0.05] @ turn
        groups[f"g{k}"] = np.vstack((good, rng.normal(0, 0.2, (bad, 3)) + turn[2] * 4 + turn[0] * k))
    floor = (0.01, 0.01, 0.01)
    rows = [(g, *map(float, r)) for g, x in groups.items() for r in x]
    df = spark.createDataFrame(rows, "grp string, v0 double, v1 double, v2 double")
    found = {r.grp: r for r in estimates(df, 3, floor=floor).collect()}
    limit = chi2_quantile(3, 0.99999)
    for g, x in groups.items():
        logdet, far = plain_search(x, floor)
        # The operator's subset ends at a bin of distances, so it may hold a few rows more than h.
        assert found[g].logdet <= logdet + 0.05
        upper, inverse = found[g].inverse, np.zeros((3, 3))
        inverse[np.triu_indices(3)] = upper
        inverse = (inverse + inverse.T) / 2
        gap = x - np.array(found[g].mean)
        mine = np.einsum("ij,jk,ik->i", gap, inverse, gap)
        clear = (far < 0.8 * limit) | (far > 1.25 * limit)
        assert clear.mean() > 0.98 and ((mine <= limit) == (far <= limit))[clear].all()


def test_odd_rows(spark):
    rng = random.Random(4)
    clean = [" ".join("w" * rng.randint(2, 8) + str(rng.randint(0, 999)) for _ in range(60)) for _ in range(80)]
    texts = [*clean, None, "", "few words", "a b c d e " * 50, "#$% " * 40 + "x y", "l1 a\nl1 a\n \n\nz", "  é\x0bq\x1cr " * 5000]
    rows = [(i if i % 9 else None, t, None if i % 2 else "en", "s" if i % 3 else None, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_words int")
    got = quality(df).collect()
    assert sorted(base_of(r) for r in got) == sorted(brute(r[1]) for r in rows + rows[:3])
    df = df.withColumn("_llm_stats", F.lit("mine")).withColumn("_llm_kept", F.lit(False))
    kept = keep_good(df)
    assert kept.columns == df.columns and {(r[5], r[6]) for r in kept.collect()} == {("mine", False)}
    found = {r.n_words for r in kept.collect()}
    assert found >= set(range(80)) and not found & {80, 81, 82, 83}
    assert kept.count() == sum(r.kept for r in got)
    assert quality(df.limit(0)).count() == 0 == keep_good(df.limit(0)).count()
