import re
from collections import defaultdict

import pandas as pd

from sigweave.llm import pareto_mix
from sigweave.llm.pareto_mix import mix, mixed
from sigweave.llm.queries import QUERIES


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """sizes: source -> words. Shares out, caps and shares out again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= cap * sizes[s]}
        if not over:
            target.update({s: unit * weight[s] for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def check(rows, texts, tolerance):
    """rows: of `mix`; texts: (source, text) in any order."""
    sizes = defaultdict(int)
    for source, text in texts:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 + tolerance * target[s], s


def test_query_meets_targets_and_repeats_itself(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op4_pareto_mix"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    check(rows, list(zip(docs.source, docs.text)), 0)
    again = QUERIES["op4_pareto_mix"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_odd_rows(spark):
    texts = [("b", "x " * n) for n in range(1, 60)] + [("a", "y"), ("a", None), (None, "q w"), ("", " "), ("é", "z z z")]
    rows = [(i % 50 if i % 7 else None, t, s, "extra") for i, (s, t) in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mix(df).collect()
    assert len(got) == len(rows)
    check(got, texts * 2, 0)
    copies = mixed(df)
    assert copies.columns == df.columns
    assert copies.count() == sum(r.copies for r in got if r.size)
    assert mix(df.limit(0)).count() == 0 == mixed(df.limit(0)).count()
    blank = df.where("size = 'none'").union(df.limit(3).selectExpr("doc_id", "' '", "source", "size"))
    assert [r.taken for r in mix(blank).collect()] == [0, 0, 0]


def test_inclusion_follows_odds(spark):
    """Over many seeds a document's mean copies come near its expected ones."""
    rows = [(i, "w " * (3 if i % 2 else 40), "s") for i in range(200)] + [(1000 + i, "w " * 10, "t") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = defaultdict(int)
    for seed in range(12):
        for r in mix(df, seed=seed, share=0.7).collect():
            total[r.size, r.source] += r.copies
    # Weights are the binary digits of the sizes: 2 and 6.
    assert 2.4 < total[40, "s"] / total[3, "s"] < 3.7


def test_few_rows_are_sorted(spark):
    """Only the rows of one bin per source take part in an order; full sources have none."""
    rows = [(i, "w " * (5 + i % 40), f"s{i % 4}") for i in range(4000)] + [(i, "w w", "z") for i in range(9000, 9100)]
    df = spark.createDataFrame(rows, "_mix_id long, text string, _mix_source string")
    sized = df.selectExpr("_mix_id", "_mix_source", "cast(size(split(trim(text), ' ')) as long) AS _mix_size")
    out = pareto_mix._copies(sized, (3, 1, 2), 1.5, 2, 0, None)
    border = out.where("_mix_bin = _mix_cut").groupBy("_mix_source").count().collect()
    assert all(r["count"] < 20 for r in border)
    full = out.where("_mix_source = 'z'").select("_mix_bin", "_mix_copies").distinct().collect()
    assert [tuple(r) for r in full] == [(None, 2)]
