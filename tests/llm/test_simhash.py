import random

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from sigweave.llm.queries import QUERIES
from sigweave.llm.shared import components
from sigweave.llm.simhash import (
    _with_all, commonness, keep_one, links, near_duplicates, places, signature, similar_groups,
)


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(pairs, ids):
    """For each place the least id of those reachable over pairs of places."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(ids))]


def brute_groups(prints, ids, radius=4):
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return groups_of(pairs, ids)


def similar_pairs(texts, width=5):
    """(i, j, Jaccard similarity of the sets of word shingles) of all pairs of texts that share one."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))})
    out = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both:
                out.append((i, j, both / (len(a) + len(sets[j]) - both)))
    return out


@pytest.mark.parametrize("segments", [2, 3, 4, None])
def test_links_like_all_pairs(spark, segments):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(6):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            prints.add(y)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {tuple(r) for r in links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, segments).distinct().collect()}
    want = {(max(a, b), min(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 120)] + [(200, 201), (201, 202), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_like_all_pairs(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    prints = [brute_fingerprint(t) for t in docs.text]
    want = list(zip([f"{p:016x}" for p in prints], brute_groups(prints, docs.doc_id.tolist())))
    got = QUERIES["op5_simhash"](spark, sf_dir).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert list(zip(got.fingerprint, got.component_id)) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(90000))
    rows = [(None, "a b c"), (7, "A  b\nC"), (7, "A  b\nC"), (3, None), (4, ""), (5, " \n"), (6, long), (8, "é b c")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in near_duplicates(df).collect())
    want = sorted((i or -1, f"{brute_fingerprint(t):016x}", {None: 7, 7: 7, 3: 3, 4: 3, 5: 3, 6: 6, 8: 8}[i]) for i, t in rows)
    assert got == want
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 8]
    assert near_duplicates(df.limit(0)).count() == 0 == keep_one(df.limit(0)).count()
    only_null = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert keep_one(only_null).count() == 1


@pytest.mark.parametrize("edits", [1, 3, 6])
def test_recall_of_similar_texts(spark, edits):
    """Pairs of about 0.95, 0.9 and 0.8, and some below: nine of ten are linked, and none of those below."""
    rng = random.Random(edits)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts, close = [], []
    for _ in range(300):
        words = [word() for _ in range(300)]
        other = list(words)
        for at in rng.sample(range(10, 290), edits):
            other[at] = word()
        texts += [" ".join(words), " ".join(other), " ".join(words[:225] + [word() for _ in range(75)])]
    nodes = dict(spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text)").collect())
    root = dict(similar_groups(spark.createDataFrame([(t,) for t in texts], "text string")).collect())
    linked = lambda i, j: root[nodes[texts[i]]] == root[nodes[texts[j]]]
    pairs = similar_pairs(texts)
    close = [linked(i, j) for i, j, s in pairs if s >= 0.8]
    assert len(close) >= 290 and sum(close) >= 0.9 * len(close)
    assert not any(linked(i, j) for i, j, s in pairs if s < 0.8)


def test_groups_of_near_copies_and_a_shared_passage(spark):
    """Many near copies of one text are one group; texts that have only a passage in common are not."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, passage, rows = [word() for _ in range(120)], [word() for _ in range(60)], []
    for i in range(400):
        near = list(base)
        near[rng.randrange(120)] = word()
        rows.append((i, " ".join(near)))
        rows.append((1000 + i, " ".join([word() for _ in range(50)] + passage)))
    kept = {r.doc_id for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {0, *range(1000, 1400)}


def test_every_similar_pair_is_linked(spark):
    """Texts of all lengths with edits that leave them just at or above the limit: no link is left out, none added."""
    rng = random.Random(17)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts, common = ["", " \n", "a b", "A  b"], [word() for _ in range(30)]
    for i in range(250):
        words = [word() for _ in range(rng.choice([6, 25, 60, 120, 300]))] + common * (i % 2)
        texts.append(" ".join(words))
        for _ in range(2):
            other, at = list(words), rng.randrange(len(words))
            most = max(1, round(len(words) / 9))
            other[at : at + rng.randint(1, most)] = [word() for _ in range(rng.randint(0, most))]
            texts.append(" ".join(other))
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = groups_of([(i, j) for i, j, s in similar_pairs(texts) if s >= 0.8] + [(0, 1)], list(range(len(texts))))
    assert sum(w != i for i, w in enumerate(want)) > 150
    assert sorted(r.doc_id for r in keep_one(table).collect()) == sorted(set(want))


def test_near_copies_below_the_limit_make_few_pairs(spark):
    """Copies of a short text with a word changed are below the limit: their places are few, and few pairs are compared.
    Those that are alike are."""
    rng = random.Random(23)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, texts = [word() for _ in range(60)], []
    for _ in range(120):
        near = list(base)
        near[rng.randrange(5, 55)] = word()
        texts.append(" ".join(near))
    texts += [t + " more" for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    common = commonness(docs.select("text"))
    signed = docs.select("node", signature(F.col("text"), common).alias("s")).select("node", "s.*").cache()
    rows = places(signed).withColumn("root", F.col("node"))
    who = rows.groupBy("shingle").agg(F.sort_array(F.collect_list("node")).alias("who"))
    assert who.select("who").distinct().count() == who.count()
    got = {(r.b, r.a) for r in _with_all(rows, signed, 0.8).collect()}
    alike = {(j, i) for i, j, s in similar_pairs(texts) if s >= 0.8}
    assert len(alike) >= 20 and alike <= got
    assert len(got) <= 3 * len(alike)
