import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from sigweave.llm.packing import END, Capacity, best_fit, pack
from sigweave.llm.queries import QUERIES
from sigweave.llm.token_lengths import at_limits, histogram, quantile, suffix_sums
from sigweave.llm import attention_lm
from sigweave.llm.tokens import LONG_RUN, RANKS, encoder, ids_of


def test_capacity_finds_the_least():
    rng = random.Random(0)
    tree, there = Capacity(100), set()
    for _ in range(3000):
        c = rng.randint(1, 100)
        if rng.random() < 0.5:
            there.add(c)
        else:
            there.discard(c)
        tree.mark(c, c in there)
        need = rng.randint(1, 100)
        assert tree.least(need) == min((x for x in there if x >= need), default=None)


def test_best_fit_like_a_scan():
    rng = random.Random(1)
    for _ in range(30):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 80))]
        rows = best_fit(sizes, 64)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= 64 for r in rows)
        free = []
        for s in sorted(sizes, reverse=True):
            fit = min((f for f in free if f >= s), default=None)
            if fit is None:
                free.append(64 - s)
            else:
                free.remove(fit)
                free.append(fit - s)
        assert sorted(64 - sum(sizes[i] for i in r) for r in rows) == sorted(free)


def unpacked(rows, context):
    """doc_id -> texts, read back from packed rows; checks the layout on the way."""
    parts = defaultdict(list)
    for r in rows:
        ids, place = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(place) == context and r.cu_seqlens[-1] == r.n_tokens <= context
        assert len(r.cu_seqlens) == len(r.doc_ids) + 1 == len(r.pieces) + 1
        assert (ids[r.n_tokens :] == END).all() and not place[r.n_tokens :].any()
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert place[a:b].tolist() == list(range(b - a))
            parts[doc].append((piece, ids[a:b].tolist()))
    out = {}
    for doc, found in parts.items():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        ids = [i for _, part in found for i in part]
        assert ids[-1] == END and END not in ids[:-1]
        out[doc] = encoder().decode(ids[:-1])
    return out


def test_query_round_trip(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op8_packing"](spark, sf_dir).collect()
    assert unpacked(rows, 2048) == dict(zip(docs.doc_id, docs.text))
    assert len({r.row_id for r in rows}) == len(rows)


def test_small_groups_and_odd_texts(spark):
    texts = ["", None, "a", "x" * 5000, "é日本𝒳 <|endoftext|>", " \n\n ", "w " * 3000, "1234567890" * 300]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = pack(df, context=64, group_tokens=500).collect()
    assert unpacked(rows, 64) == {i: t or "" for i, t in enumerate(texts)}
    assert pack(df.limit(0)).count() == 0
    twice = pack(spark.createDataFrame([(None, "a b")] * 2, "doc_id long, text string").coalesce(1), context=16).collect()
    assert [r.doc_ids for r in twice] == [[None, None]]


def test_suffix_sums_like_plain_sums(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    docs["n"] = [len(encoder().encode_ordinary(t)) for t in docs.text]
    got = QUERIES["op2_token_lengths"](spark, sf_dir).toPandas()
    for source, part in docs.groupby("source"):
        n = part.n.to_numpy()
        mine = got[got.source == source]
        assert dict(zip(mine.length, mine.n_docs)) == Counter(n.tolist())
        for r in mine.itertuples():
            assert r.docs_from == (n >= r.length).sum() and r.tokens_from == n[n >= r.length].sum()
            assert r.docs_over == (n > r.length).sum() and r.total == n.sum()
            assert r.truncated_total == np.minimum(n, r.length).sum()
            assert abs(r.quantile - (n <= r.length).mean()) < 1e-12


def test_lengths_of_odd_rows(spark):
    df = spark.createDataFrame([("a", None), (None, "x y z"), (None, ""), ("a", "x " * 4000)], "source string, text string")
    hist = histogram(df.crossJoin(spark.range(1).withColumnRenamed("id", "length")), by=("source",))
    sums = suffix_sums(hist, ("source",))
    assert {(r.source, r.length): r.n_docs for r in sums.collect()}.keys() >= {("a", 0), (None, 0), (None, 3)}
    assert {r.source: r.length for r in quantile(sums, 0.5, ("source",)).collect()} == {"a": 0, None: 0}
    kept = {(r.source, r.limit): r.truncated_total for r in at_limits(hist, [2, 5], ("source",)).collect()}
    assert kept == {("a", 2): 2, ("a", 5): 5, (None, 2): 2, (None, 5): 3}
    assert suffix_sums(histogram(df.limit(0))).count() == 0


BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in "\x1c\x1d\x1e\x1f"]


def test_runs_of_blanks_like_the_encoder():
    """Around the length from which runs are cut out, before words, at both ends, of all kinds of blanks."""
    rng = random.Random(5)
    texts = ["a" + " " * 700_000 + "b", "\n" * LONG_RUN, " " * (LONG_RUN - 1) + "q", "x y" + "\n" * 120_000 + "  z"]
    for n in (LONG_RUN - 1, LONG_RUN, LONG_RUN + 1):
        run = "".join(rng.choice(BLANKS) for _ in range(n))
        texts += ["word." + run + "Next", run + "'s", "1" + run, "".join(BLANKS) + "\x1c" + run + "\x1f" + run]
    for text in texts:
        assert ids_of(text).tolist() == encoder().encode_ordinary(text)


def test_very_long_runs_of_blanks(spark):
    """Where the encoder itself fails."""
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "a" + "\u3000" * 1_200_000 + "b c"]
    for text in texts:
        assert encoder().decode(ids_of(text).tolist()) == text
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert unpacked(pack(df, context=1024).collect(), 1024) == dict(enumerate(texts))
    assert sum(r.n_docs for r in histogram(df).collect()) == 3
    assert len(attention_lm._ids([texts[2].encode()], RANKS)) > 1000
