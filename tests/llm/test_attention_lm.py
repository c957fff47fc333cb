import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from sigweave.llm import attention as A
from sigweave.llm import attention_lm
from sigweave.llm.attention_lm import scored, vocabulary, word_counts
from sigweave.llm.queries import QUERIES


def random_model():
    rng = np.random.default_rng(5)
    p = A.initial(rng.integers(0, 1000, A.VOCABULARY))
    for k in ("in", "cls", "down", "out"):
        p[k] = (p[k] * 10).astype(np.float32)
    return p


def test_gradients_like_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in random_model().items()}
    ids, targets = rng.integers(0, A.VOCABULARY, (2, 3, A.SPAN))
    live = rng.random((3, A.SPAN)) < 0.8
    _, grads = A.gradients(p, ids, targets, live)
    at = {"embed": (ids[0, 3], 2), "near": (1,), "in": (targets[live][0] // A.CLASS, 3, 5)}
    for k, shape in A.SHAPES.items():
        i = at.get(k) or tuple(rng.integers(0, s) for s in shape)
        side = []
        for step in (1e-4, -1e-4):
            q = {n: v.copy() for n, v in p.items()}
            q[k][i] += step
            side.append(A.gradients(q, ids, targets, live)[0])
        assert (side[0] - side[1]) / 2e-4 == pytest.approx(grads[k][i], rel=1e-2, abs=1e-7), k


def test_every_token_is_scored_once_with_context():
    lengths = np.array([1, A.SPAN, A.SPAN + 1, 5, 200, 56, 57])
    ids = np.arange(lengths.sum()) % A.VOCABULARY
    inputs, targets, live, text = A.windows(ids, lengths, 0)
    assert sorted(targets[live].tolist()) == sorted(ids.tolist())
    assert np.bincount(np.repeat(text, A.SPAN)[live.ravel()], minlength=7).tolist() == lengths.tolist()


def test_scores_are_a_distribution_and_forms_agree():
    p = random_model()
    context = np.array([7, 300, 12])
    logs = [A.score(p, np.append(context, i), np.array([4]), 0)[0] for i in range(A.VOCABULARY)]
    alone = A.score(p, context, np.array([3]), 0)[0]
    assert sum(10 ** (x - alone) for x in logs) == pytest.approx(1, abs=1e-3)
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 150, 40)
    ids = rng.integers(0, A.VOCABULARY, lengths.sum())
    inputs, targets, live, text = A.windows(ids, lengths, 0)
    last = A._forward(p, inputs)[-1][live.ravel()]
    found = A._losses(p, last, targets[live])
    want = np.bincount(np.repeat(text, A.SPAN)[live.ravel()], found, len(lengths)) / math.log(10)
    assert np.allclose(A.score(p, ids, lengths, 0, batch=7, group=3), want, atol=1e-3)


def brute_base(docs):
    words = [(t or "").encode().lower().split() for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    count = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, None])
    n, v = sum(count.values()), len(count)
    out = []
    for ws, h in zip(words, held):
        ws = [*ws, None]
        out.append((h, len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)))
    return out


def test_query_base_and_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    got = QUERIES["op9_attention_lm"](spark, folder).toPandas().set_index("doc_id").loc[docs.doc_id]
    want = brute_base(list(zip(docs.doc_id, docs.text)))
    for r, w in zip(got.itertuples(), want):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9)
    held = got[got.held_out]
    # Better than word counts on texts it has not seen.
    assert held.score.sum() > held.base_score.sum()
    again = QUERIES["op9_attention_lm"](spark, folder).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert np.allclose(again.score, got.score, rtol=1e-6)


def test_odd_rows(spark):
    rows = [(None, "a b A"), (0, None), (1, ""), (2, " \n"), (3, "x " * 5000), (3, "x " * 5000), (4, "é日本   <|endoftext|>"), (5, "z" * 40000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, c int")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in scored(df, frequent=1, steps=3).collect())
    want = sorted((i if i is not None else -1, b[1], b[2], round(b[4], 6)) for (i, _), b in zip(rows, brute_base(rows)))
    assert got == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored(df, steps=3).collect())
    assert scored(df.limit(0)).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    none = scored(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in none] == [(0, 0, 0.0)] * 2


def test_every_window_and_subword_of_large_input_teaches(spark):
    """Shards far smaller than the input leave nothing out."""
    rows = [(f"d{i}", f"only{i} word{i % 7} and more of it " * (1 + i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    counts = word_counts(df.select("text")).cache()
    place, occur = vocabulary(counts, len(rows))
    words = [(t.lower()).split() for _, t in rows]
    ids = np.concatenate([attention_lm._ids([w.encode() for w in ws], attention_lm.RANKS) for ws in words])
    assert occur.sum() == len(ids) + len(rows)
    want = Counter(place[ids].tolist())
    assert all(occur[i] == c for i, c in want.items() if i > 1)
    coded = fit_weights(spark, df, counts, place, occur)
    assert len(coded) > 20 and sum(coded) == len(ids) + len(rows)


def fit_weights(spark, df, counts, place, occur):
    """The tokens that each of many shards learns from."""
    seen = []
    whole = attention_lm._averaged

    def spy(models):
        seen.append([r.weight for r in models.collect()])
        return whole(models)

    known = spark.sparkContext.broadcast(attention_lm._known({}, (1, 1), place, attention_lm.RANKS))
    attention_lm._averaged = spy
    try:
        attention_lm.fit(df.withColumnRenamed("doc_id", "id"), occur, known, place, steps=1, shard_bytes=1000)
    finally:
        attention_lm._averaged = whole
    assert seen[0] and sorted(seen[0]) == sorted(seen[1])
    return seen[0]


def test_rounds_take_every_window(monkeypatch):
    lengths = np.array([4000, 30, 900])
    ids = np.arange(lengths.sum()) % A.VOCABULARY
    taken = []
    monkeypatch.setattr(A, "gradients", lambda p, i, t, live: (taken.append(t[live]), {k: np.zeros(s, np.float32) for k, s in A.SHAPES.items()}))
    for turn in range(2):
        A.train(A.initial(np.ones(A.VOCABULARY)), ids, lengths, 0, 0.01, 1, batch=8, turn=turn, turns=2)
    found = Counter(np.concatenate(taken).tolist())
    assert all(found[i] >= n for i, n in Counter(ids.tolist()).items())


def test_later_windows_have_context_and_training_has_its_least_volume(monkeypatch):
    assert A.OVERLAP >= 8
    _, _, skip = A.cut(np.array([500]))
    assert skip[0] == 0 and (skip[1:] >= 8).all()
    taken = []
    monkeypatch.setattr(A, "gradients", lambda p, i, t, live: (taken.append(len(i)), {k: np.zeros(s, np.float32) for k, s in A.SHAPES.items()}))
    for turn in range(len(attention_lm.RATES)):
        A.train(A.initial(np.ones(A.VOCABULARY)), np.arange(50), np.array([50]), 0, 0.01, attention_lm.STEPS, turn=turn, turns=2)
    assert sum(taken) >= 153_600


def test_places_of_context_are_keys_only():
    p = random_model()
    rng = np.random.default_rng(2)
    lengths = np.array([200, 3, A.SPAN + 1])
    ids = rng.integers(0, A.VOCABULARY, lengths.sum())
    inputs, _, live, _ = A.windows(ids, lengths, 0)
    some = A._forward(p, inputs, live)[-1]
    assert len(some) == live.sum() == lengths.sum()
    assert np.allclose(some, A._forward(p, inputs)[-1][live.ravel()], atol=1e-5)


def test_losses_of_large_logits():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in random_model().items()}
    p["in"] *= 300
    o, targets = rng.standard_normal((50, A.WIDTH)), rng.integers(0, A.VOCABULARY, 50)
    cls = targets // A.CLASS
    e, f = o @ p["cls"] + p["cls_b"], np.einsum("nw,nwk->nk", o, p["in"][cls]) + p["in_b"][cls]
    assert abs(f).max() > 800
    at = np.arange(50)
    want = e[at, cls] - np.logaddexp.reduce(e, 1) + f[at, targets % A.CLASS] - np.logaddexp.reduce(f, 1)
    assert np.allclose(A._losses(p, o, targets), want)


def test_every_text_is_encoded_once(spark, monkeypatch):
    rows = [(i, f"word{i % 5} and more") for i in range(60)] + [(None, None)]
    seen, whole = [], attention_lm.coded
    monkeypatch.setattr(attention_lm, "coded", lambda rows, *a: (seen.append(rows.count()), whole(rows, *a))[1])
    assert scored(spark.createDataFrame(rows, "doc_id long, text string"), steps=2).count() == 61
    assert seen == [61]
