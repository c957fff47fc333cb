import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from sigweave.llm.differencing import Piece, differenced, near_equal, pack, packed, pieces_of
from sigweave.llm.queries import QUERIES
from sigweave.llm.word_ids import VOCABULARY, WordIds


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts.items()}


def test_query_holds_each_id_once_with_little_padding(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    ids = plain_ids(dict(zip(docs.doc_id, docs.text)))
    rows = QUERIES["op12_differencing"](spark, sf_dir).collect()
    parts, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
    assert set(parts) == set(ids)
    for doc, found in parts.items():
        assert gapless(found) == len(ids[doc])
    sizes = [gapless(w) for w in windows.values()]
    assert max(sizes) <= 4096
    assert sum(4096 - s for s in sizes if s & (s - 1)) <= 0.001 * sum(sizes)
    assert sum(s < 4096 for s in sizes) <= 12 * 8


def gapless(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at and length > 0
        at += length
    return at


def test_ids_like_the_tokenizer():
    texts = [
        "Don't stop, it's 3.5 km!", "ÉCOLE école x y　z", "a\x1cb\x85c", "", " \t\r\n\x0b\x0c ",
        "x" * 3000, "<|endoftext|> and < |startoftext|>", "日本語 ﬁ ΣΑΣ İ", "﻿​ a ́b", "'S'T''s",
    ]
    rng = random.Random(0)
    some = ["a", "B", " ", "\n", "'", "s", "́", "9", "é", "\x1f", " ", "日", "!", "<|endoftext|>", "　"]
    texts += ["".join(rng.choice(some) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    own = WordIds(VOCABULARY)
    latin = [chr(c) for c in (*range(33, 127), *range(0xA1, 0x180))] + ["'s", "'LL", "'", "a", "e", "́"]
    texts += ["".join(rng.choice(latin) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    plain = plain_ids(dict(enumerate(texts)))
    assert [[*own.of(t.encode()).tolist(), 2] for t in texts] == [plain[k] for k in range(len(texts))]


def test_differencing_like_merged_tuples():
    """Each merge pairs the largest of one with the smallest of the other; the least even go first."""
    rng = random.Random(1)
    for _ in range(60):
        k = rng.randint(1, 7)
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 30))]
        found = differenced(sizes, k)
        assert len(found) == k and sorted(i for w in found for i in w) == list(range(len(sizes)))
        tuples = [[s] + [0] * (k - 1) for s in sizes]
        while len(tuples) > 1:
            tuples.sort(key=lambda t: max(t) - min(t))
            a, b = sorted(tuples.pop(), reverse=True), sorted(tuples.pop())
            tuples.append([x + y for x, y in zip(a, b)])
        spread = max(tuples[0]) - min(tuples[0]) if tuples else 0
        sums = [sum(sizes[i] for i in w) for w in found]
        # Merges of equal spread may come in another order.
        assert max(sums) - min(sums) <= max(spread, max(sizes, default=0))


def test_near_equal_beats_chance_and_rises():
    rng = random.Random(2)
    sizes = [rng.randint(1, 600) for _ in range(600)]
    windows = differenced(sizes, 40)
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 4
    assert len(near_equal([60, 60, 60], 100)) == 3
    assert len(near_equal([50, 50, 50, 50], 100)) == 2


def test_windows_of_one_task():
    rng = random.Random(3)
    for n in [0, 1, 2, 5, 40, 300]:
        sizes = [rng.choice([1, 3, 20, 64, 65, 300]) for _ in range(n)]
        docs = [Piece(k, 0, np.arange(s, dtype="<u4"), s) for k, s in enumerate(sizes)]
        windows = list(packed(iter(docs), 64, windows=8))
        lengths = [sum(len(p.ids) for p in w) for w in windows]
        assert all(x == 64 or x & (x - 1) == 0 for x in lengths) and sum(lengths) == sum(sizes)
        seen = defaultdict(list)
        for w in windows:
            for p in w:
                assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
                seen[p.doc].append((p.start, len(p.ids)))
        assert {d: gapless(s) for d, s in seen.items()} == dict(enumerate(sizes))


def test_odd_rows(spark):
    texts = ["", None, "a", "x" * 200_000, "é日本𝒳", " " * 2_000_000, "w " * 30_000, "\n" * 1_000_000 + "end"]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(None, "a b", "own")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces_of(pack(df, context=64, windows=4)).collect()
    ids = plain_ids({i: t for i, t, _ in rows if i is not None})
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert len(found.pop(None)) >= 2
    assert {d: [i for _, part in sorted(p) for i in part] for d, p in found.items()} == ids
    assert pieces_of(pack(df.limit(0))).count() == 0
