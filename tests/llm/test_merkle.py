from hashlib import sha256
from itertools import groupby
from zlib import crc32

import pandas as pd
import pytest

from sigweave.llm import merkle
from sigweave.llm.queries import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Levels of digests from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[k : k + 3]) for k in range(0, len(last), 3)])
    return levels


def siblings(levels, at):
    """(before, after) of each level below the root."""
    found = []
    for level in levels[:-1]:
        run = at - at % 3
        found.append((level[run:at], level[at + 1 : run + 3]))
        at //= 3
    return found


def expected(rows):
    """rows: (source, doc_id, leaf, changed) -> per (source, doc_id): subroot, root, proof, folded."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r[0])]
    trees = [tree([r[2] for r in g]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, (group, levels) in enumerate(zip(groups, trees)):
        for at, (source, doc, leaf, changed) in enumerate(group):
            path = siblings(levels, at) + siblings(top, k)
            now = changed or leaf
            for before, after in path:
                now = h(*before, now, *after)
            out.append((source, doc, leaf, levels[-1][0], top[-1][0], ["".join(b + a) for b, a in path], now))
    return out


def test_query_like_plain_trees(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = []
    for r in docs.itertuples():
        values = [None if pd.isna(v) else v for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text)]
        changed = None
        if crc32(str(r.doc_id).encode()) % 2 == 0:
            changed = leaf_of(*values[:4], values[4] if values[4] is None else values[4].replace("\n", ""))
        rows.append((values[1], r.doc_id, leaf_of(*values), changed))
    want = {
        doc: (doc, leaf, sub, root, h(*proof), folded, folded == root)
        for _, doc, leaf, sub, root, proof, folded in expected(rows)
    }
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_merkle"](spark, sf_dir).collect()}
    assert got == want
    assert len({w[6] for w in want.values()}) == 2


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_groups_of_all_sizes_ties_and_nulls(spark, monkeypatch, levels):
    """Blocks of 3, 9 and 729 nodes; groups from one row to many rounds; nulls, ties, repeated rows."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = []
    for k, n in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 90, 250]):
        for i in range(n):
            rows.append((f"s{k}", i, h("leaf", str(k), str(i)), h("new", str(i)) if i % 3 == 0 else None))
    rows += [(None, None, h("x"), None), (None, 5, h("y"), h("z")), ("", 1, h("e"), None)]
    rows += [("é", 7, h("t", str(i % 3)), None) for i in range(40)] + [("copies", 1, h("c"), h("d"))] * 30
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string, changed string").repartition(5)
    got = merkle.manifest(df, "source", ["doc_id"]).collect()

    def key(r):
        return tuple((x is not None, x) for x in r[:2]) + (r[2], r[5])

    want = expected(rows)
    assert sorted(((r.source, r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in got), key=key) == sorted(want, key=key)
    assert all(r.proof_sha256 == h(*r.proof) for r in got)


def test_empty_extra_columns_and_clashes(spark):
    schema = "source string, doc_id long, leaf string, changed string"
    assert merkle.manifest(spark.createDataFrame([], schema), "source", ["doc_id"]).count() == 0
    df = spark.createDataFrame([("a", 1, h("1"), None)], schema).selectExpr("*", "7 AS digest", "'y' AS k")
    row = merkle.manifest(df, "source", ["doc_id"]).first()
    assert (row.root, row.subroot, row.proof, row.digest, row.k) == (h("1"), h("1"), [], 7, "y")
    with pytest.raises(ValueError):
        merkle.manifest(df.withColumnRenamed("k", "root"), "source", ["doc_id"])


def test_parent_resumes_its_states():
    parent = merkle.Parent([b"a" * 64, b"b" * 64, b"c" * 64])
    assert parent.digest.decode() == h("a" * 64, "b" * 64, "c" * 64)
    assert parent.folded(1, b"x" * 64).decode() == h("a" * 64, "x" * 64, "c" * 64)
    assert parent.folded(1, b"b" * 64) == parent.digest


def test_digest_tells_values_apart(spark):
    text = "ä\n" * 5
    df = spark.createDataFrame([(1, None, text), (None, "", None)], "a long, b string, c string")
    got = [r.d for r in df.select(merkle.digest_of("a", "b", "c").alias("d")).collect()]
    assert got == [leaf_of(1, None, text), leaf_of(None, "", None)]
