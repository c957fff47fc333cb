from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sigweave.llm import outliers
from tests.llm.test_outliers import brute as brute_statistics
from tests.llm.test_packing_and_lengths import unpacked
from tests.llm.test_pareto_mix import check as check_mix
from tests.llm.test_simhash import groups_of, similar_pairs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, as data frames; written and reread between them."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        given = docs
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (given, docs)
    return out


def test_stages_in_order_with_the_columns_of_documents(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_output"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == columns, name


def test_quality_keeps_what_its_operator_keeps(stages):
    before, after = stages["quality"]
    verdict = {r.doc_id: r for r in outliers.quality(before).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, r in verdict.items() if r.kept}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert not any(brute_statistics(texts[r.doc_id])[-1] for r in after.collect())


def test_one_document_of_each_group_stays(stages):
    before, after = (x.toPandas() for x in stages["near_duplicates"])
    pairs = [(i, j) for i, j, s in similar_pairs(before.text.tolist()) if s >= 0.8]
    ids = before.doc_id.tolist()
    assert pairs and sorted(after.doc_id) == sorted(set(groups_of(pairs, ids)))


def test_leaked_documents_go(stages):
    before, after = (x.toPandas() for x in stages["decontamination"])
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    plain = lambda t: " ".join(t.lower().split())
    leaked = {d for d, t in zip(before.doc_id, before.text) for i in items.text if plain(i) in plain(t)}
    assert leaked and set(after.doc_id) == set(before.doc_id) - leaked


def test_mixing_copies_rows_as_its_operator_says(stages):
    before, after = stages["mixing"]
    rows = cp.pareto_mix.mix(before).collect()
    check_mix(rows, [(r.source, r.text) for r in before.collect()], 0)
    assert Counter(r.doc_id for r in after.collect()) == Counter({r.doc_id: r.copies for r in rows if r.copies})


def test_output_holds_every_text(stages):
    before, after = stages["token_output"]
    copies, texts = Counter(), {}
    for r in before.collect():
        copies[r.doc_id] += 1
        texts[r.doc_id] = r.text
    seen, rows = defaultdict(Counter), after.collect()
    for r in rows:
        for doc, piece in zip(r.doc_ids, r.pieces):
            seen[doc][piece] += 1
    assert {d: max(c.values()) for d, c in seen.items()} == copies
    assert all(len(set(c.values())) == 1 for c in seen.values())
    once = [r for r in rows if all(copies[d] == 1 for d in r.doc_ids)]
    whole = {d for d in copies if copies[d] == 1 and len(seen[d]) == 1}
    found = {d: t for r in once for d, t in unpacked_of(r, whole).items()}
    assert found and all(texts[d] == t for d, t in found.items())


def unpacked_of(row, whole):
    if not set(row.doc_ids) <= whole:
        return {}
    return unpacked([row], 2048)


def test_run_gives_the_last_stage(spark, stages):
    got = cp.run(spark, FOLDER)
    assert got.count() > 0 and got.columns == stages["token_output"][1].columns
    tokens = lambda df: sum(r.n_tokens for r in df.select("n_tokens").collect())
    assert tokens(got) == tokens(stages["token_output"][1])


def test_stages_on_odd_rows(spark):
    said = [" ".join(f"{w}{(i * 7 + k * k) % 997}" for k, w in enumerate(["river", "stone", "cloud", "lamp"] * 12)) for i in range(30)]
    texts = [*said, None, "", " \n ", said[0]]
    rows = [(i if i % 7 else None, "s" if i % 2 else None, "en" if i % 3 else None, len(t or ""), t) for i, t in enumerate(texts)]
    clash = ["_llm_fp", "_llm_best", "_llm_d1", "_llm_row", "_llm_stats", "_mix_id", "_mix_copies", "_in_mix_id", "fp", "d1", "root"]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, source string, lang string, n_chars int, text string")
    docs = docs.withColumns({c: F.lit(c) for c in clash})
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns, name
        got = after.collect()
        assert {tuple(r[c] for c in clash) for r in got} == {tuple(clash)}, name
        left = Counter(r.text for r in got)
        if name == "quality":
            assert left == Counter(r[4] for r in rows + rows[:2] if r[4] and r[4].split())
        elif name == "near_duplicates":
            assert sum(left[t] for t in (None, "", " \n ")) == 1 and all(left[t] == 1 for t in said)
        elif name == "decontamination":
            assert left == Counter(r[4] for r in rows + rows[:2])
        else:
            assert left and not set(left) & {None, "", " \n "}
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
    last = cp.STAGES[-1][1]
    assert sum(len(r.doc_ids) for r in last(spark, docs, FOLDER).collect()) == len(rows) + 2
    assert last(spark, docs.limit(0), FOLDER).count() == 0
