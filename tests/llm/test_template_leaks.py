import pandas as pd

from sigweave.llm.queries import QUERIES
from sigweave.llm.template_leaks import leaks, without_leaks

ITEM = (
    "On a market day the farmer sold 12 baskets to Alice and 7 baskets to Robert for 3 dollars each, "
    "so how many coins did Alice give to the farmer in all?"
)
SAME_SHAPE = ITEM.replace("12", "40").replace("Alice", "Marie").replace("Robert", "Paul")
BROKEN = "On a market day the farmer sold 12 baskets to Alice and 7 baskets to Robert for 3 dollars each, so how many coins did Robert give to the farmer in all?"
FILL = "nothing to see here but some other words that go on and on without an end to them. "


def frame(spark, texts):
    rows = [(i, t, 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, hash int, template string")


def bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_exact_reparameterised_and_inconsistent(spark):
    texts = [FILL + ITEM + FILL, FILL + SAME_SHAPE, FILL + BROKEN, FILL, None, "", ITEM.upper()[:50], FILL + ITEM[:40]]
    got = {r.doc_id: r for r in leaks(frame(spark, texts), bench(spark, [ITEM, None, "", "too short"])).collect()}
    assert set(got) == {0, 1}
    assert got[0].same_values and not got[1].same_values


DENSE = "Alice drove 40 miles in 2 hours and Bob drove 60 miles in 3 hours. Who was faster?"
NUMBERS = "Sort 4 9 12 7 33 5 8 21 6 from low to high"


def test_dense_and_short_items(spark):
    other = DENSE.replace("40", "45").replace("60", "70").replace("Bob", "Carl")
    texts = [
        FILL + DENSE + FILL, FILL + other, FILL + NUMBERS, FILL + NUMBERS.replace("9 12 7 33", "3 2 1 0"),
        FILL + "What is 12 + 30? " + FILL, FILL + "What is 12 + 31? " + FILL,
    ]
    items = bench(spark, [DENSE, NUMBERS, "What is 12 + 30?"])
    got = {(r.doc_id, r.item_id): r for r in leaks(frame(spark, texts), items).collect()}
    assert set(got) == {(0, 0), (1, 0), (2, 1), (4, 2)}
    assert got[0, 0].covered == 18 and got[0, 0].same_values and not got[1, 0].same_values
    assert got[2, 1].covered == 14 and (got[4, 2].covered, got[4, 2].item_tokens) == (4, 4)


def test_values_that_coincide_and_a_clash_beside_a_verbatim_copy(spark):
    same = ITEM.replace("12", "4").replace("and 7", "and 4")
    end = " Robert gave the money to nobody at all and went back home on foot in the rain that night."
    long = ITEM + " Then nobody said a word about what was bought and sold on that fine day in spring." + end
    got = {r.doc_id: r for r in leaks(frame(spark, [FILL + same, FILL + BROKEN]), bench(spark, [ITEM])).collect()}
    assert set(got) == {0} and not got[0].same_values
    words = long.replace("did Alice give", "did Robert give")
    assert words != long
    got = leaks(frame(spark, [FILL + words]), bench(spark, [long])).collect()
    assert [(r.doc_id, r.same_values) for r in got] == [(0, True)] and got[0].covered < got[0].item_tokens


def test_punctuation_case_and_accents(spark):
    item = "Élève numéro deux va à l'école avec son frère et sa sœur chaque matin de bonne heure"
    text = FILL + item.replace("Élève", "élève").replace(" ", ",\n ") + " fin"
    assert leaks(frame(spark, [text, item[:30]]), bench(spark, [item])).count() == 1


def test_rows_stay_whole(spark):
    df = frame(spark, [FILL, ITEM, None, FILL])
    rows = df.union(df)
    kept = without_leaks(rows, bench(spark, [ITEM]))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 0, 2, 2, 3, 3]
    assert leaks(rows, bench(spark, [ITEM])).count() == 1


def test_empty_tables(spark):
    df = frame(spark, [ITEM])
    assert leaks(df.limit(0), bench(spark, [ITEM])).count() == 0
    assert leaks(df, bench(spark, [ITEM]).limit(0)).count() == 0
    assert without_leaks(df, bench(spark, [ITEM]).limit(0)).count() == 1


def test_query_finds_every_whole_item(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    items = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: " ".join(t.lower().split())
    docs["plain"] = docs.text.map(plain)
    want = {(d, i) for i, t in zip(items.item_id, items.text.map(plain)) for d in docs.doc_id[docs.plain.str.contains(t, regex=False)]}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_leaks"](spark, sf_dir).collect()}
    assert want and want == got
