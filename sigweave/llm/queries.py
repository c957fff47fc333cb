"""The queries of this subpackage: every operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.llm import (
    attention_lm,
    differencing,
    merkle,
    outliers,
    packing,
    pareto_mix,
    personal_data,
    repeats,
    simhash,
    spelling,
    template_leaks,
    token_lengths,
    url_lists,
)
from sigweave.llm.shared import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Captures and list entries made of `pages`, in words that Spark and DuckDB both know. A page is fetched on a
#: day that its id tells; every host, and the domain and a path of it, is put on lists and taken off again.
CAPTURES = """
SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INT) AS fetched FROM pages
"""
ENTRIES = """
SELECT list, kind, pattern, DATE '2023-12-01' + CAST((m * 13 + step * (41 + m % 50)) % 420 AS INT) AS day,
       CASE WHEN (step + m) % 2 = 0 THEN 'add' ELSE 'remove' END AS action, step AS seq
FROM (SELECT *, explode(sequence(0, 3)) AS step FROM (
    SELECT 'spam' AS list, 'host' AS kind, host AS pattern, m FROM hosts WHERE m % 3 <> 0
    UNION ALL SELECT 'adult', 'domain', regexp_replace(host, '^(www|blog|m)[.]', ''), m FROM hosts WHERE m % 4 = 1
    UNION ALL SELECT 'paths', 'prefix', concat(host, '/en'), m FROM hosts WHERE m % 5 < 2
    UNION ALL SELECT 'trusted', 'domain', host, m FROM hosts WHERE m % 7 = 0
) q) p
"""
HOSTS = "SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, min(page_id) AS m FROM pages GROUP BY 1"


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    hosts = stored(spark.sql(HOSTS.replace("FROM pages", "FROM {pages}"), pages=pages))
    captures = spark.sql(CAPTURES.replace("FROM pages", "FROM {pages}"), pages=pages)
    entries = spark.sql(ENTRIES.replace("FROM hosts", "FROM {hosts}"), hosts=hosts)
    return url_lists.judged(captures, entries)


def op2_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(token_lengths.histogram(table(spark, sf_dir, "documents"), by=("source",)))
    return token_lengths.suffix_sums(counts, by=("source",))


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("d1", "d2")


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"), keep=False)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.scored(table(spark, sf_dir, "documents"))


def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    other = merkle.digest_of("doc_id", "source", "lang", "n_chars", F.replace("text", F.lit("\n"), F.lit("")))
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.digest_of("doc_id", "source", "lang", "n_chars", "text").alias("leaf"),
        F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, other).alias("changed"),
    )
    return merkle.manifest(leaves, "source", ["doc_id"]).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = differencing.pieces_of(differencing.pack(table(spark, sf_dir, "documents")))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), mistype_every=spelling.MISTYPED)
    words = spelling.variants(counts.where(F.col("n") >= spelling.LEAST_COUNT))
    return words.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_lists,
        op2_token_lengths,
        op3_template_leaks,
        op4_pareto_mix,
        op5_simhash,
        op6_personal_data,
        op7_repeats,
        op8_packing,
        op9_attention_lm,
        op10_outliers,
        op11_merkle,
        op12_differencing,
        op13_spelling,
    )
}

#: The as-of join replayed per capture and pattern: the last entry before the fetch day tells.
ORACLES: dict[str, str] = {
    "op1_url_lists": f"""
WITH hosts AS ({HOSTS}), captures AS ({CAPTURES}),
entries AS ({ENTRIES.replace("explode(sequence(0, 3))", "unnest(range(0, 4))")}),
states AS (
    SELECT list, kind, pattern, day,
           arg_max(action, seq * 2 + CASE WHEN action = 'remove' THEN 1 ELSE 0 END) = 'add' AS listed
    FROM entries GROUP BY list, kind, pattern, day
),
parts AS (
    SELECT page_id, fetched, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host,
           [x FOR x IN string_split(regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1), '/') IF x <> ''] AS steps
    FROM captures
),
asked AS (
    SELECT page_id, fetched, 'host' AS kind, host AS pattern FROM parts
    UNION ALL SELECT page_id, fetched, 'domain', array_to_string(string_split(host, '.')[i:], '.')
    FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM parts) d
    UNION ALL SELECT page_id, fetched, 'prefix', host || '/' || array_to_string(steps[1:i], '/')
    FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM parts) p
),
active AS (
    SELECT page_id, list, s.kind, s.pattern FROM asked a
    JOIN states s ON a.kind = s.kind AND a.pattern = s.pattern AND s.day <= a.fetched
    GROUP BY page_id, list, s.kind, s.pattern HAVING arg_max(listed, s.day)
),
found AS (
    SELECT page_id, string_agg(list || ':' || kind || ':' || pattern, ' ' ORDER BY list || ':' || kind || ':' || pattern)
           AS matched, bool_or(list = 'trusted') AS allowed
    FROM active GROUP BY page_id
)
SELECT p.page_id, host, fetched AS fetch_day, COALESCE(matched, '') AS matched,
       matched IS NOT NULL AND NOT COALESCE(allowed, FALSE) AS blocked
FROM parts p LEFT JOIN found f ON p.page_id = f.page_id
"""
}
