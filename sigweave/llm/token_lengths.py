"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

Documents are aggregated by encoded length; the histogram has one row per length that occurs,
however many documents there are. Sums over all lengths from a given one upward give, for any
context limit: the documents that exceed it, the tokens kept if each is cut there, the share
of documents that fit, and so every quantile.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.llm.tokens import RANKS, ids_of

_BLOCK = 10


def encoded_length(text: Column, ranks: str = RANKS) -> Column:
    """Tokens of a text; 0 for null or empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([len(ids_of(t.as_py() or "", ranks)) for t in texts], pa.int64())

    return of(text)


def histogram(docs: DataFrame, text_col: str = "text", by: tuple[str, ...] = (), ranks: str = RANKS) -> DataFrame:
    """(`by`..., length, n_docs). Documents without text have length 0; a null group is a group."""
    keys = [F.col(c).alias(c) for c in by]
    lengths = docs.select(*keys, encoded_length(F.col(text_col), ranks).alias("length"))
    return lengths.groupBy(*by, "length").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """For every length of a histogram, taken as a context limit:

    n_docs of that length; docs_from, tokens_from: of that length or more; docs_over: longer;
    truncated_total: tokens kept if all are cut there; total: all tokens; quantile: the share of
    documents of that length or less. Running sums are made inside blocks of 1,024 lengths and
    over the blocks, so no task holds a whole histogram.
    """
    block = F.shiftright("length", _BLOCK)
    tokens = F.col("length") * F.col("n_docs")
    rows = hist.withColumns({"block": block, "tokens": tokens})
    blocks = rows.groupBy(*by, "block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = W.partitionBy(*by).orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    blocks = blocks.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("block").alias("_block"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(whole).alias("docs"),
        F.sum("t").over(whole).alias("total"),
    )
    on = rows["block"] == blocks["_block"]
    for c in by:
        on = on & rows[c].eqNullSafe(blocks[f"_{c}"])
    upward = W.partitionBy(*by, "block").orderBy(F.col("length").desc())
    out = rows.join(blocks, on).withColumns(
        {
            "docs_from": F.col("docs_above") + F.sum("n_docs").over(upward),
            "tokens_from": F.col("tokens_above") + F.sum("tokens").over(upward),
        }
    )
    over = F.col("docs_from") - F.col("n_docs")
    return out.select(
        *by,
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        over.alias("docs_over"),
        (F.col("total") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        "total",
        ((F.col("docs") - over) / F.col("docs")).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """Per group and limit: documents over it and tokens kept; limits need not occur as lengths."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in limits]))
    rows = hist.withColumn("limit", limit)
    return rows.groupBy(*by, "limit").agg(
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("truncated_total"),
    )


def quantile(sums: DataFrame, q: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Per group the least length that a share `q` of its documents do not exceed."""
    return sums.where(F.col("quantile") >= q).groupBy(*by).agg(F.min("length").alias("length"))
