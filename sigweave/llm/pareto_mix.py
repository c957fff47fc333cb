"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words; a document's expected number of copies follows its weight,
capped at `cap`, so that the expected words of the source are its target. The whole part of
the copies is certain. The rest f is an inclusion probability: documents are ranked by
u / (1 - u) divided by f / (1 - f), u being a uniform number from the document's id, and the
first ones are taken up to the size that is left. The size of a sample is fixed in words, which
is what targets are stated in.

Weights are size classes (the number of binary digits of the word count): a long document is
repeated rather more often than a one-line one. Other weights can be passed.

The cut is found without sorting a source: ranks fall into 65,536 bins per source, sums of bins
show in which bin the cut lies, and only the rows of that bin are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.llm.shared import free_names, key_of, stored, water_levels, words_in

_BINS = 1 << 16
_EDGE = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Per source: `target` words, from rows (source, size).

    Sources in code point order, null last, weigh `weights`, repeating; together they get
    `share` of all words and none more than `cap` times its own, the excess being reshared.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    shares = sums.select(
        "source",
        "source_size",
        F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(cap))).alias("most"),
        (F.sum("source_size").over(W.partitionBy()) * F.lit(float(share))).alias("total"),
    )
    levels = water_levels(shares, [], "weight", "most", "total")
    return levels.select("source", "source_size", F.col("share").alias("target"))


def _copies(rows: DataFrame, weights, share, cap, seed, weight) -> DataFrame:
    """Adds `_mix_copies`, `_mix_source_size` and `_mix_target` to rows that have `_mix_id`,
    `_mix_source` and `_mix_size`.

    Only tables of one row per source, per (source, size class) and per (source, bin) are
    joined, and only the rows of one bin per source are sorted.
    """
    rows = rows.withColumn("_mix_src", key_of("_mix_source"))
    size = F.col("_mix_size")
    weight = (F.length(F.bin(size)) if weight is None else weight).cast("double")
    rows = rows.withColumn("_mix_weight", weight)
    # One row per (source, class, size): all that follows but the order needs no more.
    sums = stored(
        rows.groupBy("_mix_source", "_mix_src", "_mix_weight").agg(F.sum("_mix_size").alias("words"))
    )
    targets = source_targets(
        sums.select(F.col("_mix_source").alias("source"), F.col("words").alias("size")), weights, share, cap
    )
    targets = stored(targets.select(key_of("source").alias("_mix_src"), "source_size", "target"))
    classes = sums.where("words > 0").join(targets, "_mix_src")
    classes = classes.withColumn("pull", F.col("_mix_weight") * F.col("words")).withColumn(
        "most", F.col("words") * F.lit(float(cap))
    )
    classes = water_levels(classes, ["_mix_src"], "pull", "most", "target").withColumn(
        "expected", F.least(F.lit(float(cap)), F.col("share") / F.col("words"))
    )
    near = F.round("expected")
    sure = F.when(F.abs(F.col("expected") - near) < _EDGE, near).otherwise(F.floor("expected"))
    classes = classes.withColumn("_mix_sure", sure.cast("long")).withColumn(
        "_mix_part", F.greatest(F.lit(0.0), F.col("expected") - F.col("_mix_sure"))
    )
    whole = W.partitionBy("_mix_src")
    mean = F.sum(F.col("_mix_part") * F.col("words")).over(whole) / F.sum("words").over(whole)
    left = F.col("target") - F.sum(F.col("_mix_sure") * F.col("words")).over(whole)
    classes = classes.withColumn("mean", F.least(F.greatest(mean, F.lit(1e-6)), F.lit(1 - 1e-6)))
    classes = stored(
        classes.select(
            "_mix_src", "_mix_weight", "_mix_sure", "_mix_part", left.alias("_mix_left"),
            (F.col("mean") / (1 - F.col("mean"))).alias("_mix_spread"),
        )
    )
    bits = F.xxhash64("_mix_id", "_mix_size", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 52))
    part = F.col("_mix_part")
    odds = u / (1 - u) / (part / (1 - part))
    # The same order on (0, 1), spread by the source's mean odds so that bins fill evenly.
    rank = 1 / (1 + 1 / (odds * F.col("_mix_spread")))
    scored = (
        rows.join(classes, ["_mix_src", "_mix_weight"], "left")
        .withColumn("_mix_rank", F.when((part > 0) & (size > 0), rank))
        # No rank, no bin; `least` by itself would skip the null.
        .withColumn(
            "_mix_bin",
            F.when(
                F.col("_mix_rank").isNotNull(), F.least(F.lit(_BINS - 1), F.floor(F.col("_mix_rank") * _BINS)).cast("int")
            ),
        )
    )
    # Running sums over groups of 256 bins, then inside a group: no task has all bins of a source.
    bins = (
        scored.where("_mix_bin IS NOT NULL")
        .groupBy("_mix_src", F.shiftright("_mix_bin", 8).alias("part"), "_mix_bin")
        .agg(F.sum("_mix_size").alias("filled"), F.first("_mix_left").alias("left"))
    )
    earlier = W.partitionBy("_mix_src").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = bins.groupBy("_mix_src", "part").agg(F.sum("filled").alias("sum"))
    parts = parts.select("_mix_src", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    upto = W.partitionBy("_mix_src", "part").orderBy("_mix_bin").rowsBetween(W.unboundedPreceding, 0)
    bins = bins.join(parts, ["_mix_src", "part"]).withColumn("upto", F.col("before") + F.sum("filled").over(upto))
    over = bins.where("upto > left").withColumn("room", F.expr("left - upto + filled"))
    cut = over.groupBy("_mix_src").agg(F.min(F.struct("_mix_bin", "room")).alias("cut"))
    cut = stored(
        cut.select("_mix_src", F.col("cut._mix_bin").alias("_mix_cut"), F.col("cut.room").alias("_mix_room"))
    )
    scored = scored.join(cut, "_mix_src", "left")
    taken = F.col("_mix_cut").isNull() | (F.col("_mix_bin") < F.col("_mix_cut"))
    clear = scored.where("_mix_bin IS NULL OR _mix_cut IS NULL OR _mix_bin <> _mix_cut").withColumn(
        "_mix_extra", F.when(F.col("_mix_bin").isNotNull() & taken, 1).otherwise(0)
    )
    order = W.partitionBy("_mix_src").orderBy("_mix_rank", F.col("_mix_id").asc_nulls_last(), "_mix_size")
    run = F.sum("_mix_size").over(order.rowsBetween(W.unboundedPreceding, 0))
    # The row across the cut is taken if that comes nearer to the target than leaving it.
    border = scored.where("_mix_bin = _mix_cut").withColumn(
        "_mix_extra", (run - size / 2 <= F.col("_mix_room")).cast("int")
    )
    return (
        clear.unionByName(border)
        .withColumn("_mix_copies", F.when(size > 0, F.coalesce("_mix_sure", F.lit(0)) + F.col("_mix_extra")).otherwise(0))
        .join(targets.withColumnRenamed("target", "_mix_target").withColumnRenamed("source_size", "_mix_source_size"), "_mix_src")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 0,
    weight: Column | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies, taken.

    A null or empty text has size 0 and no copies. The random number depends on id, size and
    seed alone, so reruns agree and rows that repeat are ranked alike. A null source is a source,
    the last one. `weight`: over `_mix_id`, `_mix_source` and `_mix_size`; a bounded number of
    distinct values is meant. Other columns are ignored. Empty input gives no rows.
    """
    sizes = stored(
        docs.select(
            F.col(id_col).alias("_mix_id"),
            F.col(source_col).alias("_mix_source"),
            words_in(F.col(text_col)).alias("_mix_size"),
        )
    )
    return _copies(sizes, weights, share, cap, seed, weight).select(
        F.col("_mix_id").alias("doc_id"),
        F.col("_mix_source").alias("source"),
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        F.col("_mix_copies").alias("copies"),
        (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 0,
    weight: Column | None = None,
) -> DataFrame:
    """The rows of `docs`, each as often as `mix` takes it, with all their columns.

    Documents without a word have no copies and go. Texts are not shuffled, but for those of the
    one bin per source in which the cut lies. Columns may have any names.
    """
    aside = [c for c in docs.columns if c.lower().startswith("_mix_")]
    names = dict(zip(aside, free_names(docs, *(f"_in{c}" for c in aside))))
    rows = docs.withColumnsRenamed(names)
    of = lambda c: F.col(names.get(c, c))
    rows = rows.withColumns({"_mix_id": of(id_col), "_mix_source": of(source_col), "_mix_size": words_in(of(text_col))})
    return (
        _copies(rows, weights, share, cap, seed, weight)
        .where("_mix_copies > 0")
        .withColumn("_mix_turn", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
        .select(*(of(c).alias(c) for c in docs.columns))
    )
