"""Quality rules: plain limits, then robust multivariate outliers.

Every document has a vector of transformed statistics. Per language and source, the location
and scatter of the vectors are estimated by the minimum covariance determinant: of all subsets
of h = 75 % of a group's documents, the one whose covariance matrix has the least determinant.
Concentration steps look for it: estimate, keep the h documents with the smallest Mahalanobis
distances, estimate again. Each group has three fixed starts: medians with scaled median
deviations alone, with the correlation of squashed (tanh) entries, and with that of signs in
space. Each start goes on until its determinant falls no more, and the least one wins.
Documents far from the location by the final, rescaled scatter are rejected.

A step is two aggregations of the whole vector table by group and open start: counts in bins of
the distance, which show where the h-th distance lies, and sums of products of the rows within.
A hot source is pre-aggregated like any other; only three rows a group are ever brought together,
and only whether a start is still open reaches the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigweave.llm.shared import key_of, stored

_SYMBOLS = b"#*$%&|<>"
_BLANKS = " \t\n\r\x0b\x0c"
_STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_chars long, n_caps long"
)
_CAPS = bytes(range(65, 91))
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Words that a short text's mean word length is drawn towards `_USUAL` by.
_PSEUDO, _USUAL = 30, 5.0
#: Least standard deviation of each vector entry: below it, differences are of no account.
_FLOOR = (0.04, 0.01, 0.10, 0.06, 0.03)
#: Documents that the floor counts for in the scatter of a small group.
_PRIOR = 20
#: A determinant whose logarithm falls by less has come to rest.
_FALL = 1e-6


def _repeated(words: list[bytes], width: int = 5) -> int:
    """Words in windows of `width` that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(width):
        window = (window ^ h[k : n + k]) * _MIX
        window ^= window >> np.uint64(29)
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : n + k] |= twice
    return int(covered.sum())


def _statistics(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split()]
    return (
        len(words),
        len(text) - sum(map(text.count, _BLANKS)),
        sum(raw.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        len(text),
        len(raw) - len(raw.translate(None, _CAPS)),
    )


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text; all zero for null or empty.

    Named not deterministic only so that Spark makes it once, not again for each filter on it.
    """

    @F.arrow_udf(_STATS)
    def of(texts: pa.Array) -> pa.Array:
        names = [x.split()[0] for x in _STATS.split(", ")]
        rows = np.array([_statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(names))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names)

    return of.asNondeterministic()(text)


def vector(s: str) -> list[Column]:
    """Entries of the vector from the struct column `s`; their number is the dimension.

    Log mean word length, and shares of symbols, repeated lines, words in repeated windows and
    capitals. Each share has a few pseudo counts below the line, so that short texts, whose
    shares are mostly noise, don't stand out.
    """
    n = F.col(f"{s}.n_words")
    return [
        F.log((F.col(f"{s}.word_chars") + _PSEUDO * _USUAL) / (n + _PSEUDO)),
        F.col(f"{s}.n_symbols") / (F.col(f"{s}.n_chars") + 20),
        F.col(f"{s}.n_dup_lines") / (F.col(f"{s}.n_lines") + 2),
        F.col(f"{s}.n_repeat_words") / (n + 10),
        F.col(f"{s}.n_caps") / (F.col(f"{s}.n_chars") + 40),
    ]


def failed(s: str) -> Column:
    """The plain limits: too few words, or too many of them in repeated windows."""
    return (F.col(f"{s}.n_words") < 10) | (100 * F.col(f"{s}.n_repeat_words") > 20 * F.col(f"{s}.n_words"))


def chi2_quantile(k: int, q: float) -> float:
    """Quantile of the chi-squared distribution, by bisection on its series."""

    def below(x: float) -> float:
        term = total = 1 / (k / 2)
        i = 0
        while term > total * 1e-15:
            i += 1
            term *= x / 2 / (k / 2 + i)
            total += term
        return total * math.exp(k / 2 * math.log(x / 2) - x / 2 - math.lgamma(k / 2))

    lo, hi = 1e-9, 10.0 * k + 200
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < q else (lo, mid)
    return (lo + hi) / 2


def _chi2_below(k: int, x: float) -> float:
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_quantile(k, mid) < x else (lo, mid)
    return (lo + hi) / 2


def distance(entries: list[Column], mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; `inverse` is the row-major upper triangle, off-diagonals doubled."""
    gap = [e - mean[i] for i, e in enumerate(entries)]
    terms, k = [], 0
    for i in range(len(gap)):
        for j in range(i, len(gap)):
            terms.append(gap[i] * gap[j] * inverse[k])
            k += 1
    return sum(terms[1:], terms[0])


def _flat(inverse: np.ndarray) -> list[float]:
    p = len(inverse)
    return [inverse[i, j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]


def _square(upper, p: int) -> np.ndarray:
    full = np.zeros((p, p))
    full[np.triu_indices(p)] = upper
    return full + np.triu(full, 1).T


def _solve(p: int, scale: float, floor: tuple[float, ...]):
    """From sums to (mean, inverse, logdet) of one group a row."""
    least = np.diag(np.square(floor))

    @F.pandas_udf("mean array<double>, inverse array<double>, logdet double")
    def of(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        out = []
        for count, s, xy in zip(n, sums, products):
            mean = np.asarray(s, float) / count
            cov = _square(xy, p) / count - np.outer(mean, mean)
            cov = (count * scale * cov + _PRIOR * least) / (count + _PRIOR) + least
            out.append((mean.tolist(), _flat(np.linalg.inv(cov)), np.linalg.slogdet(cov)[1]))
        return pd.DataFrame(out, columns=["mean", "inverse", "logdet"])

    return of


def _shapes(p: int):
    """From scales and two sums of products of standardised entries to the starts' inverses."""

    @F.pandas_udf("array<array<double>>")
    def of(n: pd.Series, wide: pd.Series, squashed: pd.Series, signs: pd.Series) -> pd.Series:
        out = []
        for count, w, *sums in zip(n, wide, squashed, signs):
            per = np.diag(1 / np.asarray(w, float))
            starts = [np.eye(p)]
            for upper in sums:
                shape = _square(upper, p) / count
                starts.append(shape + (0.01 * np.trace(shape) / p + 1e-9) * np.eye(p))
            out.append([_flat(per @ np.linalg.inv(x) @ per) for x in starts])
        return pd.Series(out)

    return of


def _starts(vectors: DataFrame, p: int, floor: tuple[float, ...]) -> DataFrame:
    """(grp, start, mean, inverse) to begin with, see the module's docstring."""
    v = [F.col(f"v{i}") for i in range(p)]
    middle = stored(
        vectors.groupBy("grp").agg(F.array(*[F.percentile_approx(x, 0.5, 10000) for x in v]).alias("mean"))
    )
    spread = vectors.join(middle, "grp").groupBy("grp").agg(
        F.first("mean").alias("mean"),
        F.array(
            *[
                F.sqrt(floor[i] ** 2 + F.pow(1.4826 * F.percentile_approx(F.abs(x - F.col("mean")[i]), 0.5, 10000), 2))
                for i, x in enumerate(v)
            ]
        ).alias("wide"),
    )
    spread = stored(spread)
    z = vectors.join(spread, "grp").select(
        "grp", "mean", "wide", *[((x - F.col("mean")[i]) / F.col("wide")[i]).alias(f"z{i}") for i, x in enumerate(v)]
    )
    norm = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, p)), F.col("z0") * F.col("z0"))
    z = z.withColumn("norm", F.greatest(norm, F.lit(1e-12)))
    pairs = [(F.col(f"z{i}"), F.col(f"z{j}")) for i in range(p) for j in range(i, p)]
    sums = z.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.first("mean").alias("mean"),
        F.first("wide").alias("wide"),
        F.array(*[F.sum(F.tanh(a) * F.tanh(b)) for a, b in pairs]).alias("squashed"),
        F.array(*[F.sum(a * b / F.col("norm")) for a, b in pairs]).alias("signs"),
    )
    return sums.select(
        "grp", "mean", F.posexplode(_shapes(p)("n", "wide", "squashed", "signs")).alias("start", "inverse")
    ).select("grp", "start", "mean", "inverse")


def estimates(vectors: DataFrame, p: int, share: float = 0.75, floor: tuple[float, ...] = _FLOOR) -> DataFrame:
    """(grp, mean, inverse, logdet) by minimum covariance determinant of rows (grp, v0, v1, ...).

    The determinant is that of the rescaled scatter with its floor. A start whose determinant no
    longer falls by `_FALL` (of its logarithm) stays as it is, so the steps come to an end.
    """
    v = [F.col(f"v{i}") for i in range(p)]
    # The covariance of the nearest `share` is too small by this factor if data are normal.
    scale = share / _chi2_below(p + 2, chi2_quantile(p, share))
    solve = _solve(p, scale, floor)
    products = F.array(*[F.sum(v[i] * v[j]) for i in range(p) for j in range(i, p)])
    each = ["grp", "start"]
    now = _starts(vectors, p, floor).withColumn("logdet", F.lit(math.inf)).withColumn("open", F.lit(True))
    now = stored(now)
    while not now.where("open").isEmpty():
        before = now.where("open").select(*each, "mean", "inverse", "logdet")
        far = vectors.join(before.drop("logdet"), "grp").withColumn("d", distance(v, F.col("mean"), F.col("inverse")))
        far = far.withColumn("bin", F.floor(64 * F.log2(1e-6 + F.greatest("d", F.lit(0.0)))).cast("int"))
        upto = F.sum("n").over(W.partitionBy(*each).orderBy("bin"))
        bins = far.groupBy(*each, "bin").agg(F.count("*").alias("n")).withColumn("upto", upto)
        bins = bins.withColumn("all", F.sum("n").over(W.partitionBy(*each)))
        limit = bins.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy(*each).agg(F.min("bin").alias("most"))
        near = far.join(stored(limit), each).where("bin <= most")
        sums = near.groupBy(*each).agg(
            F.count("*").alias("n"), F.array(*[F.sum(x) for x in v]).alias("sums"), products.alias("products")
        )
        step = sums.select(*each, solve("n", "sums", "products").alias("e")).join(before, each)
        lower = F.col("e.logdet") < F.col("logdet") - _FALL
        took = [F.when(lower, F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) for c in ("mean", "inverse", "logdet")]
        now = stored(now.where("NOT open").unionByName(step.select(*each, *took, lower.alias("open"))))
    best = F.min_by(F.struct("mean", "inverse", "logdet"), F.struct("logdet", "start"))
    return now.groupBy("grp").agg(best.alias("e")).select("grp", "e.mean", "e.inverse", "e.logdet")


def judged(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    quantile: float = 0.99999,
    share: float = 0.75,
) -> DataFrame:
    """All rows and columns of `docs`, with `_llm_stats` (struct), `_llm_distance` and `_llm_kept`.

    A null language or source is a group of its own; a null or empty text has no words and
    fails. Documents that fail the plain limits take no part in the estimates. A group with few
    documents leans on the least scatter, so a lone document is kept. Repeated rows count as
    often as they occur. Texts are not shuffled: statistics are made again, beside the text,
    once the estimates are known. Empty input gives no rows. Input columns of the three
    names added are replaced.
    """
    marked = docs.withColumn("_llm_stats", statistics(F.col(text_col)))
    marked = marked.withColumn("_llm_grp", key_of(lang_col, source_col))
    v = vector("_llm_stats")
    vectors = marked.where(~failed("_llm_stats")).select(
        F.col("_llm_grp").alias("grp"), *[x.alias(f"v{i}") for i, x in enumerate(v)]
    )
    found = estimates(stored(vectors), len(v), share)
    return _verdict(marked, found, v, quantile)


def _verdict(marked: DataFrame, found: DataFrame, v: list[Column], quantile: float) -> DataFrame:
    limit = chi2_quantile(len(v), quantile)
    found = found.select(
        F.col("grp").alias("_llm_g"), F.col("mean").alias("_llm_mean"), F.col("inverse").alias("_llm_inverse")
    )
    far = distance(v, F.col("_llm_mean"), F.col("_llm_inverse"))
    return (
        marked.join(found, F.col("_llm_grp") == F.col("_llm_g"), "left")
        .withColumn("_llm_distance", far)
        .withColumn("_llm_kept", ~failed("_llm_stats") & F.coalesce(F.col("_llm_distance") <= limit, F.lit(True)))
        .drop("_llm_g", "_llm_mean", "_llm_inverse", "_llm_grp")
    )


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    quantile: float = 0.99999,
) -> DataFrame:
    """One row per row of `docs`: doc_id, the statistics, base_failed, distance, kept.

    Cases as in `judged`; here the statistics are made once and written, without the text.
    """
    thin = docs.select(
        F.col(id_col).alias("doc_id"),
        key_of(lang_col, source_col).alias("_llm_grp"),
        statistics(F.col(text_col)).alias("_llm_stats"),
    )
    thin = stored(thin)
    v = vector("_llm_stats")
    vectors = thin.where(~failed("_llm_stats")).select(
        F.col("_llm_grp").alias("grp"), *[x.alias(f"v{i}") for i, x in enumerate(v)]
    )
    out = _verdict(thin, estimates(vectors, len(v)), v, quantile)
    return out.select(
        "doc_id",
        *[f"_llm_stats.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed("_llm_stats").alias("base_failed"),
        F.col("_llm_distance").alias("distance"),
        F.col("_llm_kept").alias("kept"),
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **options
) -> DataFrame:
    """The rows of `docs` that are kept, with their columns, whatever their names. Cases as in `judged`."""
    packed = docs.select(F.struct(*docs.columns).alias("_llm_row"))
    inside = [f"_llm_row.{c}" for c in (text_col, lang_col, source_col)]
    return judged(packed, *inside, **options).where("_llm_kept").select("_llm_row.*")
