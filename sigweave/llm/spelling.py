"""Spelling variants: words one edit apart, grouped under their most frequent form.

Near words are found by asymmetric q-chunks. The shorter word of a pair is cut into two disjoint chunks, its
halves; one edit leaves one of them as it is. The longer word (or the other one of equal length) gives its positional
grams of those lengths. Chunks and grams are joined on their text and place, a chunk also one place to the left and
right, and what meets is verified. Grams at places that no chunk can have are not made, so a word of any
length gives a fixed number of rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.llm.shared import stored

#: Fixed value: the characters of a run; one shorter than the least word cannot become one.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, DOMINANCE, MISTYPED = 5, 3, 2, 97
#: Different words that a task counts before it hands them on.
HELD = 300_000


def mistyped(doc: bytes, word: bytes, every: int) -> str:
    """The run as it counts: for one in `every` (document, run), without one code point."""
    h = crc32(word, crc32(doc))
    text = word.decode()
    if every and not h % every:
        at = h % len(text)
        text = text[:at] + text[at + 1 :]
    return text


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    mistype_every: int = 0,
) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z in lower case, of at least `least_length` code points.

    With `mistype_every`, each (id, run) whose CRC-32 it divides loses a code point, in all its occurrences.
    A null text has no words; a null id counts as an empty one. Rows that repeat are counted as often as they occur.
    """
    run = re.compile(f"{LETTERS}{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text")):
                prefix = f"{doc.as_py() or ''}:".encode()
                # Lower case of bytes is that of A-Z alone.
                found = Counter(run.findall((text.as_py() or b"").lower().decode()))
                if mistype_every:
                    for word, n in found.items():
                        raw = word.encode()
                        if crc32(raw, crc32(prefix)) % mistype_every:
                            total[word] += n
                        else:
                            total[mistyped(prefix, raw, mistype_every)] += n
                else:
                    total.update(found)
                if len(total) >= HELD:
                    yield _counted(total)
                    total.clear()
        if total:
            yield _counted(total)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.length("word") >= least_length)


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def _half(length: Column) -> Column:
    """Length of the first chunk of a word."""
    return F.ceil(length / 2).cast("int")


def _keys(length: Column, many: Column, at: Column) -> Column:
    """What a chunk and a gram share: length of the text, its place, and a hash of it."""
    return F.struct(many.alias("q"), at.alias("at"), F.xxhash64(F.substring(F.col("word"), at + 1, many)).alias("h"))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) of all words exactly one inserted, deleted or replaced code point apart, each pair once, b not shorter.

    `words` has different words in `word`. Words of one code point have an empty chunk; they are compared through it.
    """
    length = F.length("word")
    words = words.select("word").where("word IS NOT NULL").withColumn("size", length)
    size = F.col("size")
    first = _half(size)

    def chunk(number: int, at: Column, many: Column) -> Column:
        """One chunk at its place and one place to either side."""
        text = F.xxhash64(F.substring(F.col("word"), at + 1, many))
        return F.transform(
            F.sequence(at - 1, at + 1),
            lambda x: F.struct(F.lit(number).alias("c"), (x - at).alias("shift"), many.alias("q"), x.alias("at"), text.alias("h")),
        )

    chunks = words.select(
        F.col("word").alias("a"),
        F.col("size").alias("a_size"),
        F.explode(F.filter(F.concat(chunk(0, F.lit(0), first), chunk(1, first, size - first)), lambda x: x["at"] >= 0)).alias("k"),
    ).select("a", "a_size", "k.*")
    # Chunks come from words of this length or one less: those lengths tell the grams' lengths and places.
    grams = (
        words.select("word", "size", F.explode(F.array(size - 1, size)).alias("of"))
        .where("of > 0")
        .select("word", "size", _half(F.col("of")).alias("half"), "of")
        .select(
            "word",
            "size",
            F.explode(
                F.concat(
                    F.transform(F.sequence(F.lit(0), F.lit(1)), lambda x: F.struct(x.alias("at"), F.col("half").alias("q"), F.lit(0).alias("c"))),
                    F.transform(
                        F.sequence(F.col("half") - 1, F.col("half") + 1),
                        lambda x: F.struct(x.alias("at"), (F.col("of") - F.col("half")).alias("q"), F.lit(1).alias("c")),
                    ),
                )
            ).alias("k"),
            F.col("of"),
        )
        .where("k.at >= 0 AND k.at + k.q <= size")
        .select(
            F.col("word").alias("b"),
            F.col("size").alias("b_size"),
            F.col("of").alias("a_size"),
            F.col("k.c").alias("c"),
            F.col("k.q").alias("q"),
            F.col("k.at").alias("at"),
            F.xxhash64(F.expr("substring(word, k.at + 1, k.q)")).alias("h"),
        )
    )
    # Behind the edit a text moves by what the lengths differ, before it by nothing.
    met = chunks.join(grams, ["a_size", "c", "q", "at", "h"]).where(
        "(shift = 0 OR shift = b_size - a_size) AND (a_size < b_size OR a < b)"
    )
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """Adds to (word, n): form, n_near, form_n and root.

    A word's near words are those one edit away, `n_near` their number. `form` is the one of largest n (ties: the least
    in code-point order) if its n is at least `dominance` (2 or more) times the word's own, else null; `form_n` is its n.
    `root` is the last word reached by following forms, the word itself if it has none. Words must be different. Forms
    grow at each step, so there are no rings. Empty input gives no rows.
    """
    words = stored(words.select("word", "n"))
    pairs = stored(near_words(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = (
        both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
        .groupBy("a")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w"))).alias("best"))
        .select(F.col("a").alias("word"), "n_near", F.col("best.w").alias("w"), (-F.col("best.m")).alias("w_n"))
    )
    strong = F.col("w_n") >= dominance * F.col("n")
    found = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("w")).alias("form"),
            F.when(strong, F.col("w_n")).alias("form_n"),
        )
    )
    roots = chain_ends(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def chain_ends(links: DataFrame) -> DataFrame:
    """(word, root): where each chain of (word, root) links without rings ends, by pointer doubling."""
    links = stored(links)
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(onward, "root", "left"))
        if moved.where("next IS NOT NULL").isEmpty():
            return links
        links = stored(moved.select("word", F.coalesce("next", "root").alias("root")))
