"""Language-model scoring: a causal self-attention model on subword ids, and a word-count base.

Texts are lower-cased (A-Z), their words put in a row with single blanks, encoded with a public
tokenizer and ended with one id. Documents whose crc32(id) mod 7 is 2 are held out; all others teach:

- Word counts of all of them make the base score. Frequent words (a bounded number) are
  broadcast; a text's other words are joined with their counts, once per text.
- Their sums over the words' subwords are the subword counts, which choose the vocabulary.
- The attention model is trained in shards: every 12 MB of their texts, or part of that, make one.
  Each window of a shard is taken in one of the rounds; small shards go over theirs again. Shards start
  from the same parameters, beside each other, which are averaged after each round, weighted by
  tokens. More data means more shards, not longer ones. Averages are taken in a tree, sixteen to one.

Scoring runs windows over every text that overlap, so each token has context and is scored once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.llm import attention
from sigweave.llm.shared import stored
from sigweave.llm.tokens import RANKS, encoder, ids_of

#: Entries of the vocabulary with a meaning of their own; ids follow.
_END, _RARE, _FIRST = 0, 1, 2
#: At most so many words are broadcast with their counts.
FREQUENT = 1 << 17
#: Bytes of training texts per shard.
SHARD_BYTES = 12 << 20
#: Learning rate of each round, and the least steps of a shard in a round.
RATES = (0.03, 0.015)
STEPS = 600
_FLUSH = 400_000
_GROUP_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    """True if the id's text has a checksum of 2 mod 7; a null id teaches."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _ids(words: list[bytes], ranks: str) -> np.ndarray:
    line = b"".join(b" " + w for w in words).decode()
    return ids_of(line, ranks)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over a column `text`, counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(_words(text.as_py()))
                if len(seen) > _FLUSH:
                    yield _counted(seen)
                    seen.clear()
        if seen:
            yield _counted(seen)

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(seen: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(seen), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(seen.values(), pa.int64())], ["word", "c"])


def _frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """Words above the least count that leaves no more than `most` of them."""
    sizes = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.col("c").desc()).limit(most)
    total, least = 0, None
    for row in sizes.collect():
        total += row.n
        if total > most:
            break
        least = row.c
    if least is None:
        return {}
    return {r.word.encode(): r.c for r in counts.where(F.col("c") >= least).collect()}


def _subword_counts(counts: DataFrame, ranks: str) -> np.ndarray:
    """How often each id occurs in all texts that have these word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(encoder(ranks).n_vocab, np.int64)
        same = np.arange(len(total))
        for batch in batches:
            ids, size = _pieces(batch.column("word").cast(pa.binary()).to_pylist(), same, ranks)
            np.add.at(total, ids, np.repeat(batch.column("c").to_numpy(), size))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    out = np.zeros(encoder(ranks).n_vocab, np.int64)
    for r in counts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def vocabulary(counts: DataFrame, ends: int, ranks: str = RANKS) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary entry of each id, how often each entry occurs) in `ends` texts of these word counts."""
    ids = _subword_counts(counts, ranks)
    order = np.lexsort((np.arange(len(ids)), -ids))[: attention.VOCABULARY - _FIRST]
    place = np.full(len(ids), _RARE, np.int32)
    place[order] = np.arange(_FIRST, _FIRST + len(order))
    occur = np.zeros(attention.VOCABULARY, np.int64)
    occur[_END] = ends
    occur[_FIRST : _FIRST + len(order)] = ids[order]
    occur[_RARE] = ids.sum() - ids[order].sum()
    return place, occur


def _averaged(models: DataFrame) -> np.ndarray:
    """Mean of the parameter vectors, weighted by tokens, summed sixteen at a time."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in rows["sums"])
        return pd.DataFrame(
            {"shard": [int(rows["shard"].iloc[0]) >> 4], "weight": [rows["weight"].sum()], "sums": [total.tobytes()]}
        )

    while models.count() > 16:
        models = stored(models.groupBy(F.shiftright("shard", 4)).applyInPandas(add, models.schema))
    rows = models.collect()
    return (sum(np.frombuffer(r.sums, np.float64) for r in rows) / sum(r.weight for r in rows)).astype(np.float32)


def fit(
    texts: DataFrame,
    occur: np.ndarray,
    known,
    place: np.ndarray,
    ranks: str = RANKS,
    rates: tuple[float, ...] = RATES,
    steps: int = STEPS,
    shard_bytes: int = SHARD_BYTES,
) -> np.ndarray:
    """Flat parameters from all rows (id, text); `occur` and `place` as `vocabulary` gives them.

    No texts: a model that knows nothing but is a distribution all the same.
    """
    rows = texts.select(F.xxhash64("id", "text").alias("key"), "text")
    return learned(stored(coded(rows, known, place, ranks)), occur, rates, steps, shard_bytes)


def learned(
    rows: DataFrame,
    occur: np.ndarray,
    rates: tuple[float, ...] = RATES,
    steps: int = STEPS,
    shard_bytes: int = SHARD_BYTES,
) -> np.ndarray:
    """`fit` of rows (key, bytes, entries) as `coded` gives them; the key deals them to shards."""
    model = attention.flat(attention.initial(occur))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    if not total:
        return model
    shard = F.pmod("key", F.lit(-(-total // shard_bytes))).cast("long").alias("shard")
    context = rows.sparkSession.sparkContext
    for turn, rate in enumerate(rates):
        learn = _learning(context.broadcast(model), rate, steps, turn, len(rates))
        models = rows.select(shard, "entries").groupBy("shard").applyInPandas(learn, "shard long, weight double, sums binary")
        model = _averaged(stored(models))
    return model


_CODED = "bytes long, words long, known long, base double, other array<string>, entries binary"


def coded(rows: DataFrame, known, place: np.ndarray, ranks: str = RANKS) -> DataFrame:
    """`rows` with these columns in place of `text`: its bytes, number of words, number and base score of the frequent
    ones, all other words, and the text's vocabulary entries with its end, two bytes each."""
    at = rows.sparkSession.sparkContext.broadcast(place)
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k: _Known = known.value
        for batch in batches:
            for block in _blocks(batch, "text"):
                e = _encoded(block.column("text").to_pylist(), k, at.value, ranks)
                size, strange = e.size, e.number < 0
                ends = np.cumsum(np.bincount(e.text[strange], minlength=len(size)))
                stops = np.append(0, np.cumsum(e.lengths)) * 2
                data = pa.py_buffer(e.ids.astype(np.uint16).tobytes())
                new = [
                    pc.fill_null(pc.binary_length(block.column("text")), 0).cast(pa.int64()),
                    pa.array(size - 1),
                    pa.array(size - 1 - np.diff(ends, prepend=0)),
                    pa.array(np.bincount(e.text, np.where(strange, 0.0, k.logs[e.number]))),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(0, ends), pa.int32()), pa.array(e.other, pa.binary()).cast(pa.string())
                    ),
                    pa.Array.from_buffers(
                        pa.binary(), block.num_rows, [None, pa.py_buffer(stops.astype(np.int32).tobytes()), data]
                    ),
                ]
                names = [f.split()[0] for f in _CODED.split(", ")]
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in rest), *new], [*rest, *names])

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.mapInArrow(run, f"{kept}, {_CODED}")


def _learning(start, rate: float, steps: int, turn: int, turns: int):
    """For applyInPandas: the steps of a shard from the given parameters."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        # Rows come in any order; sorted, a rerun learns the same.
        texts = sorted(rows["entries"])
        ids = np.frombuffer(b"".join(texts), np.uint16).astype(np.int32)
        lengths = np.array([len(t) // 2 for t in texts])
        p = attention.train(attention.shaped(start.value), ids, lengths, _END, rate, steps, turn=turn, turns=turns)
        sums = attention.flat(p).astype(np.float64) * len(ids)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "weight": [float(len(ids))], "sums": [sums.tobytes()]})

    return learn


def _pieces(words: list[bytes], place: np.ndarray, ranks: str) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary entries of the words in a row, how many each has)."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    ids = _ids(words, ranks)
    opens = np.flatnonzero(_opening(ranks)[ids])
    if len(opens) == len(words) and opens[0] == 0:
        return place[ids], np.diff(np.append(opens, len(ids)))
    # Some word has a blank of its own, of another alphabet.
    parts = [place[_ids([w], ranks)] for w in words]
    return np.concatenate(parts), np.array([len(x) for x in parts])


@lru_cache(maxsize=2)
def _opening(ranks: str) -> np.ndarray:
    """Which ids begin with a blank, and so with a word."""
    enc = encoder(ranks)
    return np.array([enc.decode_single_token_bytes(i)[:1] == b" " for i in range(enc.n_vocab)])


@dataclass
class _Known:
    """Frequent words: their numbers, log probabilities, and vocabulary entries as ranges of `pool`."""

    number: dict[bytes, int]
    logs: np.ndarray
    first: np.ndarray
    size: np.ndarray
    pool: np.ndarray


def _known(counts: dict[bytes, int], totals: tuple[int, int], place: np.ndarray, ranks: str) -> _Known:
    words = list(counts)
    pool, size = _pieces(words, place, ranks)
    logs = np.log10((np.fromiter(counts.values(), np.float64, len(words)) + 1) / (sum(totals) + 1))
    # The last one is the end, whose share of the base score is added later.
    pool, size = np.append(pool, np.int32(_END)), np.append(size, 1)
    return _Known({w: i for i, w in enumerate(words)}, np.append(logs, 0.0), np.cumsum(size) - size, size, pool)


@dataclass
class _Encoded:
    """Texts in a row: numbers of their words (-1: not frequent), those words, words of each text with its end, ids, ids of each text."""

    number: np.ndarray
    text: np.ndarray
    other: list[bytes]
    size: np.ndarray
    ids: np.ndarray
    lengths: np.ndarray


def _encoded(texts: list[str | None], k: _Known, place: np.ndarray, ranks: str) -> _Encoded:
    words, size, number = [], [], []
    get, end = k.number.get, len(k.number)
    for text in texts:
        mine = _words(text)
        words += mine
        number += [get(w, -1) for w in mine]
        number.append(end)
        size.append(len(mine) + 1)
    number, size = np.array(number), np.array(size)
    text = np.repeat(np.arange(len(size)), size)
    strange = np.flatnonzero(number < 0)
    # A text's end is no word, so words before it are as many places further on.
    other = [words[i] for i in (strange - text[strange]).tolist()]
    pool, count = _pieces(other, place, ranks)
    first, length = k.first[number], k.size[number]
    first[strange] = len(k.pool) + np.cumsum(count) - count
    length[strange] = count
    total = np.cumsum(length)
    ids = np.concatenate((k.pool, pool))[np.arange(total[-1]) + np.repeat(first - total + length, length)]
    return _Encoded(number, text, other, size, ids, np.bincount(text, length).astype(np.int64))


def _scored(model, rare: float):
    """For mapInArrow: `score`, the model's, in place of the entries. An entry of `rare` ids gives each of them its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = attention.shaped(model.value)
        for batch in batches:
            for block in _blocks(batch, "entries"):
                entries = block.column("entries")
                lengths = pc.binary_length(entries).to_numpy().astype(np.int64) // 2
                ids = np.frombuffer(b"".join(entries.to_pylist()), np.uint16).astype(np.int32)
                unseen = np.bincount(np.repeat(np.arange(len(lengths)), lengths), ids == _RARE)
                score = attention.score(p, ids, lengths, _END) - unseen * np.log10(rare)
                rest = [c for c in block.schema.names if c != "entries"]
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in rest), pa.array(score)], [*rest, "score"])

    return run


def _blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `_GROUP_BYTES` in the column."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = (np.flatnonzero(np.diff(np.cumsum(size) // _GROUP_BYTES)) + 1).tolist()
    for a, b in zip([0, *cut], [*cut, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def scored(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = RANKS,
    frequent: int = FREQUENT,
    **training,
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null is an empty text: one token, the end. A null id teaches. Rows that repeat teach and are scored
    as often as they occur. If nothing teaches, all counts are 0 and the base score is that of an empty
    vocabulary. Other columns are ignored; empty input gives no rows. `training`: options of `fit`.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"),
        F.col(text_col).alias("text"),
    )
    teaching = rows.where("NOT held_out")
    counts = stored(word_counts(teaching.select("text")))
    ends = teaching.count()
    found = counts.agg(F.count("*"), F.sum("c")).first()
    n, v = (found[1] or 0) + ends, found[0] + (ends > 0)
    unknown = float(np.log10(1 / (n + v + 1)))
    end = float(np.log10((ends + 1) / (n + v + 1)))
    context = docs.sparkSession.sparkContext
    place, occur = vocabulary(counts, ends, ranks)
    known = context.broadcast(_known(_frequent(counts, frequent), (n, v), place, ranks))
    # Encoded once, for all rounds and for scoring. Written, so that the row number stays what it is.
    texts = stored(coded(rows, known, place, ranks).withColumn("row", F.monotonically_increasing_id()))
    model = learned(texts.where("NOT held_out"), occur, **training)
    rare = max(1, encoder(ranks).n_vocab - int((place != _RARE).sum()))
    out = texts.select("doc_id", "held_out", "row", "words", "known", "base", "entries")
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = stored(
        out.mapInArrow(
            _scored(context.broadcast(model), rare),
            f"doc_id {kind}, held_out boolean, row long, words long, known long, base double, score double",
        )
    )
    words = texts.select("row", F.explode("other").alias("word"))
    rest = words.join(counts, "word", "left").groupBy("row").agg(
        F.count("c").alias("known_too"),
        F.sum(F.coalesce(F.log10((F.col("c") + 1) / F.lit(float(n + v + 1))), F.lit(unknown))).alias("base_too"),
    )
    return out.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("known_too", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_too", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        "score",
    )
