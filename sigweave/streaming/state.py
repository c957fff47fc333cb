"""State of a job as tables of changes in its checkpoint folder.

A step writes the rows it changed, no more. Changes lie in a ring of slots; every so many steps what
they say is put together, so a reader needs the last whole table and the few changes after it. A step that
is repeated finds what its predecessors wrote untouched and overwrites its own slot. Slots are used again only
when what they held has been put together twice, so there is a bounded number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigweave.sources.paths import path_of


class Changes:
    """Rows written step by step, from number 1 on, and put together every `every` steps."""

    def __init__(self, folder: str, schema: T.StructType, every: int):
        self.folder, self.every = folder, every
        self.schema = T.StructType(schema.fields + [T.StructField("_seq", T.LongType())])

    def write(self, rows: DataFrame, seq: int) -> None:
        names = self.schema.names[:-1]
        numbered = rows.select(*names, F.lit(seq).cast("long").alias("_seq"))
        numbered.write.mode("overwrite").parquet(f"{self.folder}/change/slot={seq % (2 * self.every)}")

    def between(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """Rows of the steps after one up to another, at most twice `every` of them."""
        slots = [f"{self.folder}/change/slot={k % (2 * self.every)}" for k in range(after + 1, upto + 1)]
        if not slots:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", f"{self.folder}/change").parquet(*slots)
        return rows.select(*self.schema.names).where(F.col("_seq").between(after + 1, upto))

    def whole(self, seq: int) -> int:
        """The last step at or before `seq` after which changes were put together; 0 if there is none."""
        return seq - seq % self.every


class KeyedState:
    """The newest row of each key. A row with `gone` set takes its key away."""

    def __init__(self, folder: str, key: list[str], schema: T.StructType, every: int = 16):
        self.folder, self.key, self.names = folder, key, schema.names
        with_mark = T.StructType(schema.fields + [T.StructField("gone", T.BooleanType())])
        self.changes = Changes(folder, with_mark, every)

    def _snapshot(self, seq: int) -> str:
        return f"{self.folder}/whole/slot={seq // self.changes.every % 2}"

    def _merged(self, spark: SparkSession, base: int, upto: int, keys: DataFrame | None = None) -> DataFrame:
        rows = self.changes.between(spark, base, upto)
        if base:
            whole = spark.read.schema(self.changes.schema).parquet(self._snapshot(base))
            rows = rows.unionByName(whole.where(F.col("_seq") == base))
        if keys is not None:
            rows = rows.join(keys.distinct(), self.key, "left_semi")
        rest = [n for n in self.names if n not in self.key]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest, "gone"), "_seq").alias("s"))
        return newest.where("NOT s.gone").select(*self.key, *[F.col("s")[n].alias(n) for n in rest]).select(*self.names)

    def load(self, spark: SparkSession, seq: int, keys: DataFrame | None = None) -> DataFrame:
        """The state after step `seq`; with `keys`, of those keys only, found before anything is shuffled."""
        return self._merged(spark, self.changes.whole(seq), seq, keys)

    def save(self, changed: DataFrame, seq: int, alive: Column | None = None) -> None:
        """Writes the rows that step `seq` changed. When changes are put together, rows that are not
        `alive` any more are left out."""
        spark = changed.sparkSession
        if "gone" not in changed.columns:
            changed = changed.withColumn("gone", F.lit(False))
        self.changes.write(changed, seq)
        if seq % self.changes.every == 0:
            rows = self._merged(spark, seq - self.changes.every, seq)
            if alive is not None:
                rows = rows.where(alive)
            marked = rows.select("*", F.lit(False).alias("gone"), F.lit(seq).cast("long").alias("_seq"))
            marked.write.mode("overwrite").parquet(self._snapshot(seq))


class SentKeys:
    """Keys that were sent, by spans of event time; a span is dropped whole once nothing can fall into it."""

    _SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("span", T.LongType())])

    def __init__(self, folder: str, every: int = 16):
        self.folder = f"{folder}/spans"
        self.changes = Changes(folder, self._SCHEMA, every)

    def load(self, spark: SparkSession, seq: int, first_span: int) -> DataFrame:
        """(key, span) of all keys sent up to step `seq` in spans from the first one on."""
        base = self.changes.whole(seq)
        rows = self.changes.between(spark, base, seq).select("key", "span")
        if base:
            old = spark.read.schema("key string, span long, upto long").parquet(self.folder)
            rows = rows.unionByName(old.where(F.col("upto") <= base).select("key", "span"))
        return rows.where(F.col("span") >= first_span)

    def save(self, sent: DataFrame, seq: int, first_span: int) -> None:
        """Notes the keys that step `seq` sent, and drops the spans before the first one."""
        spark = sent.sparkSession
        self.changes.write(sent, seq)
        if seq % self.changes.every:
            return
        rows = self.changes.between(spark, seq - self.changes.every, seq).select("key", "span")
        rows = rows.where(F.col("span") >= first_span).withColumn("upto", F.lit(seq).cast("long"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("span", "upto").parquet(self.folder)
        folder, system = path_of(spark, self.folder)
        for status in system.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("span=") and int(name[5:]) < first_span:
                system.delete(status.getPath(), True)
