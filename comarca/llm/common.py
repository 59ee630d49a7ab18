"""What the operators of this subpackage share: table reads and the shared folder for written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.files import delete, shared_folder

#: Documents are cut to Arrow batches of this many rows; a batch is what a Python worker holds at once.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch: texts vary from a word to hundreds of thousands of characters.

    Plans are lazy and run later, so the bound is only ever lowered: no operator takes back what another one needs.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, for frames that the caller's result reads.

    Its files stay until the session's cleaner takes them, which spark.cleaner.referenceTracking.cleanCheckpoints turns on.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh place for a written table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables in the shared folder that an operator writes, reads again and deletes: at the end, or as soon as it may.

    While it is open, Spark frees the shuffle files of a finished job at once, as nothing reads them again. Frames made
    from its tables must be written or checkpointed before it closes.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.places = spark, new_path(spark, name), {}

    def __enter__(self) -> Scratch:
        self.before = self.spark.conf.get(self.CLEANUP)
        self.spark.conf.set(self.CLEANUP, "true")
        return self

    def __exit__(self, *_) -> None:
        self.spark.conf.set(self.CLEANUP, self.before)
        delete(self.spark, self.folder)

    def cut(self, df: DataFrame) -> DataFrame:
        """df, written and read back."""
        place = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(place)
        out = self.spark.read.schema(df.schema).parquet(place)
        self.places[id(out)] = place
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for frame in frames:
            delete(self.spark, self.places.pop(id(frame)))


#: Words of 64 bits in an id filter, at most, however many ids go in: a broadcast of half a million small rows.
FILTER_WORDS = 1 << 19


def with_maybe(rows: DataFrame, row_id: str, ids: DataFrame, column: str, into: str = "__maybe") -> DataFrame:
    """rows with a boolean that holds where the row's id is among ids (longs), and for few other rows.

    A Bloom filter of one hash and a fixed size, broadcast as the words that have a bit set. It spares the shuffle the rows that
    an exact join would drop anyhow; beyond some tens of millions of ids it lets more and more of them pass, which costs time
    and never changes a result.
    """
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(FILTER_WORDS * 64))
    word = lambda c: F.shiftright(place(c), 6)
    bit = lambda c: F.pmod(place(c), F.lit(64)).cast("int")
    bits = ids.where(F.col(column).isNotNull()).groupBy(word(column).alias("__word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(column))).alias("__bits"))
    joined = rows.withColumn("__at", word(row_id)).join(F.broadcast(bits), F.col("__at") == F.col("__word"), "left")
    held = F.call_function("shiftright", F.col("__bits"), bit(row_id)).bitwiseAND(F.lit(1).cast("long")) == 1
    return joined.withColumn(into, F.coalesce(held, F.lit(False))).drop("__at", "__word", "__bits")


class Memo:
    """A bounded memo of two generations: once the young one is full it turns old, and what is still used comes back."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most // 2, {}, {}

    def get(self, keys: set, learn) -> dict:
        """The entries of keys, in a dictionary of their own; learn gives those of a list of keys that have none yet."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        out = dict(zip(keys, map(self.young.get, keys), strict=True))
        absent = [k for k, held in out.items() if held is None]
        if self.old and absent:
            back = dict(zip(absent, map(self.old.get, absent), strict=True))
            absent = [k for k, held in back.items() if held is None]
            out.update(back)
            self.young.update((k, held) for k, held in back.items() if held is not None)
        if absent:
            new = dict(zip(absent, learn(absent), strict=True))
            out.update(new)
            self.young.update(new)
        return out
