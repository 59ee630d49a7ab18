"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a seeded hash, are cut into blocks of `block_rows`: 16, or as many more as keep
the number of slots within `MOST_SLOTS`. With the target weight w of
its source, block i (from 0) is released at slot floor(i / w) and due by slot ceil((i + 1) / w); in each slot the released
block with the earliest deadline runs. On one stream of total weight 1 that meets every deadline, so after any number of
slots every source is less than one block away from its share.

Weights are exact: whole numbers in the proportions of the given ones, never rounded to a period. Once a source's share is
used up, the weights of the rest are scaled up, so nothing is dropped or repeated. With W the weights, N the sources' blocks
and v a clock that all sources share, source k is to have min(W_k * v, N_k) blocks, which add up to the slots so far; block
i of k therefore begins at the slot where v = i / W_k, in whole numbers, also across the ends of sources, and the bound of
one block holds from the first slot to the last. Slots are dealt out one after the other by a single task, which holds a
few numbers for each source and passes on one row for each block; documents are placed in parallel, with no global sort.

A document's number within its source is found without gathering the source: hash buckets are counted, counts are summed
up over the buckets, and rows are numbered within their bucket. A source that holds a third of all rows has as many
buckets as its rows ask for. The slots of a bucket's blocks come to its rows as one array, by the key that numbered them.

Cases: a null source is a source of its own. The hash is of the id and the other columns, so rows that share an id, or have
none, spread like others; equal rows are interchangeable. Texts are only hashed, however long. Sources without a target weight get the least positive one; with no weights at all, weights are the
square roots of the sources' sizes. An empty table gives an empty table. Columns named like the new ones are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping
from fractions import Fraction
from itertools import batched
from math import ceil, lcm, sqrt

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.files import shared_folder
from comarca.llm.common import cut

BLOCK_ROWS = 16
#: Slots, about, at most: beyond, blocks grow, for slots are dealt out one after the other.
MOST_SLOTS = 4_000_000
SEED = 17
#: Buckets whose counts are summed up in one step.
SPAN = 64
#: Rows of a bucket, about, at most.
BUCKET_ROWS = 4_096


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights, whose floats are taken as they are written: 0.3 is three tenths."""
    exact = {k: Fraction(str(w)) if isinstance(w, float) else Fraction(w) for k, w in weights.items()}
    unit = lcm(*[w.denominator for w in exact.values()])
    return {k: int(w * unit) for k, w in exact.items()}


def slots(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int]]:
    """(source, block) of each slot: earliest deadline first among released blocks; ties by name."""
    blocks = {k: n for k, n in blocks.items() if n > 0}
    w = whole_weights({k: weights[k] for k in blocks})
    # Sources by the end of their share on the common clock; before end p, `active` is the weight of those that go on and `over` the blocks of those that don't.
    ends = sorted(blocks, key=lambda k: (Fraction(blocks[k], w[k]), k))
    active, over = [sum(w.values())], [0]
    for k in ends:
        active.append(active[-1] - w[k])
        over.append(over[-1] + blocks[k])
    phase = dict.fromkeys(blocks, 0)

    def at(k: str, i: int) -> tuple[int, int]:
        """The slot, rounded down and up, by which source k is to have i blocks."""
        p = phase[k]
        later = lambda j: blocks[j] * w[k] >= i * w[j]
        if not later(ends[p]):
            p = phase[k] = bisect_left(ends, True, p, key=later)
        x = i * active[p] + over[p] * w[k]
        return x // w[k], -(-x // w[k])

    waiting = [(0, at(k, 1)[1], k, 0) for k in blocks]  # (release, deadline, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= slot:
            _, due, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, k, i))
        due, k, i = heapq.heappop(ready)
        assert slot < due, "a deadline was missed"
        yield k, i
        if i + 1 < blocks[k]:
            release = at(k, i + 1)[0]
            heapq.heappush(waiting, (release, at(k, i + 2)[1], k, i + 1))


def schedule(share: Mapping[str, int]) -> list[str]:
    """The source of each slot of a period in which every source runs its share."""
    return [k for k, _ in slots(share, share)]


def default_weights(sizes: Mapping[str, int]) -> dict[str, float]:
    return {k: sqrt(n) for k, n in sizes.items()}


def _slot_table(spark, blocks: Mapping[str, int], weights: Mapping[str, float]) -> DataFrame:
    """A row for each block with its slot, dealt out by one task."""
    kind = pa.schema([("__source", pa.string()), ("mix_block", pa.int64()), ("mix_slot", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                for some in batched(enumerate(slots(blocks, weights)), 10_000):
                    yield pa.record_batch([[k for _, (k, _) in some], [i for _, (_, i) in some], [s for s, _ in some]], schema=kind)

    return spark.range(0, 1, 1, 1).mapInArrow(run, "__source string, mix_block long, mix_slot long")


def row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row's columns; rows that share both are taken for equal, and so for interchangeable."""
    own = [F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t]
    return F.xxhash64(*own), F.hash(*own)


def _positions_path(docs: DataFrame) -> str:
    """A place in the shared folder that the rows of docs name, in any order and partitions."""
    a, b = row_keys(docs)
    r = docs.agg(F.count("*"), F.coalesce(F.bit_xor(a), F.lit(0)), F.coalesce(F.sum(b.cast("long")), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64(b, a)), F.lit(0))).first()
    named = hashlib.sha256(repr((docs.columns, *r)).encode()).hexdigest()[:32]
    return f"{shared_folder(docs.sparkSession).rstrip('/')}/tables/mix_positions-{named}"


def write_positions(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> None:
    """Write each row's mix_slot and mix_position beside docs, under its keys, for `with_positions` of the same rows."""
    a, b = row_keys(docs)
    keyed = docs.withColumns({"__a": a, "__b": b})
    rows = mixed(keyed, weights, **options).select("__a", "__b", "mix_slot", "mix_position")
    rows.write.mode("overwrite").parquet(_positions_path(docs))


def with_positions(docs: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """make(docs), a row for each row, with the mix_slot and mix_position written for docs; they are null if none were."""
    a, b = row_keys(docs)
    made = make(docs.withColumns({"__a": a, "__b": b}))
    columns = [c for c in made.columns if c not in ("__a", "__b", "mix_slot", "mix_position")]
    spark, path = docs.sparkSession, _positions_path(docs)
    try:
        held = spark.read.parquet(path)
    except AnalysisException:  # the rows were never mixed
        held = spark.createDataFrame([], "__a long, __b int, mix_slot long, mix_position long")
    # Equal rows are told apart by a number, so that each gets one position.
    number = lambda order: F.row_number().over(Window.partitionBy("__a", "__b").orderBy(order))
    held = held.withColumn("__number", number("mix_position"))
    numbered = made.select(*[F.col(f"`{c}`") for c in columns], "__a", "__b").withColumn("__number", number("__a"))
    return numbered.join(held, ["__a", "__b", "__number"], "left").select(*[F.col(f"`{c}`") for c in columns], "mix_slot", "mix_position")


def in_mix_order(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """docs, its own columns, in the order of the mix: partitions are ranges of positions, sorted."""
    rows = mixed(docs, weights, **options)
    return rows.repartitionByRange("mix_position").sortWithinPartitions("mix_position").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int | None = None, buckets: int | None = None, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """All columns of docs with mix_block (number in its source), mix_slot and mix_position (unique, in order of the mix; blocks leave gaps where they are short)."""
    spark = docs.sparkSession
    # The other columns only break ties of repeated ids; of texts the length and the first hash do.
    rest = [F.hash(F.col(f"`{c}`")) for c, t in docs.dtypes if not t.startswith("map") and c not in (doc_id, "__a", "__b")]
    key = F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    tie = F.xxhash64(*rest)
    rows = docs.withColumns({"__source": key, "__hash": F.xxhash64(F.col(doc_id), F.lit(SEED), tie), "__tie": tie})  # rows without an id spread too
    sizes = {r["__source"]: r["count"] for r in rows.groupBy("__source").count().collect()}  # one row for each source
    given = {("null" if k is None else f"={k}"): w for k, w in (weights or {}).items() if w > 0}
    target = {k: given.get(k, min(given.values())) for k in sizes} if given else default_weights(sizes)

    total = sum(sizes.values())
    block_rows = block_rows or max(BLOCK_ROWS, ceil(total / MOST_SLOTS))
    buckets = buckets or max(32 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_ROWS)
    per = max(1, total // buckets)
    of = spark.createDataFrame([(k, max(1, n // per)) for k, n in sizes.items()], "__source string, __n int")
    bucketed = rows.join(F.broadcast(of), "__source").withColumn("__bucket", F.pmod("__hash", F.col("__n")).cast("int")).drop("__n")
    counted = bucketed.groupBy("__source", "__bucket").agg(F.count("*").alias("__rows")).withColumn("__span", F.floor(F.col("__bucket") / SPAN))
    # Sums over the buckets before, in two steps: spans of buckets within their source, and buckets within their span.
    earlier = lambda key, order: Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    spans = counted.groupBy("__source", "__span").agg(F.sum("__rows").alias("__all")).withColumn("__above", F.coalesce(F.sum("__all").over(earlier(["__source"], "__span")), F.lit(0))).drop("__all")
    below = F.coalesce(F.sum("__rows").over(earlier(["__source", "__span"], "__bucket")), F.lit(0))
    offsets = counted.withColumn("__below", below).join(F.broadcast(spans), ["__source", "__span"])
    before = F.col("__below") + F.col("__above")
    first = lambda n: F.floor(n / block_rows)
    offsets = cut(offsets.select("__source", "__bucket", before.alias("__before"), F.explode(F.sequence(first(before), first(before + F.col("__rows") - 1))).alias("mix_block")))
    table = _slot_table(spark, {k: ceil(n / block_rows) for k, n in sizes.items()}, target)
    run = F.array_sort(F.collect_list(F.struct("mix_block", "mix_slot")))
    # Spark takes the table, made from one row, for small; it grows with the documents, so it must not be broadcast.
    dealt = offsets.join(table.hint("merge"), ["__source", "mix_block"]).groupBy("__source", "__bucket", "__before").agg(F.transform(run, lambda x: x["mix_slot"]).alias("__slots"))

    within = Window.partitionBy("__source", "__bucket").orderBy("__hash", F.col(doc_id), "__tie")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("mix_block", "mix_slot", "mix_position")]
    numbered = bucketed.withColumn("__at", F.row_number().over(within) - 1).select(*kept, "__source", "__bucket", "__at").join(dealt, ["__source", "__bucket"])
    number = F.col("__at") + F.col("__before")
    slot = F.element_at("__slots", (first(number) - first(F.col("__before")) + 1).cast("int"))
    return numbered.select(*kept, first(number).alias("mix_block"), slot.alias("mix_slot"), (slot * block_rows + number % block_rows).alias("mix_position"))
