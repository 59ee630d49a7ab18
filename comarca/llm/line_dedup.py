"""Line dedup: lines that several documents hold stay in one of them.

Lines are exploded and normalised (white space at both ends stripped, A-Z lower-cased) and hashed to two longs; the distinct
documents of each hash are counted, in two steps that both combine before they shuffle. Lines whose hash is in enough documents
are dropped, but for those of the first document that holds it; the positions of a text's dropped lines meet it again, and it is
put together without them. Only hashes, ids and positions move for the count; texts move once, to meet their positions. The
thousand hashes of the most documents are broadcast to where their lines lie, so a line that a third of all documents hold never
meets in one task; all other hashes are joined by a shuffle.

Cases: a null or empty text is one empty line. Short keys are never dropped. Rows that share a doc_id are one document; rows
without one are one document that comes after all others. Repeated rows lose the same lines. A text that loses every line is
the empty text. A very long text is one row, whose positions are a list of its own lines. An empty table gives an empty table.
Extra columns stay as they are, whatever their names, but for one named like the new column, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import Scratch, cut, small_batches

#: Hashes that are broadcast, those of the most documents; every other one has less than a thousandth of all rows.
HOT = 1000

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "struct<n_lines:bigint,n_dropped:bigint,kept:string>"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hashes(value: Column) -> tuple[Column, Column]:
    """Two hashes that start from different seeds."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _lines(docs: DataFrame, doc_id: str, text: str, least_length: int) -> DataFrame:
    """__id, __t1, __t2 (the text's hashes), __pos, __h1, __h2 of each line that may be dropped."""
    (t1, t2), whole = hashes(F.col(text)), F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("__id"), t1.alias("__t1"), t2.alias("__t2"), F.posexplode(F.split(whole, "\n")).alias("__pos", "__line"))
    rows = rows.select("__id", "__t1", "__t2", "__pos", line_key(F.col("__line")).alias("__key")).where(F.length("__key") >= least_length)
    h1, h2 = hashes(F.col("__key"))
    return rows.select("__id", "__t1", "__t2", "__pos", h1.alias("__h1"), h2.alias("__h2"))


def dropped_positions(docs: DataFrame, doc_id: str, text: str, least_length: int, least_documents: int) -> DataFrame:
    """__id, __t1, __t2 and __drop, the positions of the lines which that text in that document loses."""
    with Scratch(docs.sparkSession, "line_dedup") as scratch:
        lines = scratch.cut(_lines(docs, doc_id, text, least_length))
        # min passes over null ids: a line that only rows without an id hold has no holder, and all of them keep it.
        counted = lines.groupBy("__h1", "__h2").agg(F.count_distinct(F.struct("__id")).alias("__docs"), F.min("__id").alias("__holder"))
        shared = scratch.cut(counted.where(F.col("__docs") >= least_documents))
        # Lines of the most documents, HOT rows at most, meet their rows where those lie; of the others none has more than that share.
        hot = F.broadcast(shared.orderBy(F.col("__docs").desc(), "__h1", "__h2").limit(HOT).drop("__docs"))
        keys = ["__h1", "__h2"]
        rest = lines.join(hot.select(*keys), keys, "left_anti").join(shared.drop("__docs"), keys)
        lost = rest.unionByName(lines.join(hot, keys)).where(~F.col("__id").eqNullSafe(F.col("__holder")))
        return cut(lost.groupBy("__id", "__t1", "__t2").agg(F.collect_set("__pos").alias("__drop")))


def _reassembled(text: Column, drop: Column) -> Column:
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            n_lines, n_dropped, kept = [], [], []
            for whole, positions in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
                whole = whole or ""
                n_lines.append(whole.count("\n") + 1)
                n_dropped.append(len(positions or ()))
                if positions:
                    gone = set(positions)
                    whole = "\n".join([line for k, line in enumerate(whole.split("\n")) if k not in gone])
                kept.append(whole)
            yield pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept"])

    return run(text, drop)


def without_repeated_lines(docs: DataFrame, least_length: int = 10, least_documents: int = 2, doc_id: str = "doc_id", text: str = "text", into: str = "lines") -> DataFrame:
    """All columns of docs, and the struct column `into`: n_lines, n_dropped and kept, the text without its dropped lines."""
    small_batches(docs.sparkSession)
    lost = dropped_positions(docs, doc_id, text, least_length, least_documents)
    t1, t2 = hashes(F.col(f"`{text}`"))
    at = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & t1.eqNullSafe(F.col("__t1")) & t2.eqNullSafe(F.col("__t2"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.join(lost, at, "left").select(*kept, _reassembled(F.col(f"`{text}`"), F.col("__drop")).alias(into))
