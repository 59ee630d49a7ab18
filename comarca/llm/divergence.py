"""Source divergence audit: how far the sources of a language differ in their terms, and by which terms.

Terms are counted by (language, source), and a language keeps those that enough of its documents hold. Kept terms with one and
the same sparse vector of source counts are one column with a multiplicity: every pair of sources is evaluated once for each
distinct vector, in dense blocks of vectors by sources, and weighted by the multiplicity. Only for the ranking of terms the
vectors go back to the terms: first the vectors' own best values set a floor for each group, then the terms above it are ranked.

All arithmetic is exact: shares are whole numbers of a billionth, from decimals in Spark and from integers in the tasks.

Memory and skew: a task counts its documents' terms and hands its counts on when it holds LIMIT of them; Spark combines them by
(language, source, term) before a term's vector is collected, which holds one entry for each source. The vectors of a language are
dealt out by their hash to as many groups as keep each below VECTORS; sources beyond BLOCK are compared block by block.
The result has a row for each pair of sources of a language, and at most `top` terms for each group.

Cases: a null text, lang or source is the empty string. Every row is a document, also one that shares its doc_id. Texts
without terms, and groups without kept terms, still give their group. A language that keeps no term has pairs of value 0 and no
terms; one source alone has no pairs. Ties go by the item's UTF-8. A very long text is one row, split whole. An empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.llm.common import Scratch, cut, small_batches

#: Counts that a task holds before it hands them on.
LIMIT = 400_000
#: Distinct vectors that meet the pairs of sources at once in a task, and rows of one dense block of them.
VECTORS, ROWS = 1000, 1024
#: Sources of a language that are compared in one block.
BLOCK = 512
#: ASCII letters in lower case, bytes of other characters as they are; all else separates terms.
_FOLDED = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
COUNTS = "lang string, source string, term binary, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
    occurs: dict[tuple, Counter] = {}
    holds: dict[tuple, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for group, counted in occurs.items():
            terms, docs = list(counted), holds[group]
            yield pa.record_batch([pa.array([group[0]] * len(terms)), pa.array([group[1]] * len(terms)), pa.array(terms, pa.binary()), pa.array(list(counted.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())], schema=kind)
        occurs.clear()
        holds.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            terms = text.translate(_FOLDED).split()
            if terms:
                occurs.setdefault((lang, source), Counter()).update(terms)
                holds.setdefault((lang, source), Counter()).update(set(terms))
        if sum(map(len, occurs.values())) > LIMIT:
            yield from flush()
    yield from flush()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n (its occurrences in the group) and docs (the group's documents that hold it)."""
    small_batches(docs.sparkSession)
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = docs.select(whole(lang).alias("lang"), whole(source).alias("source"), whole(text).cast("binary").alias("text")).mapInArrow(_count, COUNTS)
    return found.groupBy("lang", F.col("term").cast("string").alias("term"), "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column, smoothing: int, scale: int) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), exact."""
    exact = lambda c: c.cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", exact(count + smoothing) * F.lit(scale), exact(total + smoothing * terms))


def _pairs(smoothing: int, scale: int):
    """The differences of all pairs of the key's two blocks of sources, summed over the key's vectors."""
    kind = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def run(key: tuple, vectors: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("number")
        sources, block = groups["source"].combine_chunks(), groups["number"].to_numpy() // BLOCK
        first, second = np.flatnonzero(block == key[2].as_py()), np.flatnonzero(block == key[3].as_py())
        total = (groups["total"].to_numpy() + smoothing * groups["terms"].to_numpy()).astype(np.int64)
        values = np.zeros((len(first), len(second)), np.int64)
        for start in range(0, vectors.num_rows, ROWS):
            some = vectors.slice(start, ROWS)
            lists = some["at"].combine_chunks()
            row, flat = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
            at = pc.index_in(flat.field("source"), sources).fill_null(-1).to_numpy()
            counts = np.zeros((some.num_rows, len(sources)), np.int64)
            counts[row[at >= 0], at[at >= 0]] = flat.field("n").to_numpy()[at >= 0]
            counts += smoothing
            wide = counts.max(initial=0) > (2**63 - 1) // scale
            shares = 1 + ((counts.astype(object) * scale // total).astype(np.int64) if wide else counts * scale // total)
            times, right = some["times"].to_numpy(), shares[:, second]
            for k, s in enumerate(first):
                values[k] += times @ np.abs(shares[:, s : s + 1] - right)
        i, j = np.nonzero(first[:, None] < second[None, :])
        return pa.table([pa.array([key[0].as_py()] * len(i), pa.string()), sources.take(pa.array(first[i])), sources.take(pa.array(second[j])), pa.array(values[i, j])], schema=kind)

    return run


def divergence(docs: DataFrame, least_documents: int = 30, smoothing: int = 5, scale: int = 10**9, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: the summed differences of shares between source and the source `item` of the same lang. Part `term`: by how
    much the share of the term `item` in the group exceeds that in the whole lang, the `top` greatest.
    """
    with Scratch(docs.sparkSession, "divergence") as scratch:
        at = F.array_sort(F.collect_list(F.struct("source", "n")))
        of_term = term_counts(docs, lang, source, text).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), at.alias("at"))
        kept = scratch.cut(of_term.where(F.col("docs") >= least_documents).select("lang", "term", "at"))
        # A vector's number, once written, stands for it where it need not be known itself.
        vectors = scratch.cut(kept.groupBy("lang", "at").agg(F.count("*").alias("times")).withColumn("vector", F.monotonically_increasing_id()))

        whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        named = docs.select(whole(lang).alias("lang"), whole(source).alias("source")).distinct()
        entries = vectors.select("lang", "times", F.explode("at").alias("x"))
        totals = entries.groupBy("lang", F.col("x.source").alias("source")).agg(F.sum(F.col("x.n") * F.col("times")).alias("total"))
        of_lang = vectors.groupBy("lang").agg(F.sum("times").alias("terms"), F.count("*").alias("vectors"))
        zero = {"total": 0, "terms": 0, "vectors": 0}
        by_lang = Window.partitionBy("lang")  # a language's sources, whose pairs are the result
        groups = named.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(zero)
        groups = groups.withColumns({"of_lang": F.sum("total").over(by_lang), "number": F.row_number().over(by_lang.orderBy("source")) - 1, "sources": F.count("*").over(by_lang)})
        groups = scratch.cut(groups)

        parts = F.greatest(F.lit(1), F.ceil(F.col("vectors") / VECTORS)).cast("int")
        blocks = F.ceil(F.col("sources") / BLOCK).cast("int")
        over = groups.groupBy("lang").agg(F.max(parts).alias("parts"), F.max(blocks).alias("blocks"))
        one = lambda n: F.sequence(F.lit(0), n - 1)
        i_j = lambda n: F.flatten(F.transform(one(n), lambda i: F.transform(F.sequence(i, n - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
        dealt = vectors.join(over, "lang").select("lang", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int").alias("part"), F.explode(i_j(F.col("blocks"))).alias("ij"), "at", "times")
        mine = F.floor(F.col("number") / BLOCK).cast("int")
        shared = groups.withColumns({"parts": parts, "blocks": blocks}).withColumn("ij", F.explode(i_j(F.col("blocks")))).where((F.col("ij.i") == mine) | (F.col("ij.j") == mine))
        shared = shared.select("lang", F.explode(one(F.col("parts"))).alias("part"), "ij", "source", "number", "total", "terms")
        keyed = lambda df, *more: df.select("lang", "part", F.col("ij.i").alias("i"), F.col("ij.j").alias("j"), *more).groupBy("lang", "part", "i", "j")
        met = keyed(dealt, "at", "times").cogroup(keyed(shared, "source", "number", "total", "terms")).applyInArrow(_pairs(smoothing, scale), "lang string, a string, b string, value long")
        pairs = scratch.cut(met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
        both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(pairs.select("lang", F.col("b"), F.col("a"), "value"))

        own = vectors.select("lang", "vector", F.explode("at").alias("x"), F.aggregate("at", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("all"))
        own = own.select("lang", "vector", F.col("x.source").alias("source"), F.col("x.n").alias("n"), "all").join(groups, ["lang", "source"])
        share = lambda n, total: _share(F.col(n), F.col(total), F.col("terms"), smoothing, scale)
        own = own.withColumn("value", share("n", "total") - share("all", "of_lang")).where(F.col("value") > 0).select("lang", "source", "vector", "value")
        greatest = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        # As many vectors as ranks are at least as many terms: no term below the last of them has a rank.
        floors = own.withColumn("place", F.row_number().over(greatest)).where(F.col("place") <= top).groupBy("lang", "source").agg(F.min("value").alias("floor"))
        likely = own.join(floors, ["lang", "source"]).where(F.col("value") >= F.col("floor"))
        named_by = kept.join(vectors.select("lang", "at", "vector"), ["lang", "at"]).select("vector", "term")
        terms = likely.join(named_by, "vector").select("lang", "source", F.col("term").alias("item"), "value")

        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        told = lambda df, part: df.withColumn("rank", rank).select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
        return cut(told(both, "pair").unionByName(told(terms, "term").where(F.col("rank") <= top)))
