"""Embedding near-duplicates within spherical k-means cells.

Equal vectors of one label are one class, found by a 128-bit fingerprint. Centroids come from a bounded sample of
classes (`SAMPLE_ROWS`); every class is then assigned: its home is the centroid of largest cosine, and it also visits
lower-numbered cells whose border with its home lies within reach of it, since a partner may be just across. Each pair
of a label thus meets in one cell at most: the lower home of the two. Cells are cut into blocks, and blocks compare by
one matrix product in double precision. A block gives each member its number of links and the least member that it is
connected to there; pairs themselves never leave it. Blocks' stars then join into components, whose least member is the
representative that is kept.

Reach: linked vectors lie within r = sqrt(2 - 2 cosine) of each other, so `reach=1` visits every cell in which a partner
can be (exact). Across a border only the part of the difference along its normal counts, about r / sqrt(d); the default
of 4 / sqrt(d) (at most 1) covers four times that.

Cases: vectors that are null, zero, of no length or hold null or non-finite components, and rows without a label, link with
nothing and are kept. Vectors of different lengths never link. Repeated rows count as vectors of their own. Rows without
a vec_id count as others' links but have no component of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import Scratch, cut
from comarca.llm.components import components

#: Classes, at most, that the centroids are fitted on.
SAMPLE_ROWS = 40_000
#: Classes that a cell holds on average, until there are MOST_CELLS cells (which bounds what every task gets).
CELL_ROWS = 2_000
MOST_CELLS = 8_192
BLOCK_ROWS = 2_048


def _vectors(batch: pa.ListArray) -> list[np.ndarray | None]:
    """Each usable vector as float64, null for the others."""
    flat = batch.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out, at = [], 0
    for n, valid in zip(batch.value_lengths().to_pylist(), batch.is_valid().to_pylist(), strict=True):
        v = flat[at : at + n] if valid else None
        at += n or 0
        out.append(v if v is not None and n and np.isfinite(v).all() and v.any() else None)
    return out


def _unit():
    @F.arrow_udf("struct<print: binary, unit: array<double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            prints, units = [], []
            for v in _vectors(batch):
                big = 1.0 if v is None else np.abs(v).max()
                prints.append(None if v is None else xxhash.xxh3_128_digest(v.tobytes()))
                units.append(None if v is None else (v / big) / np.linalg.norm(v / big))
            yield pa.StructArray.from_arrays([pa.array(prints, pa.binary()), pa.array(units, pa.list_(pa.float64()))], ["print", "unit"])

    return run


#: Vectors that meet the centroids in one product.
_STRIDE = 512


def spherical_kmeans(units: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centroids, at most `cells`."""
    centres = units[np.random.default_rng(seed).permutation(len(units))[:cells]]
    for _ in range(rounds):
        home = np.concatenate([np.argmax(units[at : at + _STRIDE] @ centres.T, axis=1) for at in range(0, len(units), _STRIDE)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
    return centres


def visited(units: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each unit vector, and which lower-numbered cells it visits besides."""
    near = units @ centres.T
    home = np.argmax(near, axis=1)
    gap = near[np.arange(len(near)), home][:, None] - near
    apart = np.sqrt(np.maximum(2 - 2 * centres[home] @ centres.T, 0))
    return home, (gap <= reach * apart) & (np.arange(len(centres)) < home[:, None])


def _cells(centres: np.ndarray, reach: float):
    @F.arrow_udf("struct<home: int, cells: array<int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            homes, cells = np.zeros(len(batch), np.int32), [[0]] * len(batch)
            fits = np.flatnonzero(batch.value_lengths().to_numpy() == centres.shape[1])  # others share cell 0, apart by their length
            for at in range(0, len(fits), _STRIDE):
                rows = fits[at : at + _STRIDE]
                home, beside = visited(batch.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1), centres, reach)
                homes[rows] = home
                for row, h, b in zip(rows, home, beside, strict=True):
                    cells[row] = [h, *np.flatnonzero(b)]
            yield pa.StructArray.from_arrays([pa.array(homes), pa.array(cells, pa.list_(pa.int32()))], ["home", "cells"])

    return run


def _links(cosine: float):
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("head", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        units = table.column("unit").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        node, copies, home, block = (table.column(c).to_numpy() for c in ("node", "copies", "at_home", "block"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        near = (units[a] @ units[b].T >= cosine) & (home[a][:, None] | home[b][None, :])
        if i == j:
            np.fill_diagonal(near, False)
        x, y = np.nonzero(near)
        if i == j:
            x, y = x[x < y], y[x < y]
        x, y = a[x], b[y]
        links, head = np.zeros(table.num_rows, np.int64), node.copy()
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        while True:
            before = head.copy()
            np.minimum.at(head, x, head[y])
            np.minimum.at(head, y, head[x])
            if (head == before).all():
                break
        some = links > 0
        return pa.Table.from_arrays([pa.array(c[some]) for c in (node, links, head)], schema=out)

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.93, reach: float | None = None, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. Rows of one label link at a cosine of at least `cosine`."""
    with Scratch(vectors.sparkSession, "near_vectors") as scratch:
        return cut(_near_vectors(vectors, cosine, reach, vec_id, vector, label, scratch))


def _near_vectors(vectors: DataFrame, cosine: float, reach: float | None, vec_id: str, vector: str, label: str, scratch: Scratch) -> DataFrame:
    rows = scratch.cut(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), _unit()(F.col(vector)).alias("x")).select("vec_id", "label", "x.*"))
    fit = rows.where(F.col("label").isNotNull() & F.col("print").isNotNull())
    # A class is numbered by its least vec_id; without any, by a hash below all ids.
    least = F.coalesce(F.min("vec_id"), F.shiftrightunsigned(F.xxhash64(F.first("print")), 2) - F.lit(1 << 62))
    classes = scratch.cut(fit.groupBy("label", "print").agg(least.alias("node"), F.count("*").alias("copies"), F.first("unit").alias("unit")))
    most = classes.groupBy(F.size("unit").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d, n = (most["d"], most["count"]) if most else (1, 0)
    whole = 1 << 20
    some = classes.where(F.size("unit") == d)
    if n > SAMPLE_ROWS:
        some = some.where(F.pmod(F.xxhash64("node"), F.lit(whole)) < int(whole * SAMPLE_ROWS / n))
    sample = some.select("unit").limit(SAMPLE_ROWS).toArrow().column("unit").combine_chunks().flatten().to_numpy().reshape(-1, d)
    cells = min(MOST_CELLS, max(1, n // CELL_ROWS), max(1, len(sample) // 4))
    centres = spherical_kmeans(sample, cells) if len(sample) else np.zeros((1, d))
    margin = np.sqrt(2 - 2 * cosine) * (min(1.0, 4 / np.sqrt(d)) if reach is None else reach) + 1e-9
    homed = classes.withColumn("c", _cells(centres, margin)("unit"))
    members = scratch.cut(homed.select("label", F.size("unit").alias("d"), F.explode("c.cells").alias("cell"), "c.home", "node", "copies", "unit").withColumn("at_home", F.col("cell") == F.col("home")).drop("home"))

    key = ["label", "d", "cell"]
    blocks = scratch.cut(members.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")))
    dealt = members.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.select(*key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "at_home", "unit")
    found = scratch.cut(tasks.groupBy(*key, "i", "j").applyInArrow(_links(cosine), "node long, links long, head long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where(F.col("node") != F.col("head")).select(F.col("node").alias("u"), F.col("head").alias("v")), scratch)
    of = classes.select("label", "print", "node", "copies").join(links, "node", "left").join(parts, "node", "left")
    of = scratch.cut(of.where((F.col("copies") > 1) | F.col("links").isNotNull()).select("label", "print", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")))
    out = rows.join(of, ["label", "print"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
