"""MinHash near-duplicates by a signature-coordinate inverted join.

Documents of one shingle set are one class, found by a 128-bit fingerprint of the set; classes do the rest. A class posts
itself under each (coordinate, value) of its MinHash signature. Pairs count whose signatures agree in at least
`matches` of the `COORDINATES` coordinates. Two such classes share one of the COORDINATES - matches + 1 rarest values
of either (prefix), so only those are posted, and values that no other class has are not posted at all: a class with too
many of them is skipped altogether. Collisions of the pairs found are then counted on the signatures, and the pairs that
are retained are confirmed on the full sets. The default least number of matches loses a pair at the threshold with a
probability of about 1e-9 (six standard deviations).

A list of postings is compared in rounds. First every member with the list's head, the member with most shared values: that
settles groups of copies, however large, in as many pairs as they have members. Then, where members are still in
different components, those outside the largest are compared with those in it and with each other: in short lists pair by pair, in long ones (more than
`SHORT_LIST` members) block by block, where a task holds two blocks and gives the least member that each of
theirs is connected to, never the pairs: first by signatures, and then, of members that signatures connect with another
component, by full sets. Blocks of the component meet those outside it, never each other. Members of one
component need no further link, so no group is ever expanded into all its pairs, and no pair of different components goes
unseen. Nothing is capped. Pairs of blocks grow with the square of a group; they are dealt over waves, so that disk does not.

Texts are read where they lie: once for the signatures, twice in each of two rounds of pairs (a text goes to the texts that
it is paired with, which takes less room than sets), and once for the blocks' sets. A filter of the wanted ids, of a fixed
size, keeps the other texts out of these shuffles.

Cases: documents without words (or null) have an empty set and link with nothing. Documents with fewer words than a
shingle have their whole sequence as one. Rows that share a doc_id count as one document. Rows without a doc_id have no
component and are kept. Repeated rows each get their row. Very long texts are taken whole: a task holds the hashes of one
batch of texts. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import Scratch, cut, small_batches, with_maybe
from comarca.llm.components import components

COORDINATES = 48
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LINE = np.random.default_rng(20240501)
_A = _LINE.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _LINE.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
#: Lists up to this length are compared pair by pair, which gives so many pairs for each of their members at most.
SHORT_LIST = 16
#: Shingles that a block of sets holds on average.
BLOCK_SHINGLES = 150_000
#: Signatures that a block of signatures holds on average.
BLOCK_SIGNATURES = 16_384
#: A wave of block pairs moves so many times what the members hold, or what so many blocks hold if that is more.
WAVE, WAVE_BLOCKS = 2, 32
#: Hashes that go through the signature's arithmetic at a time.
_STRIDE = 1 << 16


def least_matches(threshold: float, coordinates: int = COORDINATES) -> int:
    """Six and a half standard deviations below the matches expected at the threshold."""
    return max(1, int(np.floor(coordinates * threshold - 6.5 * np.sqrt(coordinates * threshold * (1 - threshold)))) + 1)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, min(size, len(w)), np.uint64)
    for k in range(min(size, len(w))):
        h = (h + w[k : k + n]) * _STEP
        h ^= h >> np.uint64(29)
    h *= _MIX
    return np.unique(h ^ (h >> np.uint64(32)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signature of each (non-empty) set, uint32."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    at = 0
    while at < len(sets):
        end, n = at, 0
        while end < len(sets) and (end == at or n + len(sets[end]) <= _STRIDE):
            n += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.r_[0, np.cumsum([len(s) for s in sets[at : end - 1]])].astype(np.int64)
        for c in range(COORDINATES):
            out[at:end, c] = np.minimum.reduceat((flat * _A[c] + _B[c]) >> np.uint64(32), starts)
        at = end
    return out


def _sketch(size: int):
    @F.arrow_udf("struct<n: long, print: binary, signature: array<int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [shingle_hashes(t, size) for t in batch.to_pylist()]
            full = [s for s in sets if len(s)]
            made = signatures(full).view(np.int32)
            rows = np.cumsum([len(s) > 0 for s in sets]) - 1
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([COORDINATES * (len(s) > 0) for s in sets], out=offsets[1:])
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            assert len(rows) == len(sets)
            yield pa.StructArray.from_arrays([pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel(), pa.int32()))], ["n", "print", "signature"])

    return run


def _set(size: int):
    @F.arrow_udf("array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [shingle_hashes(t, size).view(np.int64) for t in batch.to_pylist()]
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(s) for s in sets], out=offsets[1:])
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))

    return run


def _prefixes(classes: DataFrame, matches: int, scratch: Scratch) -> DataFrame:
    """Postings (value, node, n) of each class's rarest values."""
    value = lambda i, x: i.cast("long") * F.lit(1 << 32) + x.cast("long")
    posts = classes.select("node", "n", F.explode(F.transform("signature", lambda x, i: value(i, x))).alias("value"))
    shared = scratch.cut(posts.groupBy("value").agg(F.count("*").alias("seen")).where(F.col("seen") > 1))
    # Most values that nobody shares stay where they are; the others go to their value, and single rows from there to their node.
    met = with_maybe(posts, "value", shared, "value").where("__maybe").drop("__maybe").join(shared, "value").repartition("node")
    ranked = met.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("seen", "value"))).alias("values"), F.count("*").alias("held"))
    # Of the rarest COORDINATES - matches + 1 values, those that nobody shares come first.
    left = F.size("values") - F.lit(matches - 1)
    return ranked.where(left > 0).select("node", "n", "held", F.explode(F.slice("values", F.lit(1), left)).alias("x")).select("x.value", "node", "n", "held")


def _pairs(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of nodes that meet under a value and whose sizes allow the threshold."""
    met = left.select("value", F.col("node").alias("a"), F.col("n").alias("na"), F.col("part").alias("pa")).join(right.select("value", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("part").alias("pb")), "value")
    met = met.where((F.col("a") != F.col("b")) & (F.col("pa") != F.col("pb")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _heads(posts: DataFrame, scratch: Scratch) -> DataFrame:
    """Of each list the member with most shared values."""
    head = F.max(F.struct("held", -F.col("node"), "n", "part")).alias("x")
    return scratch.cut(posts.groupBy("value").agg(head).select("value", (-F.col("x.col2")).alias("node"), "x.n", "x.part"))


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not (a and b):
        return out
    of = [np.concatenate(x) for x in (a, b)]
    shared = np.intersect1d(np.unique(of[0]), np.unique(of[1]), assume_unique=True)
    where = []
    for x, flat in zip((a, b), of, strict=True):
        row, at = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.searchsorted(shared, flat)
        at[at == len(shared)] = 0
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        row, at = row[hit], at[hit]
        order = np.argsort(at, kind="stable")
        where.append((row[order], at[order]))
    for low in range(0, len(shared), 4096):
        wide = min(4096, len(shared) - low)
        sides = []
        for (row, at), n in zip(where, (len(a), len(b)), strict=True):
            i, j = np.searchsorted(at, [low, low + wide])
            m = np.zeros((n, wide), np.float32)
            m[row[i:j], at[i:j] - low] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _heads_of(node: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least node that each row is connected to by links between rows x and y."""
    head = node.copy()
    while True:
        before = head.copy()
        np.minimum.at(head, x, head[y])
        np.minimum.at(head, y, head[x])
        if (head == before).all():
            return head


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks that meet. Block i lies outside; block j outside too, or inside."""
    inside, block = (table.column(c).to_numpy() for c in ("inside", "block"))
    i, j, within = (table.column(c)[0].as_py() for c in ("i", "j", "within"))
    return np.flatnonzero((block == i) & ~inside), np.flatnonzero((block == j) & (inside == within))


def _moved(node: np.ndarray, head: np.ndarray) -> pa.Table:
    moved = head != node
    return pa.Table.from_arrays([pa.array(node[moved]), pa.array(head[moved])], schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def _alike(matches: int, percent: int):
    """Links between members of different components whose signatures and sizes allow the threshold."""

    def run(table: pa.Table) -> pa.Table:
        node, n, part = (table.column(c).to_numpy() for c in ("node", "n", "part"))
        made = table.column("signature").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        a, b = _sides(table)
        of_b, links = np.ascontiguousarray(made[b].T), [np.zeros((2, 0), np.int64)]
        for at in range(0, len(a), 256):  # a few rows at a time, and of their links only what joins them
            rows = a[at : at + 256]
            same = np.zeros((len(rows), len(b)), np.uint8)
            for c in range(made.shape[1]):
                same += made[rows, c][:, None] == of_b[c]
            low, high = np.minimum(n[rows][:, None], n[b]), np.maximum(n[rows][:, None], n[b])
            x, y = np.nonzero((same >= matches) & (low * 100 >= high * percent) & (part[rows][:, None] != part[b]))
            head = _heads_of(row := np.arange(len(node)), rows[x], b[y])
            links.append(np.stack([row[head != row], head[head != row]]))
        x, y = np.concatenate(links, axis=1)
        return _moved(node, _heads_of(node, x, y))

    return run


def _blocks(percent: int):
    """Links confirmed on the full sets."""

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        column = table.column("set").combine_chunks()
        flat, ends = column.flatten().to_numpy(), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
        sets = [flat[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
        n = np.diff(ends).astype(np.float32)
        a, b = _sides(table)
        common = _common([sets[k] for k in a], [sets[k] for k in b])
        near = common * 100 >= (n[a][:, None] + n[b][None, :] - common) * percent
        x, y = np.nonzero(near & (node[a][:, None] != node[b][None, :]))
        return _moved(node, _heads_of(node, a[x], b[y]))

    return run


def _near(size: int, percent: int):
    """Whether two texts link. Rows come by their second text, whose set is kept for the next row."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, held = None, np.zeros(0, np.uint64)
        for left, right in batches:
            out = []
            for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True):
                if y != last:
                    last, held = y, shingle_hashes(y, size)
                own = shingle_hashes(x, size)
                common = len(np.intersect1d(own, held, assume_unique=True))
                out.append(common > 0 and common * 100 >= (len(own) + len(held) - common) * percent)
            yield pa.array(out, pa.bool_())

    return run


def _compared(members: DataFrame, weight: str, most: int, payload: DataFrame, run, scratch: Scratch) -> DataFrame:
    """Edges (u, v) that run finds between the blocks of each group: blocks outside meet each other and those inside.

    members: group, node, inside and weight; most: the weight of a block; payload: what a task needs of each node. A node
    goes to as many tasks as its group has blocks, so the tasks are dealt over waves, each of which moves about
    WAVE times the members' weight, and whose shuffle is gone when the next one begins.
    """
    n = F.ceil(F.sum(weight) / most).cast("int").alias("blocks")
    blocks = scratch.cut(members.groupBy("group", "inside").agg(n, F.sum(weight).alias("weight")))
    dealt = members.select("group", "inside", "node").join(blocks.drop("weight"), ["group", "inside"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A block outside meets the blocks outside from its own on, and all inside.
    out_blocks = blocks.where(~F.col("inside")).select("group", F.col("blocks").alias("out"), F.col("weight").alias("w_out"))
    in_blocks = blocks.where(F.col("inside")).select("group", F.col("blocks").alias("in"), F.col("weight").alias("w_in"))
    sides = out_blocks.join(in_blocks, "group")
    moved = F.sum(F.col("w_out") * (F.col("out") + F.col("in")) + F.col("w_in") * F.col("out"))
    total = sides.agg(moved.alias("moved"), F.sum(F.col("w_out") + F.col("w_in")).alias("held")).first()
    waves = 1 + int((total["moved"] or 0) // (WAVE * max(total["held"] or 0, WAVE_BLOCKS * most)))
    dealt = dealt.drop("blocks").join(sides.select("group", "out", "in"), "group")
    task = lambda i, j, within: F.struct(i.alias("i"), j.alias("j"), F.lit(within).alias("within"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.col("block")
    beside = F.concat(F.transform(upto("out"), lambda k: task(F.least(own, k), F.greatest(own, k), False)), F.transform(upto("in"), lambda k: task(own, k, True)))
    meets = F.when(F.col("inside"), F.transform(upto("out"), lambda k: task(k, own, True))).otherwise(beside)
    payload = payload.withColumnRenamed("node", "__node")

    def wave(k: int) -> DataFrame:
        mine = F.filter(meets, lambda x: F.pmod(F.xxhash64("group", x["i"], x["j"], x["within"]), F.lit(waves)) == k)
        tasks = dealt.withColumn("task", F.explode(mine)).select("group", "task.*", "block", "node", "inside")
        return tasks.join(payload, F.col("node") == F.col("__node")).drop("__node").groupBy("group", "i", "j", "within").applyInArrow(run, "u long, v long")

    return reduce(DataFrame.unionByName, (scratch.cut(wave(k)) for k in range(waves)))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, matches: int | None = None, short_list: int = SHORT_LIST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept. Documents link at 100 * intersection >= percent * union."""
    with Scratch(docs.sparkSession, "near_duplicates") as scratch:
        return _near_duplicates(docs, size, percent, matches or least_matches(percent / 100), short_list, doc_id, text, scratch)


def _near_duplicates(docs: DataFrame, size: int, percent: int, matches: int, short_list: int, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = scratch.cut(rows.select("doc_id", _sketch(size)("text").alias("s")).select("doc_id", "s.*"))
    classes = scratch.cut(sketch.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.count("*").alias("copies")))
    posts = scratch.cut(_prefixes(classes, matches, scratch).withColumn("part", F.col("node")))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs that collide in enough coordinates; of the signatures, only those of pairs move."""
        met = scratch.cut(pairs)
        some = with_maybe(classes, "node", ends(met), "node").where("__maybe")
        side = lambda x: some.select(F.col("node").alias(x), F.col("signature").alias(f"s{x}"))
        same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        found = scratch.cut(met.join(side("a"), "a").join(side("b"), "b").where(same >= matches).select("a", "b"))
        scratch.drop(met)
        return found

    def texts(wanted: DataFrame) -> DataFrame:
        """doc_id and text of the nodes in wanted, which alone move."""
        some = with_maybe(rows, "doc_id", wanted, "node").where("__maybe").drop("__maybe")
        return some.join(wanted.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs that link by their full sets. A text goes to each node that it is paired with and that has more pairs, and no set moves."""
        seen = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("pairs"))
        side = lambda x: seen.select(F.col("node").alias(x), F.struct("pairs", "node").alias(f"of_{x}"))
        ranked = pairs.join(side("a"), "a").join(side("b"), "b")
        far, hub = F.least("of_a", "of_b")["node"].alias("far"), F.greatest("of_a", "of_b")["node"].alias("hub")
        stars = scratch.cut(ranked.select(far, hub))
        nodes = lambda x: scratch.cut(stars.select(F.col(x).alias("node")).distinct())
        fars, hubs = nodes("far"), nodes("hub")
        left = texts(fars).join(stars, F.col("doc_id") == F.col("far")).select("far", "hub", F.col("text").alias("left"))
        both = left.join(texts(hubs).select(F.col("doc_id").alias("hub"), F.col("text").alias("right")), "hub")
        found = scratch.cut(both.where(_near(size, percent)("left", "right")).select(F.col("far").alias("u"), F.col("hub").alias("v")))
        scratch.drop(stars, fars, hubs)
        return found

    def parted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members in the largest component of lists that hold several, and those outside it."""
        parts = components(edges, scratch)
        now = scratch.cut(posts.drop("part").join(parts.select("node", F.col("component").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node")))
        counted = now.groupBy("value", "part").agg(F.count("*").alias("members"))
        mixed = scratch.cut(counted.groupBy("value").agg(F.count("*").alias("parts"), F.sum("members").alias("length"), F.max(F.struct("members", "part"))["part"].alias("first")).where(F.col("parts") > 1).select("value", "length", "first"))
        open_ = scratch.cut(now.join(mixed, "value"))
        scratch.drop(now, mixed)
        return open_.where(F.col("part") == F.col("first")), open_.where(F.col("part") != F.col("first"))

    heads = _heads(posts, scratch)
    pairs = near(_pairs(posts, heads, percent))
    edges = confirmed(pairs)

    inside, outside = parted(edges)
    scratch.drop(posts, heads, pairs)
    short = F.col("length") <= short_list
    pairs = near(_pairs(outside.where(short), inside.where(short), percent).unionByName(_pairs(outside.where(short), outside.where(short), percent)).distinct())
    edges = edges.unionByName(confirmed(pairs))

    # In long lists signatures are compared first, and sets only where signatures connect members of different components.
    member = lambda rows, within: rows.where(~short).select(F.col("first").alias("group"), "node", "n", "part", F.lit(1).alias("one"), F.lit(within).alias("inside"))
    members = scratch.cut(member(inside, True).unionByName(member(outside, False)).distinct())
    known = members.select("node", "n", "part").distinct()
    alike = components(_compared(members, "one", BLOCK_SIGNATURES, known.join(classes.select("node", "signature"), "node"), _alike(matches, percent), scratch), scratch)
    grouped = scratch.cut(known.join(alike.withColumnRenamed("component", "group"), "node"))
    first = grouped.groupBy("group", "part").agg(F.sum("n").alias("held")).groupBy("group").agg(F.max(F.struct("held", "part"))["part"].alias("first"))
    members = scratch.cut(grouped.join(first, "group").select("group", "node", "n", (F.col("part") == F.col("first")).alias("inside")).distinct())
    held = scratch.cut(texts(scratch.cut(members.select("node").distinct())).select(F.col("doc_id").alias("node"), _set(size)("text").alias("set")))
    edges = scratch.cut(edges.unionByName(_compared(members, "n", BLOCK_SHINGLES, held, _blocks(percent), scratch)))
    parts = components(edges, scratch)

    of = classes.join(parts.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left").where((F.col("copies") > 1) | F.col("component").isNotNull())
    of = scratch.cut(of.select("print", F.coalesce("component", "node").alias("component")))
    found = sketch.select("doc_id", "print", F.col("n").alias("n_shingles")).join(of, "print", "left")
    out = found.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return cut(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each component: the one of least doc_id. Rows that repeat a doc_id are one document, of which one row stays."""
    found = near_duplicates(docs, size, percent, doc_id=doc_id, text=text).select(F.col("doc_id").alias("__id"), "kept")
    repeated = found.where(F.col("__id").isNotNull()).groupBy("__id").count().where(F.col("count") > 1).select("__id", F.lit(True).alias("again"))
    gone = found.where(~F.col("kept")).select("__id", F.lit(False).alias("again")).distinct()
    # Most rows are sure to stay and need no shuffle; those that the filter lets through meet the exact list.
    touched = cut(gone.unionByName(repeated))
    rows = with_maybe(docs, doc_id, touched, "__id")
    sure, some = rows.where(~F.col("__maybe")).drop("__maybe"), rows.where("__maybe").drop("__maybe")
    ids = lambda again: touched.where(F.col("again") == again).select("__id")
    out = some.join(ids(False), F.col(doc_id) == F.col("__id"), "left_anti")
    once = out.join(ids(True), F.col(doc_id) == F.col("__id"), "left_semi").dropDuplicates([doc_id])
    rest = out.join(ids(True), F.col(doc_id) == F.col("__id"), "left_anti")
    return sure.unionByName(rest).unionByName(once) if not touched.where("again").isEmpty() else sure.unionByName(out)
