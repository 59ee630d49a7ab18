import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from comarca.llm import embedding_dedup, kdtree_topk, minhash_dedup, mixing
from comarca.files import delete
from comarca.llm.common import Scratch, small_batches, with_maybe
from comarca.llm.components import components


def joined(links, nodes):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    texts = [None, "", "  \t ", "one", "One", "one two", "two one", "a\u00a0b c", "x " * 4000]
    for _ in range(30):
        own = [r.choice(words) for _ in range(r.randint(1, 60))]
        texts.append(" ".join(own))
        for _ in range(r.randint(0, 5)):
            copy = list(own)
            for _ in range(r.randint(0, 1 + len(copy) // 10)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(" ".join(copy))
    texts += ["common passage of a few words here " + " ".join(r.choice(words) for _ in range(4)) for _ in range(25)]
    return texts


@pytest.mark.parametrize(("size", "short"), [(2, 16), (2, 0), (5, 16)])
def test_near_duplicates(spark, size, short, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", 200)
    texts = corpus(size)
    docs = spark.createDataFrame([(k * 3, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, node string")
    sets = {k * 3: shingles(t, size) for k, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = joined(links, sets)
    rows = minhash_dedup.near_duplicates(docs, size=size, short_list=short).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {k: (len(s), want[k], want[k] == k) for k, s in sets.items()}
    assert len(rows) == len(texts) and len(links) > 20
    assert sorted(r["doc_id"] for r in minhash_dedup.deduplicated(docs, size=size).collect()) == sorted(k for k in want if want[k] == k)


def test_near_duplicates_of_shared_passages(spark, monkeypatch):
    """Texts that share passages and no more stand in long lists. Few of their sets move, block pairs come in waves, and links are found."""
    r, moved, cut = random.Random(3), [], minhash_dedup.Scratch.cut
    passages = [" ".join(f"p{i}w{k}" for k in range(5)) for i in range(30)]
    texts = [" ".join(r.sample(passages, 7)) for _ in range(90)]
    texts += [t + " more" for t in texts[:4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def counted(self, df):
        out = cut(self, df)
        moved.append(out.count() if "set" in out.columns else 0)
        return out

    monkeypatch.setattr(minhash_dedup.Scratch, "cut", counted)
    for name, value in (("BLOCK_SHINGLES", 60), ("BLOCK_SIGNATURES", 16), ("WAVE", 1), ("WAVE_BLOCKS", 1)):
        monkeypatch.setattr(minhash_dedup, name, value, raising=False)
    rows = minhash_dedup.near_duplicates(docs, size=2, short_list=0).collect()
    assert {x["doc_id"]: x["component_id"] for x in rows} == {k: k - 90 if k >= 90 else k for k in range(94)}
    assert 2 * sum(moved) < len(texts)


def test_near_duplicates_of_little(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(docs, size=2).collect())
    assert got == {(1, 1, True): 2, (2, 1, False): 1, (3, 3, True): 1, (None, None, True): 1}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in minhash_dedup.deduplicated(docs, size=2).collect()) == [(False, 1), (False, 3), (True, 0)]
    assert minhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 63, 900, dtype=np.uint64))
    pairs = [(a[:400], a[k : 400 + k]) for k in (10, 44, 100, 200)]
    for x, y in pairs:
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        many = [np.mean(np.equal(*minhash_dedup.signatures([np.unique(x * np.uint64(2 * s + 1)), np.unique(y * np.uint64(2 * s + 1))]))) for s in range(40)]
        assert abs(np.mean(many) - true) < 0.05
    assert minhash_dedup.least_matches(0.8) == 21


def test_components(spark):
    r = random.Random(5)
    links = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(999, k) for k in range(500, 560)] + [(7, 7)]
    with Scratch(spark, "test") as scratch:
        got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "u long, v long"), scratch).collect()}
        assert components(spark.createDataFrame([], "u long, v long"), scratch).collect() == []
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: c for n, c in joined(links, {n for ab in links for n in ab}).items() if n in nodes}


def test_shared_state(spark):
    key, batch = Scratch.CLEANUP, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with Scratch(spark, "test") as scratch:
        kept, gone = scratch.cut(spark.range(5)), scratch.cut(spark.range(3))
        assert kept.count() == 5 and gone.count() == 3 and spark.conf.get(key) == "true"
        scratch.drop(gone)
        folder = spark._jvm.org.apache.hadoop.fs.Path(scratch.folder)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        assert len(store.listStatus(folder)) == 1
    assert not store.exists(folder) and spark.conf.get(key) == before
    delete(spark, scratch.folder)  # what is not there is no error
    small_batches(spark, 64)
    small_batches(spark, 500)
    assert spark.conf.get(batch) == "64"


def test_id_filter_holds_for_every_id(spark, monkeypatch):
    ids = spark.range(0, 3000, 3).unionByName(spark.createDataFrame([(None,), (-7,)], "id long"))
    rows = spark.range(-10, 3000)
    of = lambda some: with_maybe(rows.withColumn("x", F.lit("kept")), "id", some, "id")
    passed = {r["id"] for r in of(ids).where("__maybe").collect()}
    assert passed >= {*range(0, 3000, 3), -7} and len(passed) < 1010 and of(ids).count() == 3010 and of(ids).columns == ["id", "x", "__maybe"]
    assert of(ids.limit(0)).where("__maybe").count() == 0
    monkeypatch.setattr("comarca.llm.common.FILTER_WORDS", 1)
    assert {r["id"] for r in of(ids).where("__maybe").collect()} >= {*range(0, 3000, 3), -7}


def vectors(seed, n, d=16):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n // 4, d))
    rows = np.concatenate([base, base[: n // 4] + r.normal(size=(n // 4, d)) * 0.1, base[: n // 8] * 2, r.normal(size=(n - n // 4 - n // 4 - n // 8, d))]).astype(np.float32)
    return rows[r.permutation(len(rows))]


STRANGE = [(1001, None, 0), (1002, [], 0), (1003, [0.0] * 16, 0), (1004, [float("nan")] + [1.0] * 15, 0), (1005, [None] + [1.0] * 15, 0), (1006, [1.0] * 16, None), (1007, [1.0] * 15, 0), (1008, [float("inf")] * 16, 0), (1009, [1.0] * 16, 0), (1009, [1.0] * 16, 0)]


@pytest.mark.parametrize(("cell_rows", "block_rows"), [(2000, 2048), (20, 16)])
def test_near_vectors(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block_rows)
    own = vectors(3, 300)
    rows = [(k, [float(x) for x in v], k % 2) for k, v in enumerate(own)] + STRANGE
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_vectors(frame, reach=1.0).collect()
    x = own.astype(np.float64)
    near = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= 0.93
    links = [(a, b) for a in range(len(x)) for b in range(a) if near[a, b] and a % 2 == b % 2]
    ones = [k for k, v in enumerate(x) if k % 2 == 0 and v @ np.ones(16) / np.linalg.norm(v) / 4 >= 0.93]
    assert not ones and len(links) > 20
    counts, want = Counter(n for ab in links for n in ab), joined(links, range(len(x)))
    found = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    assert {k: (found[k]["n_links"], found[k]["component_id"], found[k]["kept"]) for k in range(len(x))} == {k: (counts[k], want[k], want[k] == k) for k in range(len(x))}
    assert all(found[k]["n_links"] == 0 and found[k]["component_id"] == k and found[k]["kept"] for k in range(1001, 1009)) and found[1009]["n_links"] == 1
    default = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(frame).collect()}
    assert sum(default.values()) >= 0.9 * sum(r["n_links"] for r in got)
    clash = embedding_dedup.near_vectors(frame.withColumns({c: F.lit("x") for c in ("node", "cell", "print", "home", "links", "component")}), reach=1.0)
    assert sorted(map(str, clash.collect())) == sorted(map(str, got))
    assert embedding_dedup.near_vectors(frame.limit(0)).collect() == []


def test_pairs_across_borders_are_found_whatever_their_direction():
    """Recall over 200 cells in 64 dimensions of partners that differ in one, two or all components."""
    r = np.random.default_rng(9)
    d = 64
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(r.normal(size=(6000, d)))
    centres = embedding_dedup.spherical_kmeans(base, 200)
    margin = np.sqrt(2 - 2 * 0.93) * min(1.0, 4 / np.sqrt(d)) + 1e-9
    for few in (1, 2, 8, d):
        step = np.zeros_like(base)
        for k in range(len(base)):
            step[k, r.permutation(d)[:few]] = r.normal(size=few)
        other = unit(base + 0.36 * unit(step))
        near = (base * other).sum(axis=1) >= 0.93
        sides = [embedding_dedup.visited(x, centres, margin) for x in (base, other)]
        (h1, v1), (h2, v2) = sides
        at = np.arange(len(base))
        met = (h1 == h2) | np.where(h1 < h2, v2[at, h1], v1[at, h2])
        assert near.sum() > 2000 and met[near].mean() > 0.99, few


@pytest.mark.parametrize("shard_rows", [4096, 40])
def test_top_k(spark, shard_rows):
    own = vectors(8, 200, 8)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(own)] + STRANGE[:6] + [(500, [float(x) for x in own[0]], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    usable = kdtree_topk.usable(frame)
    got = kdtree_topk.top_k(usable, usable.where("id % 10 = 0"), k=5, shard_rows=shard_rows, query_rows=7).collect()
    v = {k: np.floor(np.array(x, np.float64) * 256).astype(np.int64) for k, x, _ in ((k, [np.float32(y) for y in x], 0) for k, x, _ in rows if k < 1000)}
    want = {(q, n): (s, i) for q in v if q % 10 == 0 for n, (s, i) in enumerate(sorted(((int(v[q] @ v[i]), i) for i in v if i != q), key=lambda x: (-x[0], x[1]))[:5], 1)}
    assert {(r["query_id"], r["rank"]): (r["score"], r["vec_id"]) for r in got} == want
    few = usable.where("id < 3")
    assert kdtree_topk.top_k(few, few.where("id = 0")).count() == 2
    assert kdtree_topk.top_k(usable.limit(0), usable.limit(0)).collect() == []


def test_top_k_enters_few_shards_of_clustered_data(spark, monkeypatch):
    r = np.random.default_rng(3)
    heart = r.normal(size=(16, 6)) * 4
    own = np.concatenate([heart[np.arange(1600) % 16] + r.normal(size=(1600, 6)) * 0.1, np.ones((800, 6))]).astype(np.float32)  # a third are equal
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(own)], "vec_id long, embedding array<float>")
    usable = kdtree_topk.usable(frame)
    entered = []
    fits = kdtree_topk.Shards.others_udf
    monkeypatch.setattr(kdtree_topk.Shards, "others_udf", lambda self, d: entered.append(int(self.first[-1])) or fits(self, d))
    got = kdtree_topk.top_k(usable, usable.where("id % 40 = 0"), k=5, shard_rows=64).collect()
    v = np.floor(own.astype(np.float64) * 256).astype(np.int64)
    for q in range(0, 2400, 40):
        want = sorted(((-int(v[q] @ v[i]), i) for i in range(2400) if i != q))[:5]
        assert [(r_["rank"], -r_["score"], r_["vec_id"]) for r_ in got if r_["query_id"] == q] == [(n, s, i) for n, (s, i) in enumerate(want, 1)]
    cells = kdtree_topk.Cells(v, 32)
    where = cells.of(v)
    assert cells.leaves == len(set(where)) and 16 < cells.leaves <= 32 and entered == [entered[0]] and entered[0] >= 38
    shards = kdtree_topk.Shards({int(c): (int((where == c).sum()), v[where == c].min(axis=0), v[where == c].max(axis=0)) for c in set(where)}, 64)
    kth = np.array([sorted((int(x) for x in v @ v[q]), reverse=True)[5] for q in range(0, 1600, 40)])
    assert (shards.bounds(v[:1600:40]) >= kth[:, None]).mean() < 0.5  # cells that a query enters, of all
    assert shards.parts.max() >= 12  # equal vectors are spread over shards


def test_kdtree_boxes_bound_and_prune():
    points = np.random.default_rng(2).integers(-500, 500, (700, 4))
    tree = kdtree_topk.KdTree(np.arange(700), points)
    q = np.array([5, -3, 100, 7])
    bound = tree.bounds(q[None])[0]
    for node, (a, b) in enumerate(tree.span):
        assert (tree.points[a:b] @ q).max() <= bound[node]
    assert [i for _, i in tree.top(-1, q, bound, 3, None)] == sorted(range(700), key=lambda i: (-(points[i] @ q), i))[:3]


@pytest.mark.parametrize("share", [{"a": 1, "b": 1}, {"a": 500, "b": 333, "c": 167}, {"a": 97, "b": 1, "c": 1, "d": 1}, {"a": 7}])
def test_schedule_is_fair_at_every_slot(share):
    total, done = sum(share.values()), Counter()
    for slot, k in enumerate(mixing.schedule(share), 1):
        done[k] += 1
        assert all(abs(done[s] - Fraction(slot * w, total)) < 1 for s, w in share.items())
    assert done == share


def test_mixture(spark):
    sizes = {"big": 700, "mid": 150, "small": 40, None: 10}
    rows, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((k, s, f"t{k}", "x"))
            k += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_block string").repartition(3)
    weights = {"big": 0.5, "mid": 0.3, "small": 0.15, None: 0.05}
    got = mixing.mixed(docs, weights, block_rows=5).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(k)) and len({r["mix_position"] for r in got}) == k
    blocks = {}
    for r in got:
        blocks.setdefault(r["mix_slot"], set()).add((r["source"], r["mix_block"]))
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    order, done = [next(iter(blocks[s]))[0] for s in sorted(blocks)], Counter()
    end = {s: -(-n // 5) for s, n in sizes.items()}
    for slot, s in enumerate(order, 1):
        done[s] += 1
        if any(done[x] == end[x] for x in sizes):
            break
        assert all(abs(done[x] - slot * Fraction(str(w))) < 1 for x, w in weights.items())
    whole = mixing.in_mix_order(docs, weights, block_rows=5)
    assert whole.columns == docs.columns and [r["doc_id"] for r in whole.collect()] == [r["doc_id"] for r in sorted(got, key=lambda r: r["mix_position"])]
    assert mixing.mixed(docs).count() == k and mixing.mixed(docs.unionByName(docs)).count() == 2 * k
    assert mixing.mixed(docs.limit(0)).collect() == []
    assert mixing.mixed(docs.withColumn("source", F.lit("one"))).count() == k


@pytest.mark.parametrize(
    ("blocks", "weights"),
    [
        ({"hot": 2000, **{f"s{k}": 220 for k in range(19)}}, {"hot": 10.0**0.5, **dict.fromkeys((f"s{k}" for k in range(19)), 1.0)}),
        ({"big": 9000, "rare": 3, "mid": 1500}, {"big": 0.8999, "rare": 0.0001, "mid": 0.1}),
        ({f"s{k}": 1 + k % 7 for k in range(1200)}, {f"s{k}": 1.0 + k % 5 * 0.3 for k in range(1200)}),
        ({"a": 500, "b": 3, "c": 77}, {"a": Fraction(1, 3), "b": Fraction(1, 7), "c": Fraction(11, 21)}),
    ],
)
def test_exact_weights_are_kept_to_a_block(blocks, weights):
    """Also where sources end: targets are those of water that runs into vessels of the sources' sizes at the rates of their weights."""
    w, clock, target, done, most, checked = {k: Fraction(str(x)) for k, x in weights.items()}, Fraction(0), {}, Counter(), 0, 0
    out = list(mixing.slots(blocks, weights))
    assert sorted(out) == sorted((k, i) for k, n in blocks.items() for i in range(n))
    step = 1 if len(blocks) < 50 else 97
    for slot, (k, i) in enumerate(out, 1):
        assert done[k] == i
        done[k] += 1
        left = Fraction(1)
        while left > 0:  # the common clock goes on until a slot's worth has run in
            live = [s for s in blocks if w[s] * clock < blocks[s]] if not target or target["clock"] <= clock else target["live"]
            target = {"live": live, "clock": min(Fraction(blocks[s]) / w[s] for s in live), "rate": sum(w[s] for s in live)} if live is not target.get("live") else target
            by = min(left / target["rate"], target["clock"] - clock)
            clock, left = clock + by, left - by * target["rate"]
        if slot % step == 0:
            checked += 1
            worst = max(abs(done[s] - min(w[s] * clock, blocks[s])) for s in blocks)
            most = max(most, worst)
            assert worst < 1, slot
    assert checked > 20 and most > 0


@pytest.mark.parametrize("weights", [{"a": 0.5005, "b": 0.3333, "c": 0.1662}, {"a": 0.9996, "b": 0.0004}])
def test_no_source_is_a_block_off_over_twenty_thousand_slots(weights):
    blocks = {k: int(21_000 * w) + 1 for k, w in weights.items()}
    done, worst, exact = Counter(), 0, {k: Fraction(str(w)) for k, w in weights.items()}
    for slot, (k, _) in enumerate(mixing.slots(blocks, weights), 1):
        done[k] += 1
        worst = max(worst, *(abs(done[s] - slot * w) for s, w in exact.items()))
        if slot == 20_000:
            break
    assert slot == 20_000 and worst < 1


def test_documents_stand_where_the_slots_say(spark):
    sizes = {"hot": 3000, "b": 301, "c": 302, "rare": 2}
    docs = spark.createDataFrame([(k * 10 + j, s) for j, (s, n) in enumerate(sizes.items()) for k in range(n)], "doc_id long, source string")
    weights = {"hot": 0.7, "b": 0.1499, "c": 0.15, "rare": 0.0001}
    want = {slot: ki for slot, ki in enumerate(mixing.slots({s: -(-n // 4) for s, n in sizes.items()}, weights))}
    for buckets in (None, 3, 2000):
        rows = mixing.mixed(docs, weights, block_rows=4, buckets=buckets).collect()
        assert len(rows) == sum(sizes.values()) == len({r["mix_position"] for r in rows})
        assert {r["mix_slot"]: (r["source"], r["mix_block"]) for r in rows} == want and all(r["mix_position"] // 4 == r["mix_slot"] for r in rows)
