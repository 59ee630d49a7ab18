import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from comarca.llm import divergence, line_dedup

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, least_length=10, least_documents=2):
    """(n_lines, n_dropped, kept) of each (doc_id, text); rows of one id, and those without, are one document."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holds = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holds[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = lambda k: len(k) >= least_length and len(holds[k]) >= least_documents and doc != min(holds[k], key=lambda d: (d is None, d or 0))
        kept = [x for x in lines if not gone(key(x))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINES = ["a line that comes again", "  A Line THAT comes again\t", "\x0b\x0ca line that comes again\r", "short", "", "   ", "ÉTÉ à la montagne", "été à la montagne", "\xa0a line that comes again", "0123456789", "012345678", "漢字かな交じり文の行である", "x" * 4000, "once only, this one"]


@pytest.mark.parametrize("least_documents", [2, 3])
def test_line_dedup_equals_brute_force(spark, least_documents):
    r = random.Random(5)
    rows = [(k, "\n".join(r.choice(LINES) for _ in range(r.randint(0, 6)))) for k in range(60)]
    rows += [(None, "a line that comes again"), (None, "only without an id here\nonly without an id here"), (None, "only without an id here"), (70, None), (71, ""), (72, "\n\n"), (73, "\n".join(["a line that comes again"] * 3000)), *rows[:5], (3, "another text of this id\nonce only, this one"), (-1, "once only, this one\nonce only, this one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lines": F.lit("clash"), "__id": F.lit(1), "key": F.lit("k")}).repartition(3)
    found = line_dedup.without_repeated_lines(docs.drop("__id"), least_documents=least_documents)
    assert found.columns == ["doc_id", "text", "key", "lines"]
    assert sorted(((x["doc_id"], *x["lines"]) for x in found.collect()), key=repr) == plain_lines(rows, least_documents=least_documents)
    assert line_dedup.without_repeated_lines(docs.drop("__id").limit(0)).collect() == []


def plain_divergence(rows, least, smoothing, scale, top):
    """The audit over dense dictionaries."""
    n, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), k in docs.items() if x == lang and k >= least]
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        share = lambda count, whole: 1 + scale * (count + smoothing) // (whole + smoothing * len(kept))
        p = {(s, t): share(n[lang, s, t], total[s]) for s in sources for t in kept}
        q = {t: share(sum(n[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s, t] - p[o, t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s, t], t.encode()) for t in kept if n[lang, s, t] > 0 and p[s, t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(items, 1)]
    return sorted(out)


def corpus(n, seed=9):
    r = random.Random(seed)
    words = ["the", "The", "cat", "été", "ÉTÉ", "漢字", "x1y", "don't", "a_b", "ﬁ", "zz", "😀", "end.", "K", "İ"] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = [(r.choice(["en", "fr", "de", None]), r.choice([f"s{k}" for k in range(6)] + [None]), " ".join(r.choice(words[: r.randint(1, len(words))]) for _ in range(r.randint(0, 12)))) for _ in range(n)]
    return rows + [("xx", "lonely", "the the the"), ("yy", "a", None), ("yy", "b", ""), ("en", "no terms", "12 34 _ \x00"), ("en", "s1", "the " * 20000)] + rows[:40]


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_brute_force(spark, monkeypatch, small):
    rows = corpus(600)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit("clash"), "n": F.lit(1), "at": F.lit(2), "number": F.lit(3)}).repartition(5)
    if small:  # many groups of vectors, blocks of sources and hand-overs of counts
        for name, value in {"VECTORS": 7, "ROWS": 3}.items():
            monkeypatch.setattr(divergence, name, value)
    found = divergence.divergence(docs, least_documents=20, top=9)
    want = plain_divergence(rows, 20, 5, 10**9, 9)
    assert sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect())) == want
    assert len(want) > 100 and divergence.divergence(docs.limit(0)).collect() == []


def test_blocks_of_sources(spark, monkeypatch):
    rows = corpus(400, seed=4)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    found = divergence.divergence(spark.createDataFrame(rows, "lang string, source string, text string"), least_documents=10, top=5)
    assert sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect())) == plain_divergence(rows, 10, 5, 10**9, 5)


def test_shares_beyond_64_bits():
    """Counts whose product with the scale leaves 64 bits are divided as whole numbers of any size."""
    import pyarrow as pa

    n = [[12 * 10**9, 3], [5, 2 * 10**10]]
    key = tuple(pa.scalar(x) for x in ("en", 0, 0, 0))
    kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
    vectors = pa.table({"at": pa.array([[{"source": s, "n": x} for s, x in zip("ab", row, strict=True)] for row in n], kind), "times": [1, 4]})
    totals = [n[0][0] + 4 * n[1][0], n[0][1] + 4 * n[1][1]]
    groups = pa.table({"source": ["a", "b"], "number": pa.array([0, 1], pa.int32()), "total": totals, "terms": [5, 5]})
    share = lambda row, s: 1 + 10**9 * (n[row][s] + 5) // (totals[s] + 25)
    assert divergence._pairs(5, 10**9)(key, vectors, groups)["value"].to_pylist() == [sum(w * abs(share(row, 0) - share(row, 1)) for row, w in ((0, 1), (1, 4)))]
