import random
import re
from collections import Counter
from math import sqrt

import sentencepiece

import corpus_pipeline
import public_tokenizers
from comarca.llm import language_id, mixing, queries

TEXTS = {
    1: "the calm river runs past the quiet fields and over the old stone bridge in the evening light of june",
    2: "the calm river runs past the quiet fields and over the old stone bridge in the evening light of june",
    3: "la casa de los niños está en la calle que va por el centro de la ciudad y de ahí a la plaza",
    4: "please keep it safe: password=abcdefghijklmnop and do not tell the others about that at all",
    5: "12345 !!! 67890",
    6: None,
}


def test_stages(spark, tmp_path):
    rows = [(k, t, "es" if k == 3 else "en", f"s{k % 2}", len(t or "")) for k, t in TEXTS.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 3, 4} and all(r["decodes"] for r in got.values())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert got[1]["ids"] == library.encode(TEXTS[1]) and got[4]["ids"] == library.encode(TEXTS[4].replace("abcdefghijklmnop", "[secret]"))


def test_every_stage_against_brute_force(spark, tmp_path):
    """Several hundred documents with copies, secrets, strange scripts, nulls, ties, a very long text and clashing names."""
    r = random.Random(8)
    words = {"en": "the of and to in is that it was for on with as his they at be this have from", "es": "el de la que los por con una para del las un no se su al lo como más pero"}
    texts = []
    for _ in range(150):
        lang = r.choice(["en", "es"])
        own = [r.choice(words[lang].split()) + r.choice(["", "", "a", "o", "er"]) for _ in range(r.randint(20, 90))]
        texts.append((" ".join(own), lang))
        for _ in range(r.choice([0, 0, 1, 3])):
            copy = list(own)
            for _ in range(r.choice([0, 0, 1])):
                copy[r.randrange(len(copy))] = r.choice(words[lang].split())
            texts.append((" ".join(copy), lang))
    texts += [(f"{' '.join(r.choice(words['en'].split()) for _ in range(30))} password={r.getrandbits(80):020x} and AKIA{'ABCDEFGHIJKLMNOP'[k % 9:]}QRSTUVWX end", "en") for k in range(0, 60, 4)]
    texts += [(None, "en"), ("", "en"), ("12 34 !!", "es"), ("漢字 " * 40, "en"), (" ".join(r.choice(words["en"].split()) for _ in range(60_000)), "en")]
    sources = ["hot", "hot", "hot", "mid", None]
    rows = [(k, t, lang, sources[k % 5], len(t or ""), "x", "y") for k, (t, lang) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, node string"
    docs = spark.createDataFrame(rows, schema)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    model = language_id.fit(docs)
    kept = {k: t for k, (t, _) in enumerate(texts) if not model.predict(t)[2]}
    assert len(kept) == len(texts) - 4
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, t in kept.items() if (w := t.lower().split())}
    least = {k: k for k in kept}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(len(links)):
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    alone = {k: t for k, t in kept.items() if least[k] == k}
    assert len(alone) < len(kept) - 50

    def clean(text):
        """Secret parts out, however many patterns meet in one place."""
        spans = [(m.start(2), m.end(2)) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
        spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18] + [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        out, at = "", 0
        for a, b in sorted(spans, key=lambda x: (x[0], -x[1])):
            if a >= at:
                out, at = out + text[at:a] + "[secret]", b
            at = max(at, b)
        return out + text[at:]

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(got) == set(alone) and any("[secret]" in clean(t) for t in alone.values())
    for k, t in alone.items():
        ids = library.encode(clean(t))
        assert (got[k]["ids"], got[k]["n_tokens"], got[k]["decodes"]) == (ids, len(ids), library.decode(ids) == clean(t)), k
    of = Counter(sources[k % 5] for k in alone)
    blocks = {"null" if s is None else f"={s}": -(-n // mixing.BLOCK_ROWS) for s, n in of.items()}
    slots = dict(enumerate(mixing.slots(blocks, mixing.default_weights({"null" if s is None else f"={s}": n for s, n in of.items()}))))
    assert len({x["mix_position"] for x in got.values()}) == len(got)
    for x in got.values():
        assert slots[x["mix_slot"]][0] == ("null" if x["source"] is None else f"={x['source']}") and x["mix_position"] // mixing.BLOCK_ROWS == x["mix_slot"]


def test_the_mix_reaches_the_last_stage(spark, tmp_path):
    """Unequal sources: the rows of the last stage say where the mixing stage put them, whatever files they come from."""
    sizes = {"hot": 600, "mid": 150, "small": 40, None: 7}
    rows = [(k * 10 + j, f"text {k} of {s}", "en", s, 9) for j, (s, n) in enumerate(sizes.items()) for k in range(n)]
    rows += [(5, "twice", "en", "mid", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = {(r["doc_id"], r["mix_slot"], r["mix_position"]) for r in mixing.mixed(docs).collect()}
    assert all(r["mix_slot"] is None for r in corpus_pipeline.pieces(spark, docs.where("doc_id > 100"), "").collect())  # never mixed
    corpus_pipeline.mixture(spark, docs, "").repartition(5, "doc_id").write.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.pieces(spark, spark.read.parquet(str(tmp_path / "mixed")), "").collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["mix_slot"], r["mix_position"]) for r in got} == want
    sizes["mid"] += 2
    share, done = {s: sqrt(n) / sum(map(sqrt, sizes.values())) for s, n in sizes.items()}, Counter()
    at = {r["mix_slot"]: r["source"] for r in got}
    for slot in range(17):  # none has ended yet
        done[at[slot]] += 1
        assert all(abs(done[s] - (slot + 1) * w) < 1 for s, w in share.items())


def test_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words that are here", "en", "a", 24), (1, "some words that are here", "en", "a", 24)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 1
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").collect() == [], name


def test_registered():
    names = queries.queries()
    assert sorted({n.split("_")[0] for n in names}, key=lambda n: int(n[2:])) == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
