import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from comarca.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PLAIN = ["the cat sat", "The cats, the dogs; don't they?", "l'Été à Zürich\nnaïve  words ", "x=1234567 key_b\n\nend\n", "the cat sat", "unbelievably internationalised antidisestablishmentarianism", "token's \"quote\" (a)b c--d ... !!"]
ODD = [None, "", " ", "\n", "▁a b", "漢字かな交じり文", "😀😀 x 👩‍👩‍👧", "tab\tand\r\nline;\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "a\x00b", "éá ²½", "\xa0x y", "Ωμέγα и Кириллица", "x" * 3000, " " * 50 + "a" + "\n" * 20]


def library():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(text, a, b):
    """Groups of one text by walking over its tokens' byte offsets: lists of (id, start, end)."""
    if not text:
        return []
    of = alignment.byte_level_alphabet()
    spell_a = lambda i: bytes(of[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    sides = []
    for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, spell_a), (b.encode(text), spell_b)):
        if b"".join(map(spell, ids)) != (" " + text).encode():
            return []
        at, side = 0, []
        for i in ids:
            side.append((i, at, at := at + len(spell(i))))
        sides.append(side)
    cuts = sorted({x[2] for x in sides[0]} & {x[2] for x in sides[1]})
    return [tuple([x for x in side if low < x[2] <= high] for side in sides) for low, high in zip([0, *cuts], cuts, strict=False)]


def plain_result(texts):
    a, b = library()
    found = [plain_groups(t, a, b) for t in texts]
    links = [[(x[0], y[0]) for left, right in groups for x in left for y in right if x[1] < y[2] and y[1] < x[2]] for groups in found]
    docs = Counter(pair for own in links for pair in set(own))
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for groups, own in zip(found, links, strict=True):
        told = ";".join(",".join(str(x[0]) for x in left) + "|" + ",".join(str(y[0]) for y in right) for left, right in groups)
        sums = sum(len(left) for left, _ in groups), sum(len(right) for _, right in groups), len(groups), len(own)
        out.append((*sums, sum(docs[p] == most[p[0]] for p in own), sum(docs[p] for p in own), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return out, docs, most


def told(frame):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in frame.collect())


def random_texts(n, seed=3):
    r = random.Random(seed)
    alphabet = "ab the'sdon'tre  \n\n.,;-_=/()1234éßÀ▁²漢😀\r\t"
    words = ["the", "cat's", "don't", "Zürich", "123", "...", "\n", " ", "(x)", "re-use", "naïveté"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(n)] + [" ".join(r.choice(words) for _ in range(r.randint(1, 30))) for _ in range(n)]


def test_units_give_what_whole_texts_give():
    own = alignment.Aligner(A, B)
    assert own.split is not None
    a, b = library()
    texts = [t for t in PLAIN + ODD if t] + random_texts(1500)
    assert sum(not alignment._ODD.search(t) for t in texts) > 500
    for text, numbers in zip(texts, own.numbers(texts), strict=True):
        want = ";".join(",".join(str(x[0]) for x in left) + "|" + ",".join(str(y[0]) for y in right) for left, right in plain_groups(text, a, b))
        assert ";".join(own.told[k] for k in numbers) == want, text


@pytest.mark.parametrize("limits", [{}, {"ENTRIES": 50}])
def test_counts_equal_brute_force(spark, monkeypatch, limits):
    texts = PLAIN * 2 + ODD + random_texts(60)
    ids = [None if k % 11 == 0 else k // 2 for k in range(len(texts))]
    docs = spark.createDataFrame([(k, t, "x") for k, t in zip(ids, texts, strict=True)], "doc_id long, text string, key string").repartition(3)
    want, pairs, most = plain_result(texts)
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)  # the blocks' writer is a closure, pickled with its constants
    assert told(alignment.align_documents(docs, A, B)) == sorted((k is not None, k or 0, *row) for k, row in zip(ids, want, strict=True))
    if not limits:
        found = {(r["a"], r["b"]): (r["docs"], r["best"]) for r in alignment.id_pairs(docs, A, B).collect()}
        assert found == {p: (n, n == most[p[0]]) for p, n in pairs.items()}


def test_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_blocks_close_and_the_worker_starts_anew(monkeypatch):
    """The writer itself, in this process: many blocks, each with its own dictionary, which cover all groups."""
    texts = [t for t in PLAIN * 3 if t] + random_texts(40)
    for name, value in {"UNITS": 60, "ENTRIES": 100}.items():
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment, "_HELD", {})
    monkeypatch.setattr(alignment.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 5})()))
    batches = [pa.record_batch([pa.array(range(k, k + len(texts[k : k + 10]))), pa.array(texts[k : k + 10])], ["doc_id", "text"]) for k in range(0, len(texts), 10)]
    rows = [r for b in alignment._write_blocks(A, B)(iter(batches)) for r in b.to_pylist()]
    keys = {(r["block"], r["number"]): r["key"] for r in rows if r["key"] is not None}
    blocks = {r["block"] for r in rows}
    assert len(blocks) > 5 and all(b >> 32 == 5 for b in blocks)
    a, b = library()
    for r in (r for r in rows if r["groups_sha256"] is not None):
        got = Counter()
        for n, times in zip(np.frombuffer(r["at"], "<u4").tolist(), np.frombuffer(r["times"], "<u4").tolist(), strict=True):
            got[keys[r["block"], n]] += times
        assert got == Counter(",".join(str(x[0]) for x in left) + "|" + ",".join(str(y[0]) for y in right) for left, right in plain_groups(texts[r["doc_id"]], a, b))
