import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from comarca.llm import sentencepiece_bpe, token_files
from comarca.llm.common import Memo, new_path

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts(alphabet, n, seed=1, most=80):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


TEXTS = [None, "", " ", "a", "x" * 5000, "Hello wörld 漢字 😀\x00", " " * 100 + "é", "same", "same", "<|endoftext|> it's", "▁a▁▁b", "a\u0301e\u0301 n\u0303"]


def test_merge_rounds_equal_the_library():
    own, library = sentencepiece_bpe.BpeEncoder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for t in TEXTS] + odd_texts("ab the of\n\t▁ 漢é😀\x00=-_/²1", 2000) + [" " * k + "b" for k in range(60)] + ["a" * k for k in range(40)]
    got = own.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [own.decode(x.tolist()) for x in got] == library.decode(library.encode(texts))


def test_encoded_documents(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, pieces string")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = sentencepiece_bpe.encode_documents(docs, PIECES).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = library.encode(r["text"] or "")
        assert (r["pieces"]["ids"], r["pieces"]["decoded"]) == (ids, library.decode(ids) if ids else "")
    assert sentencepiece_bpe.encode_documents(docs.limit(0), PIECES).collect() == []


def test_words_equal_the_library():
    own = token_files.WordEncoder(WORDS)
    assert own.split is not None
    texts = [t or "" for t in TEXTS] + odd_texts("ab'sSt the oOf\n\t ́≠é😀\x00=-_/.,İΣσς²Ⅷ٣3漢ñ \x0b\x1c<|>", 3000)
    assert own.encode(texts) == own._whole(texts)


def test_an_unknown_tokenizer_goes_whole():
    own = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.split is None and own.encode(["a b"]) == own._whole(["a b"])


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    payload = token_files.pack(ids, bits)
    assert len(payload) == -(-1001 * bits // 8)
    assert (token_files.unpack(payload, bits, 0, 1001) == ids).all() and (token_files.unpack(payload, bits, 37, 100) == ids[37:137]).all()
    assert len(token_files.unpack(payload, bits, 5, 0)) == 0


def test_files_come_back_in_order(spark):
    docs = spark.createDataFrame([(k, t) for k, t in zip((9, 3, None, 7, 7, 1, 0, 8, 20, 21, 22, 23), TEXTS, strict=True)], "doc_id long, text string").withColumn("start", F.lit("clash"))
    path = new_path(spark, "files")
    token_files.write_token_files(docs, WORDS, path, end_id=2)
    library = Tokenizer.from_file(WORDS)
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    want, start = [], 0
    for r in order:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], start, len(ids), ids))
        start += len(ids)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids"]) for r in token_files.read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    digests = {r["start"]: r["ids_crc32"] for r in token_files.read_token_digests(spark, path).collect()}
    assert digests == {s: zlib.crc32(np.array(ids, "<u4").tobytes()) for _, s, _, ids in want}
    empty = new_path(spark, "files")
    token_files.write_token_files(docs.limit(0), WORDS, empty, end_id=2)
    assert token_files.read_token_files(spark, empty).collect() == []


def test_memo_is_bounded_and_keeps_what_is_used():
    memo, learned = Memo(4), []

    def learn(keys):
        learned.extend(keys)
        return [k * 2 for k in keys]

    for k in range(20):
        assert memo.get({k, -1}, learn) == {k: 2 * k, -1: -2}
        assert len(memo.young) + len(memo.old) <= 8
    assert learned.count(-1) == 1
