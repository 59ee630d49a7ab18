"""Token ids in bit-packed blocks.

Every id takes the fewest bits that hold the vocabulary's largest id. A block holds whole documents, its payload and the
end of each document in it, so any document unpacks alone with numpy, from its bit offset on. Blocks are the rows of a
written table (Spark's own writer and reader, so any store will do), in ascending doc_id order: partitions are ranges of
doc_id, and within one, documents follow each other. The start of a document among all ids is the sum of the ids of the
partitions before, of its blocks before and of the documents before it in its block; no task sees more than its range.

Cases: a null or empty text has the end id alone. Null doc_ids come first; rows of one doc_id stand in the order of their
texts' hash, each with its own ids. A very long text is a block of its own, whole: a task holds the ids of one batch of texts.
An empty table writes an empty file and reads back empty. Extra columns, whatever their names, are not written.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from comarca.llm.common import Memo, small_batches

#: A block is closed when it holds so many ids.
BLOCK_IDS = 1 << 16
#: Distinct words that a worker keeps, at most.
MEMO_WORDS = 1_400_000
BLOCK_SCHEMA = "part int, block int, start long, n_ids long, bits int, doc_ids array<long>, ends array<long>, payload binary"
_VIEWS = {8: "<u1", 16: "<u2", 32: "<u4"}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, lowest bit first."""
    if bits in _VIEWS:
        return ids.astype(_VIEWS[bits]).tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """n ids from the id numbered `first` on; reads only the bytes that hold them."""
    if bits in _VIEWS:
        return np.frombuffer(payload, _VIEWS[bits], n, first * bits // 8).astype(np.uint32)
    low, high = first * bits, (first + n) * bits
    raw = np.frombuffer(payload, np.uint8, (high + 7) // 8 - low // 8, low // 8)
    spread = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + n * bits].reshape(n, bits)
    return spread.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


#: Steps of the normaliser and the splitter after which a text's words can be told apart here as the library does.
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def _stable(c: str) -> bool:
    """Normalisation and lower case leave or give one character of the same kind."""
    low = c.lower()
    return len(low) == 1 and unicodedata.normalize("NFC", c) == c and unicodedata.normalize("NFC", low) == low and unicodedata.category(c)[0] == unicodedata.category(low)[0]


_LETTERS = "".join(re.escape(chr(p)) for p in range(0x41, 0x250) if unicodedata.category(chr(p))[0] == "L" and _stable(chr(p)))
_SYMBOLS = "".join(re.escape(chr(p)) for p in range(0x21, 0x2C00) if unicodedata.category(chr(p))[0] in "PS" and _stable(chr(p)))
#: What a plain text does not hold. Plain texts have Latin letters, ASCII digits and white space, and symbols.
_ODD = re.compile(f"[^ \\n\\r\\t0-9{_LETTERS}{_SYMBOLS}]")


def _plain(text: str) -> bool:
    return text.isascii() and text.replace("\n", " ").isprintable() or not _ODD.search(text)


class WordEncoder:
    """Whole texts through the tokenizers library, each distinct word once.

    The tokenizer's own splitting pattern, read from its file, is run on plain texts; it yields the words that the library
    would merge one by one. New words go through the library, many at a time; the worker keeps what they gave. A text that
    is not plain, or holds a control string, goes through the library whole, and so does every text if the tokenizer
    normalises or splits in another way.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bits = max(1, max(vocabulary.values()).bit_length())
        self.control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.memo = Memo(MEMO_WORDS)
        self.split = self._splitter()
        probe = ["It's 42% of THE l'Été — naïve_x!! don't we'LL\tß ÀB\n(12)'d", "x"]
        if self.split and self.encode(probe) != self._whole(probe):
            self.split = None

    def _splitter(self):
        """findall of the splitting pattern, on plain lower-cased texts; none if the tokenizer works otherwise."""
        told = json.loads(self.tokenizer.to_str())
        normal, before = told.get("normalizer") or {}, (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        cuts = before[0]
        if normal.get("normalizers") != _STEPS or cuts.get("type") != "Split" or cuts.get("behavior") != "Removed" or not cuts.get("invert") or any(x.get("use_regex", True) for x in before[1:]):
            return None
        return re.compile(cuts["pattern"]["Regex"].replace("\\p{L}", _LETTERS).replace("\\p{N}", "0-9")).findall

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words. Words of letters are joined by spaces, and come apart where a token ends a word."""
        letters = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        of = dict(zip(rest, self._whole(rest), strict=True))
        for k in range(0, len(letters), 2000):
            some = letters[k : k + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                of.update(zip(some, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
            else:
                of.update(zip(some, self._whole(some), strict=True))
        return [of[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.split:
            return self._whole(texts)
        plain = [_plain(t) and not any(c in t for c in self.control) for t in texts]
        cut = [self.split(t.lower()) if p else [] for t, p in zip(texts, plain, strict=True)]
        get = self.memo.get(set().union(*cut), self._learn).__getitem__
        others = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [b"".join(map(get, words)) if p else next(others) for words, p in zip(cut, plain, strict=True)]


_HELD: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _HELD:
        _HELD[path] = WordEncoder(path)
    return _HELD[path]


def _blocks(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, end = encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], np.uint32).tobytes()
        names = [x.split(" ")[0] for x in BLOCK_SCHEMA.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        docs, held, n_held, start, block = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), np.uint32)
            row = [part, block, start, len(ids), own.bits, docs, np.cumsum([len(x) // 4 for x in held]).tolist(), pack(ids, own.bits)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), own.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                docs.append(doc)
                held.append(ids + end)
                n_held += len(ids) // 4 + 1
                if n_held >= BLOCK_IDS:
                    yield flush()
                    start, block, docs, held, n_held = start + n_held, block + 1, [], [], 0
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode the texts of docs and write the blocks in doc_id order. The range shuffle moves the texts once; encoding happens behind it, in order."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")  # rows that share an id, or have none, may lie in several ranges
    rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text").mapInArrow(_blocks(tokenizer, end_id), BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids (array<long>)."""
    return _documents(spark, path, "ids array<long>", lambda ids: ids.astype(np.int64))


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32; the ids stay in the task that unpacks them."""
    return _documents(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _documents(spark: SparkSession, path: str, column: str, of) -> DataFrame:
    small_batches(spark, 64)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # One row for each written partition: as many as there are files, whatever the documents.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    kind = pa.list_(pa.int64()) if column.endswith(">") else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.array(row["ends"], np.int64)
                starts = np.r_[0, ends[:-1]]
                got = [of(unpack(row["payload"], row["bits"], a, b - a)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"] + row["before"]), pa.array(ends - starts), pa.array(got, kind)], ["doc_id", "start", "n_tokens", column.split(" ")[0]])

    return blocks.join(F.broadcast(offsets), "part").select("doc_ids", "ends", "start", "bits", "payload", "before").mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")
