"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

A text is normalised by the model's own rules and cut into words: no piece holds a word mark after another character, so
merges never cross from one word into the next. All words of a batch that are new lie in one flat numpy array of symbols.
A round looks up the rank of every adjacent pair, takes the minimum of each word's segment, merges its occurrences from
the left at once and compacts the array, until no pair remains. Words without a pair leave the array. Equal words are
encoded once per worker; the memo is bounded.

Cases: a null or empty text has no ids and decodes to the empty text. A character outside the vocabulary becomes its
UTF-8 bytes (or the unknown id, if the model has no byte pieces). Every row gets its result; rows never meet, so ties,
repeated rows and extra columns change nothing. Very long texts are encoded whole, word by word. An empty table gives an
empty table; a column named like the new one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import Memo, small_batches

MARK = "▁"
#: Distinct words that a worker keeps, at most.
MEMO_WORDS = 600_000
#: Words in one flat array, so that its rounds stay in the processor's cache.
BLOCK_WORDS = 4096
_HASH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Pair of symbol ids -> merged id, as an open-addressing table that numpy probes for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int], n_ids: int):
        self.n_ids = np.int64(n_ids)
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        keys = np.array([a * n_ids + b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] < 0
            _, first = np.unique(np.where(free, slots, -1 - np.arange(len(slots))), return_index=True)
            put = first[free[first]]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _HASH) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, -1 for none."""
        keys = left.astype(np.int64) * self.n_ids + right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], np.int32(-1))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class BpeEncoder:
    def __init__(self, model_file: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        plain = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.bytes_ = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unk = sp.unk_id()
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.table = PairTable({(plain[p[:k]], plain[p[k:]]): i for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain}, n)
        scores = np.array([sp.get_score(i) for i in range(n)])
        levels, self.rank = np.unique(-scores, return_inverse=True)
        self.rank = self.rank.astype(np.int32)
        ids = np.fromiter(plain.values(), np.int64)
        self.shared = np.bincount(self.rank[ids], minlength=len(levels)) > 1
        inner = any(p.lstrip(MARK).find(MARK) >= 0 for p in plain)
        run = max((len(p) for p in plain if not p.strip(MARK)), default=1)
        leads = any(p.startswith(MARK * 2) and p.strip(MARK) for p in plain)
        whole = run > 1 and not leads and self._ids(MARK * run) == [plain[MARK * run]]
        # Long runs of marks come apart into the longest run piece from the left, so they are cut there.
        runs = f"{MARK}{{{run}}}(?={MARK})|" if whole else ""
        inside = [p.lstrip(MARK) for p in plain]
        loose = {c for p in inside for c in p if len(p) > 1 and c.isalnum() and not (c.isalpha() or c.isdecimal())}
        kind = lambda c: c.isalnum() and c not in loose
        mixed = any(kind(a) != kind(c) for p in inside for a, c in zip(p, p[1:], strict=False))
        more = re.escape("".join(sorted(loose)))
        letters, other = f"[^\\W_{more}]", f"(?:[^\\w{MARK}]|[_{more}])"
        # No piece mixes letters or digits with other characters: words end there too.
        finer = f"{runs}{MARK}*{letters}+|{MARK}+{other}*|{other}+"
        self.words = (lambda text: [text]) if inner else re.compile(f"{runs}{MARK}+[^{MARK}]*|[^{MARK}]+" if mixed else finer).findall
        self.memo = Memo(MEMO_WORDS)

    def _ids(self, word: str) -> list[int]:
        return np.frombuffer(self._merge([word])[0], np.int32).tolist()

    def _merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as int32 bytes, from merge rounds over all of them at once."""
        size = np.fromiter(map(len, words), np.int32, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)
        sym = self.of_char[points]
        sym = np.where(sym < 0, ~points, sym)
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            near = np.flatnonzero((word[:-1] == word[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0))
            found = self.table.get(sym[near], sym[near + 1])
            near, found = near[found >= 0], found[found >= 0]
            if not len(near):
                break
            rank, of = self.rank[found], word[near]
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(near)]))
            best = np.flatnonzero(rank == low)
            at, found, rank, of = near[best], found[best], rank[best], of[best]
            opens = np.r_[True, at[1:] != at[:-1] + 1]  # runs of touching occurrences: every other one merges
            odd = (at - np.repeat(at[opens], np.diff(np.r_[np.flatnonzero(opens), len(at)]))) & 1
            take = (odd == 0) & (np.r_[True, of[1:] != of[:-1]] | ~self.shared[rank])  # pieces of equal score: only the leftmost
            at, found = at[take], found[take]
            sym[at] = found
            busy = np.zeros(len(words), bool)
            busy[of] = True
            stays = busy[word]
            if len(sym) > 2 * np.count_nonzero(stays):  # words without a pair leave the array
                done.append((word[~stays], sym[~stays]))
            else:
                stays[:] = True
            stays[at + 1] = False
            sym, word = sym[stays], word[stays]
        done.append((word, sym))
        word, sym = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        order = np.argsort(word, kind="stable")
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        raw = sym[order].tobytes()
        out = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        for k in np.unique(word[sym < 0]).tolist():
            out[k] = np.array([y for x in np.frombuffer(out[k], np.int32).tolist() for y in self._spell(x)], np.int32).tobytes()
        return out

    def _spell(self, symbol: int) -> list[int]:
        """A symbol's ids; one outside the vocabulary is spelled in bytes."""
        if symbol >= 0:
            return [symbol]
        raw = chr(~symbol).encode("utf-8", "surrogatepass")
        return [self.bytes_[b] for b in raw] if self.bytes_ else [self.unk]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.words(self.sp.normalize(t)) if t else [] for t in texts]
        learn = lambda fresh: [ids for k in range(0, len(fresh), BLOCK_WORDS) for ids in self._merge(fresh[k : k + BLOCK_WORDS])]
        get = self.memo.get(set().union(*cut), learn).__getitem__
        return [np.frombuffer(b"".join(map(get, words)), np.int32) for words in cut]

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids) if ids else ""


_HELD: dict[str, BpeEncoder] = {}


def encoder(model_file: str) -> BpeEncoder:
    """The worker's encoder of this model; tables are built once per Python worker."""
    if model_file not in _HELD:
        _HELD[model_file] = BpeEncoder(model_file)
    return _HELD[model_file]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))


def encoded(model_file: str, text: Column, with_decoded: bool = True) -> Column:
    """struct<ids array<int>, decoded string> of a text column; decoded is null unless asked for."""

    @F.arrow_udf("struct<ids array<int>, decoded string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(model_file)
        for batch in batches:
            ids = own.encode([t or "" for t in batch.to_pylist()])
            back = pa.array([own.decode(x.tolist()) for x in ids] if with_decoded else [None] * len(ids), pa.string())
            yield pa.StructArray.from_arrays([_lists(ids), back], ["ids", "decoded"])

    return run(text)


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", into: str = "pieces", with_decoded: bool = True) -> DataFrame:
    """All columns of docs, and the struct column `into` with ids and decoded."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, encoded(model_file, F.col(text), with_decoded))
