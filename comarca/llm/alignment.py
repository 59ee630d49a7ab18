"""Cross-tokenizer alignment: which tokens of one tokenizer overlap which of another, by a dictionary of groups.

A text's bytes are cut wherever a token of A and a token of B both end; what lies between two cuts is a group of A ids and
B ids, written `a1,a2|b1`. Tasks intern distinct groups in dictionaries: a block is a run of documents with a dictionary of its
own, and a document is the numbers of its groups and how often it has them. Links, the overlaps of a group's tokens, are expanded
once for each distinct group; an id pair's count is the number of documents that hold a group that links it, each document once.
The counts go back to the groups by the group's text, from there to each block's numbers, and a block's documents are weighted
with them by their frequencies. Neither groups nor links of single documents are ever shuffled.

Plain texts (Latin letters, ASCII digits, symbols, spaces and single line ends) are cut into units at whose ends both tokenizers
must cut: before a space after another character, after a word of letters and around a line end. Distinct units are encoded and
aligned once, many at a time, in flat arrays. All other texts, and tokenizers that work otherwise, go through the libraries whole.

Memory: a worker that holds UNITS units, GROUPS groups or WEIGHT characters of them starts anew after the batch; with that, or at
ENTRIES group entries, a block closes, so what meets in one task of the second pass is one block. Very long texts are whole.

Cases: a null or empty text, and one whose tokens of either side don't spell it, has no tokens, no groups and the digest ''.
Every row is a document, also one that shares its doc_id or has none. Ties for an id's highest count are all its best. An empty
table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from comarca.llm.common import Scratch, cut, small_batches
from comarca.llm.sentencepiece_bpe import MARK, BpeEncoder
from comarca.llm.token_files import _LETTERS, _SYMBOLS

#: Units, groups and characters of a worker's units at which it starts anew; entries (documents' distinct groups) at which a block closes.
UNITS, GROUPS, WEIGHT, ENTRIES = 300_000, 300_000, 25_000_000, 1_500_000
#: New units that are encoded and aligned at once.
MANY = 8192
_ODD = re.compile(f"[^ \\n0-9{_LETTERS}{_SYMBOLS}]|{MARK}")
#: Words of letters with the space before them; other characters with all up to the next white space; line ends; longer white space.
_FINE = f" ?[{_LETTERS}]+| ?[^\\s{_LETTERS}]\\S*|\\n(?=\\S)|\\s+\\S*"
_COARSE = " ?\\S+|\\n(?=\\S)|\\s+\\S*"
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
#: Rows of the written table: a document (digest), a block's group (key) or an id pair's documents in a block (a, b, n).
BLOCK_SCHEMA = f"block long, {DIGEST}, at binary, times binary, number int, key string, a int, b int, n long"


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes for code points from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _spelled(pieces: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    return pieces, np.fromiter(map(len, pieces), np.int64, len(pieces))


class Aligner:
    """Both tokenizers, and the units and groups that the worker has seen since the last reset."""

    def __init__(self, a_file: str, b_file: str):
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        of = byte_level_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        spell = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            spell[k] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.a_bytes, self.a_size = _spelled(spell)
        self.bpe = BpeEncoder(b_file)
        self.b: sentencepiece.SentencePieceProcessor = self.bpe.sp
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes, self.b_size = _spelled([bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)])
        self.n_b = len(pieces)
        self.split = self._splitter([p for k, p in enumerate(pieces) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k))])
        self.reset()
        probe = "It's 42% of THE l'Été —  naïve_x!! don't we'LL ß ÀB\n(12)'d\n\n a\n b  \nc-d;e  "
        if self.split and self._by_units([probe])[0] != self._whole(probe):
            self.split = None
        self.reset()

    def _splitter(self, pieces: list[str]):
        """findall of units, if both tokenizers surely cut at their ends."""
        before = self.a.pre_tokenizer
        plain_a = self.a.normalizer is None and isinstance(before, pre_tokenizers.ByteLevel) and not before.add_prefix_space and getattr(before, "use_regex", True)
        probe = "A ﬁ  é\n²"
        inner = any(MARK in p.lstrip(MARK) or ("\n" in p) or (" " in p) for p in pieces)
        if not plain_a or inner or self.b.normalize(probe) != MARK + probe.replace(" ", MARK) or not self.bpe.bytes_:
            return None
        letter = re.compile(f"[{_LETTERS}][^{_LETTERS}{MARK}]")
        return re.compile(_COARSE if any(letter.search(p) for p in pieces) else _FINE).findall

    def reset(self) -> None:
        self.unit: dict[str, int] = {}  # unit -> number; -1: its tokens don't spell it
        self.weight = 0  # characters of what is kept
        self.told: list[str] = []  # groups of a unit, as they are written
        self.sums = np.zeros((0, 4), np.int64)  # of a unit: A tokens, B tokens, groups, links
        self.first = np.zeros(1, np.int64)  # a unit's groups: those of `groups` from first[k] to first[k + 1]
        self.groups = np.zeros(0, np.int64)
        self.group: dict[str, int] = {}
        self.keys: list[str] = []
        self.link_first = np.zeros(1, np.int64)  # a group's distinct links, likewise
        self.links = np.zeros(0, np.int64)

    def _add(self, texts: list[bytes], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[int]:
        """Align the tokens of texts; the numbers of new units, -1 where tokens don't spell a text."""
        good = [b"".join(map(self.a_bytes.__getitem__, a)) == t == b"".join(map(self.b_bytes.__getitem__, b)) and t != b"" for t, a, b in zip(texts, a_ids, b_ids, strict=True)]
        size = np.array([len(t) for t, g in zip(texts, good, strict=True) if g], np.int64)
        pick = lambda lists: [x for x, g in zip(lists, good, strict=True) if g]
        n_a, n_b = (np.fromiter(map(len, pick(x)), np.int64, len(size)) for x in (a_ids, b_ids))
        a, b = (np.fromiter((k for ids in pick(x) for k in ids), np.int64) for x in (a_ids, b_ids))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.intersect1d(a_end, b_end)
        a_cut, b_cut = np.searchsorted(a_end, ends, "right"), np.searchsorted(b_end, ends, "right")  # tokens of no bytes belong before the cut
        last = np.searchsorted(ends, np.cumsum(size), "left") + 1  # groups up to the end of each text
        n_groups = np.diff(last, prepend=0)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        i = j = 0
        written, fresh = [], []
        for k, (x, y) in enumerate(zip(a_cut.tolist(), b_cut.tolist(), strict=True)):
            key = f"{a_text[i]}|{b_text[j]}" if x == i + 1 and y == j + 1 else f"{','.join(a_text[i:x])}|{','.join(b_text[j:y])}"
            if key not in self.group:
                self.group[key] = len(self.keys)
                self.keys.append(key)
                fresh.append(k)
            written.append(key)
            i, j = x, y
        self._link(fresh, a, b, a_end, b_end, a_cut, b_cut)
        base, at = len(self.told), np.r_[0, last].tolist()
        self.told += [";".join(written[x:y]) for x, y in zip(at, at[1:], strict=False)]
        self.weight += sum(map(len, self.told[base:])) + sum(map(len, texts))
        self.groups = np.r_[self.groups, np.fromiter(map(self.group.__getitem__, written), np.int64, len(written))]
        self.first = np.r_[self.first, self.first[-1] + last]
        self.sums = np.r_[self.sums, np.stack([n_a, n_b, n_groups, n_a + n_b - n_groups], 1)]  # links of a group: its tokens less one
        number = iter(range(base, len(self.told)))
        return [next(number) if g else -1 for g in good]

    def _link(self, fresh: list[int], a, b, a_end, b_end, a_cut, b_cut) -> None:
        """The distinct links of groups that are new: between two cuts, every end of a token takes that side a token on."""
        if not fresh:
            return
        out: list[int] = []
        ends = []
        a_from, b_from = np.r_[0, a_cut[:-1]][fresh].tolist(), np.r_[0, b_cut[:-1]][fresh].tolist()
        for i, j, x, y in zip(a_from, b_from, a_cut[fresh].tolist(), b_cut[fresh].tolist(), strict=True):
            if x == i + 1 and y == j + 1:
                out.append(int(a[i]) * self.n_b + int(b[j]))
            elif x == i + 1 or y == j + 1:
                out += set((a[i:x] * self.n_b + b[j:y]).tolist())
            else:
                out += set((_overlaps(a[i:x], b[j:y], a_end[i:x], b_end[j:y]) @ np.array([self.n_b, 1])).tolist())
            ends.append(len(out))
        self.links = np.r_[self.links, np.array(out, np.int64)]
        self.link_first = np.r_[self.link_first, self.link_first[-1] + np.array(ends, np.int64)]

    def _learn(self, units: list[str]) -> None:
        for k in range(0, len(units), MANY):
            some = units[k : k + MANY]
            a = [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            b = [np.frombuffer(x, np.int32).tolist() for x in self.bpe._merge([u.replace(" ", MARK) for u in some])]
            self.unit.update(zip(some, self._add([u.encode() for u in some], a, b), strict=True))

    def _by_units(self, texts: list[str]) -> list[str | None]:
        """The groups of each text as written, by its units (for the probe)."""
        cut_ = [self.split(" " + t) for t in texts]
        self._learn([u for u in set().union(*cut_) if u not in self.unit])
        return [";".join(self.told[self.unit[u]] for u in units) if all(self.unit[u] >= 0 for u in units) else None for units in cut_]

    def _whole_numbers(self, texts: list[str]) -> list[int]:
        """The numbers of texts that go through the libraries whole; -1 for those without tokens."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return self._add([b" " + t.encode() for t in texts], a, self.b.encode(texts, num_threads=1))

    def _whole(self, text: str) -> str | None:
        (k,) = self._whole_numbers([text])
        return None if k < 0 else self.told[k]

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's units, in order; none for a text without tokens."""
        plain = [bool(t) and self.split is not None and not _ODD.search(t) for t in texts]
        units = [self.split(" " + t) if p else [] for t, p in zip(texts, plain, strict=True)]
        self._learn([u for u in set().union(*units) if u not in self.unit])
        out = [np.fromiter(map(self.unit.__getitem__, own), np.int64, len(own)) for own in units]
        whole = [k for k, text in enumerate(texts) if text and (not plain[k] or (out[k] < 0).any())]
        for k, number in zip(whole, self._whole_numbers([texts[k] for k in whole]) if whole else [], strict=True):
            out[k] = np.array([number] if number >= 0 else [], np.int64)
        return out

    def full(self) -> bool:
        return len(self.keys) >= GROUPS or len(self.told) >= UNITS or self.weight >= WEIGHT

    def entries(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the text, group and its frequency there, for each text's distinct groups; sorted."""
        units = np.concatenate([np.zeros(0, np.int64), *numbers])
        place = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
        n = self.first[units + 1] - self.first[units]
        at = np.repeat(self.first[units] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both, times = np.unique(np.repeat(place, n) * len(self.keys) + self.groups[at], return_counts=True)
        return *np.divmod(both, max(1, len(self.keys))), times

    def pairs(self, place: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct links of all groups, as a * n_b + b, and how many texts hold each."""
        n = self.link_first[group + 1] - self.link_first[group]
        at = np.repeat(self.link_first[group] - np.cumsum(n) + n, n) + np.arange(n.sum())
        codes, number = np.unique(self.links[at], return_inverse=True)
        held = np.unique(np.repeat(place, n) * max(1, len(codes)) + number)
        return codes, np.bincount(held % max(1, len(codes)), minlength=len(codes))


def _overlaps(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """(a, b) of all pairs of tokens of one group whose bytes overlap."""
    a_start, b_start = np.r_[-1, a_end[:-1]], np.r_[-1, b_end[:-1]]
    start = min(a_end[0], b_end[0]) - 1
    a_start[0] = b_start[0] = start
    low = np.searchsorted(b_end, a_start, "right")  # the first of B that ends after the token of A starts
    high = np.searchsorted(b_start, a_end, "left")  # the first that starts where it has ended
    n = np.maximum(high - low, 0)
    at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.stack([np.repeat(a, n), b[at]], 1)


_HELD: dict[tuple[str, str], Aligner] = {}


def aligner(a_file: str, b_file: str) -> Aligner:
    if (a_file, b_file) not in _HELD:
        _HELD[a_file, b_file] = Aligner(a_file, b_file)
    return _HELD[a_file, b_file]


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_FIELDS = {name: _TYPES[kind] for name, kind in (x.split(" ") for x in BLOCK_SCHEMA.split(", "))}


def _rows(rows: int, **columns) -> pa.RecordBatch:
    """A batch of rows of the written table; columns that are not given are null."""
    made = [pa.nulls(rows, kind) if name not in columns else pa.array(columns[name], kind) for name, kind in _FIELDS.items()]
    return pa.RecordBatch.from_arrays(made, list(_FIELDS))


def _write_blocks(a_file: str, b_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(a_file, b_file), TaskContext.get().partitionId() << 32
        digests: list[tuple] = []
        places, groups, times, links = [], [], [], {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, links
            place, group, often = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (places, groups, times))
            used, number = np.unique(group, return_inverse=True)
            ends = np.searchsorted(place, np.arange(len(digests) + 1))
            cuts = list(zip(ends.tolist(), ends[1:].tolist(), strict=False))
            raw = lambda x: [x[i:j].astype("<u4").tobytes() for i, j in cuts]
            at, often = raw(number), raw(often)
            for k in range(0, len(digests), 200):
                some = digests[k : k + 200]
                named = dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*some, strict=True), strict=True))
                yield _rows(len(some), block=[block] * len(some), at=at[k : k + 200], times=often[k : k + 200], **named)
            for k in range(0, len(used), 50_000):
                some = used[k : k + 50_000].tolist()
                yield _rows(len(some), block=[block] * len(some), number=range(k, k + len(some)), key=[own.keys[g] for g in some])
            codes = np.fromiter(links, np.int64, len(links))
            held = np.fromiter(links.values(), np.int64, len(links))
            for k in range(0, len(codes), 50_000):
                a, b = np.divmod(codes[k : k + 50_000], own.n_b)
                yield _rows(len(a), block=np.full(len(a), block), a=a.astype(np.int32), b=b.astype(np.int32), n=held[k : k + 50_000])
            block, links = block + 1, {}
            for x in (digests, places, groups, times):
                x.clear()

        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            numbers = own.numbers(texts)
            base = len(digests)
            for doc, units in zip(ids, numbers, strict=True):
                sums = own.sums[units].sum(0).tolist()
                sha = hashlib.sha256(";".join(map(own.told.__getitem__, units.tolist())).encode()).hexdigest() if len(units) else ""
                digests.append((doc, *sums, sha))
            place, group, often = own.entries(numbers)
            codes, held = own.pairs(place, group)
            for c, n in zip(codes.tolist(), held.tolist(), strict=True):
                links[c] = links.get(c, 0) + n
            places.append(place + base)
            groups.append(group)
            times.append(often)
            if sum(map(len, groups)) >= ENTRIES or own.full():
                yield from flush()
                if own.full():
                    own.reset()
        if digests:
            yield from flush()

    return run


class Alignment:
    """The written blocks of a corpus, and what is derived from them; tables live in the scratch folder given."""

    def __init__(self, scratch: Scratch, docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text"):
        small_batches(docs.sparkSession, 200)
        self.files, self.scratch = (a_file, b_file), scratch
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        self.blocks = scratch.cut(rows.mapInArrow(_write_blocks(a_file, b_file), BLOCK_SCHEMA))

    def documents(self) -> DataFrame:
        return self.blocks.where(F.col("groups_sha256").isNotNull()).select("block", *[x.split(" ")[0] for x in DIGEST.split(", ")], "at", "times")

    def groups(self) -> DataFrame:
        return self.blocks.where(F.col("key").isNotNull()).select("block", "number", "key")

    def pair_counts(self) -> DataFrame:
        """a, b, docs (documents that hold the pair linked), best (whether it is the most that any pair with this a has)."""
        counted = self.scratch.cut(self.blocks.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.sum("n").alias("docs")))
        most = counted.groupBy("a").agg(F.max("docs").alias("most"))
        return counted.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))

    def group_counts(self) -> DataFrame:
        """key, best (its links whose pair is its a's best) and count_sum (over its links)."""
        links = self.groups().select("key").distinct().mapInArrow(_expand(*self.files), "key string, a int, b int, times long")
        counted = links.join(self.pair_counts(), ["a", "b"])
        best = F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long"))
        return counted.groupBy("key").agg(F.sum(best).alias("best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))

    def weighted(self) -> DataFrame:
        """The documents' digests with n_best and count_sum."""
        known = self.groups().join(self.group_counts(), "key").select(F.col("block").alias("in_block"), "number", "best", "count_sum")
        return known.groupBy("in_block").cogroup(self.documents().groupBy("block")).applyInArrow(_weigh, f"{DIGEST}, n_best long, count_sum long")


def _expand(a_file: str, b_file: str):
    """The links of each group's text, with how often the group has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_file, b_file)
        kind = pa.schema([("key", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())])
        for batch in batches:
            keys = batch.column(0).to_pylist()
            found: list[tuple[str, int, int]] = []
            for key in keys:
                left, right = key.split("|")
                if "," not in left or "," not in right:
                    found += [(key, int(x), int(y)) for x in left.split(",") for y in right.split(",")]
                else:
                    a, b = (np.array(x.split(","), np.int64) for x in (left, right))
                    found += [(key, x, y) for x, y in _overlaps(a, b, np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b])).tolist()]
            seen: dict[tuple[str, int, int], int] = {}
            for x in found:
                seen[x] = seen.get(x, 0) + 1
            if seen:
                text, a, b = zip(*seen, strict=True)
                yield pa.record_batch([pa.array(text), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(seen.values(), pa.int64())], schema=kind)

    return run


def _weigh(known: pa.Table, docs: pa.Table) -> pa.Table:
    """A block's documents with the sums of their groups' figures, by the groups' numbers in the block."""
    number = known["number"].to_numpy()
    best, total = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    best[number], total[number] = known["best"].to_numpy(), known["count_sum"].to_numpy()
    sums: list[list[int]] = [[], []]
    for at, times in zip(docs["at"].to_pylist(), docs["times"].to_pylist(), strict=True):
        at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        sums[0].append(int(times @ best[at]))
        sums[1].append(int(times @ total[at]))
    told = docs.select([x.split(" ")[0] for x in DIGEST.split(", ")])
    return told.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def align_documents(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    with Scratch(docs.sparkSession, "alignment") as scratch:
        return cut(Alignment(scratch, docs, a_file, b_file, doc_id, text).weighted())


def id_pairs(docs: DataFrame, a_file: str, b_file: str, text: str = "text") -> DataFrame:
    """The map between the vocabularies: a, b, docs, best."""
    with Scratch(docs.sparkSession, "alignment") as scratch:
        return cut(Alignment(scratch, docs.withColumn("__id", F.lit(0)), a_file, b_file, "__id", text).pair_counts())
