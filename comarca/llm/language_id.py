"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter 1- to 3-grams (lower case; what is not a letter is a space). Every
language has several centroids, from spherical k-means over its training vectors. The nearest centroid by cosine gives
the language and the score. A text is rejected where its best cosine is less than a share of what texts of that language and
of like length have (a low quantile, so that a few rows with a wrong label don't set it), or where it has no letter. Every
training text also counts by a piece of each lesser class of lengths, so that short classes are known however long the texts
are; a class with too few texts, as those beyond the longest training texts, has the limit of the nearest that has enough.

The model is fitted on a bounded sample of labelled rows (`SAMPLE_PER_LANGUAGE` of each language, by hash of the id);
prediction reads every whole text and nothing but the text.

Cases: a null text, or one without a letter, is `und`, with score 0, rejected. Equal cosines go to the language that
sorts first. Very long texts are read whole; repeated rows each get the same answer. Without labelled rows nothing is learned
and every text is `und`. An empty table gives an empty table.
Extra columns stay; one named like the new column is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import small_batches

UNDETERMINED = "und"
BITS = 13
#: Labelled rows of each language, at most, that a model is fitted on.
SAMPLE_PER_LANGUAGE = 1_000
CENTROIDS = 4
#: A text is rejected if its cosine is below this share of the low quantile of texts of its language and length.
REJECTED_BELOW = 0.5
LOW_QUANTILE = 0.05
#: Texts that a class of lengths needs for a limit of its own, and training texts of a language whose pieces are scored.
ENOUGH, PIECED = 30, 100
CLASSES = 40
_HELD: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _HELD:
        _HELD["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _HELD["letters"]


def grams(text: str | None) -> tuple[np.ndarray, int]:
    """Bucket of every 1- to 3-gram of a text, and its number of letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    n = int(np.count_nonzero(letter))
    if not n:
        return np.zeros(0, np.int64), 0
    points = np.where(letter, points, np.uint32(32))[letter | np.r_[True, letter[:-1]]]
    c = np.r_[np.uint32(32), points, np.uint32(32)].astype(np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return np.concatenate([(x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS) for x in (one, two, three)]).astype(np.int64), n


def counts(text: str | None) -> tuple[np.ndarray, int]:
    buckets, n = grams(text)
    return np.bincount(buckets, minlength=1 << BITS), n


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def clustered(rows: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """Unit centroids of unit rows."""
    centres = rows[np.random.default_rng(seed).permutation(len(rows))[:k]]
    for _ in range(rounds):
        home = np.argmax(rows @ centres.T, axis=1)
        centres = _unit(np.stack([rows[home == c].sum(axis=0) if (home == c).any() else centres[c] for c in range(len(centres))]))
    return centres


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    of: np.ndarray
    centres: np.ndarray
    weights: np.ndarray
    least: np.ndarray

    def vector(self, tally: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(tally) * self.weights)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)"""
        tally, n = counts(text)
        if not n or not self.languages:
            return UNDETERMINED, 0.0, True
        near = self.centres @ self.vector(tally)
        best = int(np.argmax(near))
        score = float(min(1.0, max(0.0, near[best])))
        return self.languages[self.of[best]], score, score < self.least[self.of[best], min(CLASSES - 1, n.bit_length())]


def pieces(text: str, n: int) -> list[str]:
    """For each class of lengths below that of a text of n letters, a piece of that many letters that begins with a word."""
    letter = np.array([c.isalpha() for c in text])
    starts = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
    upto = np.cumsum(letter)
    out, seed = [], zlib.crc32(text.encode("utf-8", "surrogatepass"))
    for b in range(n.bit_length() - 1):
        size = (1 << b) + seed % (1 << b)
        fits = starts[upto[starts] - 1 + size <= n]
        at = int(fits[seed % len(fits)])
        out.append(text[at : int(np.searchsorted(upto, upto[at] - 1 + size)) + 1])
    return out


def _tallies():
    """Buckets and counts as int32 bytes, of a text and of its pieces: the driver gets a few kB for each sampled text."""
    one = [("bucket", pa.binary()), ("tally", pa.binary()), ("letters", pa.int64())]
    kind = pa.struct([*one, ("pieces", pa.list_(pa.struct(one)))])

    def packed(t: str | None) -> dict:
        tally, n = counts(t)
        some = np.flatnonzero(tally)
        return {"bucket": some.astype(np.int32).tobytes(), "tally": tally[some].astype(np.int32).tobytes(), "letters": n}

    @F.arrow_udf("struct<bucket: binary, tally: binary, letters: long, pieces: array<struct<bucket: binary, tally: binary, letters: long>>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, pieced in batches:
            out = []
            for t, more in zip(texts.to_pylist(), pieced.to_pylist(), strict=True):
                own = packed(t)
                out.append(own | {"pieces": [packed(x) for x in pieces((t or "").lower(), own["letters"])] if more and own["letters"] else []})
            yield pa.array(out, kind)

    return run


def limits(seen: list[list[list[float]]]) -> np.ndarray:
    """The limit of each language and class of lengths, from the cosines seen in them."""
    low = lambda x: REJECTED_BELOW * float(np.quantile(x, LOW_QUANTILE, method="lower"))
    everyone = [[x for own in seen for x in own[b]] for b in range(CLASSES)]
    out = np.zeros((len(seen), CLASSES))
    for k, own in enumerate(seen):
        # A language with few texts takes the classes of all languages together; with few of these too, what there is.
        of = next((y for least in (ENOUGH, 1) for y in (own, everyone) if any(len(x) >= least for x in y)), [])
        known = [b for b, x in enumerate(of) if len(x) >= min(ENOUGH, max(map(len, of)))]
        for b in range(CLASSES if known else 0):
            out[k, b] = low(of[min(known, key=lambda c: (abs(c - b), c))])
    return out


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit on rows whose text and language are not null, at most per_language of each language, chosen by the hash of their id."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.xxhash64(F.col(doc_id), F.lit(11)).alias("h"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    whole = 1 << 30
    drawn = lambda most: reduce(or_, ((F.col("lang") == name) & (F.pmod("h", F.lit(whole)) < min(whole, int(whole * 1.2 * most / n))) for name, n in sizes.items()), F.lit(False))
    share, pieced = drawn(per_language), drawn(PIECED)
    sample = rows.where(share).select("lang", "h", _tallies()("text", pieced).alias("t")).select("lang", "h", "t.*").toArrow().sort_by([("lang", "ascending"), ("h", "ascending")]) if sizes else None
    taken: dict[str, list] = {}  # numbers of the sample's rows, whose counts stay in Arrow's buffers
    for k in range(sample.num_rows if sample else 0):
        if sample["letters"][k].as_py() and len(held := taken.setdefault(sample["lang"][k].as_py(), [])) < per_language:
            held.append(k)
    size, names = 1 << BITS, tuple(sorted(taken))
    pair = lambda x: (np.frombuffer(x["bucket"].as_buffer(), np.int32), np.frombuffer(x["tally"].as_buffer(), np.int32))
    of = lambda k: pair({c: sample[c][k] for c in ("bucket", "tally")})
    texts = np.zeros(size, np.int64)
    for name in names:
        for k in taken[name]:
            texts[of(k)[0]] += 1
    weights = (np.log((1 + sum(map(len, taken.values()))) / (1 + texts)) + 1).astype(np.float32)

    def units(name: str) -> np.ndarray:
        """The vectors of one language's texts; no more are held at a time."""
        out = np.zeros((len(taken[name]), size), np.float32)
        for row, k in zip(out, taken[name], strict=True):
            bucket, tally = of(k)
            row[bucket] = np.sqrt(tally) * weights[bucket]
            row /= max(float(np.linalg.norm(row)), 1e-12)
        return out

    centres = [clustered(units(name), centroids) for name in names]
    flat = np.concatenate(centres) if centres else np.zeros((0, size), np.float32)
    seen = [[[] for _ in range(CLASSES)] for _ in names]
    for own, name in zip(seen, names, strict=True):
        for k, x in zip(taken[name], (units(name) @ flat.T).max(axis=1), strict=True):
            own[int(sample["letters"][k].as_py()).bit_length()].append(x)
            for piece in sample["pieces"][k]:
                bucket, tally = pair(piece)
                v = np.sqrt(tally) * weights[bucket]
                own[int(piece["letters"].as_py()).bit_length()].append(float((flat[:, bucket] @ v).max() / np.linalg.norm(v)))
    least = limits(seen)
    return LanguageModel(names, np.repeat(np.arange(len(names)), [len(c) for c in centres]), flat.astype(np.float32), weights, least)


def predicted(model: LanguageModel, text: Column) -> Column:
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([dict(zip(("lang", "score", "rejected"), model.predict(t), strict=True)) for t in batch.to_pylist()], kind)

    return run(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text is a multiple of 5: rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", into: str = "language") -> DataFrame:
    """All columns of docs and the struct column `into` (lang, score, rejected)."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, predicted(model, F.col(text)))
