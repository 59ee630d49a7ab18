"""Ordinal quality grades by cumulative-link regression.

P(grade <= j) = sigmoid(threshold_j - w.x) with one weight vector w over hashed text features and ordered thresholds.
Features are words (lower case), runs of symbols, and a few shapes of the text (how many words repeat, are in capitals,
are single symbols; all in coarse steps), hashed into 2^BITS weights; a feature counts log2(1 + occurrences). The expected
grade and the tail probability P(grade >= g) come from the same thresholds; selection compares the tail with a limit.

The model is fitted on a bounded sample of rated rows (`SAMPLE_ROWS`, by hash of the id); grading reads every whole text.

Cases: a null or empty text has the shape features alone. Without rated rows, or with one grade only, every text gets
that grade (0) with certainty. Very long texts are read whole. Ties and repeated rows change nothing; an empty table gives an empty table. Extra columns
stay; one named like the new column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import small_batches

BITS = 18
#: Rated rows, at most, that a model is fitted on.
SAMPLE_ROWS = 8_000
#: A bucket gets a weight if so many sampled texts hold it.
LEAST_TEXTS = 5
PENALTY = 3.0
#: Least tail probability of the top grade at which a text is kept.
KEEP = 0.3
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")


def _step(x: float) -> int:
    return int(round(10 * x))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values), one entry for each bucket."""
    whole = text or ""
    tokens = _TOKEN.findall(whole)
    words = whole.split()
    n = max(1, len(words))
    tally = Counter(t.lower() for t in tokens)
    most = max(Counter(words).values(), default=0)
    lines = [x for x in whole.split("\n") if x]
    shapes = {
        f"\0most {_step(most / n)}": 1, f"\0repeat {_step(1 - len(set(words)) / n)}": 1, f"\0lines {_step(1 - len(set(lines)) / max(1, len(lines)))}": 1,
        f"\0capitals {_step(sum(w.isupper() for w in words) / n)}": 1, f"\0symbols {_step(sum(not t[0].isalpha() for t in tokens) / max(1, len(tokens)))}": 1, f"\0size {min(4, n.bit_length())}": 1,
    }
    tally.update(shapes)
    mask = (1 << BITS) - 1
    buckets = np.fromiter((xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) & mask for t in tally), np.int64, len(tally))
    values = np.log2(1 + np.fromiter(tally.values(), np.float64, len(tally)))
    buckets, at = np.unique(buckets, return_inverse=True)
    return buckets, np.bincount(at, values)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str | None) -> np.ndarray:
        """P(grade >= g) for g = 1, 2, ..."""
        buckets, values = features(text)
        return _sigmoid(self.weights[buckets] @ values - self.thresholds) if len(self.thresholds) else np.zeros(0)


def _loss(w, t, rows, cols, vals, grade, n, size, penalty):
    """Negative log likelihood of the grades and its gradient."""
    s = np.bincount(rows, vals * w[cols], minlength=n)
    upper, lower = np.r_[t, np.inf][grade], np.r_[-np.inf, t][grade]
    pu, pl = _sigmoid(upper - s), _sigmoid(lower - s)
    p = np.maximum(pu - pl, 1e-12)
    du, dl = pu * (1 - pu), pl * (1 - pl)
    gs = (du - dl) / p
    gw = np.bincount(cols, vals * gs[rows], minlength=size) + penalty * w
    gt = np.array([(dl[grade == j + 1] / p[grade == j + 1]).sum() - (du[grade == j] / p[grade == j]).sum() for j in range(len(t))])
    return -np.log(p).sum() + 0.5 * penalty * (w @ w), gw, gt


def fitted(samples: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, rounds: int = 300, penalty: float = PENALTY) -> OrdinalModel:
    """Adam on the whole sample; thresholds are kept in order by their gaps' logarithms."""
    top, size = int(grade.max()) if len(grade) else 0, 1 << BITS
    if not top:
        return OrdinalModel(np.zeros(size, np.float32), np.zeros(0))
    rows = np.repeat(np.arange(len(samples)), [len(b) for b, _ in samples])
    cols, vals = np.concatenate([b for b, _ in samples]), np.concatenate([v for _, v in samples])
    used = np.bincount(cols, minlength=size) >= LEAST_TEXTS
    rows, vals, cols = rows[used[cols]], vals[used[cols]], cols[used[cols]]
    own, cols = np.unique(cols, return_inverse=True)
    share = np.clip(np.array([(grade <= j).mean() for j in range(top)]), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    x = np.r_[np.zeros(len(own)), start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    m, v = np.zeros_like(x), np.zeros_like(x)
    for k in range(1, rounds + 1):
        w, a = x[: len(own)], x[len(own) :]
        t = np.cumsum(np.r_[a[0], np.exp(a[1:])])
        _, gw, gt = _loss(w, t, rows, cols, vals, grade, len(samples), len(own), penalty)
        later = np.cumsum(gt[::-1])[::-1]
        g = np.r_[gw, later[0], later[1:] * np.exp(a[1:])]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - 0.1 * 0.99**k * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9) if k < rounds else x
    a = x[len(own) :]
    weights = np.zeros(size, np.float32)
    weights[own] = x[: len(own)]
    return OrdinalModel(weights, np.cumsum(np.r_[a[0], np.exp(a[1:])]))


def _features_udf():
    kind = pa.struct([("bucket", pa.binary()), ("value", pa.binary())])

    @F.arrow_udf("struct<bucket: binary, value: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([{"bucket": b.astype(np.int32).tobytes(), "value": v.astype(np.float32).tobytes()} for b, v in map(features, batch.to_pylist())], kind)

    return run


def fit(rated: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on rows with a grade of 0, 1, ...; at most sample_rows of them, chosen by the hash of their id."""
    small_batches(rated.sparkSession)
    rows = rated.where(F.col(grade).isNotNull()).select(F.xxhash64(F.col(doc_id), F.lit(5)).alias("h"), F.col(text).alias("text"), F.col(grade).cast("int").alias("grade"))
    n, whole = rows.count(), 1 << 30
    some = rows.where(F.pmod("h", F.lit(whole)) < min(whole, int(whole * 1.1 * sample_rows / max(1, n))))
    got = sorted(some.select("h", "grade", _features_udf()("text").alias("f")).collect(), key=lambda r: (r["h"], r["grade"]))[:sample_rows]
    samples = [(np.frombuffer(r["f"]["bucket"], np.int32).astype(np.int64), np.frombuffer(r["f"]["value"], np.float32).astype(np.float64)) for r in got]
    return fitted(samples, np.array([r["grade"] for r in got], np.int64))


def graded(model: OrdinalModel, text: Column) -> Column:
    kind = pa.struct([("expected", pa.float64()), ("tails", pa.list_(pa.float64()))])

    @F.arrow_udf("struct<expected: double, tails: array<double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            tails = [model.tails(t) for t in batch.to_pylist()]
            yield pa.array([{"expected": float(t.sum()), "tails": t.tolist()} for t in tails], kind)

    return run(text)


def grade_documents(docs: DataFrame, model: OrdinalModel, text: str = "text", into: str = "grade") -> DataFrame:
    """All columns of docs and the struct column `into`: expected grade, and tails[g-1] = P(grade >= g)."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, graded(model, F.col(text)))
