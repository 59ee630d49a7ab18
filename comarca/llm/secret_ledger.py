"""Secret scans through an incremental blob ledger.

A text is a blob, addressed by its SHA-256. The ledger is a written table of (blob, rule version, spans): only blobs
that it lacks for this rule version are scanned, each once however many documents hold it, and appended. The findings
then join back to every document that holds the blob, in any version of the corpus.

Cases: a null text is the empty blob. A document without findings has an empty list. Repeated rows each get their
findings. Very long texts are scanned whole. An empty table adds nothing to the ledger. Extra columns stay as they are;
one named like the new column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.common import cut, small_batches

SPAN = "struct<kind:string,start:int,end:int,from:int>"
LEDGER = f"blob string, rules string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """kind; pattern; group whose length counts and which holds the secret; its least length; words of which a text must hold one, in lower case."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0
    needs: tuple[str, ...] = ()


#: Kinds in the order in which spans of one start are listed. The first three are the base kinds.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.I | re.A, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, re.A, ("akia",)),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, re.A),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, re.A, ("private key",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{30,}", 0, 34, re.A, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, re.A, ("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20, re.A, ("eyj",)),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 0, 39, re.A, ("aiza",)),
)
BASE = ("assign", "access", "hex")
RULE_VERSION = "1"


def find(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) by start, then kind as listed; code points."""
    lower, out = text.lower(), []
    for k, (rule, pattern) in enumerate(rules):
        if not rule.needs or any(n in lower for n in rule.needs):
            out += [(m.start(), k, m.end(), m.start(rule.group)) for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
    return [(rules[k][0].kind, a, b, c) for a, k, b, c in sorted(out)]


def _scan(rules: tuple[Rule, ...]):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("from", pa.int32())]))

    @F.arrow_udf(f"array<{SPAN}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = [(r, re.compile(r.pattern, r.flags)) for r in rules]
        for batch in batches:
            yield pa.array([[{"kind": k, "start": a, "end": b, "from": c} for k, a, b, c in find(t or "", compiled)] for t in batch.to_pylist()], kind)

    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(blobs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION) -> None:
    """blobs: columns blob and text. Scan those that the ledger lacks at this rule version, once each, and append them."""
    small_batches(blobs.sparkSession)
    seen = read_ledger(blobs.sparkSession, path).where(F.col("rules") == version).select("blob")
    unseen = blobs.dropDuplicates(["blob"]).join(seen, "blob", "left_anti")  # copies go before the shuffle, in every task
    unseen.select("blob", F.lit(version).alias("rules"), _scan(rules)(F.col("text")).alias("spans")).write.mode("append").parquet(path)


def scan_documents(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION, text: str = "text", into: str = "spans") -> DataFrame:
    """All columns of docs and the array column `into` with the spans of the text; the ledger at `path` is brought up to date first."""
    whole = F.coalesce(F.col(text), F.lit(""))
    blob = F.sha2(whole, 256)
    update_ledger(docs.select(blob.alias("blob"), whole.alias("text")), path, rules, version)
    # Cut off, so that the join stands on two exchanges of its own and can split a text that many documents share.
    found = cut(read_ledger(docs.sparkSession, path).where((F.col("rules") == version) & (F.size("spans") > 0)).dropDuplicates(["blob"]).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")))
    joined = docs.withColumn("__key", blob).join(found, F.col("__key") == F.col("__blob"), "left")
    none = F.array().cast(f"array<{SPAN}>")
    return joined.select(*[joined[f"`{c}`"] for c in docs.columns if c != into], F.coalesce("__spans", none).alias(into))


def joined_spans(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end, comma-joined, of a spans column."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text, spans, mark: str = "[secret]"):
    """The text with every secret (a span from its secret part on) replaced by a mark; overlapping spans merge into one."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda s, x: F.when(
        x["from"] >= s["at"],
        F.struct(F.concat(s["out"], F.substring(text, s["at"] + 1, x["from"] - s["at"]), F.lit(mark)).alias("out"), x["end"].alias("at")),
    ).otherwise(F.struct(s["out"].alias("out"), F.greatest(s["at"], x["end"]).alias("at")))
    # Spans in order of the secret's own start, since a wider match may begin earlier than its secret.
    ordered = F.array_sort(spans, lambda a, b: F.when(a["from"] != b["from"], a["from"] - b["from"]).otherwise(b["end"] - a["end"]))
    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, state, step, rest))
