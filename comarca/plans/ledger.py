"""A ledger of runs: inputs by their content, outputs by the inputs that they were made of. What no changed input leads to is not made again.

An input that lies as it lay (names, sizes, times of change) is taken for unchanged without being read; any other is hashed by
Spark, as a bag of lines, so a copy of the same lines is no change.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from comarca.files import listed, read_text, write_text


def load(spark: SparkSession, path: str) -> dict:
    """{inputs: name -> {listing, digest}, outputs: name -> {of: input -> digest, path, schema}, ...}; empty where there is none."""
    try:
        return json.loads(read_text(spark, path) or "")
    except ValueError:
        return {"inputs": {}, "outputs": {}}


def save(spark: SparkSession, path: str, ledger: dict) -> None:
    write_text(spark, path, json.dumps(ledger, ensure_ascii=False, indent=1) + "\n")


def digest(spark: SparkSession, path: str) -> str:
    """Of the lines at a path, whatever their order; `absent` where there is nothing."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return "absent"
    of = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")), F.lit(0))
    return "-".join(map(str, lines.agg(F.count("*"), of(1), of(2)).first()))


def inputs(spark: SparkSession, paths: Mapping[str, str], known: Mapping[str, dict]) -> dict[str, dict]:
    out = {}
    for name, path in paths.items():
        listing = hashlib.sha256(json.dumps(listed(spark, path)).encode()).hexdigest()
        before = known.get(name, {})
        out[name] = {"listing": listing, "digest": before["digest"] if before.get("listing") == listing else digest(spark, path)}
    return out


def unchanged(ledger: Mapping, name: str, of: Sequence[str], now: Mapping[str, dict]) -> dict | None:
    """The entry of an output that was made of the same inputs, as they are now."""
    entry = ledger.get("outputs", {}).get(name)
    return entry if entry and entry["of"] == {i: now[i]["digest"] for i in of} else None
