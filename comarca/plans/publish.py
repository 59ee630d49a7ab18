"""Write, audit, publish: a version is written whole, audited as it was written, and only then pointed to.

Pointers are small numbered documents; the last one that reads whole counts. So readers see the last good version until a better
one is complete, a lot that fails its audit leaves nothing but a status, and a run that dies in between leaves no trace to readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca import dims
from comarca.files import listed, read_text, write_text
from comarca.plans import rollups

#: An audit makes one row of the version's frames: ok, and what it found in words.
Audit = Callable[[Mapping[str, DataFrame]], DataFrame]
STATUS = "version string, audit string, ok boolean, told string"


def version_path(folder: str, version: str) -> str:
    return f"{folder}/version={version}"


def pointed(spark: SparkSession, folder: str) -> dict | None:
    """The last pointer: version and those before it; none where nothing was published."""
    for name, *_ in reversed(listed(spark, f"{folder}/_pointers")):
        try:
            return json.loads(read_text(spark, f"{folder}/_pointers/{name}") or "")
        except ValueError:  # cut off while it was written: the one before counts
            continue
    return None


def current(spark: SparkSession, folder: str) -> str | None:
    """The path of the version that counts."""
    pointer = pointed(spark, folder)
    return pointer and version_path(folder, pointer["version"])


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A dataset of the version that counts."""
    path = current(spark, folder)
    if path is None:
        raise FileNotFoundError(f"nothing was published in {folder}")
    return spark.read.parquet(f"{path}/{name}")


def settle(spark: SparkSession, folder: str, version: str, verdicts: DataFrame) -> bool:
    """Keep the verdicts (STATUS) as status rows, and point to the version if all are good. Doing it again for the version that counts changes nothing."""
    rows = verdicts.select(*[x.split(" ")[0] for x in STATUS.split(", ")]).collect()  # a row for each audit
    good = bool(rows) and all(r["ok"] for r in rows)
    write_text(spark, f"{folder}/_status/{version}.json", "".join(json.dumps(r.asDict(), ensure_ascii=False) + "\n" for r in rows))
    last = pointed(spark, folder)
    if good and (last is None or last["version"] != version):
        n = 1 + max((int(name.split(".")[0]) for name, *_ in listed(spark, f"{folder}/_pointers")), default=0)
        write_text(spark, f"{folder}/_pointers/{n:012d}.json", json.dumps({"version": version, "before": last and last["version"]}))
    return good


def status(spark: SparkSession, folder: str) -> DataFrame:
    """The status rows of all versions that were tried."""
    if not listed(spark, f"{folder}/_status"):
        return spark.createDataFrame([], STATUS)
    return spark.read.schema(STATUS).json(f"{folder}/_status")


def audited(frames: Mapping[str, DataFrame], version: str, audits: Mapping[str, Audit]) -> DataFrame:
    """A status row for each audit."""
    own = [audit(frames).select(F.lit(version).alias("version"), F.lit(name).alias("audit"), F.coalesce("ok", F.lit(False)).alias("ok"), F.col("told").cast("string").alias("told")) for name, audit in audits.items()]
    out = own[0]
    for more in own[1:]:
        out = out.unionByName(more)
    return out


def publish(spark: SparkSession, frames: Mapping[str, DataFrame], folder: str, version: str, audits: Mapping[str, Audit]) -> bool:
    """Write the frames as a version, audit what was written, and publish it if every audit is passed. The version that counts is never written over."""
    pointer = pointed(spark, folder)
    if pointer and pointer["version"] == version:
        raise ValueError(f"version {version} is published")
    path = version_path(folder, version)
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
    back = {name: spark.read.schema(frame.schema).parquet(f"{path}/{name}") for name, frame in frames.items()}
    return settle(spark, folder, version, audited(back, version, audits))


def covers(name: str, least: int = dims.LEAST_COMMUNES, code: str = "commune_code") -> Audit:
    """Enough distinct communes."""
    n = F.countDistinct(F.nullif(F.col(code).cast("string"), F.lit("")))
    return lambda frames: frames[name].agg((n >= least).alias("ok"), F.format_string(f"%d of at least {least} communes", n).alias("told"))


def totals_hold(name: str, expected: DataFrame, keys: Sequence[str], value: str = "value") -> Audit:
    """No key's sum differs from the expected one."""
    return lambda frames: rollups.control_totals(frames[name], expected, keys, value).agg((F.count("*") == 0).alias("ok"), F.format_string("%d keys miss their total", F.count("*")).alias("told"))
