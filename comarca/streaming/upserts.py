"""The annual cache kept up from a stream of monthly or annual rows: each batch is an upsert into a new version.

The cache lies in buckets of its key. A version is a manifest, which says for each bucket the batch that wrote it last; batch n
rewrites the buckets that its keys fall into and takes over all others by name, so what it writes follows the batch and not the
cache. The manifest is written last: a batch that died, or runs again, is written anew from version n - 1.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.files import delete, listed, read_text, write_text
from comarca.operators.merge import cache_keys, upserted

BUCKETS = 64


def _bucket(keys: Sequence[str | Column] | None, buckets: int) -> Column:
    own = [F.col(k) if isinstance(k, str) else k for k in keys] if keys is not None else cache_keys()
    return F.pmod(F.xxhash64(*own), F.lit(buckets)).cast("int")


def _manifest_path(folder: str, version: int) -> str:
    return f"{folder}/manifests/{version:012d}.json"


def _bucket_path(folder: str, version: int, bucket: int) -> str:
    return f"{folder}/data/version={version:012d}/__bucket={bucket}"


def manifest(spark: SparkSession, folder: str, version: int, buckets: int = BUCKETS) -> dict:
    """{buckets, of: bucket -> the batch that wrote it, rejected: batches}. Before version 0 nothing is written; any other version that is gone is an error, never an empty cache."""
    if version < 0:
        return {"buckets": buckets, "of": {}, "rejected": []}
    text = read_text(spark, _manifest_path(folder, version))
    if text is None:
        raise FileNotFoundError(f"version {version} of {folder} is missing: the cache cannot be continued without it")
    return json.loads(text)


def read_version(spark: SparkSession, folder: str, version: int, schema, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets."""
    of = manifest(spark, folder, version)["of"]
    paths = [_bucket_path(folder, v, int(b)) for b, v in of.items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_batch(batch: DataFrame, n: int, folder: str, keys: Sequence[str | Column] | None = None, ordinal: str = "ordinal", buckets: int = BUCKETS, accept: Callable[[DataFrame], bool] | None = None) -> None:
    """Version n of the cache: version n - 1 with the batch's rows over those of the same keys. A batch that `accept` refuses leaves the rows as they are and is named in the manifest."""
    spark, before = batch.sparkSession, manifest(batch.sparkSession, folder, n - 1, buckets)
    if accept is not None and not accept(batch):
        write_text(spark, _manifest_path(folder, n), json.dumps({**before, "rejected": [*before["rejected"], n]}))
        return
    count = before["buckets"]
    touched = sorted(r[0] for r in batch.select(_bucket(keys, count)).distinct().collect())  # at most as many as there are buckets
    if touched:
        old = read_version(spark, folder, n - 1, batch.schema, touched)
        merged = upserted(old, batch, keys, ordinal)
        _write(merged.withColumn("__bucket", _bucket(keys, count)), folder, n, len(touched))
    write_text(spark, _manifest_path(folder, n), json.dumps({**before, "of": {**before["of"], **{str(b): n for b in touched}}}))


def _write(rows: DataFrame, folder: str, version: int, buckets: int) -> None:
    """A bucket is one file. The folder of a batch that died is written over."""
    rows.repartition(buckets, "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{folder}/data/version={version:012d}")


def rebucketed(spark: SparkSession, folder: str, version: int, schema, buckets: int, keys: Sequence[str | Column] | None = None) -> None:
    """The last version, written whole as the next one in another number of buckets: for a cache that has outgrown them."""
    rows = read_version(spark, folder, version, schema).withColumn("__bucket", _bucket(keys, buckets))
    _write(rows, folder, version + 1, buckets)
    of = {name.split("=")[1]: version + 1 for name, *_ in listed(spark, f"{folder}/data/version={version + 1:012d}") if name.startswith("__bucket=")}
    write_text(spark, _manifest_path(folder, version + 1), json.dumps({**manifest(spark, folder, version), "buckets": buckets, "of": of}))


def swept(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete the versions before the last `keep`, and every bucket that none of those reads; how many buckets went."""
    versions = [int(name.split(".")[0]) for name, *_ in listed(spark, f"{folder}/manifests")]
    kept = versions[-keep:]
    live = {(int(v), int(b)) for n in kept for b, v in manifest(spark, folder, n)["of"].items()}
    for n in versions[:-keep]:
        delete(spark, _manifest_path(folder, n))
    gone = 0
    for name, *_ in listed(spark, f"{folder}/data"):
        v = int(name.split("=")[1])
        for part, *_ in listed(spark, f"{folder}/data/{name}"):
            if v <= max(kept, default=-1) and part.startswith("__bucket=") and (v, int(part.split("=")[1])) not in live:
                delete(spark, f"{folder}/data/{name}/{part}")
                gone += 1
    return gone


def upsert_stream(rows: DataFrame, folder: str, checkpoint: str, keys: Sequence[str] | None = None, ordinal: str = "ordinal", buckets: int = BUCKETS, accept: Callable[[DataFrame], bool] | None = None):
    """A started query; keys are the annual cache's unless given. Batch n writes version n from version n - 1, so a batch that runs again writes the same version again."""

    def write(batch: DataFrame, n: int) -> None:
        batch = batch.persist()  # read for the gate, for its buckets and for the upsert
        try:
            upsert_batch(batch, n, folder, keys, ordinal, buckets, accept)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
