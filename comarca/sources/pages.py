"""Web pages and files as rows of bytes: a data source that fetches them, the text they hold, a store of what was fetched, and saved pages replayed."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from comarca import dims
from comarca.sources.tables import document

FETCHED_SCHEMA = "url string, content binary, content_type string, sha256 string, bytes long, http_status int, retrieved_at string, ok boolean, error string"
PAGE_COLUMNS = ("html", "sha256", "bytes", "http_status", "retrieved_at")
TIMEOUT_S = 45
#: Requests at a time to one host.
PER_HOST = 2


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    """A partition's urls are of one host and fetched one after another, and a host has PER_HOST partitions at most: so many requests at a time."""

    def __init__(self, urls: list[str], timeout: float, per_host: int, pause: float):
        self.urls, self.timeout, self.per_host, self.pause = urls, timeout, per_host, pause

    def partitions(self) -> list[_Urls]:
        hosts: dict[str, list[str]] = {}
        for url in dict.fromkeys(self.urls):
            hosts.setdefault(urlsplit(url).netloc.lower(), []).append(url)
        return [_Urls(part) for urls in hosts.values() for k in range(self.per_host) if (part := urls[k :: self.per_host])] or [_Urls([])]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        import hashlib

        for k, url in enumerate(partition.urls):
            if k and self.pause:
                time.sleep(self.pause)
            at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "comarca"}), timeout=self.timeout) as r:  # noqa: S310
                    raw, status, kind = r.read(), getattr(r, "status", None), r.headers.get("Content-Type")
                yield url, raw, kind, hashlib.sha256(raw).hexdigest(), len(raw), status, at, True, None
            except Exception as e:  # noqa: BLE001  a page that fails is a status, not a failed job
                yield url, None, None, None, None, getattr(e, "code", None), at, False, f"{type(e).__name__}: {e}"[:500]


class HttpPages(DataSource):
    """format("comarca_pages") with options urls (one on each line), timeout, per_host (requests at a time to one host) and pause (seconds between them)."""

    @classmethod
    def name(cls) -> str:
        return "comarca_pages"

    def schema(self) -> str:
        return FETCHED_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        get = self.options.get
        return _Reader([u for u in get("urls", "").split("\n") if u], float(get("timeout", TIMEOUT_S)), max(1, int(get("per_host", PER_HOST))), float(get("pause", 0)))


def fetched(spark: SparkSession, urls: Sequence[str], timeout: float = TIMEOUT_S, per_host: int = PER_HOST, pause: float = 0.0) -> DataFrame:
    """What the urls hold, as bytes and as text (html), and how they were reached."""
    spark.dataSource.register(HttpPages)
    options = {"urls": "\n".join(urls), "timeout": str(timeout), "per_host": str(per_host), "pause": str(pause)}
    return spark.read.format("comarca_pages").options(**options).load().withColumn("html", text_of(F.col("content"), F.col("content_type")))


#: Names under which pages declare the Western eight-bit charset, and how its bytes 0x80 to 0x9F read.
LATIN = ("iso-8859-1", "latin-1", "latin1", "iso8859-1", "iso-8859-15", "windows-1252", "cp1252", "us-ascii", "ascii")
_CONTROLS = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
HEAD_BYTES = 4096


def charset_of(content: Column, content_type: Column) -> Column:
    """The charset of a page: by its first bytes, else the header's, else the page's own word for it, else whether it reads as UTF-8."""
    given = lambda text, pattern: F.nullif(F.lower(F.regexp_extract(text, pattern, 1)), F.lit(""))
    header = given(F.coalesce(content_type, F.lit("")), r"""(?i)charset\s*=\s*["']?([\w.:-]+)""")
    head = F.decode(F.substring(content, 1, HEAD_BYTES), "ISO-8859-1")
    told = given(head, r"""(?is)<meta[^>]{0,500}?charset\s*=\s*["']?([\w.:-]+)""")
    marked = F.when(F.hex(F.substring(content, 1, 3)) == "EFBBBF", F.lit("utf-8"))
    return F.coalesce(marked, header, told, F.when(F.is_valid_utf8(content.cast("string")), F.lit("utf-8")).otherwise(F.lit("windows-1252")))


def text_of(content: Column, content_type: Column) -> Column:
    """The bytes of a page as text. Under an unknown name they are UTF-8 where they read as such, else Western."""
    name = charset_of(content, content_type)
    western = F.translate(F.decode(content, "ISO-8859-1"), "".join(a for a, b in _CONTROLS if b), "".join(b for _, b in _CONTROLS if b))
    unicode = F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"^\x{FEFF}", "")
    return F.when(name.isin("utf-8", "utf8"), unicode).when(name.isin(*LATIN), western).otherwise(F.when(F.is_valid_utf8(content.cast("string")), unicode).otherwise(western))


STORED = "sha256 string, bytes long, content binary"


def stored(pages: DataFrame, folder: str) -> DataFrame:
    """Add the bytes of fetched pages and files to a store, each content once, and give the evidence of them: url, sha256, bytes, retrieved_at.

    The store's rows are addressed by content. An addition is seen once its write is committed, whole or not at all; what the store
    has is not written again.
    """
    spark = pages.sparkSession
    got = pages.where(F.col("ok"))
    new = got.select(*[x.split(" ")[0] for x in STORED.split(", ")]).join(in_store(spark, folder).select("sha256"), "sha256", "left_anti").dropDuplicates(["sha256"])
    new.write.mode("append").parquet(folder)
    return got.select("url", "sha256", "bytes", "retrieved_at")


def in_store(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(STORED).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def from_store(evidence: DataFrame, folder: str) -> DataFrame:
    """(file, content) of the evidence's urls, for the readers of workbooks and the like."""
    return evidence.select(F.col("url").alias("file"), "sha256").join(in_store(evidence.sparkSession, folder).select("sha256", "content"), "sha256").select("file", "content")


def replayed(targets: DataFrame, saved: DataFrame) -> DataFrame:
    """targets (source_id, url, ...) with saved pages in the shape of fetched(); a target without one has ok = false."""
    joined = targets.join(saved.select("url", *PAGE_COLUMNS), "url", "left")
    known = F.col("sha256").isNotNull()
    return joined.withColumns({"ok": known, "error": F.when(~known, F.lit("not saved"))})


def page_status(pages: DataFrame) -> DataFrame:
    """A status row for each source: whether all of its pages could be read, and how many."""
    return pages.groupBy("source_id").agg(F.bool_and("ok").alias("ok"), F.count_if("ok").alias("pages"), F.first("error", ignorenulls=True).alias("error"))


REGISTRY = "source_id string, institution string, url string, priority int, source_tier string, role string, status string"
#: A registered source that is watched by its own producer, not by a probe of its page.
UNPROBED = "cead_estadisticas_delictuales"


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The sources of a registry document (its list `sources`), in their order."""
    rows = (document(spark, path) or {}).get("sources", [])
    names = [c.split(" ")[0] for c in REGISTRY.split(", ")]
    return spark.createDataFrame([(k, *[r.get(n) for n in names]) for k, r in enumerate(rows)], f"ordinal int, {REGISTRY}")


def probe_targets(sources: DataFrame) -> DataFrame:
    """The sources of first priority whose pages are probed."""
    return sources.where((F.col("priority") == 1) & (F.col("source_id") != UNPROBED))


def probed(targets: DataFrame, pages: DataFrame, most_title: int = 300) -> DataFrame:
    """A health row for each target (ordinal, source_id, url), in their order: status, title and error of its page."""
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    joined = targets.select("ordinal", "source_id", "url").join(pages, "url", "left")
    ok = F.coalesce("ok", F.lit(False))
    return joined.select("ordinal", "source_id", "url", "retrieved_at", "http_status", ok.alias("ok"), F.when(ok, F.substring(title, 1, most_title)).alias("title"), F.when(~ok, F.coalesce("error", F.lit("not fetched"))).alias("error")).orderBy("ordinal")


# The documents that the legal rules rest on: source id, address, observation unit.
LEGAL_TARGETS = (
    ("fiscalia_catalogo_delitos", "https://www.fiscaliadechile.cl/sites/default/files/2026-02/Catalogo_de_delitos.pdf", "catalogo_codigos_delito"),
    ("bcn_ley_19913", "https://www.bcn.cl/leychile/navegar?idNorma=219119&idParte=8649605", "norma_juridica"),
)


def legal_targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *t) for k, t in enumerate(LEGAL_TARGETS)], "ordinal int, source_id string, url string, observation_unit string")


def legal_evidence(targets: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evidence of the legal documents that could be fetched, and a status row for each; the rules themselves are static."""
    joined = targets.join(pages, "url", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    known = joined.where("ok").select(F.concat(F.lit("legal:"), "source_id", F.lit(":v0.2")).alias("evidence_id"), "source_id", "url", "retrieved_at", "sha256", "bytes", "observation_unit", F.lit(dims.LEGAL_VERSION).alias("rules_version"))
    status = joined.orderBy("ordinal").select("source_id", "ok", F.col("sha256").alias("evidence_sha256"), F.when(~F.col("ok"), F.coalesce("error", F.lit("not fetched"))).alias("error"), F.when(~F.col("ok"), F.lit(True)).alias("static_rules_available"))
    return known, status


def sector_hypotheses(spark: SparkSession, path: str) -> DataFrame:
    """(signal, sector_tags, aml_relevance, note) of a hypotheses document; they say nothing about conduct."""
    signals = (document(spark, path) or {}).get("signals", {})
    return spark.createDataFrame([(k, v.get("sector_tags", []), v.get("aml_relevance"), v.get("note")) for k, v in signals.items()], "signal string, sector_tags array<string>, aml_relevance string, note string")
