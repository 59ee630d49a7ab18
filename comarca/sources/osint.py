"""Links of watched pages as events and publications."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.functions.text import keyword_hits, nearby_date
from comarca.operators.merge import one_per
from comarca.sources.html import links

LEAST_TITLE, MOST_TITLE = 18, 500


def events(pages: DataFrame, keywords: Iterable[str], least_title: int = LEAST_TITLE) -> DataFrame:
    """pages (source_id, url, ordinal, html): links whose title names a keyword; of one url the last counts."""
    found = links(pages, base="url").withColumn("hits", keyword_hits(F.col("title"), keywords))
    kept = found.where((F.length("title") >= least_title) & (F.size("hits") > 0) & F.col("target").startswith("http"))
    stamp = F.col("retrieved_at") if "retrieved_at" in pages.columns else F.lit(None).cast("string")
    shaped = kept.select(
        F.concat(F.lit("url:"), F.sha1("target")).alias("event_id"), "source_id", F.substring("title", 1, MOST_TITLE).alias("title"), F.col("target").alias("url"), nearby_date(F.col("around")).alias("published_date"), stamp.alias("retrieved_at"),
        F.col("hits").alias("matched_keywords"), F.lit("official_publication_signal").alias("event_type"), F.lit("observed_publication").alias("data_status"), "ordinal", "link_at",
    )
    return one_per(shaped, ["url"], [F.col("ordinal"), F.col("link_at")], last=True).drop("ordinal", "link_at")


def publications(pages: DataFrame, terms: Iterable[str] = dims.PUBLICATION_TERMS) -> DataFrame:
    """Links whose lower-cased title or whole address holds a term, as it is written; of one address the first counts.

    A link without a title has the last part of its address. Links to what is no web page count too.
    """
    found = links(pages, base="url").where(F.col("target").isNotNull())
    said = F.lower(F.concat_ws(" ", "title", "target"))
    own = F.array(*[F.lit(t) for t in terms])
    kept = found.where(F.exists(own, lambda t: F.contains(said, t)))
    title = F.when(F.col("title") == "", F.substring_index("target", "/", -1)).otherwise(F.col("title"))
    stamp = F.col("retrieved_at") if "retrieved_at" in pages.columns else F.lit(None).cast("string")
    shaped = kept.select("source_id", title.alias("title"), F.col("target").alias("url"), stamp.alias("retrieved_at"), F.lit("official_discovery").alias("publication_type"), F.lit("observed_link").alias("data_status"), "ordinal", "link_at")
    return one_per(shaped, ["url"], [F.col("ordinal"), F.col("link_at")]).drop("ordinal", "link_at")


def event_status(pages: DataFrame, found: DataFrame) -> DataFrame:
    """A status row for each watched page (source_id, ok, error): how many events it gave."""
    counts = found.groupBy("source_id").agg(F.count("*").alias("__events"))
    ok = F.coalesce("ok", F.lit(False))
    return pages.select("source_id", ok.alias("ok"), F.when(~ok, F.coalesce("error", F.lit("not fetched"))).alias("error")).join(counts, "source_id", "left").select("source_id", "ok", F.when(F.col("ok"), F.coalesce("__events", F.lit(0))).alias("events"), "error")
