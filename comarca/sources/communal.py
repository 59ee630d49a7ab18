"""The communal control: two pages for each of the 28 districts, read, checked and put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca import dims
from comarca.operators.merge import one_per
from comarca.sources import html

# Address of a district's page, by kind.
PAGES = {
    "annual": "https://www.bcn.cl/siit/reportesdistritales/reporte_final.html?anno=2025&distrito={district}",
    "latest": "https://www.bcn.cl/siit/reportesdistritales/reporte_final.html?anno=2026&distrito={district}",
}
# Evidence id's stem, status id and observation unit, by kind.
NAMES = {
    "annual": ("bcn:cead:annual2024:d", "bcn_siit_cead_annual_2024", "tabla_tasa_denuncias_comunal"),
    "latest": ("bcn:cead:q3_2025:d", "bcn_siit_cead_latest_2025", "tabla_denuncias_comunal_q3"),
}


def targets(spark: SparkSession) -> DataFrame:
    """The 56 pages to fetch: kind, district, region_code, region_name, url."""
    rows = [(kind, d, code, dims.REGIONS[code], url.format(district=d)) for kind, url in PAGES.items() for d, code in enumerate(dims.DISTRICTS, 1)]
    return spark.createDataFrame(rows, "kind string, district int, region_code string, region_name string, url string")


def _name(at: int) -> Column:
    return F.when(F.col("kind") == "annual", NAMES["annual"][at]).otherwise(NAMES["latest"][at])


def communal(pages: DataFrame, least: int = dims.LEAST_COMMUNES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """pages: targets with html, sha256, bytes, retrieved_at, ok, error. Gives rows, evidence and status.

    Annual rows take the population of 2024 from the latest pages and the frequency that it implies. A page that failed is a
    status row; its district has no rows, and no zeros.
    """
    shown = pages.where("ok")
    page = lambda kind: shown.where(F.col("kind") == kind).select(*html.DISTRICT, "html")
    url = lambda rows, kind: rows.withColumn("source_url", F.replace(F.lit(PAGES[kind]), F.lit("{district}"), F.col("district").cast("string")))
    latest = url(html.latest_rates(page("latest")), "latest")
    known = latest.select("region_code", "commune_name_norm", "district", F.col("pop_2024").cast("long").alias("population"))
    annual = html.with_population(url(html.annual_rates(page("annual")), "annual"), one_per(known, ["region_code", "commune_name_norm"], [F.col("district")], last=True))
    figures = [c for c in latest.columns if c in html.FIGURES or c == "duplicated"]
    rows = annual.unionByName(latest.drop(*figures), allowMissingColumns=True)

    evidence = shown.select(
        F.concat(_name(0), F.col("district").cast("string")).alias("evidence_id"), F.lit("bcn_siit_cead_communal").alias("source_id"), "district", "url", "retrieved_at", "sha256", "bytes", _name(2).alias("observation_unit")
    )
    usable = F.col("quality_status") == "usable"
    drugs = F.countDistinct(F.when(F.col("cead_family_key") == "delitos_asociados_drogas", F.col("territory_id")))
    none = lambda kind: F.lit(None).cast(kind)
    told = [
        annual.agg(F.lit(NAMES["annual"][1]).alias("source_id"), none("int").alias("district"), (drugs >= least).alias("ok"), F.count("*").alias("records"), drugs.alias("communes"), none("array<int>").alias("quarantined_districts"), none("string").alias("error")),
        latest.agg(
            F.lit(NAMES["latest"][1]).alias("source_id"), none("int").alias("district"), F.lit(True).alias("ok"), F.count("*").alias("records"), F.countDistinct(F.when(usable, F.col("territory_id"))).alias("communes"),
            F.array_sort(F.collect_set(F.when(~usable, F.col("district")))).alias("quarantined_districts"), none("string").alias("error"),
        ),
        pages.where(~F.col("ok")).select(_name(1).alias("source_id"), "district", F.lit(False).alias("ok"), F.lit(0).cast("long").alias("records"), F.lit(0).cast("long").alias("communes"), none("array<int>").alias("quarantined_districts"), "error"),
    ]
    return rows, evidence, told[0].unionByName(told[1]).unionByName(told[2])
