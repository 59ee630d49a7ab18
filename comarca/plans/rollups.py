"""Sums, appended national rows, coverage gates, control totals and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.functions.text import norm


def annualised(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums by keys and year; null keys are a group, a group of nulls stays null."""
    return monthly.groupBy(*keys, "year").agg(F.sum("value").alias("value"))


def with_national(rows: DataFrame) -> DataFrame:
    """rows and, for their region rows, the sums by year, category, metric and source as national rows."""
    sums = rows.where(F.col("territory_level") == "region").groupBy("year", "crime_category", "metric", "source_id").agg(F.sum("value").alias("value"))
    national = sums.withColumns({"region_code": F.lit("CL"), "region_name": F.lit("Chile"), "territory_level": F.lit("national"), "data_status": F.lit("derived_sum")})
    return rows.unionByName(national, allowMissingColumns=True)


def totals(rows: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]], value: str = "value") -> DataFrame:
    """Sums of the value for several sets of keys at once: `level` says which of them a row is for (its place among the sets), keys that it sums over are null.

    One pass and one exchange: every row counts for each set, and is summed up before it is sent.
    """
    marks = [F.grouping(c).cast("int") for c in by]
    number = sum((m * (1 << (len(by) - 1 - k)) for k, m in enumerate(marks)), F.lit(0))
    gid = {sum(1 << (len(by) - 1 - k) for k, c in enumerate(by) if c not in own): at for at, own in enumerate(sets)}
    level = F.coalesce(*[F.when(F.col("__gid") == g, F.lit(at)) for g, at in gid.items()])
    summed = rows.groupingSets([[F.col(c) for c in own] for own in sets], *[F.col(c) for c in by]).agg(F.sum(value).alias(value), number.alias("__gid"))
    return summed.withColumn("level", level).drop("__gid")


def regions_and_nation(rows: DataFrame) -> DataFrame:
    """Facts (year, region_code, crime_category, value, ...) summed up by region and, as rows of CL, for the nation; one pass over the facts."""
    found = totals(rows, ["year", "region_code", "crime_category"], [["year", "region_code", "crime_category"], ["year", "crime_category"]])
    nation = F.col("level") == 1
    return found.select("year", F.when(nation, "CL").otherwise(F.col("region_code")).alias("region_code"), "crime_category", "value", F.when(nation, "national").otherwise("region").alias("territory_level"))


def coverage(rows: DataFrame, by: Sequence[str] = ("year",), least: int = dims.LEAST_COMMUNES, code: str = "commune_code") -> DataFrame:
    """Distinct communes, and whether they suffice to accept the rows."""
    return rows.groupBy(*by).agg(F.countDistinct(code).alias("communes")).withColumn("accepted", F.col("communes") >= least)


def control_totals(rows: DataFrame, expected: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Keys whose sums differ from the expected ones, either side missing included."""
    found = rows.groupBy(*keys).agg(F.sum(value).alias("found"))
    both = found.join(expected.select(*keys, F.col(value).alias("expected")), list(keys), "full_outer")
    return both.where(~F.col("found").eqNullSafe(F.col("expected")))


def years_by(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_sort(F.collect_set("year")).alias("years"))


def manifest(master: DataFrame) -> DataFrame:
    """One row: counts, years and communes of the master. Labels are one offense however they are written; an empty code is no commune."""
    code = F.nullif(F.col("commune_code").cast("string"), F.lit(""))
    return master.agg(
        F.count("*").alias("rows"), F.countDistinct(code).alias("communes"), F.countDistinct(norm(F.col("crime_category"))).alias("offenses"), F.array_sort(F.collect_set("year")).alias("years"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.lit(dims.EXPECTED_COMMUNES).alias("expected_communes"),
    )


def update_manifest(master: DataFrame, direct: DataFrame, control: DataFrame, backbone: dict, probe: dict | None = None, version: str = "0.5.0", generated_at: str | None = None) -> dict:
    """The manifest document: what the master covers, where it comes from and in which order sources count.

    backbone is what is known of the main source (as backbone_status() tells, with the expected and missing communes); probe the
    state of the primary one. A backbone that others keep up stands for the primary source.
    """
    probe = probe or {}
    told, years = manifest(master).first(), direct.agg(F.array_sort(F.collect_set("year")).alias("years")).first()["years"]
    external = bool(probe.get("externalized")) or backbone.get("source_id") == "cead_data_pipeline_external"
    active = "external_cead_data_pipeline" if external else "primary_direct" if years and probe.get("ok") else "mirror_of_primary"
    coverage = {
        "years": told["years"], "expected_communes": int(backbone.get("expected_communes") or dims.EXPECTED_COMMUNES), "observed_communes": told["communes"], "unavailable_communes": backbone.get("missing_expected_communes") or [],
        "offenses": told["offenses"], "records": told["rows"], "direct_years": years, "bcn_control_records": control.where(F.col("quality_status") == "usable").count(),
    }
    last = None if external or not probe.get("ok") else probe.get("latest_nonzero_period")
    return {
        "version": version, "generated_at": generated_at, "source_precedence": list(dims.SOURCE_PRECEDENCE), "primary_probe": probe, "active_backbone": active, "bridge_snapshot": backbone, "coverage": coverage,
        "last_primary_period": last, "update_policy": "the order of the sources holds, and absence is never turned into zero",
    }


def unavailable(master: DataFrame, communes: DataFrame) -> DataFrame:
    """The expected communes of which master has no row, by code."""
    return communes.join(F.broadcast(master.select("commune_code").distinct()), "commune_code", "left_anti").orderBy("commune_code")  # a fixed list of places


def section_fingerprints(rows: DataFrame, section: Sequence[str], figures: Sequence[Column]) -> DataFrame:
    """A digest of each section's rows whatever their order: equal digests are equal bags of rows.

    The digest sums two 64-bit hashes of every row and counts them, so a section of any size is aggregated, not gathered.
    """
    one, two = F.xxhash64(*figures, F.lit(1)).cast("decimal(38,0)"), F.xxhash64(*figures, F.lit(2)).cast("decimal(38,0)")
    return rows.groupBy(*section).agg(F.count("*").alias("rows"), F.sum(one).alias("one"), F.sum(two).alias("two"))


def quarantined_duplicates(rows: DataFrame, source: str, section: str, checked: str, against: Sequence[str], figures: Sequence[Column]) -> DataFrame:
    """Per source: whether the checked section repeats one of the others row for row."""
    prints = section_fingerprints(rows, [source, section], figures).withColumn("print", F.struct("rows", "one", "two"))
    own = F.max(F.when(F.col(section) == checked, F.col("print"))).alias("own")
    others = F.collect_set(F.when(F.col(section).isin(*against), F.col("print"))).alias("others")  # one for each section
    return prints.groupBy(source).agg(own, others).where(F.col("own").isNotNull()).select(source, F.array_contains("others", F.col("own")).alias("duplicated"))
