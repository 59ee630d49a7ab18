"""Regional pressure and the priorities of regions and communes.

Regions of a year are a fixed few, so their percentiles are windows; places are ranked in ranges, however many there are.
Every fact is read once: aggregates that several branches need are held in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca import dims
from comarca.files import held
from comarca.functions.stats import clamp, half_even, priority_level, tie_rank_percentile, upper_median, with_percentiles
from comarca.functions.text import norm, once
from comarca.operators.merge import one_per
from comarca.plans.rollups import totals

AML_CLASSES, ORG_CLASSES = ("base_19913", "proxy_19913"), ("crimen_organizado_proxy",)


def regional_pressure(rows: DataFrame) -> DataFrame:
    """rows: year, region_code, crime_category, value, aml_class, weight of region rows, region_name where they have it. One row for each (year, region)."""
    name = F.col("region_name") if "region_name" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumns({"weight": F.coalesce("weight", F.lit(0.1)), "__name": name})
    # Regions and categories of a year are a fixed few: their totals come from one exchange, and meet the cells by broadcast.
    sums = totals(rows, ["year", "region_code", "crime_category"], [["year", "region_code"], ["year", "crime_category"], ["year"]])
    joined = rows
    for level, (name, keys) in enumerate((("region_total", ["year", "region_code"]), ("category_total", ["year", "crime_category"]), ("year_total", ["year"]))):
        own = F.broadcast(sums.where(F.col("level") == level).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("value").alias(name)))
        joined = joined.join(own, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).drop(*[f"__{k}" for k in keys])
    floor = lambda c: F.greatest(F.col(c), F.lit(1)).cast("double")
    quotient = (F.col("value") / floor("region_total")) / (floor("category_total") / floor("year_total"))
    part = F.log1p("value") * clamp(quotient, 0.25, 3.0) * F.col("weight")
    aml, org = F.col("aml_class").isin(*AML_CLASSES), F.col("aml_class").isin(*ORG_CLASSES)
    raw = held(joined.groupBy("year", "region_code").agg(
        # sums come in any order: nine digits decide who ties
        F.round(F.sum(F.when(aml, part).otherwise(0.0)), 9).alias("raw_aml"), F.round(F.sum(F.when(org, part).otherwise(0.0)), 9).alias("raw_org"), F.sum((aml & (F.col("value") > 0)).cast("double")).alias("diversity"),
        F.min("__name").alias("region_name"),
    ))
    # The year before is the table's, not the region's: a region that skipped it starts anew. There is a row for each year and region.
    timed = raw.withColumn("at", F.dense_rank().over(Window.orderBy("year")))
    own = Window.partitionBy("region_code").orderBy("at")
    timed = timed.withColumn("before", F.when(F.lag("at").over(own) == F.col("at") - 1, F.lag("raw_aml").over(own)))
    trend = F.when(F.col("before") > 0, 50.0 + 50.0 * clamp((F.col("raw_aml") - F.col("before")) / F.col("before"), -1.0, 1.0)).otherwise(50.0)
    ranked = timed.select("year", "region_code", "region_name", trend.alias("trend"), *[tie_rank_percentile(F.col(c), F.col("region_code"), ["year"]).alias(p) for c, p in (("raw_aml", "p_aml"), ("raw_org", "p_org"), ("diversity", "p_div"))])
    score = half_even(0.55 * F.col("p_aml") + 0.25 * F.col("p_org") + 0.10 * F.col("trend") + 0.10 * F.col("p_div"), 1)
    return ranked.select(
        "year", "region_code", "region_name", score.alias("pressure_score"), priority_level(score).alias("pressure_level"), half_even(F.col("p_aml"), 1).alias("aml_component_percentile"),
        half_even(F.col("p_org"), 1).alias("organized_crime_component_percentile"), half_even(F.col("trend"), 1).alias("trend_component"), half_even(F.col("p_div"), 1).alias("diversification_percentile"),
        F.lit("proxy_mp_v0.1").alias("method"), F.lit(dims.PRESSURE_TEXT).alias("interpretation"),
    )


def in_latest_year(rows: DataFrame) -> DataFrame:
    latest = rows.agg(F.max("year").alias("__latest"))  # one row
    return rows.join(F.broadcast(latest), F.col("year") == F.col("__latest")).drop("__latest")


def latest_region_priority(pressure: DataFrame, method: str = "ministerio_publico_aml_proxy_v0.3") -> DataFrame:
    """Pressure of the latest year, under the name of the proxy."""
    return in_latest_year(pressure).withColumns({"method": F.lit(method), "interpretation": F.lit(dims.REGION_PROXY_TEXT)})


def region_priority(pressure: DataFrame, homicide: DataFrame) -> DataFrame:
    """pressure: year, region_code, pressure_score; homicide: territory_level, period, region_code, rate_100k. Regions with all four figures."""
    name = F.col("region_name") if "region_name" in pressure.columns else F.lit(None).cast("string")
    latest = in_latest_year(pressure).select("year", "region_code", name.alias("region_name"), "pressure_score")
    periods = {"r24": "2024", "h24": "2024-H1", "h25": "2025-H1"}
    rates = homicide.where((F.col("territory_level") == "region") & F.col("period").isin(*periods.values())).groupBy("region_code").agg(*[F.max(F.when(F.col("period") == p, F.col("rate_100k"))).alias(c) for c, p in periods.items()])
    # Places are among the regions that have the figure, whether or not they have the others.
    rates = rates.withColumns({p: tie_rank_percentile(F.col(c), F.col("region_code"), [F.col(c).isNull()]) for p, c in (("p24", "r24"), ("p25", "h25"))})
    joined = latest.join(rates.dropna(subset=list(periods)), "region_code")
    delta = (F.col("h25") - F.col("h24")) / F.greatest(F.col("h24"), F.lit(0.1))
    trend = clamp(50 + 50 * clamp(delta, -1.0, 1.0), 0.0, 100.0)
    score = half_even(0.60 * F.col("pressure_score") + 0.20 * F.col("p24") + 0.15 * F.col("p25") + 0.05 * trend, 1)
    return joined.select(
        "year", F.lit("2025-H1").alias("period"), "region_code", "region_name", score.alias("territorial_priority_score"), priority_level(score).alias("priority_level"), F.col("pressure_score").alias("mp_aml_proxy_score"), F.col("r24").alias("homicide_2024_rate"),
        half_even(F.col("p24"), 1).alias("homicide_2024_percentile"), F.col("h25").alias("homicide_h1_2025_rate"), half_even(F.col("p25"), 1).alias("homicide_h1_2025_percentile"),
        half_even(delta * 100, 1).alias("homicide_h1_rate_change_pct"), half_even(trend, 1).alias("recent_trend_component"),
        F.lit("territorial_priority_v0.2").alias("method"), F.lit(dims.REGION_PRIORITY_TEXT).alias("interpretation"),
    )


def shrunk(rate: Column, population: Column, prior: Column, k: float) -> Column:
    """The rate pulled towards the prior by population / (population + k)."""
    reliability = population / (population + F.lit(k))
    return reliability * rate + (1 - reliability) * prior


#: Who a commune is, as rows may say it.
NAMED = ("region_code", "region_name", "commune_code", "commune_name")


def _has(rows: DataFrame, *names: str) -> list[Column]:
    return [F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in names]


def _last_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows that repeat a key the last one, by `ordinal` where rows have it."""
    own = [F.col("ordinal")] if "ordinal" in rows.columns else [F.col(c) for c in order]
    return one_per(rows.select(*keys, *order, *(["ordinal"] if "ordinal" in rows.columns else [])), keys, own, last=True).select(*keys, *order)


def homicide_pressure(rows: DataFrame) -> DataFrame:
    """rows of homicide_rows(): communes in 2024 (territory_id, rate_100k, population, value, recent_h1_2025_victims); others are no part of it.

    Percentiles are by territory. Of rows that repeat one the last counts, and all of them have its places and score.
    """
    given = [c for c, kept in (("territory_level", "commune"), ("period", "2024")) if c in rows.columns]
    rows = rows.where(F.lit(True) if not given else F.expr(" AND ".join(f"{c} = '{v}'" for c, v in (("territory_level", "commune"), ("period", "2024")) if c in given)))
    population = F.greatest(F.lit(1), F.col("population")).cast("double")
    figures = ["__rate", "__volume", "__recent"]
    rows = rows.withColumns({"__rate": shrunk(F.col("rate_100k"), population, F.lit(6.0), 50_000.0), "__volume": F.log1p("value"), "__recent": F.coalesce(F.col("recent_h1_2025_victims"), F.lit(0)).cast("double")})
    ranked = with_percentiles(_last_of(rows, ["territory_id"], figures), {f"p{c}": c for c in figures}, "territory_id")
    score = half_even(0.55 * F.col("p__rate") + 0.25 * F.col("p__volume") + 0.20 * F.col("p__recent"), 1)
    scored = ranked.select(F.col("territory_id").alias("__territory"), score.alias("__score"), half_even(F.col("__rate"), 2).alias("__shrunk"))
    joined = rows.join(scored, F.col("territory_id") == F.col("__territory"))
    return joined.select(
        F.lit(2024).alias("year"), F.lit("2025-H1").alias("recent_period"), "territory_id", *_has(rows, *NAMED), F.col("__score").alias("homicide_pressure_score"), priority_level(F.col("__score")).alias("pressure_level"), F.col("value").alias("victims_2024"),
        F.col("rate_100k").alias("rate_100k_2024"), F.col("population").cast("long").alias("population_2024"), F.col("__shrunk").alias("shrunk_rate_2024"), F.col("__recent").cast("long").alias("victims_h1_2025"), F.lit("homicide_pressure_v0.2").alias("method"), F.lit(dims.HOMICIDE_TEXT).alias("interpretation"),
    )


def commune_priority(rows: DataFrame) -> DataFrame:
    """rows of E3: communes' drug family in 2024, usable and eligible. Rates shrink to their upper median; volume counts where it is known."""
    kept = held(rows.where((F.col("year") == 2024) & (F.col("cead_family_key") == "delitos_asociados_drogas") & (F.col("quality_status") == "usable") & F.col("score_eligible")))
    prior = F.broadcast(upper_median(kept, "rate_100k").select(F.coalesce("value", F.lit(0.0)).alias("__prior")))  # one row
    population = F.coalesce("population", F.lit(0)).cast("double")
    reliability = F.when(population > 0, population / (population + 25_000.0)).otherwise(0.45)
    figures = kept.join(prior, F.col("__prior").isNotNull()).withColumns({
        "__rate": reliability * F.coalesce("rate_100k", F.lit(0.0)) + (1 - reliability) * F.col("__prior"),
        "__volume": F.coalesce(F.log1p(F.greatest(F.lit(0), F.col("estimated_frequency"))), F.lit(0.0)),
    })
    # Percentiles are by territory: of rows that repeat one, the last counts, and all get its places and its rate.
    per = _last_of(figures, ["territory_id"], ["__rate", "__volume"])
    places = with_percentiles(per, {"p_rate": "__rate", "p_volume": "__volume"}, "territory_id").select("territory_id", "p_rate", "p_volume", F.col("__rate").alias("__last_rate"))
    ranked = figures.join(places, "territory_id")
    known = F.col("estimated_frequency").isNotNull()
    score = half_even(F.when(known, 0.70 * F.col("p_rate") + 0.30 * F.col("p_volume")).otherwise(F.col("p_rate")), 1)
    return ranked.select(
        "year", F.lit("2024").alias("period"), "territory_id", *_has(rows, *NAMED, "commune_name_norm"), score.alias("cead_aml_priority_score"), priority_level(score).alias("priority_level"), F.col("rate_100k").alias("drug_complaint_rate_100k"), "population",
        F.col("estimated_frequency").alias("estimated_drug_complaints"), half_even(F.col("__last_rate"), 2).alias("shrunk_drug_rate"), half_even(F.col("p_rate"), 1).alias("rate_percentile"), F.when(known, half_even(F.col("p_volume"), 1)).alias("volume_percentile"),
        F.lit(dims.DRUG_LAW_RELATION).alias("article27_relation"), F.lit(dims.DRUG_LAW_BASIS).alias("legal_basis"), *_has(rows, "source_id", "ultimate_source_id"), F.lit("cead_art27_commune_priority_v0.3").alias("method"),
        F.when(population > 0, "high").otherwise("medium").alias("method_confidence"), F.lit(dims.COMMUNE_PRIORITY_TEXT).alias("interpretation"),
    )


#: What activity shows of the row that it takes.
ACTIVITY = ("territory_id", "region_code", "region_name", "commune_name", "crime_category", "aml_class", "article27_mapping_key", "source_id", "source_tier", "quality_status")


def current_activity(master: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The latest year's drug cases of each commune against the calendar year before; family rows before group rows.

    What a row is worth is asked where rows of a commune's year meet, not of every row of the fact that master is made of.
    """
    rank = once(norm(F.col("crime_category")), lambda n: F.when(n == dims.DRUG_FAMILY_LABEL, 0).when(n == dims.DRUG_GROUP_LABEL, 1))
    cases = F.coalesce("value", F.lit(0)).alias("cases_policiales")
    shown = [F.col(c) for c in ACTIVITY if c in master.columns]
    worth = F.when(rank.isNotNull() & F.col("score_eligible"), F.struct(rank, F.col(ordinal)))  # rows worth nothing are passed over
    best = master.groupBy("year", "commune_code").agg(F.min_by(F.struct(*shown, cases), worth).alias("__own")).where(F.col("__own").isNotNull()).select("year", "commune_code", "__own.*")
    found = year_on_year(best, ["commune_code"], "cases_policiales")
    return found.withColumns({"previous_year": F.col("year") - 1, "interpretation": F.lit(dims.ACTIVITY_TEXT)})


def year_on_year(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows (one for each key and year) of the latest year with the value of the year before (not of the last one observed) and the change in percent.

    A key's years, a few, meet in one row, which is held; the fact itself is read once.
    """
    rest = [c for c in rows.columns if c not in (*keys, "year")]
    years = F.collect_list(F.struct("year", F.col(value).alias("value"))).alias("__years")
    per = held(rows.groupBy(*keys).agg(F.max("year").alias("year"), F.max_by(F.struct(*rest), "year").alias("__own"), years))
    before = F.get(F.filter("__years", lambda x: x["year"] == F.col("year") - 1), F.lit(0))["value"]
    now = in_latest_year(per).select(*keys, "year", "__own.*", before.alias(f"previous_{value}"))
    change = half_even((F.col(value) - F.col(f"previous_{value}")) * 100.0 / F.nullif(F.col(f"previous_{value}"), F.lit(0)), 1)
    return now.withColumn("yoy_pct", change)
