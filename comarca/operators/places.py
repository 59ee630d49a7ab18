"""Official codes attached to rows by place name. The list of places is a fixed 346, so it may be broadcast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.functions.text import commune_code, commune_id, legacy_commune_id, norm_name, plain
from comarca.operators.merge import one_per
from comarca.plans.rollups import control_totals


def codes_attached(rows: DataFrame, places: DataFrame) -> DataFrame:
    """rows of communes get commune_code from places (region_code, name_norm, commune_code, ordinal); of repeated places the last counts."""
    known = one_per(places, ["region_code", "name_norm"], [F.col("ordinal")], last=True)
    known = F.broadcast(known.select(F.col("region_code").alias("__region"), F.col("name_norm").alias("__name"), F.col("commune_code").alias("__code")))
    on = (F.col("region_code") == F.col("__region")) & (F.col("commune_name_norm") == F.col("__name")) & (F.col("territory_level") == "commune")
    joined = rows.join(known, on, "left")
    code = F.coalesce("__code", "commune_code")
    return joined.withColumns({"commune_code": code, "territory_id": F.when(F.col("__code").isNotNull(), F.concat(F.lit("CL-"), "__code")).otherwise(F.col("territory_id"))}).drop("__region", "__name", "__code")


def attach_status(rows: DataFrame, least: int = dims.LEAST_COMMUNES) -> DataFrame:
    """One row: communes with a code, and whether they suffice."""
    return rows.agg(F.countDistinct("commune_code").alias("matched")).withColumn("ok", F.col("matched") >= least)


def codes_by_name(rows: DataFrame, places: DataFrame) -> DataFrame:
    """rows of communes with a name get the official code and id that the name has in places (name_norm, commune_code, ordinal; of repeated names the last counts).

    territory_key_status says what came of it: official_cut, cut_region_mismatch (the code is of another region, so the row stays as
    it is) or name_fallback (no such name); a status that a row already has only gives way to official_cut. Rows of other levels,
    and those without a name, stay as they are. A row without a region code matches no code.
    """
    for name, kind in (("commune_code", "string"), ("territory_id", "string"), ("territory_key_status", "string"), ("territory_mapping_method", "string"), ("territory_mapping_confidence", "double")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    known = F.broadcast(one_per(places, ["name_norm"], [F.col("ordinal")], last=True).select(F.col("name_norm").alias("__name"), commune_code(F.col("commune_code")).alias("__code")))
    named = (F.col("territory_level") == "commune") & (F.coalesce("commune_name", F.lit("")) != "")
    joined = rows.withColumn("__key", F.when(named, norm_name(F.col("commune_name")))).join(known, F.col("__key") == F.col("__name"), "left")
    region = F.lpad(F.coalesce(F.col("region_code").cast("string"), F.lit("")), 2, "0")
    same = F.coalesce(F.substring("__code", 1, 2) == region, F.lit(False))
    status = F.when(F.col("__name").isNull(), "name_fallback").when(same, "official_cut").otherwise("cut_region_mismatch")
    matched = F.col("__key").isNotNull() & same
    put = lambda c, value: F.when(matched, value).otherwise(F.col(c))
    return joined.withColumns({
        "territory_key_status": F.when(matched, "official_cut").when(F.col("__key").isNotNull(), F.coalesce("territory_key_status", status)).otherwise(F.col("territory_key_status")),
        "commune_code": put("commune_code", F.col("__code")), "territory_id": put("territory_id", commune_id(F.col("__code"))), "territory_mapping_method": put("territory_mapping_method", F.lit("CODE_EXACT")),
        "territory_mapping_confidence": put("territory_mapping_confidence", F.lit(1.0)),
    }).drop("__key", "__name", "__code")


def codes_status(coded: DataFrame, least: int = dims.LEAST_COMMUNES) -> DataFrame:
    """One row on codes_by_name(): how many communes it was given, matched, and did not."""
    name = F.when((F.col("territory_level") == "commune") & (F.coalesce("commune_name", F.lit("")) != ""), norm_name(F.col("commune_name")))
    of = lambda status: F.when(F.col("territory_key_status") == status, name)
    matched, mismatched = F.countDistinct(F.when(of("official_cut").isNotNull(), F.col("commune_code"))), F.countDistinct(of("cut_region_mismatch"))
    return coded.agg(
        F.lit("cead_cut_join").alias("source_id"), ((matched >= least) & (mismatched == 0)).alias("ok"), F.countDistinct(name).alias("input_communes"), matched.alias("matched_communes"), F.countDistinct(of("name_fallback")).alias("unmatched_communes"),
        mismatched.alias("region_mismatches"), F.lit("CL-COM-{CUT}").alias("territory_id_format"),
    )


def region_code_of(name: Column) -> Column:
    """The code of a region by its official or short name, however it is accented and written."""
    known = dims.SHORT_REGIONS | {plain(label.replace("`", "'"), "'"): code for code, label in dims.REGIONS.items()}
    return F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[norm_name(name)]


# Fixed values of the homicide rows' contract.
VICTIMS = {"crime_category": "HOMICIDIO CONSUMADO - VÍCTIMAS", "metric": "victimas_homicidio_consumado", "observation_unit": "victima_homicidio_consumado", "aml_class": "crimen_organizado_proxy"}
ANNUAL_SOURCE, RECENT_SOURCE = "homicidios_interinstitucional_2024", "homicidios_interinstitucional_h1_2025"


def homicide_communes(annual: DataFrame, recent: DataFrame) -> DataFrame:
    """Communes of the annual table with the recent victims, a derived zero where the recent one does not list them, and the communes that only it lists.

    Both: region_name, commune_name, victims. Places meet by normalised names.
    """
    keys = [norm_name(F.col("region_name")).alias("__region"), norm_name(F.col("commune_name")).alias("__commune")]
    on = ["__region", "__commune"]
    new = recent.select(*keys, F.col("victims").alias("__victims"))
    old = annual.select("*", *keys).join(new, on, "left").withColumns({
        "recent_h1_2025_victims": F.coalesce("__victims", F.lit(0)),
        "recent_h1_2025_status": F.when(F.col("__victims").isNull(), "derived_zero_not_listed_in_complete_positive_table").otherwise("observed_positive"), "period": F.lit("2024"),
    }).drop("__victims")
    only = recent.select("*", *keys).join(annual.select(*keys), on, "left_anti").select("region_name", "commune_name", "victims", F.col("victims").alias("recent_h1_2025_victims"), F.lit(None).cast("string").alias("recent_h1_2025_status"), F.lit("2025-H1").alias("period"))
    return old.drop(*on).unionByName(only, allowMissingColumns=True)


def homicide_checked(regions: DataFrame, annual: DataFrame, recent: DataFrame, control: Mapping[str, int] = dims.HOMICIDE_CONTROL) -> None:
    """Raise where the three tables miss the control totals or the communes of a region miss its own total."""
    in_year = F.when((F.col("period_type") == "annual") & (F.col("year") == 2024), "2024").when(F.col("period") == "2025-H1", "2025-H1")
    told = regions.select(F.lit("regions").alias("table"), in_year.alias("period"), F.col("region_code"), F.col("victims").alias("value")).where(F.col("period").isNotNull())
    of = lambda rows, period: rows.select(F.lit("communes").alias("table"), F.lit(period).alias("period"), region_code_of(F.col("region_name")).alias("region_code"), F.col("victims").alias("value"))
    rows = told.unionByName(of(annual, "2024")).unionByName(of(recent, "2025-H1"))
    spark = regions.sparkSession
    expected = spark.createDataFrame([(t, p, n) for t in ("regions", "communes") for p, n in control.items()], "table string, period string, value long")
    by_region = lambda t: rows.where((F.col("table") == t) & (F.col("period") == "2024"))
    listed = by_region("communes").select("region_code").distinct()
    own = by_region("regions").join(listed, "region_code", "left_semi").groupBy("region_code").agg(F.sum("value").alias("value"))
    wrong = [r.asDict() for frame in (control_totals(rows, expected, ["table", "period"]), control_totals(by_region("communes"), own, ["region_code"])) for r in frame.limit(5).collect()]
    if wrong:
        raise ValueError(f"victims miss their control totals: {wrong}")


def homicide_rows(regions: DataFrame, annual: DataFrame, recent: DataFrame, codes: DataFrame | None = None, control: Mapping[str, int] = dims.HOMICIDE_CONTROL) -> DataFrame:
    """Region and commune rows of the three audited tables, checked against the control totals.

    regions: year, period, period_type, region_code, region_name, victims, rate_100k; annual: region_name, commune_name, victims,
    rate_100k, population; recent: region_name, commune_name, victims; codes: name_norm, commune_code, as a codes sheet gives them.
    """
    regions = regions.withColumn("region_code", F.lpad(F.col("region_code").cast("string"), 2, "0"))
    homicide_checked(regions, annual, recent, control)
    fixed = [*[F.lit(v).alias(k) for k, v in VICTIMS.items()], F.lit(0.65).alias("weight")]
    first = F.when(F.col("period_type") == "annual", ANNUAL_SOURCE).otherwise(RECENT_SOURCE)
    whole = regions.select(
        "year", "period", "period_type", F.lit("region").alias("territory_level"), "region_code", "region_name", F.concat(F.lit("CL-"), "region_code").alias("territory_id"), F.col("victims").cast("long").alias("value"), F.col("rate_100k").cast("double").alias("rate_100k"),
        first.alias("source_id"), F.lit("observed_official_table").alias("data_status"), *fixed,
    )
    rows = homicide_communes(annual, recent).withColumns({"region_code": region_code_of(F.col("region_name")), "__name": norm_name(F.col("commune_name"))})
    if codes is None:
        rows = rows.withColumn("commune_code", F.lit(None).cast("string"))
    else:
        rows = rows.join(F.broadcast(codes.select(F.col("name_norm").alias("__known"), "commune_code")), F.col("__name") == F.col("__known"), "left")
    old = F.col("period") == "2024"
    names = F.create_map(*[F.lit(x) for kv in dims.REGIONS.items() for x in kv])
    communes = rows.select(
        F.when(old, 2024).otherwise(2025).alias("year"), "period", F.when(old, "annual").otherwise("h1").alias("period_type"), F.lit("commune").alias("territory_level"), "region_code", names[F.col("region_code")].alias("region_name"),
        "commune_code", "commune_name", legacy_commune_id(F.col("commune_code"), F.col("region_code"), F.col("commune_name")).alias("territory_id"), F.col("victims").cast("long").alias("value"), F.col("rate_100k").cast("double").alias("rate_100k"), F.col("population").cast("long").alias("population"),
        F.col("recent_h1_2025_victims").cast("long").alias("recent_h1_2025_victims"), "recent_h1_2025_status", F.when(old, ANNUAL_SOURCE).otherwise(RECENT_SOURCE).alias("source_id"), F.when(old, "observed_official_table").otherwise("observed_official_table_partial").alias("data_status"), *fixed,
    )
    return whole.unionByName(communes, allowMissingColumns=True)


#: The three tables that were copied from the reports and checked: file, source id.
REFERENCE_TABLES = (("homicides_regions.csv", "reference:homicides_regions_v0.2"), ("homicides_2024_communes.csv", "reference:homicides_communes_2024_v0.2"), ("homicides_h1_2025_communes.csv", "reference:homicides_communes_h1_2025_v0.2"))


def homicide_evidence(files: DataFrame, urls: dict[str, str]) -> DataFrame:
    """Evidence of the reference tables among files (read as binaryFile); urls: file name -> the report that it was copied from."""
    file = F.substring_index("path", "/", -1)
    known = F.create_map(*[F.lit(x) for kv in REFERENCE_TABLES for x in kv])
    told = F.create_map(*[F.lit(x) for kv in urls.items() for x in kv]) if urls else F.lit(None).cast("map<string,string>")
    rows = files.withColumn("__id", known[file]).where(F.col("__id").isNotNull())
    return rows.select(
        F.col("__id").alias("evidence_id"), F.col("__id").alias("source_id"), told[file].alias("url"), F.concat(F.lit("data/reference/"), file).alias("reference_path"), F.sha2("content", 256).alias("sha256"),
        F.length("content").cast("long").alias("bytes"), F.lit("tabla_transcrita_y_validada_desde_informe_oficial").alias("observation_unit"), F.lit("audited_reference").alias("provenance_status"),
    )


def homicide_status(pages: DataFrame) -> DataFrame:
    """A status row for each report (source_id, url, sha256, ok, error as pages.fetched() gives them); the tables stand without it."""
    ok = F.coalesce("ok", F.lit(False))
    return pages.select("source_id", ok.alias("ok"), F.when(ok, F.col("sha256")).alias("evidence_sha256"), F.when(~ok, F.coalesce("error", F.lit("not fetched"))).alias("error"), F.when(~ok, F.lit(True)).alias("reference_table_available"))
