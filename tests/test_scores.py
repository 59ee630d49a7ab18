from pyspark.sql import functions as F

from comarca.operators import classify
from comarca.plans import geographic, priorities, rollups

FACT = "commune_code string, year int, crime_category string, value long, quality_status string"


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_layers_and_order(spark):
    labels = ["Tráfico de sustancias", "Receptación", "Comercio ilegal", "Amenazas"]
    rows = [("13101", y, c, 10 * k, "usable") for k, y in enumerate((2022, 2023, 2024), 2) for c in labels] + [("13102", y, c, 5, "usable") for y in (2022, 2023, 2024) for c in labels]
    found = geographic.ranked(geographic.geographic_scores(facts(spark, rows))).collect()
    assert [r["commune_code"] for r in found] == ["13101", "13102"]
    assert found[0]["score"] > found[1]["score"] and found[0]["confidence"] < 100
    assert all(found[0][f"{x}_layer_score"] is not None for x in ("predicate_direct", "criminal_economy", "criminogenic_context"))


def test_absence_stays_absent(spark):
    (row,) = geographic.geographic_scores(facts(spark, [("13101", 2024, "Tráfico de sustancias", 5, "usable")])).collect()
    assert row["criminal_economy_layer_score"] is None and row["criminogenic_context_layer_score"] is None
    assert row["score"] is not None and row["confidence"] < 60


def test_fallback_is_global_and_in_order(spark):
    rows = [("13101", 2024, "Delitos asociados a drogas", 5, None), ("13102", 2024, "Crímenes y simples delitos ley de drogas", 9, None)]
    found = {r["commune_code"]: r for r in geographic.geographic_scores(facts(spark, rows)).collect()}
    assert found["13102"]["predicate_direct_layer_score"] is not None and found["13101"]["predicate_direct_layer_score"] is None
    direct = geographic.geographic_scores(facts(spark, rows + [("13103", 2024, "tráfico de sustancias", 1, None)])).collect()
    assert [r["commune_code"] for r in direct if r["score"] is not None] == ["13103"]


def test_quarantined_rows_do_not_score_but_keep_their_commune(spark):
    rows = [("13101", 2024, "Receptación", 5, "quarantined"), (None, 2024, "Receptación", 5, "usable_bridge")]
    found = {r["commune_code"]: r["score"] for r in geographic.geographic_scores(classify.quality_normalised(facts(spark, rows))).collect()}
    assert set(found) == {"13101", "00000"} and found["13101"] is None and found["00000"] is not None


def test_year_gap(spark):
    rows = [("13101", y, "Receptación", v, None) for y, v in ((2018, 2), (2020, 4), (2024, 6))] + [("13102", 2024, "Receptación", 1, None)]
    got = {r["code"]: r for r in geographic.component_metrics(facts(spark, rows)).collect()}
    assert got["13101"]["years_observed"] == 3 and got["13102"]["trend"] == 50.0 and got["13101"]["trend"] > 50


def test_empty_master(spark):
    assert geographic.geographic_scores(facts(spark, [])).collect() == []
    assert geographic.component_metrics(facts(spark, [])).collect() == []


def test_base_share_drives_regional_pressure(spark):
    rows = [(2024, "01", "drogas", 100, "base_19913", 1.0), (2024, "01", "robos", 10, "contexto_general", 0.0), (2024, "02", "drogas", 5, "base_19913", 1.0), (2024, "02", "robos", 100_000, "contexto_general", 0.0)]
    found = {r["region_code"]: r["pressure_score"] for r in priorities.regional_pressure(spark.createDataFrame(rows, "year int, region_code string, crime_category string, value long, aml_class string, weight double")).collect()}
    assert found["01"] > found["02"]


def test_activity_prefers_the_family_and_the_calendar_year(spark):
    schema = "year int, commune_code string, crime_category string, value long, score_eligible boolean, ordinal int"
    rows = [(2024, "1", "Delitos asociados a drogas", 80, True, 0), (2025, "1", "Delitos asociados a drogas", 100, True, 1), (2025, "1", "Crímenes y simples delitos ley de drogas", 7, True, 2), (2023, "2", "Delitos asociados a drogas", 1, True, 3), (2025, "2", "Delitos asociados a drogas", 3, True, 4)]
    found = {r["commune_code"]: r for r in priorities.current_activity(spark.createDataFrame(rows, schema)).collect()}
    assert found["1"]["cases_policiales"] == 100 and found["1"]["yoy_pct"] == 25.0 and found["2"]["yoy_pct"] is None


def test_homicide_and_commune_priority(spark):
    rows = spark.createDataFrame([("a", 100.0, 1_500, 2, 0), ("b", 8.0, 400_000, 30, 9), ("c", 3.0, 300_000, 9, None)], "territory_id string, rate_100k double, population long, value long, recent_h1_2025_victims long")
    found = {r["territory_id"]: r for r in priorities.homicide_pressure(rows).collect()}
    assert found["a"]["shrunk_rate_2024"] < 10 and found["b"]["homicide_pressure_score"] > found["a"]["homicide_pressure_score"]
    e3 = "territory_id string, rate_100k double, population long, estimated_frequency long, year int, cead_family_key string, quality_status string, score_eligible boolean"
    drugs = lambda t, r, p, f, ok=True: (t, r, p, f, 2024, "delitos_asociados_drogas", "usable", ok)
    got = priorities.commune_priority(spark.createDataFrame([drugs("a", 100.0, 50_000, 50), drugs("b", 10.0, None, None), drugs("x", 10_000.0, 1, 1, False)], e3)).orderBy(F.desc("cead_aml_priority_score")).collect()
    assert [r["territory_id"] for r in got] == ["a", "b"] and got[1]["volume_percentile"] is None and got[1]["method_confidence"] == "medium"


def test_fingerprints_see_bags_of_rows(spark):
    rows = spark.createDataFrame([(1, "drugs", 5), (1, "drugs", 6), (1, "life", 6), (1, "life", 5), (2, "drugs", 5), (2, "life", 5), (2, "life", 5), (3, "drugs", 1)], "district int, section string, figure int")
    found = {r["district"]: r["duplicated"] for r in rollups.quarantined_duplicates(rows, "district", "section", "drugs", ["life"], [F.col("figure")]).collect()}
    assert found == {1: True, 2: False, 3: False}


def test_national_rows_are_appended_once(spark):
    rows = spark.createDataFrame([("01", 2024, "x", 3, "region", "m", "s"), ("02", 2024, "x", 4, "region", "m", "s"), ("9", 2024, "x", 99, "commune", "m", "s")], "region_code string, year int, crime_category string, value long, territory_level string, metric string, source_id string")
    found = rollups.with_national(rows)
    assert found.count() == 4 and found.where("territory_level = 'national'").first()["value"] == 7


def test_a_repeated_territory_has_one_score(spark):
    shape = "territory_id string, territory_level string, period string, rate_100k double, population long, value long, recent_h1_2025_victims long, ordinal int, commune_name string"
    rows = [("a", "commune", "2024", 90.0, 10, 9, 9, 0, "A"), ("b", "commune", "2024", 5.0, 1000, 5, 1, 1, "B"), ("a", "commune", "2024", 1.0, 1_000_000, 1, 0, 2, "A"), ("c", "region", "2024", 99.0, 1, 99, 99, 3, "C"), ("b", "commune", "2025-H1", 99.0, 1, 99, 99, 4, "B")]
    found = sorted((r["territory_id"], r["homicide_pressure_score"], r["shrunk_rate_2024"], r["victims_2024"], r["rate_100k_2024"], r["population_2024"], r["commune_name"]) for r in priorities.homicide_pressure(spark.createDataFrame(rows, shape)).collect())
    assert found == [("a", 0.0, 1.24, 1, 1.0, 1_000_000, "A"), ("a", 0.0, 1.24, 9, 90.0, 10, "A"), ("b", 100.0, 5.98, 5, 5.0, 1000, "B")]


def test_scores_say_what_they_are(spark):
    """Names, methods and interpretations beside the figures."""
    rows = spark.createDataFrame([(2024, "13", "Metropolitana", "DELITOS LEY DE DROGAS", 5, "base_19913", 1.0), (2024, "05", "Valparaíso", "HURTOS", 7, "contexto_general", 0.0)], "year int, region_code string, region_name string, crime_category string, value long, aml_class string, weight double")
    pressure = priorities.regional_pressure(rows)
    found = {r["region_code"]: r for r in pressure.collect()}
    assert found["13"]["region_name"] == "Metropolitana" and found["13"]["method"] == "proxy_mp_v0.1" and found["05"]["interpretation"].startswith("Presión delictual AML (proxy)")
    latest = priorities.latest_region_priority(pressure).first()
    assert latest["method"] == "ministerio_publico_aml_proxy_v0.3" and "peso cero" in latest["interpretation"]
    master = spark.createDataFrame([(y, "13101", "Delitos asociados a drogas", True, v, y, "Santiago", "family:4") for y, v in ((2022, 50), (2023, 80), (2024, 100))], "year int, commune_code string, crime_category string, score_eligible boolean, value long, ordinal int, commune_name string, article27_mapping_key string")
    (row,) = priorities.current_activity(master).collect()
    assert (row["year"], row["previous_year"], row["cases_policiales"], row["previous_cases_policiales"], row["yoy_pct"], row["commune_name"], row["article27_mapping_key"]) == (2024, 2023, 100, 80, 25.0, "Santiago", "family:4") and "no es tasa" in row["interpretation"]
