import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from comarca import dims
from comarca.operators import classify, export, merge, places
from comarca.plans import geographic

ROW = "year int, commune_code string, crime_category string, metric string, value long, source_tier string, ordinal int"


def test_direct_rows_come_first(spark):
    mirror = spark.createDataFrame([(2024, "1101", "Drogas", "casos_policiales", 100, "mirror_of_primary", 0), (2024, None, "Drogas", "casos_policiales", 1, "mirror_of_primary", 1), (2024, "1101", "Otro", "tasa", 1, None, 2), (2024, "9", "z", "casos_policiales", 1, None, 3)], ROW)
    direct = spark.createDataFrame([(2024, "01101", "DROGAS", "casos_policiales", 110, "primary_direct", 0)], ROW)
    found = {r["commune_code"]: r for r in merge.precedence_merged(mirror, direct).collect()}
    assert set(found) == {"01101", "9"} and found["01101"]["value"] == 110 and found["01101"]["source_rank"] == 10 and found["9"]["source_rank"] == 99


def test_missing_tier_contends_before_unknown(spark):
    rows = spark.createDataFrame([(2024, "1", "a", "casos_policiales", 1, "elsewhere", 0), (2024, "1", "a", "casos_policiales", 2, None, 1), (2024, "1", "a", "casos_policiales", 3, None, 2)], ROW)
    assert [r["value"] for r in merge.precedence_merged(rows, rows.limit(0)).collect()] == [2]


def test_upsert_and_replace_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, ordinal int")
    new = spark.createDataFrame([(2, "c", 0), (2, "d", 1), (3, "e", 0)], "k int, v string, ordinal int")
    once = merge.upserted(old, new, ["k"])
    assert sorted((r["k"], r["v"]) for r in once.collect()) == [(1, "a"), (2, "d"), (3, "e")]
    assert sorted(merge.upserted(once, new, ["k"]).collect()) == sorted(once.collect())
    contract = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "signal_family string, v int")
    fresh = spark.createDataFrame([("x", 9)], "signal_family string, v int")
    replaced = merge.family_replaced(contract, fresh, "x")
    assert {r["v"] for r in replaced.collect()} == {2, 3, 9} == {r["v"] for r in merge.family_replaced(replaced, fresh, "x").collect()}


def test_legal_codes(spark):
    want = {"12133": "laundering_offense", "012174": "laundering_offense", "7007": "predicate_direct", "12051": "predicate_direct", "202": "predicate_direct", "551": "predicate_direct", "806": "organized_crime_signal", "542": "organized_crime_signal", "12053": "predicate_candidate", "7035": "historical_nonvigent", "7098": "historical_nonvigent", "999999": "unmapped", "x": "unmapped", None: "unmapped"}
    found = classify.legal_classified(spark.createDataFrame([(k,) for k in want], "code string")).collect()
    assert {r["code"]: r["legal_class"] for r in found} == want
    assert {r["code"]: r["legal_basis"] for r in found}["806"].startswith("Extorsión art. 438") and {r["code"]: r["legal_code"] for r in found}["012174"] == "12174"
    (told,) = classify.legal_summary(spark).collect()
    assert told["classes"] == {"predicate_direct": 37, "organized_crime_signal": 10, "predicate_candidate": 4, "laundering_offense": 2}
    assert (told["exact_rules"], told["range_rules"], told["legal_basis"]["article"], told["version"]) == (53, 2, "27", "0.2.0") and told["catalog"]["published"] == "2026-02-10"


def test_overlapping_ranges(spark):
    """The first of overlapping ranges counts at every number, as by trying all of them."""
    r = random.Random(1)
    rules = [(k, low, low + r.randint(-1, 40), f"c{k}") for k, low in enumerate(r.randint(-50, 400) for _ in range(120))]
    ranges = spark.createDataFrame(rules, "ordinal int, low long, high long, class string")
    cut = classify.segments(r[:3] for r in rules)
    assert all(a <= b for a, b, _ in cut) and all(x[1] < y[0] for x, y in zip(cut, cut[1:], strict=False))
    numbers = [*range(-60, 450), None]
    found = {x["n"]: x["range"] and x["range"]["class"] for x in classify.ranged(spark.createDataFrame([(n,) for n in numbers], "n long"), ranges, "n").collect()}
    assert found == {n: next((c for _, low, high, c in rules if n is not None and low <= n <= high), None) for n in numbers}
    assert classify.ranged(spark.range(2), ranges.limit(0), "id").where("range IS NOT NULL").count() == 0
    plan = classify.ranged(spark.range(2), ranges, "id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_labels(spark):
    rows = spark.createDataFrame([("DELITOS LEY DE DROGAS",), ("HOMICIDIOS",), ("?",), (None,)], "crime_category string")
    found = {r["crime_category"]: (r["aml_class"], r["weight"]) for r in classify.taxonomy_annotated(rows).collect()}
    assert found == {"DELITOS LEY DE DROGAS": ("base_19913", 1.0), "HOMICIDIOS": ("contexto_general", 0.0), "?": ("contexto_general", 0.0), None: ("contexto_general", 0.0)}
    mapped = {r["crime_category"]: r for r in classify.catalog_mapped(spark.createDataFrame([("Tráfico de sustancias",), ("Homicidios",), ("nada",)], "crime_category string")).collect()}
    assert mapped["Tráfico de sustancias"]["score_eligible"] and not mapped["Homicidios"]["score_eligible"] and mapped["nada"]["article27_mapping_key"] == "default"
    assert export.predicate_features(classify.catalog_mapped(rows.select("crime_category", F.lit(1).alias("value"), F.lit(2024).alias("year")))).count() == 0
    assert classify.drug_family(spark.createDataFrame([("Delitos asociados a drogas",), ("x",)], "crime_category string")).count() == 1


PRODUCER = export.Producer("X", "X_CAPTURE", "EVT-X-", "EVD-X-")
LINEAGE = "source_id string, content_sha256 string, retrieved_at string, generated_at string, freshness string"


def test_interop(spark):
    rows = spark.createDataFrame([("13101", 2024, "a"), (None, 2024, "a"), ("123456", None, "a")], "commune_code string, year int, crime_category string")
    adapted = export.adapted(rows.withColumn("source_id", F.lit(None).cast("string")), PRODUCER)
    assert sorted((r["territory_id"] or "", r["territory_mapping_method"]) for r in adapted.collect()) == [("", "UNRESOLVED"), ("", "UNRESOLVED"), ("CL-COM-13101", "CODE_EXACT")]
    lineage = spark.createDataFrame([("cead", "abc", "2025-01-01T00:00:00+00:00", "g", "stale")], LINEAGE)
    evidence = export.fusion_evidence(lineage, PRODUCER)
    own = evidence.first()
    assert own["evidence_id"] == "EVD-X-" + hashlib.sha256(b"cead|abc|2025-01-01T00:00:00+00:00").hexdigest()[:20]
    assert (own["quality_status"], own["source_run_id"], own["ingested_at"], own["producer_id"], own["source_tier"]) == ("STALE", "g", "g", "X", "GOVERNED_PUBLIC")
    events = export.fusion_events(adapted, PRODUCER, own)
    (event,) = events.collect()
    assert event["event_id"] == "EVT-X-" + hashlib.sha256(b"CL-COM-13101|2024|a|").hexdigest()[:24] and event["event_type"] == "TERRITORIAL_CRIME_STATISTIC"
    assert event["temporal"]["valid_to"] == "2025-01-01T00:00:00+00:00" and event["temporal"]["freshness_state"] == "STALE" and event["temporal"]["observed_at"] == own["retrieved_at"] and event["temporal"]["source_published_at"] is None
    attributes = event["attributes"].asDict()
    assert attributes["source_id"] is None and attributes["year"] == 2024 and not {"territory_id", "radar_id", "interop_version"} & set(attributes) and event["entity_ids"] == [] and event["evidence_ids"] == [own["evidence_id"]]
    assert export.interop_status(adapted).first().asDict() == {"interop_version": "1.0", "radar_id": "X", "rows": 3, "resolved": 1, "unresolved": 2, "territory_id_format": "CL-COM-{CUT}"}
    told = export.fusion_status(adapted, events, evidence).first().asDict()
    assert (told["events"], told["evidence"], told["territory_rows"], told["freshness_state"], told["source_failure_is_zero"]) == (1, 1, 3, "STALE", False)
    with pytest.raises(Exception, match="lineage"):
        export.fusion_evidence(lineage.drop("retrieved_at", "generated_at"), PRODUCER).first()


def test_an_export_makes_its_master_once(spark, tmp_path):
    rows = spark.createDataFrame([("13101", 2024, None)], "commune_code string, year int, source_id string").withColumn("crime_category", F.expr("uuid()"))
    export.interop_export(rows, spark.createDataFrame([("cead", None, None, "2025", None)], LINEAGE), str(tmp_path / "out"), PRODUCER)
    read = lambda name: json.loads("".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out" / name).glob("part-*")))
    assert read("territory_interop")["crime_category"] == read("territory_events_fusion")["attributes"]["crime_category"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("13101", 2024, "á", None)], "commune_code string, year int, crime_category string, source_id string")
    lineage = spark.createDataFrame([("cead", None, None, "2025", None)], LINEAGE)
    export.interop_export(rows, lineage, str(tmp_path / "out"), PRODUCER)
    read = lambda name: "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out" / name).glob("part-*"))  # noqa: E731  a part may be empty
    assert json.loads(read("territory_interop"))["source_id"] is None and "á" in read("territory_interop")
    event, evidence = json.loads(read("territory_events_fusion")), json.loads(read("evidence_fusion"))
    assert event["evidence_ids"] == [evidence["evidence_id"]] and event["attributes"]["crime_category"] == "á" and evidence["quality_status"] == "VALID"
    assert json.loads((tmp_path / "out/fusion_interop_status.json").read_text())["events"] == 1
    with pytest.raises(ValueError, match="empty"):
        export.interop_export(rows.limit(0), lineage, str(tmp_path / "none"), PRODUCER)
    with pytest.raises(ValueError, match="lineage"):
        export.interop_export(rows, lineage.limit(0), str(tmp_path / "none"), PRODUCER)
    assert not (tmp_path / "none").exists()
    scores = spark.createDataFrame([("13101", 50.5, "Medio", "<b>A&B</b>"), ("2", None, None, None)], "commune_code string, score double, level string, commune_name string")
    method = geographic.methodology()
    block = export.score_block(scores, method)
    page = export.injected("<body></body>", block)
    assert page.count("50.5") == 1 and export.injected(page, block) == page and "&lt;b&gt;A&amp;B&lt;/b&gt;" in block and "<b>A" not in block
    assert block.index("<td>1</td><td>&lt;b&gt;") < block.index("<td>2</td><td>—</td>") and "Delito base directo: 55%" in block and "Tráfico de sustancias (33%)" in block and method["methodology"]["trend"] in block
    activity = spark.createDataFrame([("2", "Dos", "r", 7, None, None, "t"), ("1", "<Uno>", "r", 1500, 1000, 2.5, "t")], "commune_code string, commune_name string, region_name string, cases_policiales long, previous_cases_policiales long, yoy_pct double, source_tier string")
    regions = spark.createDataFrame([("13", "Metropolitana", 70.04, "alta"), ("05", "Valparaíso", 80.0, "muy_alta")], "region_code string, region_name string, pressure_score double, pressure_level string")
    status = spark.createDataFrame([(k, f"s{k}", k % 2 == 0, "<down>" if k % 2 else None) for k in range(30)], "ordinal int, source_id string, ok boolean, error string")
    manifest = {"active_backbone": "mirror_of_primary", "bridge_snapshot": {"ok": True, "max_date": "2025-06-01", "content_sha256": "a" * 64}, "coverage": {"observed_communes": 2, "expected_communes": 346, "years": [2024], "records": 9, "unavailable_communes": [{"commune_code": "3", "commune_name": "Tres"}]}}
    export.dashboard(str(tmp_path), manifest, activity, regions, dims.catalog(spark), status, features=activity, integration=regions, extra={"x": 1})
    page, data = (tmp_path / "index.html").read_text(), json.loads((tmp_path / "data.json").read_text())
    assert page.count("<table>") == 5 and page.count('class="card"') == 4 and "Tres (CUT 3): no_disponible" in page and "<td>1</td><td>&lt;Uno&gt;</td><td>r</td><td>1.500</td><td>1.000</td><td>+2.5%</td>" in page and "<td>2</td><td>Dos</td><td>r</td><td>7</td><td>—</td><td>s/d</td>" in page
    assert page.index("Valparaíso") < page.index("Metropolitana") and "<td>70.0</td>" in page and "máx. 2025-06-01" in page and "SHA256 aaaaaaaaaaaa<" in page and "2/346" in page and "&lt;down&gt;" in page and "s8<" in page and "s7<" not in page and "family:4" in page
    assert [r["commune_name"] for r in data["activity"]] == ["<Uno>", "Dos"] and data["activity"][1]["cases_policiales"] == 7 and len(data["status"]) == 30 and data["predicate_features"] == {"path": "predicate_features", "rows": 2} and data["extra"] == {"x": 1}
    contract = spark.createDataFrame([("a",), ("a",), ("b",)], "signal_family string")
    for _ in range(2):
        export.with_score(str(tmp_path), scores, contract, method)
    data, page = json.loads((tmp_path / "data.json").read_text()), (tmp_path / "index.html").read_text()
    assert data["geographic_score"][0]["score"] == 50.5 and data["integration"] == {"path": "integration", "rows": 3, "families": {"a": 2, "b": 1}} and page.count("A&amp;B") == 1 and data["geographic_score_methodology"]["layers"]["criminal_economy"]["components"][5]["aliases"] == ["abigeato"]
    assert spark.read.json(str(tmp_path / "integration")).count() == 3
    lineage = export.lineage_of(spark, {"generated_at": "2025", "bridge_snapshot": {"source_id": "b", "producer_manifest": {"freshness": {"status": "stale"}, "bridge_snapshot": {"content_sha256": "c", "retrieved_at": "2024"}}}})
    assert (row := export.fusion_evidence(lineage, PRODUCER).first())["quality_status"] == "STALE" and (row["source_id"], row["content_sha256"], row["retrieved_at"], row["ingested_at"]) == ("b", "c", "2024", "2025")


def test_contract(spark):
    regions = spark.createDataFrame([(2024, "13", 70.0)], "year int, region_code string, pressure_score double")
    features = spark.createDataFrame([("CL-1", "2024", 5, "cead_predicate_offense", "predicate_direct", "s", "s"), ("CL-1", "2024", 5, "other", None, None, None)], "territory_id string, period string, value long, signal_family string, aml_class string, source_id string, ultimate_source_id string")
    old = spark.createDataFrame([("CL-2", "2024", 60.0, "13", None, "x")], "territory_id string, period string, cead_aml_priority_score double, region_code string, commune_code string, commune_name_norm string")
    found = {r["signal_family"]: r for r in export.integration_contract(regions, features, old).collect()}
    assert set(found) == {"ministerio_publico_aml_proxy", "cead_predicate_offense", "cead_art27_drug_family"}
    assert found["cead_predicate_offense"]["source_families"] == ["s"] and found["cead_art27_drug_family"]["source_families"] == ["cead_estadisticas_delictuales"]
    assert found["cead_art27_drug_family"]["join_keys"]["commune_name_norm"] == "x" and found["cead_predicate_offense"]["join_keys"]["commune_name_norm"] is None
    assert all(r["excludes_homicide_weight"] for r in found.values()) and {"crime_category", "article27_mapping_key", "aml_weight", "mapping_confidence", "source_tier", "quality_status", "article27_relation"} < set(found["cead_predicate_offense"].asDict())


def test_places(spark):
    known = spark.createDataFrame([("13", "santiago", "13101", 0), ("13", "santiago", "13199", 1)], "region_code string, name_norm string, commune_code string, ordinal int")
    rows = spark.createDataFrame([("13", "santiago", "commune", None, "x", "Santiago"), ("05", "santiago", "commune", "7", "y", "Santiago"), ("13", "santiago", "region", None, "z", "nada")], "region_code string, commune_name_norm string, territory_level string, commune_code string, territory_id string, commune_name string")
    assert sorted((r["territory_id"], r["commune_code"]) for r in places.codes_attached(rows, known).collect()) == [("CL-13199", "13199"), ("y", "7"), ("z", None)]
    assert places.attach_status(rows).first().asDict() == {"matched": 1, "ok": False}
    known = spark.createDataFrame([("santiago", "13101", 0), ("arica", "15101", 1), ("mala", "123456", 2)], "name_norm string, commune_code string, ordinal int")
    shape = "commune_name string, territory_level string, region_code string, commune_code string, territory_id string, territory_key_status string"
    rows = [("Santiago", "commune", "13", None, "t1", None), ("ARICA", "commune", "13", "13999", "t2", None), ("Otra", "commune", "05", "05999", "t3", "earlier"), ("Santiago", "region", "13", "13", "t4", None), ("Arica", "commune", "15", "x", "t5", "name_fallback"), (None, "commune", "13", "y", "t6", None), ("Santiago", "commune", None, "z", "t7", None), ("Mala", "commune", "12", "w", "t8", None)]
    coded = places.codes_by_name(spark.createDataFrame(rows, shape), known)
    got = sorted((r["territory_id"], r["commune_code"], r["territory_key_status"], r["territory_mapping_method"]) for r in coded.collect())
    assert got == [
        ("CL-COM-13101", "13101", "official_cut", "CODE_EXACT"), ("CL-COM-15101", "15101", "official_cut", "CODE_EXACT"), ("t2", "13999", "cut_region_mismatch", None), ("t3", "05999", "earlier", None), ("t4", "13", None, None), ("t6", "y", None, None),
        ("t7", "z", "cut_region_mismatch", None), ("t8", "w", "cut_region_mismatch", None),
    ]
    assert places.codes_status(coded, 2).first().asDict() == {"source_id": "cead_cut_join", "ok": False, "input_communes": 4, "matched_communes": 2, "unmatched_communes": 0, "region_mismatches": 3, "territory_id_format": "CL-COM-{CUT}"}
    annual = spark.createDataFrame([("R", "a", 3), ("R", "Bé", 4)], "region_name string, commune_name string, victims int")
    recent = spark.createDataFrame([("r", "BE", 1), ("R", "c", 2)], "region_name string, commune_name string, victims int")
    found = {r["commune_name"]: (r["period"], r["recent_h1_2025_victims"], r["recent_h1_2025_status"]) for r in places.homicide_communes(annual, recent).collect()}
    assert found == {"a": ("2024", 0, "derived_zero_not_listed_in_complete_positive_table"), "Bé": ("2024", 1, "observed_positive"), "c": ("2025-H1", 2, None)}


def test_homicide_tables(spark):
    reg = "year int, period string, period_type string, region_code string, region_name string, victims int, rate_100k double"
    regions = spark.createDataFrame([(2024, "2024", "annual", "13", "Metropolitana de Santiago", 1000, 5.0), (2024, "2024", "annual", "6", "O'Higgins", 207, 5.0), (2025, "2025-H1", "h1", "13", "Metropolitana de Santiago", 511, 2.5)], reg)
    annual = spark.createDataFrame([("Metropolitana", "Santiago", 1000, 9.0, 500_000), ("O’Higgins", "Rancagua", 207, 8.0, 1)], "region_name string, commune_name string, victims int, rate_100k double, population int")
    annual = annual.withColumn("region_name", F.replace("region_name", F.lit("’"), F.lit("`")))
    recent = spark.createDataFrame([("Metropolitana", "SANTIAGO", 500), ("Metropolitana", "Maipú", 11)], "region_name string, commune_name string, victims int")
    codes = spark.createDataFrame([("santiago", "13101")], "name_norm string, commune_code string")
    rows = places.homicide_rows(regions, annual, recent, codes).collect()
    of = {(r["period"], r["territory_id"]): r for r in rows}
    assert len(rows) == 6 and of["2024", "CL-06"]["value"] == 207 and of["2024", "CL-06-rancagua"]["region_name"] == "Libertador General Bernardo O'Higgins"
    santiago, maipu = of["2024", "CL-13101"], of["2025-H1", "CL-13-maipu"]
    assert (santiago["recent_h1_2025_victims"], santiago["recent_h1_2025_status"], santiago["weight"]) == (500, "observed_positive", 0.65) and of["2024", "CL-06-rancagua"]["recent_h1_2025_victims"] == 0
    assert (maipu["value"], maipu["rate_100k"], maipu["data_status"], maipu["period_type"], maipu["source_id"]) == (11, None, "observed_official_table_partial", "h1", "homicidios_interinstitucional_h1_2025")
    with pytest.raises(ValueError, match="control totals"):
        places.homicide_rows(regions.withColumn("victims", F.col("victims") + 1), annual, recent)


def test_cache_keys_meet_however_written(spark):
    old = spark.createDataFrame([(2024, "1101", "Tráfico", 1, 0)], "year int, commune_code string, crime_category string, value int, ordinal int")
    new = spark.createDataFrame([(2024, "01101", "TRAFICO", 2, 0), (2024, None, "x", 3, 0)], "year int, commune_code string, crime_category string, value int, ordinal int")
    assert sorted((r["commune_code"] or "", r["value"]) for r in merge.upserted(old, new).collect()) == [("", 3), ("01101", 2)]


def test_a_lot_that_covers_too_little_is_no_lot(spark):
    lot = spark.createDataFrame([("1", 5), ("2", 6), ("", 7), (None, 8)], "commune_code string, value int")
    assert merge.gated(lot, 3).count() == 0 and merge.gated(lot, 2).count() == 4 and merge.gated(lot.limit(0), 1).count() == 0
