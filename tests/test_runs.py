import json
import time

import pytest
from pyspark.sql import functions as F

from comarca.plans import offline, publish, rollups
from comarca.sources import pages


def write(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")


def test_offline_run(spark, tmp_path):
    row = lambda code, year, label, value, tier, k: {"year": year, "period": str(year), "territory_id": f"CL-{code}", "commune_code": code, "crime_category": label, "metric": "casos_policiales", "value": value, "source_tier": tier, "quality_status": "usable_bridge", "source_id": "s", "ordinal": k}
    write(tmp_path / "bridge.jsonl", [row("13101", 2023, "Delitos asociados a drogas", 80, "mirror_of_primary", 0), row("13101", 2024, "Delitos asociados a drogas", 90, "mirror_of_primary", 1), row("13102", 2024, "Homicidios", 1, "mirror_of_primary", 2)])
    write(tmp_path / "direct.jsonl", [row("13101", 2024, "Delitos asociados a drogas", 100, "primary_direct", 0)])
    write(tmp_path / "metrics.jsonl", [{"year": 2024, "region_code": r, "crime_category": "DELITOS LEY DE DROGAS", "value": v, "territory_level": "region", "metric": "delitos_ingresados", "source_id": "mp"} for r, v in (("13", 5), ("05", 9))])
    write(tmp_path / "lineage.jsonl", [{"source_id": "cead", "retrieved_at": "2025-01-01T00:00:00+00:00", "freshness": "stale"}])
    write(tmp_path / "communes.jsonl", [{"commune_code": c, "commune_name": c, "region_code": c[:2]} for c in ("13101", "13102", "13103")])
    write(tmp_path / "status.jsonl", [{"ordinal": 0, "source_id": "<mp>", "ok": True}])
    write(tmp_path / "publications.jsonl", [{"source_id": "spd", "title": "t", "url": "u"}])
    (tmp_path / "producer.json").write_text(json.dumps({"producer_id": "X", "capture_method": "Y"}))
    paths = offline.run(spark, str(tmp_path), str(tmp_path / "out"), "1")
    got = {name: spark.read.json(path).collect() for name, path in paths.items() if name != "commune_priority"}
    assert [(r["cases_policiales"], r["yoy_pct"]) for r in got["current_activity"]] == [(100, 25.0)]
    assert {r["commune_code"]: r["score"] for r in got["geographic_score"]}["13101"] is not None
    assert {r["signal_family"] for r in got["integration_ready"]} == {"ministerio_publico_aml_proxy", "cead_predicate_offense", "cead_criminogenic_geographic_score"}
    assert len(got["mp_metrics"]) == 3 and len(got["region_pressure"]) == 2 and len(got["publications"]) == 1 and len(paths) >= 19
    folder = tmp_path / "out/version=1"
    status, data = json.loads((folder / "status.json").read_text()), json.loads((folder / "public/data.json").read_text())
    assert status["communes"] == 2 and status["coverage"]["unavailable_communes"] == ["13103"] and [r["commune_code"] for r in got["unavailable_communes"]] == ["13103"]
    assert data["geographic_score"][0]["commune_code"] == "13101" and data["status"][0]["source_id"] == "<mp>" and "13101" in (folder / "public/index.html").read_text() and "&lt;mp&gt;" in (folder / "public/index.html").read_text()
    score = next(r for r in got["geographic_score"] if r["commune_code"] == "13101")
    assert score["territory_id"] == "CL-13101" and score["layers"]["predicate_direct"]["components"][0]["id"] == "drug_family_fallback" and score["layers"]["predicate_direct"]["components"][0]["label"] == "delitos asociados a drogas" and score["layer_weights"]["predicate_direct"] == 0.55
    signal = next(r for r in got["integration_ready"] if r["signal_family"] == "cead_criminogenic_geographic_score")
    assert signal["join_keys"]["commune_code"].startswith("131") and "No representa probabilidad" in signal["interpretation"]
    event = spark.read.json(str(folder / "interop/territory_events_fusion")).first()
    assert event["temporal"]["freshness_state"] == "STALE" and event["evidence_ids"] == [spark.read.json(str(folder / "interop/evidence_fusion")).first()["evidence_id"]]
    assert event["producer_id"] == "X" and json.loads((folder / "update_manifest.json").read_text())["coverage"]["offenses"] == 2 and not status["accepted"]
    (tmp_path / "nothing").mkdir()
    (tmp_path / "nothing/producer.json").write_text(json.dumps({"producer_id": "X", "capture_method": "Y"}))
    with pytest.raises(ValueError, match="empty"):
        offline.run(spark, str(tmp_path / "nothing"), str(tmp_path / "none"), "2")
    # Too few communes: the version is there, but nothing points to it.
    out = str(tmp_path / "out")
    assert publish.current(spark, out) is None and [(r["audit"], r["ok"], r["told"]) for r in publish.status(spark, out).collect()] == [("coverage", False, "2 of at least 340 communes")]
    assert offline.run(spark, str(tmp_path), out, "2", least=2)["cead_master"] != paths["cead_master"]
    assert publish.current(spark, out).endswith("version=2")


def jobs(spark, f):
    """How many jobs Spark ran for f()."""
    tracker, group = spark.sparkContext.statusTracker(), f"g{time.time()}"
    spark.sparkContext.setJobGroup(group, "")
    f()
    spark.sparkContext.setJobGroup("", "")
    return len(tracker.getJobIdsForGroup(group))


def test_a_run_makes_only_what_changed(spark, tmp_path):
    row = lambda code, k, value: {"year": 2024, "period": "2024", "territory_id": f"CL-{code}", "commune_code": code, "crime_category": "Delitos asociados a drogas", "metric": "casos_policiales", "value": value, "source_tier": "mirror_of_primary", "quality_status": "usable", "source_id": "s", "ordinal": k}
    rows = [row(f"131{k:02d}", k, k + 1) for k in range(4)]
    write(tmp_path / "bridge.jsonl", rows)
    write(tmp_path / "lineage.jsonl", [{"source_id": "cead", "retrieved_at": "2025-01-01T00:00:00+00:00"}])
    write(tmp_path / "publications.jsonl", [{"source_id": "a", "title": "t", "url": "u"}])
    (tmp_path / "producer.json").write_text(json.dumps({"producer_id": "X", "capture_method": "Y"}))
    out, run = str(tmp_path / "out"), lambda version, **more: offline.run(spark, str(tmp_path), str(tmp_path / "out"), version, least=4, **more)
    first = run("1")
    assert jobs(spark, lambda: run("2")) == 0 and run("2") == first  # the same inputs: nothing is read
    time.sleep(1.1)
    write(tmp_path / "bridge.jsonl", rows[::-1])  # touched, but the same lines
    assert run("3") == first
    write(tmp_path / "publications.jsonl", [{"source_id": "a", "title": "t2", "url": "u"}])
    second = run("4")
    assert [n for n in first if second[n] != first[n]] == ["publications"] and publish.current(spark, out).endswith("version=4")
    # A lot with too few communes is refused: the last good version stays what readers see, and the refusal is a status row.
    write(tmp_path / "direct_lot.jsonl", [row("13101", 9, 500) | {"source_tier": "primary_direct"}])
    third = run("5")
    assert {r["value"] for r in spark.read.json(third["cead_master"]).collect()} == {1, 2, 3, 4}
    write(tmp_path / "bridge.jsonl", rows[:2])
    run("6")
    assert publish.current(spark, out).endswith("version=5") and {(r["version"], r["ok"]) for r in publish.status(spark, out).collect()} == {("1", True), ("4", True), ("5", True), ("6", False)}


def test_write_audit_publish(spark, tmp_path):
    rows = lambda n, v: spark.createDataFrame([(f"0110{k}", 2024, v) for k in range(n)], "commune_code string, year int, value int")
    expected = spark.createDataFrame([(2024, 12)], "year int, value long")
    audits = {"coverage": publish.covers("master", 3), "totals": publish.totals_hold("master", expected, ["year"])}
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.published(spark, out, "master")
    assert publish.publish(spark, {"master": rows(3, 4)}, out, "a", audits)
    assert not publish.publish(spark, {"master": rows(2, 6)}, out, "b", audits)  # too few
    assert not publish.publish(spark, {"master": rows(3, 5)}, out, "c", audits)  # totals
    assert publish.published(spark, out, "master").count() == 3 and publish.pointed(spark, out) == {"version": "a", "before": None}
    assert publish.publish(spark, {"master": rows(4, 3)}, out, "b", audits) and publish.pointed(spark, out) == {"version": "b", "before": "a"} and publish.published(spark, out, "master").count() == 4
    with pytest.raises(ValueError, match="is published"):
        publish.publish(spark, {"master": rows(4, 3)}, out, "b", audits)
    (tmp_path / "out/_pointers/000000000003.json").write_text('{"version": "z')  # a pointer that was cut off
    assert publish.published(spark, out, "master").count() == 4
    told = {(r["version"], r["audit"]): (r["ok"], r["told"]) for r in publish.status(spark, out).collect()}
    assert told["c", "totals"] == (False, "1 keys miss their total") and told["b", "coverage"] == (True, "4 of at least 3 communes") and told["c", "coverage"][0]


def test_totals_of_several_sets(spark):
    rows = spark.createDataFrame([(2024, "13", "a", 1), (2024, "13", "b", 2), (2024, None, "a", 4), (2023, "05", "a", 8), (2024, "13", "a", 16)], "year int, region_code string, crime_category string, value long")
    sets = [["year", "region_code", "crime_category"], ["year", "region_code"], ["year", "crime_category"], ["year"], []]
    found = rollups.totals(rows, sets[0], sets)
    got = sorted(((r["level"], r["year"], r["region_code"], r["crime_category"], r["value"]) for r in found.collect()), key=repr)
    want = [(k, *((x if c in own else None) for c, x in zip(sets[0], key, strict=True)), sum(r["value"] for r in rows.collect() if all(r[c] == x for c, x in zip(sets[0], key, strict=True) if c in own))) for k, own in enumerate(sets) for key in {tuple(r[c] if c in own else None for c in sets[0]) for r in rows.collect()}]
    assert got == sorted(want, key=repr)
    plan = rollups.totals(rows, sets[0], sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1 and "Union" not in plan


def test_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>á</p>", encoding="utf-8")
    good, bad = (tmp_path / "a.html").as_uri(), (tmp_path / "none.html").as_uri()
    saved = pages.fetched(spark, [good, bad])
    found = {r["url"]: r for r in saved.collect()}
    assert found[good]["ok"] and found[good]["bytes"] == 9 and not found[bad]["ok"] and found[bad]["html"] is None
    targets = spark.createDataFrame([("x", good), ("x", bad), ("y", good)], "source_id string, url string")
    status = {r["source_id"]: (r["ok"], r["pages"]) for r in pages.page_status(pages.replayed(targets, saved)).collect()}
    assert status == {"x": (False, 1), "y": (True, 1)}


def test_registry_and_probe(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title> Fiscalía\n de Chile </title>", encoding="utf-8")
    good, bad = (tmp_path / "a.html").as_uri(), (tmp_path / "none.html").as_uri()
    rows = [{"source_id": "b", "url": bad, "priority": 1}, {"source_id": "a", "url": good, "priority": 1}, {"source_id": "c", "url": good, "priority": 2}, {"source_id": "cead_estadisticas_delictuales", "url": good, "priority": 1}]
    (tmp_path / "sources.json").write_text(json.dumps({"sources": rows}))
    targets = pages.probe_targets(pages.registry(spark, str(tmp_path / "sources.json")))
    health = pages.probed(targets, pages.fetched(spark, [good, bad])).collect()
    assert [(r["source_id"], r["ok"], r["title"]) for r in health] == [("b", False, None), ("a", True, "Fiscalía de Chile")] and "Error" in health[0]["error"]
    legal = pages.legal_targets(spark).withColumn("url", F.when(F.col("ordinal") == 0, good).otherwise(bad))
    evidence, status = pages.legal_evidence(legal, pages.fetched(spark, [good, bad]))
    assert [(r["evidence_id"], r["rules_version"], r["bytes"] > 0) for r in evidence.collect()] == [("legal:fiscalia_catalogo_delitos:v0.2", "0.2.0", True)]
    assert [(r["ok"], r["static_rules_available"]) for r in status.collect()] == [(True, None), (False, True)]
    (tmp_path / "h.json").write_text(json.dumps({"signals": {"x": {"sector_tags": ["a"], "aml_relevance": "high"}}}))
    assert [tuple(r) for r in pages.sector_hypotheses(spark, str(tmp_path / "h.json")).collect()] == [("x", ["a"], "high", None)]
    assert pages.registry(spark, str(tmp_path / "absent.json")).collect() == []
