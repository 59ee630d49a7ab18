"""Contracts for consumers: stable identities, one row shape for signals, events and evidence, and the files they go to."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from html import escape

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from comarca import dims
from comarca.files import held, read_text, write_text
from comarca.functions.text import commune_code, commune_id, html_escaped, signed_percent, thousands
from comarca.operators.merge import distinct_sources


def digest(parts: list[Column], prefix: str, length: int) -> Column:
    """prefix and the first digits of the SHA-256 of the parts joined by |; a missing part is an empty one."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, length))


@dataclass(frozen=True)
class Producer:
    """Who exports, as consumers know them: id, capture method, and what identities of events and evidence begin with."""

    producer_id: str
    capture_method: str
    event_prefix: str = "EVT-"
    evidence_prefix: str = "EVD-"
    source_tier: str = "GOVERNED_PUBLIC"
    source_id: str = "cead_governed_snapshot"
    ultimate_source_id: str = "cead_estadisticas_delictuales"


def adapted(master: DataFrame, producer: Producer, version: str = "1.0") -> DataFrame:
    """master with the canonical commune id, or none where the code does not resolve (the code stays as it is)."""
    code = commune_code(F.col("commune_code"))
    return master.withColumns({
        "territory_id": commune_id(code), "commune_code": F.coalesce(code, F.col("commune_code").cast("string")), "territory_mapping_method": F.when(code.isNotNull(), "CODE_EXACT").otherwise("UNRESOLVED"),
        "territory_mapping_confidence": F.when(code.isNotNull(), 1.0).otherwise(0.0), "interop_version": F.lit(version), "radar_id": F.lit(producer.producer_id),
    })


def fusion_evidence(lineage: DataFrame, producer: Producer) -> DataFrame:
    """lineage: any of source_id, ultimate_source_id, source_url, source_tier, content_sha256, retrieved_at, generated_at, freshness. The evidence that events point to.

    A row with neither retrieved_at nor generated_at fails the job: nothing is exported without lineage.
    """
    has = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in lineage.columns else F.lit(None).cast("string")
    source = F.coalesce(has("source_id"), F.lit(producer.source_id))
    at = F.coalesce(has("retrieved_at"), has("generated_at"), F.raise_error(F.lit("lineage timestamp missing: nothing is exported without lineage")).cast("string"))
    return lineage.select(
        digest([source, has("content_sha256"), at], producer.evidence_prefix, 20).alias("evidence_id"), F.lit(producer.producer_id).alias("producer_id"), source.alias("source_id"), F.coalesce(has("ultimate_source_id"), F.lit(producer.ultimate_source_id)).alias("ultimate_source_id"),
        has("source_url").alias("source_url"), F.coalesce(has("source_tier"), F.lit(producer.source_tier)).alias("source_tier"), F.lit(producer.capture_method).alias("capture_method"), has("generated_at").alias("source_run_id"), has("content_sha256").alias("content_sha256"),
        F.when(has("freshness") == "stale", "STALE").otherwise("VALID").alias("quality_status"), F.lit(None).cast("string").alias("source_published_at"), at.alias("retrieved_at"), F.coalesce(has("generated_at"), at).alias("ingested_at"), F.lit("1.0").alias("schema_version"),
    )


def fusion_events(rows: DataFrame, producer: Producer, evidence: Row | None = None) -> DataFrame:
    """An event for each row with a territory, a year and a category: the whole year as interval, what else the row holds as attributes.

    rows are adapted(); year and category may go by their other names. evidence is the row of fusion_evidence() that all point to.
    """
    given = lambda *names: [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in rows.columns] or [F.lit(None).cast("string")]
    year, category = F.coalesce(*given("year", "commercial_year")).try_cast("int"), F.coalesce(*given("crime_category", "category", "offense"))
    kept = rows.withColumns({"__year": year, "__category": category}).where(F.col("territory_id").isNotNull() & F.col("__year").isNotNull() & F.col("__category").isNotNull())
    day = lambda y: F.format_string("%04d-01-01T00:00:00+00:00", y)
    told = evidence.asDict() if evidence else {}
    known = lambda name: F.lit(told.get(name)).cast("string")
    temporal = F.struct(
        day(F.col("__year")).alias("valid_from"), day(F.col("__year") + 1).alias("valid_to"), known("source_published_at").alias("source_published_at"), known("retrieved_at").alias("observed_at"), known("retrieved_at").alias("retrieved_at"),
        known("ingested_at").alias("ingested_at"), known("retrieved_at").alias("last_seen_at"), F.lit("STALE" if told.get("quality_status") == "STALE" else "CURRENT").alias("freshness_state"),
    )
    none = F.array().cast("array<string>")
    attributes = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("interop_version", "radar_id", "territory_id")])
    source = F.col("source_id") if "source_id" in rows.columns else F.lit(None).cast("string")
    return kept.select(
        digest([F.col("territory_id"), F.col("__year"), F.col("__category"), source], producer.event_prefix, 24).alias("event_id"), F.lit("TERRITORIAL_CRIME_STATISTIC").alias("event_type"), F.lit(producer.producer_id).alias("producer_id"),
        none.alias("entity_ids"), F.array("territory_id").alias("territory_ids"), none.alias("sector_ids"), (F.array(known("evidence_id")) if evidence else none).alias("evidence_ids"), temporal.alias("temporal"), attributes.alias("attributes"),
    )


def interop_status(adapted_rows: DataFrame) -> DataFrame:
    resolved = F.count_if(F.col("territory_id").isNotNull())
    return adapted_rows.agg(
        F.lit("1.0").alias("interop_version"), F.first("radar_id", ignorenulls=True).alias("radar_id"), F.count("*").alias("rows"), resolved.alias("resolved"), (F.count("*") - resolved).alias("unresolved"), F.lit("CL-COM-{CUT}").alias("territory_id_format")
    )


def fusion_status(adapted_rows: DataFrame, events: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row: what the fusion export holds, and how it is to be read."""
    told = evidence.agg(F.count("*").alias("evidence"), F.when(F.bool_or(F.col("quality_status") == "STALE"), "STALE").otherwise("CURRENT").alias("freshness_state"))
    rows = interop_status(adapted_rows).select("interop_version", "radar_id", F.lit("FUSION_EXPORT_READY_TERRITORY_CONTEXT").alias("status"), F.col("rows").alias("territory_rows"), F.col("resolved").alias("resolved_territories"), F.col("unresolved").alias("unresolved_territories"))
    one = lambda frame: frame.withColumn("__one", F.lit(1))  # noqa: E731  a row each
    out = one(rows).join(one(events.agg(F.count("*").alias("events"))), "__one").join(one(told), "__one").drop("__one")
    return out.withColumns({"source_failure_is_zero": F.lit(False), "policy": F.lit("TERRITORIAL_STATISTICS_ARE_CONTEXT_NOT_ENTITY_ATTRIBUTION")})


def predicate_features(master: DataFrame) -> DataFrame:
    """Eligible rows of positive weight, in the shape of features; other columns stay."""
    kept = master.where(F.col("score_eligible") & (F.col("aml_weight") > 0))
    return kept.withColumns({
        "geography_level": F.lit("commune"), "period": F.col("year").cast("string"), "signal_family": F.lit("cead_predicate_offense"), "metric": F.lit("casos_policiales"), "value": F.coalesce("value", F.lit(0)),
        "ultimate_source_id": F.lit("cead_estadisticas_delictuales"), "excludes_homicide_weight": F.lit(True),
    })


#: What a signal carries over from the row it is made of, where that has it: name -> type.
CARRIED = {"crime_category": "string", "article27_mapping_key": "string", "article27_relation": "string", "aml_weight": "double", "mapping_confidence": "string", "source_tier": "string", "quality_status": "string"}


def _signal(rows: DataFrame, level: str, period: Column, family: Column, score: Column, value: Column, metric: Column, version: str, relevance: Column, sources: Column, carried: tuple[str, ...] = (), keys: tuple[str, ...] = ("region_code", "commune_code")) -> DataFrame:
    has = lambda c, kind="string": F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind)
    joins = F.struct(*[(has(k) if k in keys else F.lit(None).cast("string")).alias(k) for k in ("region_code", "commune_code", "commune_name_norm")])
    return rows.select(
        has("territory_id").alias("territory_id"), F.lit(level).alias("geography_level"), period.cast("string").alias("period"), family.alias("signal_family"), score.cast("double").alias("score"), value.cast("long").alias("value"), metric.alias("metric"),
        F.lit(version).alias("score_version"), relevance.alias("aml_relevance"), *[(has(c, kind) if c in carried else F.lit(None).cast(kind)).alias(c) for c, kind in CARRIED.items()], joins.alias("join_keys"), sources.alias("source_families"),
        F.lit(True).alias("excludes_homicide_weight"),
    )


def integration_contract(regions: DataFrame, features: DataFrame, compat: DataFrame | None = None) -> DataFrame:
    """Regional scores, predicate features and, for older snapshots, communal scores, as signals of one shape; what a shape lacks is null."""
    none = F.lit(None)
    region = regions.withColumn("territory_id", F.concat(F.lit("CL-"), "region_code"))
    out = _signal(region, "region", F.col("year"), F.lit("ministerio_publico_aml_proxy"), F.col("pressure_score"), none, F.lit("score_proxy"), "0.4", F.lit("analytical_proxy"), F.array(F.lit("ministerio_publico_saf")), keys=("region_code",))
    sources = lambda rows: distinct_sources([F.col(c) for c in ("source_id", "ultimate_source_id") if c in rows.columns] or [none.cast("string")], "cead_estadisticas_delictuales")
    own = features.where(F.col("signal_family") == "cead_predicate_offense")
    metric = F.col("metric") if "metric" in features.columns else F.lit("casos_policiales")
    kind = F.coalesce("aml_class", F.lit("predicate_direct")) if "aml_class" in features.columns else F.lit("predicate_direct")
    carried = ("crime_category", "article27_mapping_key", "aml_weight", "mapping_confidence", "source_tier", "quality_status")
    out = out.unionByName(_signal(own, "commune", F.col("period"), F.col("signal_family"), none, F.col("value"), metric, "0.4", kind, sources(own), carried))
    if compat is not None:
        relation = ("article27_relation",)
        keys = ("region_code", "commune_code", "commune_name_norm")
        out = out.unionByName(_signal(compat, "commune", F.col("period"), F.lit("cead_art27_drug_family"), F.col("cead_aml_priority_score"), none, F.lit("score_proxy"), "0.3-compat", F.lit("direct_predicate_family"), sources(compat), relation, keys))
    return out


def write_jsonl(frame: DataFrame, path: str) -> None:
    """JSON lines with nulls kept, in a new folder: a path that is still being read is never overwritten."""
    frame.write.option("ignoreNullFields", "false").json(path)


def write_document(spark: SparkSession, value, path: str) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def interop_export(master: DataFrame, lineage: DataFrame, folder: str, producer: Producer) -> None:
    """Interop rows, events, their evidence and both status documents below a folder.

    lineage: one row, as fusion_evidence() reads it. An empty master or a lineage without a time is an error, never an empty export.
    The master is made once and kept in the shared folder: the files and both documents are written from it.
    """
    master = held(master)
    if master.isEmpty():
        raise ValueError("the master is empty: what is missing is not zero")
    spark, rows, evidence = master.sparkSession, adapted(master, producer), fusion_evidence(lineage, producer)
    first = evidence.first()
    if first is None:
        raise ValueError("lineage timestamp missing: nothing is exported without lineage")
    events = fusion_events(rows, producer, first)
    write_jsonl(rows, f"{folder}/territory_interop")
    write_jsonl(evidence, f"{folder}/evidence_fusion")
    write_jsonl(events, f"{folder}/territory_events_fusion")
    write_document(spark, interop_status(rows).first().asDict(), f"{folder}/territory_interop_status.json")
    write_document(spark, fusion_status(rows, events, evidence).first().asDict(), f"{folder}/fusion_interop_status.json")


def top_activity(activity: DataFrame, k: int = 35) -> DataFrame:
    """The k communes of most cases, code descending on ties, with figures as the page shows them."""
    top = activity.orderBy(F.col("cases_policiales").desc(), F.col("commune_code").desc()).limit(k)
    return top.select("commune_code", "cases_policiales", thousands(F.col("cases_policiales")).alias("shown"), signed_percent(F.col("yoy_pct")).alias("change"))


MARKER = "<!-- geographic-score -->"


def _cells(*cells: Column) -> Column:
    """A table row; every cell is escaped, a missing one is a dash."""
    shown = [html_escaped(F.coalesce(c.cast("string"), F.lit("—"))) for c in cells]
    return F.concat(F.lit("<tr>"), *[x for c in shown for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))


def _lines(rows: DataFrame, *cells: Column) -> str:
    """The lines of a report's few rows, in their order."""
    return "".join(r["line"] for r in rows.select(_cells(*cells).alias("line")).collect())


def score_block(scores: DataFrame, method: dict | None = None, k: int = 25) -> str:
    """The best k scores as an HTML block between markers, with their ranks, and the method in words."""
    rows = scores.orderBy(F.col("score").desc_nulls_last(), F.col("commune_code").desc()).limit(k)
    has = lambda c: F.col(c) if c in scores.columns else F.lit(None).cast("string")
    confidence = F.concat(has("confidence").cast("string"), F.lit("%"))
    table = _table(("#", "Comuna", "Región", "Score", "Nivel", "Confianza"), _lines(rows, F.row_number().over(Window.orderBy(F.col("score").desc_nulls_last(), F.col("commune_code").desc())), has("commune_name"), has("region_name"), F.col("score"), F.col("level"), confidence))
    return f'{MARKER}<section id="geographic-score">{table}{_method_text(method) if method else ""}</section>{MARKER}'


def _method_text(method: dict) -> str:
    percent = lambda w: f"{round(w * 100)}%"
    layers = "".join(f"<li><b>{escape(x['label'])}: {percent(method['layer_weights'][name])}</b>. {escape(', '.join(f'{c["label"]} ({percent(c["weight"])})' for c in x['components']))}</li>" for name, x in method["layers"].items())
    words = "".join(f"<p><b>{escape(name)}:</b> {escape(text)}</p>" for name, text in method["methodology"].items())
    factors = ", ".join(f"{name} {percent(w)}" for name, w in method["feature_weights"].items())
    return f"<details><summary>Ayuda metodológica</summary><ul>{layers}</ul><p>{escape(factors)}</p>{words}</details>"


def injected(page: str, block: str) -> str:
    """The page with the block before </body>, in place of an earlier one."""
    parts = page.split(MARKER)
    bare = parts[0] + parts[2] if len(parts) == 3 else page
    return bare.replace("</body>", f"{block}</body>", 1) if "</body>" in bare else bare + block


def _table(heads: Sequence[str], lines: str, none: str = "Sin datos.") -> str:
    head = "".join(f"<th>{escape(h)}</th>" for h in heads)
    return f'<table><thead><tr>{head}</tr></thead><tbody>{lines or f"<tr><td colspan={len(heads)}>{escape(none)}</td></tr>"}</tbody></table>'


def _routes(manifest: dict) -> list[tuple[str, str, str | None, str]]:
    """The ways that data come, in the order in which they count: name, state, origin, control."""
    probe, bridge, of = manifest.get("primary_probe") or {}, manifest.get("bridge_snapshot") or {}, manifest.get("coverage") or {}
    short = lambda x: str(x or "")[:12]
    return [
        ("1 · directo", "OK" if probe.get("ok") else "BLOQUEADO", probe.get("endpoint"), f"HTTP {probe.get('http_status', '—')} · {probe.get('blocking_message') or 'respuesta válida'}"),
        ("2 · réplica", "OK" if bridge.get("ok") else "FALLA", bridge.get("repo"), f"máx. {bridge.get('max_date', '—')} · blob {short(bridge.get('upstream_blob_sha'))} · SHA256 {short(bridge.get('content_sha256'))}"),
        ("3 · control", "CONTROL", "BCN/SIIT → SPD/CEAD", f"{of.get('bcn_control_records') or 0} registros de control secundario"),
        ("4 · cuarentena", "NO SCORE", "reglas de calidad", "duplicados, cobertura insuficiente o esquema inesperado no ingresan al maestro"),
    ]


def _cards(manifest: dict) -> list[tuple[str, str, str]]:
    probe, bridge, of = manifest.get("primary_probe") or {}, manifest.get("bridge_snapshot") or {}, manifest.get("coverage") or {}
    primary = "Disponible" if probe.get("ok") else f"Bloqueado {probe.get('http_status', '')}".strip()
    return [
        ("CEAD primario", primary, "sondeado en cada corrida"), ("Backbone activo", manifest.get("active_backbone") or "sin dato", "directo → réplica → control BCN"),
        ("Cobertura comunal", f"{of.get('observed_communes')}/{of.get('expected_communes')}", f"observadas · años {', '.join(map(str, of.get('years') or []))}"),
        ("Frescura CEAD", str(bridge.get("max_date") or probe.get("latest_nonzero_period") or "—"), f"{of.get('records') or 0} registros anuales normalizados"),
    ]


def dashboard(folder: str, manifest: dict, activity: DataFrame, regions: DataFrame, catalog: DataFrame, status: DataFrame, features: DataFrame | None = None, integration: DataFrame | None = None, k: int = 35, statuses: int = 22, **documents) -> None:
    """index.html and data.json below a folder, from the manifest document and the datasets of a run.

    The page has cards, the ways that data come, the gaps, the k most active communes, the catalogue, the regions and the last
    status rows (ordinal, source_id, ok, ...). data.json has the activity of all communes, the regions, the catalogue and the status; features
    and integration, which grow with the data, lie beside it as JSON lines, and data.json says where and how many. Other documents go there as they are.
    """
    spark, has = activity.sparkSession, lambda frame, c: F.col(c) if c in frame.columns else F.lit(None).cast("string")
    number = lambda *order: F.row_number().over(Window.orderBy(*order))
    most = [F.col("cases_policiales").desc(), F.col("commune_code").desc()]
    best = activity.orderBy(*most).limit(k)
    last = status.orderBy(F.col("ordinal").desc()).limit(statuses)
    before = thousands(has(activity, "previous_cases_policiales").cast("long"))
    active = _lines(best, number(*most), F.coalesce(has(activity, "commune_name"), "commune_code"), has(activity, "region_name"), thousands(F.col("cases_policiales")), before, signed_percent(F.col("yoy_pct")), has(activity, "source_tier"))
    ranked = _lines(regions.orderBy(F.col("pressure_score").desc(), "region_code"), number(F.col("pressure_score").desc(), "region_code"), has(regions, "region_name"), F.format_string("%.1f", "pressure_score"), F.col("pressure_level"))
    mapped = _lines(catalog.orderBy("mapping_key"), F.col("mapping_key"), F.col("class"), F.when(F.col("eligible"), "Sí").otherwise("No"), F.format_string("%.1f", "weight"), F.col("basis"))
    health = _lines(last.orderBy("ordinal"), F.col("source_id"), F.when(F.col("ok"), "OK").otherwise("FALLA"), F.coalesce(has(status, "note"), F.substring(has(status, "error"), 1, 140), F.lit("")))
    routes = "".join(f"<tr>{''.join(f'<td>{escape(str(c if c is not None else ""))}</td>' for c in r)}</tr>" for r in _routes(manifest))
    cards = "".join(f'<div class="card"><div>{escape(a)}</div><b>{escape(b)}</b><small>{escape(c)}</small></div>' for a, b, c in _cards(manifest))
    gaps = " · ".join(f"{m.get('commune_name')} (CUT {m.get('commune_code')}): {m.get('data_status') or 'no_disponible'}" for m in manifest["coverage"].get("unavailable_communes") or [])
    sections = (
        ("Ruta de adquisición", _table(("Prioridad", "Estado", "Origen", "Control"), routes)), ("Cobertura territorial", f"<p>{escape(gaps or 'Sin brechas territoriales declaradas.')}</p>"),
        ("Actividad comunal reciente", _table(("#", "Comuna", "Región", "Casos", "Año previo", "Var.", "Fuente"), active, "Sin actividad utilizable.")),
        ("Homologación", _table(("Nivel", "Clase", "Pondera", "Peso", "Fundamento"), mapped)), ("Proxy regional", _table(("#", "Región", "Score", "Nivel"), ranked)), ("Salud y trazabilidad de fuentes", _table(("Fuente", "Estado", "Detalle"), health)),
    )
    body = "".join(f"<section><h2>{escape(title)}</h2>{html}</section>" for title, html in sections)
    write_text(spark, f"{folder}/index.html", f'<!doctype html><html lang="es"><head><meta charset="utf-8"></head><body><div class="cards">{cards}</div>{body}</body></html>')

    few = lambda rows: [json.loads(x) for x in rows.toJSON().collect()]
    beside = {}
    for name, frame in (("predicate_features", features), ("integration", integration)):
        if frame is not None:
            frame.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}")
            beside[name] = {"path": name, "rows": frame.count()}
    shown = {
        "manifest": manifest, "activity": few(activity.orderBy(*most).limit(dims.EXPECTED_COMMUNES)), "regions": few(regions.orderBy(F.col("pressure_score").desc(), "region_code")), "catalog": few(catalog.orderBy("mapping_key")),
        "status": few(status.orderBy("ordinal")), "expected_communes": dims.EXPECTED_COMMUNES,
    }
    write_document(spark, {**shown, **beside, **documents}, f"{folder}/data.json")


def with_score(folder: str, scores: DataFrame, contract: DataFrame, method: dict, k: int = 25) -> None:
    """Put the best scores into the dashboard below folder: its data.json gains them with their method, its page their block. Doing it again changes nothing.

    The contract, with the scores' rows in it, replaces the one that lies beside data.json.
    """
    spark = scores.sparkSession
    text, page = read_text(spark, f"{folder}/data.json"), read_text(spark, f"{folder}/index.html")
    if text is not None:
        best = scores.orderBy(F.col("score").desc_nulls_last(), F.col("commune_code").desc()).limit(dims.EXPECTED_COMMUNES)  # the page shows every commune of the country
        counts = {r["signal_family"]: r["count"] for r in contract.groupBy("signal_family").count().collect()}  # a few families
        contract.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/integration")
        integration = {"path": "integration", "rows": sum(counts.values()), "families": counts}
        write_document(spark, {**json.loads(text), "geographic_score": [json.loads(x) for x in best.toJSON().collect()], "geographic_score_methodology": method, "integration": integration}, f"{folder}/data.json")
    if page is not None:
        write_text(spark, f"{folder}/index.html", injected(page, score_block(scores, method, k)))


def lineage_of(spark: SparkSession, manifest: dict) -> DataFrame:
    """The lineage row that evidence is made of, from an update manifest: its backbone's own source where that tells one, else the backbone, else the run."""
    bridge = manifest.get("bridge_snapshot") or {}
    maker = bridge.get("producer_manifest") or {}
    source = maker.get("bridge_snapshot") or {}
    row = (
        source.get("source_id") or bridge.get("source_id"), source.get("ultimate_source_id"), source.get("download_url"), source.get("source_tier"), source.get("content_sha256"), source.get("retrieved_at") or manifest.get("generated_at"),
        manifest.get("generated_at"), (maker.get("freshness") or {}).get("status"),
    )
    return spark.createDataFrame([row], "source_id string, ultimate_source_id string, source_url string, source_tier string, content_sha256 string, retrieved_at string, generated_at string, freshness string")
