"""The batch run from stored inputs: facts in, every output dataset out, in a new version of the output folder.

A run makes only what a changed input leads to (`ledger`), audits what it wrote, and points to it only if that suffices (`publish`).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from comarca import dims
from comarca.files import held
from comarca.functions.text import norm
from comarca.operators import classify, export, merge
from comarca.plans import geographic, ledger, priorities, publish, rollups
from comarca.sources.tables import document, jsonl, or_last_good

MASTER = "year int, period string, territory_level string, territory_id string, commune_code string, commune_name string, region_code string, region_name string, crime_category string, metric string, value long, source_id string, ultimate_source_id string, source_tier string, quality_status string, ordinal long"
METRICS = "year int, region_code string, region_name string, crime_category string, value long, territory_level string, metric string, source_id string"
COMMUNAL = "year int, period string, territory_id string, region_code string, region_name string, commune_name string, commune_name_norm string, commune_code string, cead_family_key string, quality_status string, score_eligible boolean, rate_100k double, population long, estimated_frequency long, source_id string, ultimate_source_id string"


EVENTS = "event_id string, source_id string, title string, url string, published_date string, matched_keywords array<string>, event_type string, data_status string, retrieved_at string"
PUBLICATIONS = "source_id string, title string, url string, retrieved_at string, publication_type string, data_status string"
EVIDENCE = "evidence_id string, source_id string, url string, retrieved_at string, sha256 string, bytes long, observation_unit string"
STATUS = "ordinal long, source_id string, ok boolean, records long, error string"
COMMUNES = "commune_code string, commune_name string, region_code string, region_name string"
LINEAGE = "source_id string, ultimate_source_id string, source_url string, source_tier string, content_sha256 string, retrieved_at string, generated_at string, freshness string"
#: What the scoring of money laundering leaves out, said in so many words.
HOMICIDE_CONTEXT = {"enabled": False, "aml_weight": 0.0, "score_eligible": False, "records_in_v04_core": 0}

#: Input files as JSON lines below the inputs' folder; what is absent is empty.
INPUTS = {
    "bridge": MASTER, "direct": MASTER, "direct_lot": MASTER, "last_master": MASTER, "metrics": METRICS, "communal": COMMUNAL, "events": EVENTS, "publications": PUBLICATIONS, "evidence": EVIDENCE, "status": STATUS, "communes": COMMUNES,
    "lineage": LINEAGE,
}


class Inputs:
    """The inputs, and what several outputs are made of; each is read and made when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, least: int = dims.LEAST_COMMUNES):
        self.spark, self.folder, self.least = spark, folder, least

    def read(self, name: str) -> DataFrame:
        return jsonl(self.spark, f"{self.folder}/{name}.jsonl", INPUTS[name])

    @cached_property
    def direct(self) -> DataFrame:
        """The cache of direct rows with the new lot over it, if that lot covers enough; else as it is."""
        old, lot = merge.latest_picked(self.read("direct"), F.lit(0)), merge.gated(self.read("direct_lot"), self.least)
        return merge.upserted(old, lot)

    @cached_property
    def master(self) -> DataFrame:
        """Every output is made of the master, so it is merged once and held."""
        merged = classify.quality_normalised(merge.precedence_merged(self.read("bridge"), self.direct).drop("source_rank", "crime_category_norm"))
        return held(classify.catalog_mapped(or_last_good(merged, self.read("last_master"))))

    @cached_property
    def metrics(self) -> DataFrame:
        return classify.taxonomy_annotated(rollups.with_national(self.read("metrics")))

    @cached_property
    def pressure(self) -> DataFrame:
        return held(priorities.regional_pressure(self.metrics.where((F.col("territory_level") == "region") & (F.col("metric") == "delitos_ingresados"))))

    @cached_property
    def priority(self) -> DataFrame:
        return priorities.latest_region_priority(self.pressure)

    @cached_property
    def features(self) -> DataFrame:
        return export.predicate_features(self.master)

    @cached_property
    def scores(self) -> DataFrame:
        return held(geographic.geographic_scores(self.master))

    @cached_property
    def contract(self) -> DataFrame:
        return merge.family_replaced(export.integration_contract(self.priority, self.features), geographic.integration_rows(self.scores), geographic.FAMILY)


_ORDER = ("year", "commune_code", "crime_category_norm")
_MASTER = ("bridge", "direct", "direct_lot", "last_master")
#: Output -> the inputs that it is made of, and how.
OUTPUTS: dict[str, tuple[tuple[str, ...], Callable[[Inputs], DataFrame]]] = {
    "territorial_metrics": (("metrics", "communal"), lambda x: x.metrics.unionByName(x.read("communal"), allowMissingColumns=True)),
    "source_evidence": (("evidence",), lambda x: x.read("evidence")),
    "cead_master": (_MASTER, lambda x: x.master.orderBy(*_ORDER)),
    "direct_cache": (("direct", "direct_lot"), lambda x: x.direct.withColumn("crime_category_norm", norm(F.col("crime_category"))).orderBy(*_ORDER)),
    "predicate_features": (_MASTER, lambda x: x.features),
    "secondary_control": (("communal",), lambda x: x.read("communal")),
    "osint_events": (("events",), lambda x: x.read("events")),
    "publications": (("publications",), lambda x: x.read("publications")),
    "current_activity": (_MASTER, lambda x: priorities.current_activity(x.master).orderBy(F.col("cases_policiales").desc(), F.col("commune_code").desc())),
    "commune_priority": (("communal",), lambda x: priorities.commune_priority(x.read("communal")).orderBy(F.col("cead_aml_priority_score").desc(), "territory_id")),
    "region_priority": (("metrics",), lambda x: x.priority.orderBy(F.col("pressure_score").desc(), "region_code")),
    "region_pressure": (("metrics",), lambda x: x.pressure.orderBy("year", F.col("pressure_score").desc(), "region_code")),
    "catalog": ((), lambda x: dims.catalog(x.spark)),
    "legal_summary": ((), lambda x: classify.legal_summary(x.spark)),
    "integration_ready": ((*_MASTER, "metrics"), lambda x: x.contract),
    "geographic_score": (_MASTER, lambda x: geographic.ranked(x.scores)),
    "mp_metrics": (("metrics",), lambda x: x.metrics),
    "coverage": (_MASTER, lambda x: rollups.coverage(x.master)),
    "manifest": (_MASTER, lambda x: rollups.manifest(x.master)),
    "unavailable_communes": ((*_MASTER, "communes"), lambda x: rollups.unavailable(x.master, x.read("communes"))),
    "source_status": (("status",), lambda x: x.read("status").orderBy("ordinal")),
}


def run(spark: SparkSession, inputs: str, outputs: str, version: str, least: int = dims.LEAST_COMMUNES, generated_at: str | None = None) -> dict[str, str]:
    """Write the datasets, the interop export, the documents and the page below outputs/version=..., and point to the version if its master covers enough.

    The inputs are never written to. Outputs that no changed input leads to are those of the run before; if none changed, nothing
    is read or written at all. inputs/lineage.jsonl says where the master came from and inputs/producer.json who exports; without
    them nothing is exported to others. Gives the paths of the outputs.
    """
    book, folder = f"{outputs}/_ledger.json", f"{outputs}/version={version}"
    past = ledger.load(spark, book)
    now = ledger.inputs(spark, {**{name: f"{inputs}/{name}.jsonl" for name in INPUTS}, "producer": f"{inputs}/producer.json"}, past["inputs"])
    own, entries, made = Inputs(spark, inputs, least), {}, {}
    everything = {name: x["digest"] for name, x in now.items()} | {"least": least}
    if past.get("run") == everything:
        return {name: entry["path"] for name, entry in past["outputs"].items()}
    told = document(spark, f"{inputs}/producer.json")
    if not told:
        raise ValueError("producer.json is missing: it says who exports")
    if own.master.isEmpty():
        raise ValueError("the master is empty: what is missing is not zero")
    for name, (of, make) in OUTPUTS.items():
        # The gate of a new lot is an input of what that lot goes into.
        entry = ledger.unchanged(past, name, of, now) if "direct_lot" not in of or past.get("run", {}).get("least") == least else None
        if entry is None:
            frame = make(own)
            entry = {"of": {i: now[i]["digest"] for i in of}, "path": f"{folder}/{name}", "schema": frame.schema.json()}
            export.write_jsonl(frame, entry["path"])
        entries[name] = entry
        made[name] = spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).json(entry["path"])
    export.interop_export(made["cead_master"], own.read("lineage"), f"{folder}/interop", export.Producer(**told))
    verdicts = publish.audited(made, version, {"coverage": publish.covers("cead_master", least)})
    accepted = publish.settle(spark, outputs, version, verdicts)
    _documents(spark, made, folder, version, accepted, generated_at)
    ledger.save(spark, book, {"inputs": now, "outputs": entries, "run": everything, "version": version, "accepted": accepted})
    return {name: entry["path"] for name, entry in entries.items()}


def _documents(spark: SparkSession, made: dict[str, DataFrame], folder: str, version: str, accepted: bool, generated_at: str | None) -> None:
    """The small documents beside the datasets, and the page."""
    missing = [r.asDict() for r in made["unavailable_communes"].limit(dims.EXPECTED_COMMUNES).collect()]  # of a fixed list of communes
    backbone = {"source_id": "cead_community_bridge", "expected_communes": dims.EXPECTED_COMMUNES, "missing_expected_communes": missing}
    manifest = rollups.update_manifest(made["cead_master"], made["direct_cache"], made["secondary_control"], backbone, version=version, generated_at=generated_at)
    of = manifest["coverage"]
    coverage = {"expected_communes": of["expected_communes"], "observed_communes": of["observed_communes"], "unavailable_communes": [m["commune_code"] for m in missing], "rule": "absence is never turned into zero"}
    method = geographic.methodology()
    for name, value in {"coverage": coverage, "homicide_context": HOMICIDE_CONTEXT, "geographic_score_methodology": method, "update_manifest": manifest}.items():
        export.write_document(spark, value, f"{folder}/{name}.json")
    export.write_document(spark, {"version": version, "communes": of["observed_communes"], "expected_communes": of["expected_communes"], "accepted": accepted, "coverage": coverage, "manifest": made["manifest"].first().asDict()}, f"{folder}/status.json")
    export.dashboard(f"{folder}/public", manifest, made["current_activity"], made["region_priority"], made["catalog"], made["source_status"], features=made["predicate_features"], integration=made["integration_ready"], homicide_context=HOMICIDE_CONTEXT, coverage=coverage)
    export.with_score(f"{folder}/public", made["geographic_score"], made["integration_ready"], method)
