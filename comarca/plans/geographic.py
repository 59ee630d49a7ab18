"""The layered geographic score: from commune x year x category rows to a score for each commune.

The master is read once: it is aggregated to cells (commune, year, category), which are held in the shared folder, and all
that follows reads those. What a value is compared with (a component's distribution in a year) is tallied: a row for each
distinct value with its count. Ranks, quartiles, medians and median deviations are positions among the tallies' running sums,
found in sorted windows that spill, without a buffer that grows with the places. Windows otherwise run over a commune's own years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca import dims
from comarca.files import held
from comarca.functions.stats import anomaly_score, half_even, interpolated, score_level, trend_score
from comarca.functions.text import norm
from comarca.operators.classify import usable

FAMILY, VERSION = "cead_criminogenic_geographic_score", "1.0.0"
#: Who a commune is, from the first of its rows.
IDENTITY = ("territory_id", "region_code", "region_name", "commune_name")


def _code5():
    raw = F.coalesce(F.col("commune_code").cast("string"), F.lit(""))
    return F.when(F.length(raw) < 5, F.lpad(raw, 5, "0")).otherwise(raw)


def cells(master: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """(code, year, norm, v, rows, who): sums and counts of usable rows by commune, year and category, and the first row's identity.

    Codes are five digits with zeros in front; a missing code is 00000, any other is null and no commune, but its year counts. Rows count as first by
    `ordinal` where master has it. The result is held: it has at most a row for each row of the master.
    """
    has = lambda c, kind="string": F.col(c).cast(kind) if c in master.columns else F.lit(None).cast(kind)
    at = has(ordinal, "long") if ordinal in master.columns else F.lit(0).cast("long")
    fits = usable(has("quality_status"))
    rows = master.select(
        _code5().alias("code"), F.col("year").cast("int").alias("year"), norm(F.col("crime_category")).alias("norm"), F.when(fits, F.coalesce("value", F.lit(0)).cast("double")).alias("value"), fits.cast("int").alias("fits"),
        F.struct(at.alias("at"), *[has(c).alias(c) for c in IDENTITY]).alias("who"),
    )
    known = rows.withColumn("code", F.when(F.col("code").rlike(r"^\d{5}$"), F.col("code"))).groupBy("code", "year", "norm")
    sums = F.sum("value").alias("v"), F.sum("fits").alias("rows")
    if not {ordinal, *IDENTITY} & {*master.columns}:  # nobody is known: plain sums, which a hash aggregate takes
        return held(known.agg(*sums).withColumn("who", F.lit(None).cast(rows.schema["who"].dataType)))
    first = F.min("who") if ordinal in master.columns else F.max("who")  # without an order, what is known comes first
    return held(known.agg(*sums, first.alias("who")))


class Occurring:
    """What one pass over the cells tells: the latest year, and the components that occur. A layer's fallback labels count, the first that occurs, only where no component of it does."""

    def __init__(self, own: DataFrame, layers: dict = dims.LAYERS):
        rows = dims.component_rows(layers)
        known = F.when(_observed() & F.col("norm").isin(*{r[7] for r in rows}), F.col("norm"))
        found = own.agg(F.max("year").alias("latest"), F.collect_set(known).alias("labels")).first()  # a set of the labels of the components
        self.latest, labels = found["latest"], set(found["labels"])
        here = [r for r in rows if r[7] in labels]
        first = {layer: min(r[8] for r in here if r[1] == layer) for layer in {r[1] for r in here}}
        self.kinds = [r for r in here if r[8] == first[r[1]]]


def _observed() -> Column:
    return (F.col("rows") > 0) & F.col("code").isNotNull() & F.col("year").isNotNull()


def series(own: DataFrame, told: Occurring) -> DataFrame:
    """(layer..., component, code, year, v): values of cells by component."""
    kinds = F.broadcast(own.sparkSession.createDataFrame(told.kinds, dims.COMPONENT_SCHEMA))
    of = ["layer_at", "layer", "layer_weight", "component_at", "component", "component_label", "component_weight"]
    return own.where(_observed()).join(kinds, F.col("norm") == F.col("label")).groupBy(*of, "code", "year").agg(F.sum("v").alias("v"))


def distributions(values: DataFrame) -> DataFrame:
    """(component, year, v) of values -> for each distinct v of a component's year: less, equal, n, q75, median, mad; all exact.

    One exchange for the tallies, by value, and one for all that is compared within a component's year.
    """
    by = ["component", "year"]
    tally = values.groupBy(*by, "v").agg(F.count("*").alias("equal"))
    whole = Window.partitionBy(*by)
    upto = lambda order: F.sum("equal").over(whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("equal")
    placed = tally.withColumns({"less": upto("v"), "n": F.sum("equal").over(whole)})
    at = lambda value, less, q: interpolated(F.col(value), F.col(less), F.col("equal"), F.col("n"), q, by)
    told = placed.withColumns({"q75": at("v", "less", 0.75), "median": at("v", "less", 0.5)}).withColumn("__off", F.abs(F.col("v") - F.col("median")))
    # Equal deviations stand beside each other: positions among them are right whichever comes first.
    return told.withColumn("__nearer", upto("__off")).withColumn("mad", at("__off", "__nearer", 0.5)).drop("__off", "__nearer")


def component_metrics(master: DataFrame, layers: dict = dims.LAYERS) -> DataFrame:
    """Intensity, persistence, trend, anomaly and score of each (component, commune) observed in the latest year."""
    own = cells(master)
    return cell_metrics(own, Occurring(own, layers))


def cell_metrics(own: DataFrame, told: Occurring) -> DataFrame:
    rows = series(own, told)
    own_years = Window.partitionBy("component", "code")
    before = own_years.orderBy("year").rowsBetween(-3, -1)
    timed = rows.join(distributions(rows.select("component", "year", "v")), ["component", "year", "v"]).withColumns({
        "mean": F.avg("v").over(before),
        "persistence": half_even(100.0 * F.sum((F.col("v") >= F.col("q75")).cast("int")).over(own_years) / F.count("*").over(own_years), 2),
        "years_observed": F.count("*").over(own_years),
    })
    now = timed.where(F.col("year") == F.lit(told.latest))
    scored = now.select(
        "layer_at", "layer", "layer_weight", "component_at", "component", "component_label", "component_weight", "code", "year", F.col("v").alias("value"),
        half_even(F.when(F.col("n") <= 1, 50.0).otherwise(100.0 * (F.col("less") + 0.5 * F.col("equal")) / F.col("n")), 2).alias("intensity"), "persistence",
        half_even(trend_score(F.col("v"), F.col("mean")), 2).alias("trend"), half_even(anomaly_score(F.col("v"), F.col("median"), F.col("mad"), F.col("n")), 2).alias("anomaly"), "years_observed",
    )
    total = sum((w * F.col(k) for k, w in dims.FACTOR_WEIGHTS.items()), F.lit(0.0))
    return scored.withColumn("score", half_even(total, 2))


def layer_scores(metrics: DataFrame, layers: dict = dims.LAYERS) -> DataFrame:
    """Per (commune, layer): the observed components' weighted mean and their share of the layer's weight."""
    whole = {name: sum(w for w, _ in parts.values()) or 1.0 for name, (_, _, parts) in layers.items()}
    total = F.create_map(*[x for k, v in whole.items() for x in (F.lit(k), F.lit(v))])
    # A commune's components of a layer, a handful, in their order.
    parts = F.array_sort(F.collect_list(F.struct("component_at", F.col("component").alias("id"), F.col("component_label").alias("label"), F.col("component_weight").alias("configured_weight"), "score", "value", "intensity", "persistence", "trend", "anomaly", "years_observed")))
    grouped = metrics.groupBy("code", "layer", "layer_weight").agg(F.sum(F.col("component_weight") * F.col("score")).alias("weighted"), F.sum("component_weight").alias("available"), parts.alias("components"))
    return grouped.select("code", "layer", "layer_weight", half_even(F.try_divide("weighted", "available"), 2).alias("layer_score"), half_even(F.least(F.lit(1.0), F.col("available") / total[F.col("layer")]), 4).alias("coverage"), "components")


def geographic_scores(master: DataFrame, layers: dict = dims.LAYERS) -> DataFrame:
    """One row for each commune of master: who it is, score, level, confidence, and per layer its score and coverage; null where nothing was observed.

    `layers` holds a struct for each layer with its label, weight, score, coverage and the observed components' details.
    """
    own = cells(master)
    told = Occurring(own, layers)
    scored = layer_scores(cell_metrics(own, told), layers)
    per = [F.max(F.when(F.col("layer") == name, F.col(c))).alias(f"{name}_{c}") for name in layers for c in ("layer_score", "coverage")]
    details = [F.first(F.when(F.col("layer") == name, F.col("components")), ignorenulls=True).alias(f"{name}_components") for name in layers]
    weights = sum(w for w, _, _ in layers.values())
    total = scored.groupBy("code").agg(F.sum(F.col("layer_weight") * F.col("layer_score")).alias("__num"), F.sum("layer_weight").alias("__den"), F.sum(F.col("layer_weight") * F.col("coverage")).alias("__cov"), *per, *details)
    communes = own.where(F.col("code").isNotNull()).groupBy("code").agg(F.min_by("who", F.coalesce("who.at", F.lit(0))).alias("who"))
    joined = communes.where(F.lit(told.latest is not None)).withColumn("year", F.lit(told.latest).cast("int")).join(total, "code", "left")
    score = half_even(F.try_divide("__num", "__den"), 2)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    none: Column = F.array().cast(scored.schema["components"].dataType)
    layer = lambda name: F.struct(F.lit(dims.LAYER_LABELS.get(name, name)).alias("label"), F.lit(layers[name][0]).alias("configured_weight"), F.col(f"{name}_layer_score").alias("score"), zero(f"{name}_coverage").alias("coverage"), F.coalesce(F.col(f"{name}_components"), none).alias("components"))
    out = joined.select(
        F.coalesce(F.nullif(F.col("who.territory_id"), F.lit("")), F.concat(F.lit("CL-"), "code")).alias("territory_id"), "who.region_code", "who.region_name", F.col("code").alias("commune_code"), "who.commune_name",
        F.col("year").cast("string").alias("period"), "year", F.lit(FAMILY).alias("signal_family"), score.alias("score"), half_even(100.0 * F.coalesce("__cov", F.lit(0.0)) / weights, 1).alias("confidence"),
        *[c for name in layers for c in (F.col(f"{name}_layer_score"), zero(f"{name}_coverage").alias(f"{name}_coverage"))],
        F.lit(VERSION).alias("score_version"), F.struct(*[F.lit(w).alias(name) for name, (w, _, _) in layers.items()]).alias("layer_weights"), F.struct(*[layer(name).alias(name) for name in layers]).alias("layers"), F.lit(dims.INTERPRETATION).alias("interpretation"),
    )
    return out.withColumn("level", score_level(F.col("score")))


def methodology(layers: dict = dims.LAYERS) -> dict:
    """The score's method as a document: weights, layers with their components and labels, and each factor in words."""
    part = lambda c, w, labels: {"id": c, "label": dims.COMPONENT_LABELS.get(c, c), "weight": w, "aliases": list(labels)}
    return {
        "version": VERSION, "score_range": [0, 100], "layer_weights": {name: w for name, (w, _, _) in layers.items()}, "feature_weights": dims.FACTOR_WEIGHTS,
        "layers": {name: {"label": dims.LAYER_LABELS.get(name, name), "fallback_aliases": list(fallback), "components": [part(c, w, labels) for c, (w, labels) in parts.items()]} for name, (_, fallback, parts) in layers.items()},
        "convergence_bonus": {"enabled": False}, "methodology": dims.METHODOLOGY, "interpretation": dims.INTERPRETATION,
    }


def ranked(scores: DataFrame) -> DataFrame:
    """Scored communes first, by score and code, both descending."""
    return scores.orderBy(F.col("score").desc_nulls_last(), F.col("commune_code").desc())


def integration_rows(scores: DataFrame) -> DataFrame:
    """Scores in the shape of the integration contract."""
    return scores.select(
        "territory_id", F.lit("commune").alias("geography_level"), "period", "signal_family", "score", F.lit(None).cast("long").alias("value"), F.lit("score_0_100").alias("metric"), "score_version",
        F.lit("territorial_criminogenic_context").alias("aml_relevance"), "confidence", "layer_weights", "layers", F.struct("region_code", "commune_code", norm(F.col("commune_name")).alias("commune_name_norm")).alias("join_keys"),
        F.array(F.lit("cead_estadisticas_delictuales")).alias("source_families"), F.lit(True).alias("excludes_homicide_as_predicate"), "interpretation",
    )
