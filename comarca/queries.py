"""The driver's queries for the domain operators and the same results in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca import dims
from comarca.bindings import DENSE_SQL, REGIONAL_SQL, SPARSE_SQL, TIERED_SQL, dense, regional, sparse, table, tiered
from comarca.files import held
from comarca.functions import stats, text
from comarca.operators import classify, export, merge, places
from comarca.plans import geographic, priorities, rollups
from comarca.sources import osint

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# sparse() has brands for labels: the components in order take Brand#1, Brand#2, ...
_BRANDS = iter(range(1, 100))
LAYERS = {name: (weight, (), {c: (w, (f"brand {next(_BRANDS)}",)) for c, (w, _) in parts.items()}) for name, (weight, _, parts) in dims.LAYERS.items()}
#: The same with a first layer of which only the second fallback label occurs.
FALLBACK_LAYERS = LAYERS | {"predicate_direct": (0.55, ("no such brand", "brand 20", "brand 21"), {"drug_traffic": (0.5, ("nothing",)), "drug_production": (0.5, ("nothing either",))})}


#: Who exports, in the queries.
PRODUCER = export.Producer("COMARCA", "COMARCA_QUERIES", "EVT-COMARCA-", "EVD-COMARCA-")


def norm_sql(c: str) -> str:
    return rf"trim(regexp_replace(lower(regexp_replace(strip_accents(coalesce({c}, '')), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g'))"


def steady(sql: str) -> str:
    """round_even(x, n) as half_even() does it: x rounded to nine digits, as sums come in any order, and then half to even in whole numbers, not in binary ones."""
    out, at = "", 0
    while (start := sql.find("round_even(", at)) >= 0:
        open_ = start + len("round_even(")
        depth, comma, end = 1, -1, open_
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            comma = end if sql[end] == "," and depth == 1 else comma
            end += 1
        digits = int(sql[comma + 1 : end - 1])
        unit, whole = 10 ** (9 - digits), "(abs(v) // {u})"
        even = f"sign(v) * ({whole} + CASE WHEN 2 * (abs(v) % {{u}}) > {{u}} OR (2 * (abs(v) % {{u}}) = {{u}} AND {whole} % 2 = 1) THEN 1 ELSE 0 END)".replace("{u}", str(unit))
        out += f"{sql[at:start]}list_transform([CAST(round(({steady(sql[open_:comma])}) * 1e9) AS HUGEINT)], lambda v: CAST({even} AS DOUBLE) / {10**digits})[1]"
        at = end
    return out + sql[at:]


def query(sql: str | None = None):
    def kept(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = steady(sql)
        return f

    return kept


# ---- The geographic score ---------------------------------------------------------------------------------------


def geo_ctes(layers: dict, facts: str) -> str:
    rows = ", ".join(f"({at}, '{layer}', {weight}::DOUBLE, '{c}', {w}::DOUBLE, '{label}', 0)" for at, (layer, (weight, _, parts)) in enumerate(layers.items()) for c, (w, labels) in parts.items() for label in labels)
    more = "".join(f", ({at}, '{layer}', {weight}::DOUBLE, '{layer}_fallback', 1.0::DOUBLE, '{label}', {p})" for at, (layer, (weight, fallback, _)) in enumerate(layers.items()) for p, label in enumerate(fallback, 1))
    return f"""
    facts AS ({facts}),
    kinds(layer_at, layer, layer_weight, component, component_weight, label, priority) AS (VALUES {rows}{more}),
    summed AS (
        SELECT layer, layer_weight, component, component_weight, priority, lpad(commune_code, 5, '0') AS code, year, CAST(sum(coalesce(value, 0)) AS DOUBLE) AS v
        FROM facts JOIN kinds ON {norm_sql("crime_category")} = label GROUP BY ALL),
    own AS (SELECT * FROM summed WHERE (layer, priority) IN (SELECT layer, min(priority) FROM summed GROUP BY layer)),
    latest AS (SELECT max(year) AS latest FROM facts),
    base AS (SELECT *, quantile_cont(v, 0.75) OVER (PARTITION BY component, year) AS q75 FROM own),
    timed AS (
        SELECT *, avg(v) OVER (PARTITION BY component, code ORDER BY year ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean,
               round_even(100.0 * count(*) FILTER (WHERE v >= q75) OVER (PARTITION BY component, code) / count(*) OVER (PARTITION BY component, code), 2) AS persistence,
               count(*) OVER (PARTITION BY component, code) AS years_observed
        FROM base),
    now AS (
        SELECT timed.*, count(*) OVER w AS n, rank() OVER (w ORDER BY v) - 1 AS less, count(*) OVER (PARTITION BY component, v) AS equal, median(v) OVER w AS med
        FROM timed, latest WHERE year = latest WINDOW w AS (PARTITION BY component)),
    mads AS (SELECT component, median(abs(v - med)) AS mad FROM now GROUP BY component),
    factors AS (
        SELECT layer, layer_weight, component, component_weight, code, v AS value, years_observed, persistence,
               round_even(CASE WHEN n <= 1 THEN 50.0 ELSE 100.0 * (less + 0.5 * equal) / n END, 2) AS intensity,
               round_even(CASE WHEN mean IS NULL THEN 50.0 WHEN mean <= 0 THEN CASE WHEN v > 0 THEN 75.0 ELSE 50.0 END ELSE 50 + 50 * tanh((v - mean) / mean) END, 2) AS trend,
               round_even(CASE WHEN n < 3 THEN 50.0 WHEN mad = 0 THEN CASE WHEN v > med THEN 75.0 WHEN v < med THEN 25.0 ELSE 50.0 END ELSE 50 + 50 * tanh(0.6745 * (v - med) / mad / 3) END, 2) AS anomaly
        FROM now JOIN mads USING (component)),
    metrics AS (SELECT *, round_even(0.40::DOUBLE * intensity + 0.25::DOUBLE * persistence + 0.20::DOUBLE * trend + 0.15::DOUBLE * anomaly, 2) AS score FROM factors)"""


METRIC_COLUMNS = ("component", "commune_code", "value", "intensity", "persistence", "trend", "anomaly", "years_observed", "score")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geographic.component_metrics(sparse(spark, sf_dir), LAYERS).withColumnRenamed("code", "commune_code")


@query(f"WITH {geo_ctes(LAYERS, SPARSE_SQL)} SELECT component, code AS commune_code, value, intensity, persistence, trend, anomaly, years_observed, score FROM metrics")
def geo_component_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*METRIC_COLUMNS)


def scores_sql(layers: dict, facts: str, who: tuple[str, str] = ("NULL::VARCHAR", "NULL::VARCHAR")) -> str:
    whole = {name: sum(w for w, _ in parts.values()) for name, (_, _, parts) in layers.items()}
    total = "CASE layer " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in whole.items()) + " END"
    per = ", ".join(f"max(CASE WHEN layer = '{k}' THEN layer_score END) AS {k}_layer_score, max(CASE WHEN layer = '{k}' THEN coverage END) AS {k}_coverage" for k in layers)
    out = ", ".join(f"{k}_layer_score, coalesce({k}_coverage, 0.0) AS {k}_coverage" for k in layers)
    region, name = who
    weights = sum(w for w, _, _ in layers.values())
    return f"""
    WITH {geo_ctes(layers, facts)},
    layered AS (
        SELECT code, layer, layer_weight, round_even(sum(component_weight * score) / sum(component_weight), 2) AS layer_score, round_even(least(1.0, sum(component_weight) / ({total})), 4) AS coverage
        FROM metrics GROUP BY code, layer, layer_weight),
    totals AS (SELECT code, sum(layer_weight * layer_score) AS num, sum(layer_weight) AS den, sum(layer_weight * coverage) AS cov, {per} FROM layered GROUP BY code),
    parts AS (SELECT code, count(*) AS observed FROM metrics GROUP BY code),
    final AS (
        SELECT 'CL-' || c.code AS territory_id, c.region_code, c.code AS commune_code, c.commune_name, CAST(latest AS VARCHAR) AS period, 'cead_criminogenic_geographic_score' AS signal_family, CAST(coalesce(observed, 0) AS INTEGER) AS observed, 0.35::DOUBLE AS economy_weight, CAST(latest AS INTEGER) AS year, round_even(num / den, 2) AS score, round_even(100.0 * coalesce(cov, 0.0) / {weights!r}::DOUBLE, 1) AS confidence, {out}
        FROM (SELECT lpad(commune_code, 5, '0') AS code, max({region}) AS region_code, max({name}) AS commune_name FROM facts GROUP BY 1) c CROSS JOIN latest LEFT JOIN totals ON totals.code = c.code LEFT JOIN parts ON parts.code = c.code)
    SELECT *, CASE WHEN score >= 80 THEN 'Muy alto' WHEN score >= 65 THEN 'Alto' WHEN score >= 45 THEN 'Medio' WHEN score >= 25 THEN 'Bajo' WHEN score IS NOT NULL THEN 'Muy bajo' END AS level FROM final"""


def _scores(master: DataFrame, layers: dict) -> DataFrame:
    """Who, score, level, confidence and layers; the layers' components are counted."""
    found = geographic.geographic_scores(master, layers)
    per = [c for name in layers for c in (f"{name}_layer_score", f"{name}_coverage")]
    observed = sum((F.size(f"layers.{name}.components") for name in layers), F.lit(0)).alias("observed")
    return found.select("territory_id", "region_code", "commune_code", "commune_name", "period", "year", "signal_family", "score", "level", "confidence", *per, observed, F.col("layer_weights.criminal_economy").alias("economy_weight"))


@query(scores_sql(LAYERS, SPARSE_SQL))
def geo_score_flat(spark, sf_dir):
    return _scores(sparse(spark, sf_dir), LAYERS)


@query(scores_sql(FALLBACK_LAYERS, SPARSE_SQL))
def geo_score_fallback(spark, sf_dir):
    return _scores(sparse(spark, sf_dir), FALLBACK_LAYERS)


TYPES = ("economy", "large", "medium", "promo", "small", "standard")
DENSE_LAYERS = {"predicate_direct": (0.55, (), {f"a{k}": (w, (t,)) for k, (w, t) in enumerate(zip((0.537, 0.463), TYPES[:2]))}), "criminal_economy": (0.35, (), {f"b{k}": (w, (t,)) for k, (w, t) in enumerate(zip((0.611, 0.389), TYPES[2:4]))}), "criminogenic_context": (0.1, (), {f"c{k}": (w, (t,)) for k, (w, t) in enumerate(zip((0.703, 0.297), TYPES[4:]))})}


@query(scores_sql(DENSE_LAYERS, DENSE_SQL, ("region_code", "commune_name")))
def geo_score_dense(spark, sf_dir):
    return _scores(dense(spark, sf_dir), DENSE_LAYERS)


for _name, _columns in (("midrank_intensity", "value, intensity"), ("persistence_q75", "persistence, years_observed"), ("trend_last3", "value, trend"), ("robust_anomaly", "value, anomaly")):

    def _part(spark, sf_dir, columns=_columns):
        return _metrics(spark, sf_dir).select("component", "commune_code", *columns.split(", "))

    _part.__name__ = _name
    query(f"WITH {geo_ctes(LAYERS, SPARSE_SQL)} SELECT component, code AS commune_code, {_columns} FROM metrics")(_part)


@query(f"""
    WITH {geo_ctes(LAYERS, SPARSE_SQL)},
    layered AS (SELECT code, layer, layer_weight, round_even(sum(component_weight * score) / sum(component_weight), 2) AS layer_score FROM metrics GROUP BY code, layer, layer_weight)
    SELECT 'CL-' || code AS territory_id, 'commune' AS geography_level, CAST((SELECT latest FROM latest) AS VARCHAR) AS period, 'cead_criminogenic_geographic_score' AS signal_family, round_even(sum(layer_weight * layer_score) / sum(layer_weight), 2) AS score,
           'score_0_100' AS metric, '1.0.0' AS score_version, 'territorial_criminogenic_context' AS aml_relevance, 0.55::DOUBLE AS direct_weight, code AS join_code, '' AS join_name, true AS excludes_homicide_as_predicate, true AS interpreted
    FROM layered GROUP BY code""")
def geo_integration_rows(spark, sf_dir):
    rows = geographic.integration_rows(geographic.geographic_scores(sparse(spark, sf_dir), LAYERS)).where(F.col("score").isNotNull())
    return rows.select(
        "territory_id", "geography_level", "period", "signal_family", "score", "metric", "score_version", "aml_relevance", F.col("layer_weights.predicate_direct").alias("direct_weight"), F.col("join_keys.commune_code").alias("join_code"),
        F.col("join_keys.commune_name_norm").alias("join_name"), "excludes_homicide_as_predicate", F.contains("interpretation", F.lit("No representa probabilidad de lavado")).alias("interpreted"),
    )


# ---- Ranks, sums, merges ----------------------------------------------------------------------------------------


@query(f"""
    WITH facts AS ({SPARSE_SQL}), totals AS (SELECT commune_code, sum(value) AS total FROM facts GROUP BY 1)
    SELECT commune_code, CAST(total AS BIGINT) AS total,
           round_even(CASE WHEN count(*) OVER () = 1 THEN 50.0 ELSE 100.0 * (row_number() OVER (ORDER BY total, commune_code) - 1) / (count(*) OVER () - 1) END, 6) AS percentile
    FROM totals""")
def tie_rank_percentile(spark, sf_dir):
    totals = sparse(spark, sf_dir).groupBy("commune_code").agg(F.sum("value").alias("total"))
    return stats.with_percentiles(totals, {"percentile": "total"}, "commune_code").withColumn("percentile", F.bround("percentile", 6))


@query(f"WITH facts AS ({DENSE_SQL}) SELECT region_code, list_sort(list(value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS upper_median, round_even(quantile_cont(value, 0.75), 6) AS q75, round_even(median(value), 6) AS median FROM facts GROUP BY 1")
def quantiles(spark, sf_dir):
    found = stats.order_statistics(dense(spark, sf_dir), ["region_code"], "value", {"q75": 0.75, "median": 0.5}, "upper_median")
    return found.select("region_code", F.col("upper_median").cast("long").alias("upper_median"), F.bround("q75", 6).alias("q75"), F.bround("median", 6).alias("median"))


@query(f"WITH facts AS ({SPARSE_SQL}), totals AS (SELECT commune_code, sum(value) AS total FROM facts GROUP BY 1) SELECT CAST(list_sort(list(total))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS DOUBLE) AS value FROM totals")
def upper_median_of_all(spark, sf_dir):
    """Of all places' totals, in bands."""
    return stats.upper_median(held(sparse(spark, sf_dir).groupBy("commune_code").agg(F.sum("value").alias("total"))), "total")


PRESSURE_CTES = f"""
    facts AS ({REGIONAL_SQL}),
    totals AS (
        SELECT *, greatest(1, sum(value) OVER (PARTITION BY year, region_code)) AS rt, greatest(1, sum(value) OVER (PARTITION BY year, crime_category)) AS ct, greatest(1, sum(value) OVER (PARTITION BY year)) AS yt FROM facts),
    parts AS (SELECT *, ln(1 + value) * least(3.0, greatest(0.25, (CAST(value AS DOUBLE) / rt) / (CAST(ct AS DOUBLE) / yt))) * weight AS part FROM totals),
    raw AS (
        SELECT year, region_code, round(sum(CASE WHEN aml_class IN ('base_19913', 'proxy_19913') THEN part ELSE 0.0 END), 9) AS raw_aml, round(sum(CASE WHEN aml_class = 'crimen_organizado_proxy' THEN part ELSE 0.0 END), 9) AS raw_org,
               CAST(count(*) FILTER (WHERE aml_class IN ('base_19913', 'proxy_19913') AND value > 0) AS DOUBLE) AS diversity
        FROM parts GROUP BY year, region_code),
    years AS (SELECT year, row_number() OVER (ORDER BY year) AS nth FROM (SELECT DISTINCT year FROM facts)),
    timed AS (SELECT raw.*, nth FROM raw JOIN years USING (year)),
    ranked AS (
        SELECT a.year, a.region_code, CASE WHEN b.raw_aml > 0 THEN 50.0 + 50.0 * greatest(-1.0, least(1.0, (a.raw_aml - b.raw_aml) / b.raw_aml)) ELSE 50.0 END AS trend,
               100.0 * (row_number() OVER (PARTITION BY a.year ORDER BY a.raw_aml, a.region_code) - 1) / (count(*) OVER (PARTITION BY a.year) - 1) AS p_aml,
               100.0 * (row_number() OVER (PARTITION BY a.year ORDER BY a.raw_org, a.region_code) - 1) / (count(*) OVER (PARTITION BY a.year) - 1) AS p_org,
               100.0 * (row_number() OVER (PARTITION BY a.year ORDER BY a.diversity, a.region_code) - 1) / (count(*) OVER (PARTITION BY a.year) - 1) AS p_div
        FROM timed a LEFT JOIN timed b ON b.region_code = a.region_code AND b.nth = a.nth - 1),
    pressure AS (
        SELECT year, region_code, round_even(0.55::DOUBLE * p_aml + 0.25::DOUBLE * p_org + 0.10::DOUBLE * trend + 0.10::DOUBLE * p_div, 1) AS pressure_score, round_even(p_aml, 1) AS aml_component_percentile,
               round_even(p_org, 1) AS organized_crime_component_percentile, round_even(trend, 1) AS trend_component, round_even(p_div, 1) AS diversification_percentile FROM ranked)"""
LEVEL_SQL = "CASE WHEN {0} >= 80 THEN 'muy_alta' WHEN {0} >= 65 THEN 'alta' WHEN {0} >= 40 THEN 'media' ELSE 'baja' END"


@query(f"WITH {PRESSURE_CTES} SELECT *, {LEVEL_SQL.format('pressure_score')} AS pressure_level FROM pressure")
def region_pressure(spark, sf_dir):
    return priorities.regional_pressure(regional(spark, sf_dir)).drop("region_name", "method", "interpretation")


@query(f"WITH {PRESSURE_CTES} SELECT year, region_code, pressure_score FROM pressure WHERE year = (SELECT max(year) FROM pressure)")
def region_latest(spark, sf_dir):
    return priorities.latest_region_priority(priorities.regional_pressure(regional(spark, sf_dir))).select("year", "region_code", "pressure_score")


HOMICIDE_LIKE_SQL = """
    SELECT 'region' AS territory_level, CASE year(o_orderdate) WHEN 1998 THEN '2024' WHEN 1999 THEN '2024-H1' ELSE '2025-H1' END AS period, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code,
           CAST(count(*) AS DOUBLE) / 4 AS rate_100k
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1998 AND 2000 AND NOT (c_nationkey = 7 AND year(o_orderdate) = 1999) GROUP BY ALL"""


def _homicide_like(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y")).where(F.col("y").between(1998, 2000))
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).where(~((F.col("c_nationkey") == 7) & (F.col("y") == 1999)))
    period = F.when(F.col("y") == 1998, "2024").when(F.col("y") == 1999, "2024-H1").otherwise("2025-H1")
    return joined.groupBy(period.alias("period"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("region_code")).agg((F.count("*").cast("double") / 4).alias("rate_100k")).withColumn("territory_level", F.lit("region"))


@query(f"""
    WITH {PRESSURE_CTES}, homicide AS ({HOMICIDE_LIKE_SQL}),
    annual AS (SELECT region_code, rate_100k AS r24, 100.0 * (row_number() OVER (ORDER BY rate_100k, region_code) - 1) / (count(*) OVER () - 1) AS p24 FROM homicide WHERE period = '2024'),
    before AS (SELECT region_code, rate_100k AS h24 FROM homicide WHERE period = '2024-H1'),
    recent AS (SELECT region_code, rate_100k AS h25, 100.0 * (row_number() OVER (ORDER BY rate_100k, region_code) - 1) / (count(*) OVER () - 1) AS p25 FROM homicide WHERE period = '2025-H1'),
    joined AS (
        SELECT *, (h25 - h24) / greatest(h24, 0.1) AS delta, greatest(0.0, least(100.0, 50 + 50 * greatest(-1.0, least(1.0, (h25 - h24) / greatest(h24, 0.1))))) AS t
        FROM pressure JOIN annual USING (region_code) JOIN before USING (region_code) JOIN recent USING (region_code) WHERE year = (SELECT max(year) FROM pressure)),
    scored AS (SELECT *, round_even(0.60::DOUBLE * pressure_score + 0.20::DOUBLE * p24 + 0.15::DOUBLE * p25 + 0.05::DOUBLE * t, 1) AS s FROM joined)
    SELECT year, region_code, s AS territorial_priority_score, {LEVEL_SQL.format('s')} AS priority_level, pressure_score AS mp_aml_proxy_score, r24 AS homicide_2024_rate, round_even(p24, 1) AS homicide_2024_percentile,
           h25 AS homicide_h1_2025_rate, round_even(p25, 1) AS homicide_h1_2025_percentile, round_even(delta * 100, 1) AS homicide_h1_rate_change_pct, round_even(t, 1) AS recent_trend_component FROM scored""")
def region_priority_4way(spark, sf_dir):
    return priorities.region_priority(priorities.regional_pressure(regional(spark, sf_dir)), _homicide_like(spark, sf_dir)).drop("period", "region_name", "method", "interpretation")


COMMUNE_LIKE_SQL = f"""
    SELECT 'CL-' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS territory_id, CAST(count(*) FILTER (WHERE year(l_shipdate) <= 1998) AS BIGINT) AS value, CAST(count(*) FILTER (WHERE year(l_shipdate) > 2000) AS BIGINT) AS recent_h1_2025_victims,
           CAST(sum(l_linenumber) * 97 AS BIGINT) AS population, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / 8 AS rate_100k FROM lineitem GROUP BY l_suppkey"""


def _commune_like(spark, sf_dir):
    year = F.year("l_shipdate")
    counted = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(year <= 1998).alias("value"), F.count_if(year > 2000).alias("recent_h1_2025_victims"), (F.sum("l_linenumber") * 97).alias("population"), (F.count_if(F.col("l_returnflag") == "R").cast("double") / 8).alias("rate_100k"),
    )
    return counted.select(F.concat(F.lit("CL-"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("territory_id"), "value", "recent_h1_2025_victims", "population", "rate_100k")


def _place(c: str) -> str:
    return f"100.0 * (row_number() OVER (ORDER BY {c}, territory_id) - 1) / (count(*) OVER () - 1)"


@query(f"""
    WITH rows AS ({COMMUNE_LIKE_SQL}),
    figures AS (SELECT *, greatest(1, population) / (greatest(1, population) + 50000.0::DOUBLE) AS rel FROM rows),
    shrunk AS (SELECT *, rel * rate_100k + (1 - rel) * 6.0::DOUBLE AS rate, ln(1 + value) AS volume, CAST(recent_h1_2025_victims AS DOUBLE) AS recent FROM figures),
    scored AS (SELECT *, round_even(0.55::DOUBLE * ({_place('rate')}) + 0.25::DOUBLE * ({_place('volume')}) + 0.20::DOUBLE * ({_place('recent')}), 1) AS s FROM shrunk)
    SELECT territory_id, s AS homicide_pressure_score, {LEVEL_SQL.format('s')} AS pressure_level, value AS victims_2024, round_even(rate, 2) AS shrunk_rate_2024, recent_h1_2025_victims AS victims_h1_2025 FROM scored""")
def homicide_pressure(spark, sf_dir):
    found = priorities.homicide_pressure(_commune_like(spark, sf_dir))
    return found.select("territory_id", "homicide_pressure_score", "pressure_level", "victims_2024", "shrunk_rate_2024", "victims_h1_2025")


@query(f"""
    WITH base AS ({COMMUNE_LIKE_SQL}),
    rows AS (SELECT *, 0 AS ordinal FROM base UNION ALL SELECT territory_id, value + 1, recent_h1_2025_victims + 2, population * 2, rate_100k * 3, 1 FROM base WHERE population % 2 = 0),
    last AS (SELECT * FROM rows WHERE ordinal = 1 OR territory_id NOT IN (SELECT territory_id FROM rows WHERE ordinal = 1)),
    figures AS (SELECT *, greatest(1, population) / (greatest(1, population) + 50000.0::DOUBLE) AS rel FROM last),
    shrunk AS (SELECT *, rel * rate_100k + (1 - rel) * 6.0::DOUBLE AS rate, ln(1 + value) AS volume, CAST(recent_h1_2025_victims AS DOUBLE) AS recent FROM figures),
    scored AS (SELECT territory_id, round_even(rate, 2) AS shrunk_rate_2024, round_even(0.55::DOUBLE * ({_place('rate')}) + 0.25::DOUBLE * ({_place('volume')}) + 0.20::DOUBLE * ({_place('recent')}), 1) AS s FROM shrunk)
    SELECT CAST(2024 AS INTEGER) AS year, '2025-H1' AS recent_period, rows.territory_id, 'r ' || rows.territory_id AS region_name, s AS homicide_pressure_score, {LEVEL_SQL.format('s')} AS pressure_level, value AS victims_2024, rate_100k AS rate_100k_2024,
           population AS population_2024, shrunk_rate_2024, recent_h1_2025_victims AS victims_h1_2025, 'homicide_pressure_v0.2' AS method FROM rows JOIN scored ON scored.territory_id = rows.territory_id""")
def homicide_repeated(spark, sf_dir):
    """Half of the territories come twice, and rows of regions and of another period beside them: the last row counts for both, the others not at all."""
    base = _commune_like(spark, sf_dir).withColumns({"ordinal": F.lit(0), "territory_level": F.lit("commune"), "period": F.lit("2024"), "region_name": F.concat(F.lit("r "), "territory_id")})
    again = base.where(F.col("population") % 2 == 0).withColumns({"value": F.col("value") + 1, "recent_h1_2025_victims": F.col("recent_h1_2025_victims") + 2, "population": F.col("population") * 2, "rate_100k": F.col("rate_100k") * 3, "ordinal": F.lit(1)})
    other = base.withColumns({"territory_level": F.lit("region"), "ordinal": F.lit(5)}).unionByName(base.withColumns({"period": F.lit("2025-H1"), "ordinal": F.lit(6)}))
    found = priorities.homicide_pressure(again.unionByName(base).unionByName(other))
    return found.select("year", "recent_period", "territory_id", "region_name", "homicide_pressure_score", "pressure_level", "victims_2024", "rate_100k_2024", "population_2024", "shrunk_rate_2024", "victims_h1_2025", "method")


@query(f"""
    WITH rows AS (SELECT territory_id, rate_100k, CASE WHEN value % 3 <> 0 THEN population END AS population, CASE WHEN value % 3 <> 0 THEN recent_h1_2025_victims END AS frequency FROM ({COMMUNE_LIKE_SQL})),
    prior AS (SELECT list_sort(list(rate_100k))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS prior FROM rows),
    figures AS (SELECT *, CASE WHEN coalesce(population, 0) > 0 THEN population / (population + 25000.0::DOUBLE) ELSE 0.45::DOUBLE END AS rel FROM rows, prior),
    shrunk AS (SELECT *, rel * rate_100k + (1 - rel) * prior AS rate, coalesce(ln(1 + frequency), 0.0) AS volume FROM figures),
    placed AS (SELECT *, {_place('rate')} AS p_rate, {_place('volume')} AS p_volume FROM shrunk),
    scored AS (SELECT *, round_even(CASE WHEN frequency IS NOT NULL THEN 0.70::DOUBLE * p_rate + 0.30::DOUBLE * p_volume ELSE p_rate END, 1) AS s FROM placed)
    SELECT territory_id, s AS cead_aml_priority_score, {LEVEL_SQL.format('s')} AS priority_level, rate_100k AS drug_complaint_rate_100k, population, frequency AS estimated_frequency, round_even(rate, 2) AS shrunk_drug_rate,
           round_even(p_rate, 1) AS rate_percentile, CASE WHEN frequency IS NOT NULL THEN round_even(p_volume, 1) END AS volume_percentile, CASE WHEN coalesce(population, 0) > 0 THEN 'high' ELSE 'medium' END AS method_confidence
    FROM scored""")
def shrunk_priority(spark, sf_dir):
    known = F.col("value") % 3 != 0
    rows = _commune_like(spark, sf_dir).select(
        "territory_id", "rate_100k", F.when(known, F.col("population")).alias("population"), F.when(known, F.col("recent_h1_2025_victims")).alias("estimated_frequency"), F.lit(2024).alias("year"),
        F.lit("delitos_asociados_drogas").alias("cead_family_key"), F.lit("usable").alias("quality_status"), F.lit(True).alias("score_eligible"),
    )
    found = priorities.commune_priority(rows).withColumnRenamed("estimated_drug_complaints", "estimated_frequency")
    return found.select("territory_id", "cead_aml_priority_score", "priority_level", "drug_complaint_rate_100k", "population", "estimated_frequency", "shrunk_drug_rate", "rate_percentile", "volume_percentile", "method_confidence")


@query("""
    WITH facts AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS crime_category, count(*) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT region_code, year, crime_category, CAST(value AS BIGINT) AS value, 'region' AS territory_level FROM facts
    UNION ALL SELECT 'CL', year, crime_category, CAST(sum(value) AS BIGINT), 'national' FROM facts GROUP BY year, crime_category""")
def national_rollup(spark, sf_dir):
    """Regions and the nation from one pass over the orders."""
    facts = _orders_by_region(spark, sf_dir).withColumn("value", F.lit(1).cast("long"))
    return rollups.regions_and_nation(facts)


@query("""
    WITH facts AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS crime_category, count(*) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT region_code, year, crime_category, CAST(value AS BIGINT) AS value, 'region' AS territory_level FROM facts
    UNION ALL SELECT 'CL', year, crime_category, CAST(sum(value) AS BIGINT), 'national' FROM facts GROUP BY year, crime_category""")
def national_rows(spark, sf_dir):
    """The nation's rows appended to those of the regions."""
    rows = _orders_by_region(spark, sf_dir).groupBy("region_code", "year", "crime_category").agg(F.count("*").alias("value"))
    shaped = rows.withColumns({"territory_level": F.lit("region"), "metric": F.lit("delitos_ingresados"), "source_id": F.lit("orders")})
    return rollups.with_national(shaped).select("region_code", "year", "crime_category", "value", "territory_level")


def _orders_by_region(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("crime_category"))
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("region_code"), "year", "crime_category")


@query("""
    SELECT CAST(year(ts) AS INTEGER) AS year, CASE WHEN user_id % 10 <> 0 THEN user_id END AS commune_code, event_type AS crime_category, CAST(round_even(sum(value), 4) AS DOUBLE) AS value
    FROM events GROUP BY ALL""")
def annualize(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.year("ts").alias("year"), F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("commune_code"), F.col("event_type").alias("crime_category"), "value")
    return rollups.annualised(rows, ["commune_code", "crime_category"]).withColumn("value", F.bround("value", 4)).select("year", "commune_code", "crime_category", "value")


_RANK = "CASE source_tier WHEN 'primary_direct' THEN 10 WHEN 'mirror_of_primary' THEN 20 WHEN 'official_secondary' THEN 30 WHEN 'quarantined' THEN 90 ELSE {} END"


@query(f"""
    WITH facts AS ({TIERED_SQL}),
    kept AS (SELECT *, CASE WHEN source_tier = 'primary_direct' THEN 1 ELSE 0 END AS side, lpad(commune_code, 5, '0') AS code, {norm_sql('crime_category')} AS crime_category_norm FROM facts WHERE commune_code IS NOT NULL AND metric = 'casos_policiales'),
    best AS (SELECT *, row_number() OVER (PARTITION BY year, code, crime_category_norm ORDER BY CASE WHEN source_tier IS NULL THEN 90 ELSE {_RANK.format(99)} END, side, ordinal) AS k FROM kept)
    SELECT year, commune_code, crime_category_norm, value, source_tier, {_RANK.format(99)} AS source_rank FROM best WHERE k = 1""")
def precedence_merge(spark, sf_dir):
    side = F.col("source_tier").eqNullSafe("primary_direct").cast("int")
    return merge.precedence_picked(tiered(spark, sf_dir), side).select("year", "commune_code", "crime_category_norm", "value", "source_tier", "source_rank")


@query(f"""
    WITH facts AS (SELECT *, CASE WHEN source_tier = 'primary_direct' THEN 1 ELSE 0 END AS side, lpad(coalesce(commune_code, ''), 5, '0') AS code, {norm_sql('crime_category')} AS label FROM ({TIERED_SQL}) WHERE commune_code IS NOT NULL),
    best AS (SELECT *, row_number() OVER (PARTITION BY year, code, label ORDER BY side DESC, ordinal DESC) AS k FROM facts)
    SELECT year, code, label, value, source_tier FROM best WHERE k = 1""")
def cache_upsert(spark, sf_dir):
    rows = tiered(spark, sf_dir).where(F.col("commune_code").isNotNull())
    found = merge.latest_picked(rows, F.col("source_tier").eqNullSafe("primary_direct").cast("int"))
    return found.select("year", merge.keyed_code(F.col("commune_code")).alias("code"), text.norm(F.col("crime_category")).alias("label"), "value", "source_tier")


@query(f"""
    WITH facts AS ({SPARSE_SQL}), picked AS (SELECT commune_code, crime_category, year, value AS cases_policiales FROM facts)
    SELECT a.commune_code, a.crime_category, a.year, a.cases_policiales, b.cases_policiales AS previous_cases_policiales, round_even((a.cases_policiales - b.cases_policiales) * 100.0::DOUBLE / nullif(b.cases_policiales, 0), 1) AS yoy_pct
    FROM picked a LEFT JOIN picked b ON b.commune_code = a.commune_code AND b.crime_category = a.crime_category AND b.year = a.year - 1 WHERE a.year = (SELECT max(year) FROM picked)""")
def yoy_activity(spark, sf_dir):
    keys = ["commune_code", "crime_category"]
    rows = sparse(spark, sf_dir).select(*keys, "year", F.col("value").alias("cases_policiales"))
    return priorities.year_on_year(rows, keys, "cases_policiales").select(*keys, "year", "cases_policiales", "previous_cases_policiales", "yoy_pct")


DRUG_SQL = """
    SELECT lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS commune_code, CAST(year(l_shipdate) AS INTEGER) AS year, CASE l_returnflag WHEN 'R' THEN 'Delitos asociados a drogas' WHEN 'A' THEN 'Crímenes y simples delitos Ley de Drogas' ELSE 'Homicidios' END AS crime_category,
           count(*) AS value FROM lineitem GROUP BY ALL"""


@query(f"""
    WITH facts AS ({DRUG_SQL}), ranked AS (SELECT *, row_number() OVER (PARTITION BY year, commune_code ORDER BY CASE WHEN crime_category LIKE 'Delitos%' THEN 0 ELSE 1 END) AS k FROM facts WHERE crime_category <> 'Homicidios'),
    best AS (SELECT * FROM ranked WHERE k = 1)
    SELECT a.year, a.commune_code, a.crime_category, a.value AS cases_policiales, b.value AS previous_cases_policiales, round_even((a.value - b.value) * 100.0::DOUBLE / nullif(b.value, 0), 1) AS yoy_pct
    FROM best a LEFT JOIN best b ON b.commune_code = a.commune_code AND b.year = a.year - 1 WHERE a.year = (SELECT max(year) FROM best)""")
def current_activity(spark, sf_dir):
    label = F.when(F.col("l_returnflag") == "R", "Delitos asociados a drogas").when(F.col("l_returnflag") == "A", "Crímenes y simples delitos Ley de Drogas").otherwise("Homicidios")
    counted = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag").agg(F.count("*").alias("value"))
    rows = counted.select(F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("commune_code"), "year", label.alias("crime_category"), "value")
    found = priorities.current_activity(rows.withColumns({"score_eligible": F.lit(True), "ordinal": F.lit(0)}))
    return found.select("year", "commune_code", "crime_category", "cases_policiales", "previous_cases_policiales", "yoy_pct")


@query(f"WITH facts AS ({SPARSE_SQL}), totals AS (SELECT commune_code, CAST(sum(value) AS BIGINT) AS cases_policiales FROM facts GROUP BY 1) SELECT commune_code, cases_policiales, replace(format('{{:,}}', cases_policiales), ',', '.') AS shown FROM totals ORDER BY cases_policiales DESC, commune_code DESC LIMIT 35")
def topk_activity(spark, sf_dir):
    totals = sparse(spark, sf_dir).groupBy("commune_code").agg(F.sum("value").alias("cases_policiales")).withColumn("yoy_pct", F.lit(None).cast("double"))
    return export.top_activity(totals).select("commune_code", "cases_policiales", "shown")


@query(f"WITH facts AS ({SPARSE_SQL}) SELECT crime_category, list_sort(list(DISTINCT year)) AS years FROM facts GROUP BY 1")
def years_distinct_array(spark, sf_dir):
    return rollups.years_by(sparse(spark, sf_dir), "crime_category")


@query(f"WITH facts AS ({SPARSE_SQL}) SELECT year, crime_category, count(DISTINCT commune_code) AS communes, count(DISTINCT commune_code) >= 60 AS accepted FROM facts GROUP BY ALL")
def coverage_gate(spark, sf_dir):
    return rollups.coverage(sparse(spark, sf_dir), ["year", "crime_category"], least=60)


@query(f"""
    WITH facts AS ({SPARSE_SQL}), told AS (SELECT *, CASE value % 3 WHEN 0 THEN lower(crime_category) WHEN 1 THEN crime_category || '  ' ELSE upper(crime_category) END AS label, CASE WHEN value % 5 <> 0 THEN commune_code ELSE '' END AS code FROM facts)
    SELECT count(*) AS rows, count(DISTINCT nullif(code, '')) AS communes, count(DISTINCT {norm_sql('label')}) AS offenses, list_sort(list(DISTINCT year)) AS years, min(year) AS first_year, max(year) AS last_year, CAST(346 AS INTEGER) AS expected_communes FROM told""")
def manifest(spark, sf_dir):
    """Labels in three spellings, and empty codes."""
    k, label = F.col("value"), F.col("crime_category")
    written = F.when(k % 3 == 0, F.lower(label)).when(k % 3 == 1, F.concat(label, F.lit("  "))).otherwise(F.upper(label))
    return rollups.manifest(sparse(spark, sf_dir).withColumns({"crime_category": written, "commune_code": F.when(k % 5 != 0, F.col("commune_code")).otherwise("")}))


@query(f"""
    WITH facts AS ({SPARSE_SQL}), new AS (SELECT commune_code, year, sum(value) AS v FROM facts GROUP BY ALL), old AS (SELECT commune_code, year, max(value) AS v FROM facts WHERE value > 1 GROUP BY ALL)
    SELECT commune_code, year, CAST(v AS BIGINT) AS value FROM old UNION ALL SELECT commune_code, year, CAST(v AS BIGINT) FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.commune_code = n.commune_code AND o.year = n.year)""")
def anti_union(spark, sf_dir):
    """Peaks of communes and years that have one, and the sums of all others."""
    keys = ["commune_code", "year"]
    both = sparse(spark, sf_dir).groupBy(*keys).agg(F.max(F.when(F.col("value") > 1, F.col("value"))).alias("peak"), F.sum("value").alias("value"))
    return merge.anti_united(both.where(F.col("peak").isNotNull()).select(*keys, F.col("peak").alias("value")), both.select(*keys, "value"), keys)


@query(f"""
    WITH facts AS ({DENSE_SQL}), found AS (SELECT region_code, year, sum(value) AS found FROM facts GROUP BY ALL),
    expected AS (SELECT region_code, year, found + CASE WHEN year = 1998 THEN 1 ELSE 0 END AS expected FROM found WHERE region_code <> '02')
    SELECT region_code, year, CAST(found AS BIGINT) AS found, CAST(expected AS BIGINT) AS expected FROM found FULL JOIN expected USING (region_code, year) WHERE found IS DISTINCT FROM expected""")
def control_totals(spark, sf_dir):
    rows = dense(spark, sf_dir)
    expected = rows.groupBy("region_code", "year").agg((F.sum("value") + F.when(F.col("year") == 1998, 1).otherwise(0)).alias("value")).where(F.col("region_code") != "02")
    return rollups.control_totals(rows, expected, ["region_code", "year"])


@query(f"""
    WITH facts AS ({SPARSE_SQL}), base AS (SELECT *, CASE year WHEN 1999 THEN 'cead_criminogenic_geographic_score' WHEN 2000 THEN NULL ELSE 'other' END AS signal_family FROM facts)
    SELECT commune_code, year, signal_family, value FROM base WHERE signal_family IS DISTINCT FROM 'cead_criminogenic_geographic_score'
    UNION ALL SELECT commune_code, year, 'cead_criminogenic_geographic_score', value + 1 FROM facts""")
def replace_family(spark, sf_dir):
    rows = sparse(spark, sf_dir)
    family = F.when(F.col("year") == 1999, geographic.FAMILY).when(F.col("year") != 2000, "other")
    shape = ["commune_code", "year", "signal_family", "value"]
    base = rows.withColumn("signal_family", family).select(*shape)
    new = rows.withColumns({"signal_family": F.lit(geographic.FAMILY), "value": F.col("value") + 1}).select(*shape)
    once = merge.family_replaced(base, new, geographic.FAMILY)
    return merge.family_replaced(once, new, geographic.FAMILY)


# ---- Classification ---------------------------------------------------------------------------------------------

_CODES = sorted({c for codes in dims.LEGAL_CODES.values() for c in codes})


@query(f"""
    WITH codes AS (SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey ELSE 7000 + p_partkey % 120 END AS VARCHAR) AS code FROM part),
    exact(code, class, confidence) AS (VALUES {", ".join(f"({c}, '{k}', '{conf}')" for (k, conf, _), cs in dims.LEGAL_CODES.items() for c in cs)}),
    classified AS (
        SELECT p_partkey, codes.code, CASE WHEN class IS NOT NULL THEN class WHEN CAST(codes.code AS BIGINT) IN (7030, 7035, 7036, 7098) THEN 'historical_nonvigent' WHEN CAST(codes.code AS BIGINT) BETWEEN 2004 AND 2011 THEN 'predicate_direct'
               WHEN CAST(codes.code AS BIGINT) BETWEEN 7001 AND 7099 THEN 'predicate_direct' ELSE 'unmapped' END AS legal_class,
               CASE WHEN class IS NOT NULL THEN 'exact' WHEN CAST(codes.code AS BIGINT) IN (7030, 7035, 7036, 7098) THEN 'exclusion' WHEN CAST(codes.code AS BIGINT) BETWEEN 2004 AND 2011 OR CAST(codes.code AS BIGINT) BETWEEN 7001 AND 7099 THEN 'range' ELSE 'default' END AS rule_type
        FROM codes LEFT JOIN exact ON exact.code = CAST(codes.code AS BIGINT))
    SELECT p_partkey, code, legal_class, rule_type FROM classified""")
def legal_range_classify(spark, sf_dir):
    code = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey")).otherwise(7000 + F.col("p_partkey") % 120).cast("string")
    return classify.legal_classified(table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))).select("p_partkey", "code", "legal_class", "rule_type")


@query(f"""
    WITH codes AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 13000 WHEN p_partkey % 3 = 1 THEN 7000 + p_partkey % 120 ELSE 2000 + p_partkey % 15 END AS code FROM part),
    exact(code, class, basis) AS (VALUES {", ".join(f"({c}, '{k}', '{basis}')" for (k, _, basis), cs in dims.LEGAL_CODES.items() for c in cs)}),
    told AS (
        SELECT codes.code, CASE WHEN class IS NOT NULL THEN class WHEN codes.code IN (7030, 7035, 7036, 7098) THEN 'historical_nonvigent' WHEN codes.code BETWEEN 2004 AND 2011 OR codes.code BETWEEN 7001 AND 7099 THEN 'predicate_direct' ELSE 'unmapped' END AS legal_class,
               CASE WHEN class IS NOT NULL THEN basis WHEN codes.code IN (7030, 7035, 7036, 7098) THEN 'Código marcado no vigente en catálogo' WHEN codes.code BETWEEN 2004 AND 2011 THEN 'Título I Ley 21.459, expresamente citado por art. 27'
                    WHEN codes.code BETWEEN 7001 AND 7099 THEN 'Delitos vigentes Ley 20.000; excluir códigos no vigentes mediante catálogo' ELSE 'Sin regla jurídica exacta en v0.2' END AS legal_basis,
               CASE WHEN class IS NOT NULL THEN 'exact' WHEN codes.code IN (7030, 7035, 7036, 7098) THEN 'exclusion' WHEN codes.code BETWEEN 2004 AND 2011 OR codes.code BETWEEN 7001 AND 7099 THEN 'range' ELSE 'default' END AS rule_type
        FROM codes LEFT JOIN exact ON exact.code = codes.code),
    used AS (SELECT legal_class, legal_basis, rule_type, count(*) AS rows, count(DISTINCT code) AS codes FROM told GROUP BY ALL),
    whole AS (SELECT class, count(*) AS rules FROM exact GROUP BY 1)
    SELECT used.*, coalesce(rules, 0) AS exact_rules, '0.2.0' AS version, '27' AS article, 53::BIGINT AS all_exact_rules, 2 AS range_rules FROM used LEFT JOIN whole ON class = legal_class""")
def legal_summary(spark, sf_dir):
    """What the rules make of part keys as codes, beside the summary of the rules."""
    k = F.col("p_partkey")
    code = F.when(k % 3 == 0, k % 13000).when(k % 3 == 1, 7000 + k % 120).otherwise(2000 + k % 15).cast("string")
    used = classify.legal_use(classify.legal_classified(table(spark, sf_dir, "part").select(F.concat(F.lit(" 0"), code).alias("code"))))
    told = F.broadcast(classify.legal_summary(spark).withColumnRenamed("legal_basis", "law"))  # one row
    rules = F.coalesce(F.col("classes")[F.col("legal_class")], F.lit(0))
    return used.join(told, F.lit(True)).select(
        "legal_class", "legal_basis", "rule_type", "rows", "codes", rules.alias("exact_rules"), "version", "law.article", F.col("exact_rules").alias("all_exact_rules"), "range_rules",
    )


_LABELS = [*dims.TAXONOMY, "OTRO DELITO"]


@query(f"""
    WITH labels(k, label) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in enumerate(_LABELS))}), known(label, class, weight, confidence) AS (VALUES {", ".join(f"('{k}', '{a}', {b}::DOUBLE, '{c}')" for k, (a, b, c, _) in dims.TAXONOMY.items())})
    SELECT o_orderkey, labels.label AS crime_category, coalesce(class, 'contexto_general') AS aml_class, coalesce(weight, 0.0::DOUBLE) AS weight, coalesce(confidence, 'low') AS confidence
    FROM orders JOIN labels ON o_orderkey % {len(_LABELS)} = k LEFT JOIN known ON known.label = labels.label""")
def taxonomy_annotate(spark, sf_dir):
    label = F.array(*[F.lit(x) for x in _LABELS])[(F.col("o_orderkey") % len(_LABELS)).cast("int")]
    return classify.taxonomy_annotated(table(spark, sf_dir, "orders").select("o_orderkey", label.alias("crime_category"))).select("o_orderkey", "crime_category", "aml_class", "weight", "confidence")


_NAMES = ["Delitos asociados a drogas", "Tráfico de sustancias", "MICROTRÁFICO  de sustancias", "Otras infracciones a la ley de drogas", "Homicidios", "Homicidios y femicidios", "Disparo injustificado", "Porte / posesión de armas o explosivos", "Algo distinto"]


@query(f"""
    WITH labels(k, label) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in enumerate(_NAMES))}), keys(n, mapping_key) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in dims.LABEL_KEYS.items())}),
    known(mapping_key, class, eligible, weight) AS (VALUES {", ".join(f"('{k}', '{a}', {b}, {c}::DOUBLE)" for k, (a, b, c, _, _) in dims.CATALOG.items())}),
    named AS (SELECT o_orderkey, label, {norm_sql('label')} AS n FROM orders JOIN labels ON o_orderkey % {len(_NAMES)} = k)
    SELECT o_orderkey, n AS crime_category_norm, coalesce(mapping_key, 'default') AS article27_mapping_key,
           CASE WHEN n IN ('homicidios', 'femicidios', 'homicidios y femicidios') THEN 'context_only' ELSE coalesce(class, 'context_or_unresolved') END AS aml_class,
           CASE WHEN n IN ('homicidios', 'femicidios', 'homicidios y femicidios') THEN false ELSE coalesce(eligible, false) END AS score_eligible,
           CASE WHEN n IN ('homicidios', 'femicidios', 'homicidios y femicidios') THEN 0.0::DOUBLE ELSE coalesce(weight, 0.0::DOUBLE) END AS aml_weight
    FROM named LEFT JOIN keys USING (n) LEFT JOIN known USING (mapping_key)""")
def catalog_annotate(spark, sf_dir):
    label = F.array(*[F.lit(x) for x in _NAMES])[(F.col("o_orderkey") % len(_NAMES)).cast("int")]
    return classify.catalog_mapped(table(spark, sf_dir, "orders").select("o_orderkey", label.alias("crime_category"))).select("o_orderkey", "crime_category_norm", "article27_mapping_key", "aml_class", "score_eligible", "aml_weight")


@query("""
    SELECT o_orderstatus, status, CASE WHEN lower(status) LIKE 'usable\\_%' ESCAPE '\\' THEN 'usable' ELSE status END AS quality_status, count(*) AS rows
    FROM (SELECT o_orderstatus, CASE o_orderkey % 5 WHEN 0 THEN 'usable_bridge' WHEN 1 THEN 'Usable_Mirror' WHEN 2 THEN 'quarantined' WHEN 3 THEN 'validated' END AS status FROM orders)
    WHERE status IS NULL OR lower(status) LIKE 'usable%' OR status IN ('validated', 'ok') GROUP BY ALL""")
def quality_filter(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    status = F.when(k == 0, "usable_bridge").when(k == 1, "Usable_Mirror").when(k == 2, "quarantined").when(k == 3, "validated")
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", status.alias("status"), status.alias("quality_status"))
    normalised = classify.quality_normalised(rows)
    return normalised.where(classify.usable(F.col("quality_status"))).groupBy("o_orderstatus", "status", "quality_status").agg(F.count("*").alias("rows"))


@query(f"""
    WITH s AS (SELECT commune_code, score FROM ({scores_sql(LAYERS, SPARSE_SQL)}))
    SELECT commune_code, score, CASE WHEN score IS NOT NULL THEN {LEVEL_SQL.format('score')} END AS priority_level FROM s""")
def level_bins(spark, sf_dir):
    scores = geographic.geographic_scores(sparse(spark, sf_dir), LAYERS)
    return scores.select("commune_code", "score", stats.priority_level(F.col("score")).alias("priority_level"))


@query("""
    WITH rows AS (SELECT l_orderkey % 40 AS district, l_linestatus AS section, l_linenumber, l_quantity FROM lineitem),
    same AS (SELECT DISTINCT district, section, l_linenumber % 2 AS figure FROM rows),
    own AS (SELECT district, list_sort(list(figure)) AS f FROM same WHERE section = 'F' GROUP BY 1), other AS (SELECT district, list_sort(list(figure)) AS f FROM same WHERE section = 'O' GROUP BY 1)
    SELECT own.district, coalesce(own.f = other.f, false) AS duplicated FROM own LEFT JOIN other USING (district)""")
def section_fingerprint(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 40).alias("district"), F.col("l_linestatus").alias("section"), (F.col("l_linenumber") % 2).alias("figure")).distinct()
    return rollups.quarantined_duplicates(rows, "district", "section", "F", ["O"], [F.col("figure")])


# ---- Text, keys, identities -------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {norm_sql('text')} AS norm FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.norm(F.col("text")).alias("norm"))


@query(f"""
    WITH said AS (SELECT doc_id, 'Tráﬁco de ½ kilo, № ' || doc_id || ' ㎏ Ⅷ ﬃ … ' || coalesce(text, '') AS t FROM documents),
    plain AS (SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(t, 'ﬁ', 'fi'), '½', '12'), '№', 'No'), '㎏', 'kg'), 'Ⅷ', 'VIII'), 'ﬃ', 'ffi'), '…', '...') AS t FROM said)
    SELECT doc_id, {norm_sql('t')} AS norm FROM plain""")
def norm_expanded(spark, sf_dir):
    """Texts that begin with ligatures, fractions and signs, which become several letters."""
    said = F.concat(F.lit("Tráﬁco de ½ kilo, № "), F.col("doc_id").cast("string"), F.lit(" ㎏ Ⅷ ﬃ … "), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", text.norm(said).alias("norm"))


@query(f"SELECT p_partkey, replace({norm_sql('p_name')}, ' ', '-') AS slug, {norm_sql('p_name')} AS norm FROM part")
def name_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.norm(F.col("p_name")).alias("norm"))


@query("SELECT c_custkey, round_even(c_acctbal, 2) AS number FROM customer")
def parse_number(spark, sf_dir):
    written = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    return table(spark, sf_dir, "customer").select("c_custkey", F.bround(text.parse_number(written), 2).alias("number"))


@query("""
    WITH keys AS (SELECT c_custkey, regexp_replace(CAST(c_custkey * 7 AS VARCHAR) || CASE WHEN c_custkey % 4 = 0 THEN '-x' WHEN c_custkey % 9 = 0 THEN '00' ELSE '' END, '\\D', '', 'g') AS d FROM customer)
    SELECT c_custkey, CASE WHEN length(d) BETWEEN 1 AND 5 THEN lpad(d, 5, '0') END AS commune_code, CASE WHEN length(d) BETWEEN 1 AND 5 THEN 'CL-COM-' || lpad(d, 5, '0') END AS territory_id,
           CASE WHEN length(d) BETWEEN 1 AND 5 THEN 'CODE_EXACT' ELSE 'UNRESOLVED' END AS territory_mapping_method FROM keys""".replace("\\\\D", "\\D"))
def territory_key(spark, sf_dir):
    raw = F.concat((F.col("c_custkey") * 7).cast("string"), F.when(F.col("c_custkey") % 4 == 0, "-x").when(F.col("c_custkey") % 9 == 0, "00").otherwise(""))
    rows = export.adapted(table(spark, sf_dir, "customer").select("c_custkey", raw.alias("commune_code")), PRODUCER)
    return rows.select("c_custkey", F.when(F.col("territory_id").isNotNull(), F.col("commune_code")).alias("commune_code"), "territory_id", "territory_mapping_method")


@query(f"""
    WITH facts AS ({DENSE_SQL})
    SELECT 'EVT-COMARCA-' || left(sha256('CL-COM-' || commune_code || '|' || year || '|' || crime_category || '|' || 'lineitem'), 24) AS event_id, 'TERRITORIAL_CRIME_STATISTIC' AS event_type, 'COMARCA' AS producer_id, 'CL-COM-' || commune_code AS territory_id,
           'EVD-COMARCA-' || left(sha256('cead_governed_snapshot||2025-01-02T03:04:05+00:00'), 20) AS evidence_id, format('{{:04d}}-01-01T00:00:00+00:00', year) AS valid_from, format('{{:04d}}-01-01T00:00:00+00:00', year + 1) AS valid_to,
           '2025-01-02T03:04:05+00:00' AS observed_at, 'STALE' AS freshness_state, value AS attribute_value, commune_code AS attribute_code FROM facts""")
def event_identity(spark, sf_dir):
    lineage = spark.createDataFrame([("2025-01-02T03:04:05+00:00", "stale")], "generated_at string, freshness string")
    rows = export.adapted(dense(spark, sf_dir), PRODUCER).withColumn("source_id", F.lit("lineitem"))
    events = export.fusion_events(rows, PRODUCER, export.fusion_evidence(lineage, PRODUCER).first())
    return events.select(
        "event_id", "event_type", "producer_id", F.col("territory_ids")[0].alias("territory_id"), F.col("evidence_ids")[0].alias("evidence_id"), "temporal.valid_from", "temporal.valid_to", "temporal.observed_at", "temporal.freshness_state",
        F.col("attributes.value").alias("attribute_value"), F.col("attributes.commune_code").alias("attribute_code"),
    )


@query("""
    SELECT 'EVD-COMARCA-' || left(sha256('pages|' || sha256(coalesce(html, '')) || '|2025-01-0' || (page_id % 9 + 1)), 20) AS evidence_id, 'COMARCA' AS producer_id, 'pages' AS source_id, 'cead_estadisticas_delictuales' AS ultimate_source_id,
           url AS source_url, 'GOVERNED_PUBLIC' AS source_tier, sha256(coalesce(html, '')) AS content_sha256, CASE WHEN page_id % 3 = 0 THEN 'STALE' ELSE 'VALID' END AS quality_status, '2025-01-0' || (page_id % 9 + 1) AS retrieved_at, '2025-01-0' || (page_id % 9 + 1) AS ingested_at FROM pages""")
def evidence_identity(spark, sf_dir):
    at = F.concat(F.lit("2025-01-0"), (F.col("page_id") % 9 + 1).cast("string"))
    rows = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source_id"), F.col("url").alias("source_url"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("content_sha256"), at.alias("retrieved_at"), F.when(F.col("page_id") % 3 == 0, "stale").alias("freshness"))
    return export.fusion_evidence(rows, PRODUCER).select("evidence_id", "producer_id", "source_id", "ultimate_source_id", "source_url", "source_tier", "content_sha256", "quality_status", "retrieved_at", "ingested_at")


@query("SELECT min(page_id) AS page_id, 'url:' || sha1(url) AS event_id, url FROM (SELECT page_id, url FROM pages WHERE starts_with(url, 'http') AND NOT contains(url, ' ') AND length('el enlace de esta misma hoja') > 18) GROUP BY url")
def osint_identity(spark, sf_dir):
    """Each page links to itself once; the first page of an address counts."""
    link = F.concat(F.lit('<a href="'), text.html_escaped(F.col("url")), F.lit('">el enlace de esta misma hoja</a>'))
    rows = table(spark, sf_dir, "pages").select("page_id", "url").where(F.col("url").startswith("http") & ~F.contains("url", F.lit(" ")))
    pages = rows.select(F.lit("s").alias("source_id"), F.lit("http://host/").alias("url"), (-F.col("page_id")).alias("ordinal"), link.alias("html"))
    found = osint.events(pages, ("enlace",)).select("event_id", "url")
    return found.join(rows.groupBy("url").agg(F.min("page_id").alias("page_id")), "url").select("page_id", "event_id", "url")


_KEYWORDS = ("idiot", "Password", "license", "the", "queau", "token")


@query(f"""SELECT doc_id, list_sort(list_filter([{", ".join(f"'{k.lower()}'" for k in sorted(_KEYWORDS, key=str.lower))}], lambda k: contains(lower(text), k))) AS hits FROM documents""")
def keyword_hits(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.keyword_hits(F.col("text"), _KEYWORDS).alias("hits"))


@query(r"""SELECT doc_id, CASE WHEN d <> '' THEN regexp_extract(t, '\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b', 3) || '-' || lpad(regexp_extract(t, '\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b', 2), 2, '0') || '-' || lpad(regexp_extract(t, '\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b', 1), 2, '0') END AS published_date
    FROM (SELECT doc_id, t, regexp_extract(t, '\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b', 0) AS d FROM (SELECT doc_id, text || ' ' || (doc_id % 31) || CASE WHEN doc_id % 2 = 0 THEN '/' ELSE '.' END || '0' || (doc_id % 9 + 1) || '-2024 x' AS t FROM documents))""")
def nearby_date(spark, sf_dir):
    made = F.concat("text", F.lit(" "), (F.col("doc_id") % 31).cast("string"), F.when(F.col("doc_id") % 2 == 0, "/").otherwise("."), F.lit("0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("-2024 x"))
    return table(spark, sf_dir, "documents").select("doc_id", text.nearby_date(made).alias("published_date"))


@query(f"""
    WITH {PRESSURE_CTES}, facts2 AS ({SPARSE_SQL})
    SELECT 'CL-' || region_code AS territory_id, 'region' AS geography_level, CAST(year AS VARCHAR) AS period, 'ministerio_publico_aml_proxy' AS signal_family, pressure_score AS score, CAST(NULL AS BIGINT) AS value, 'score_proxy' AS metric, '0.4' AS score_version, 'analytical_proxy' AS aml_relevance,
           CAST(NULL AS VARCHAR) AS crime_category, CAST(NULL AS VARCHAR) AS article27_mapping_key, CAST(NULL AS VARCHAR) AS article27_relation, CAST(NULL AS DOUBLE) AS aml_weight, CAST(NULL AS VARCHAR) AS source_tier, region_code AS join_region, CAST(NULL AS VARCHAR) AS join_commune, CAST(NULL AS VARCHAR) AS join_name, ['ministerio_publico_saf'] AS source_families, true AS excludes_homicide_weight FROM pressure
    UNION ALL SELECT 'CL-' || commune_code, 'commune', CAST(year AS VARCHAR), 'cead_predicate_offense', NULL, value, 'casos_policiales', '0.4', 'predicate_direct', crime_category, 'group:401', NULL, 1.0, 'mirror_of_primary', NULL, commune_code, NULL, ['lineitem', 'cead_estadisticas_delictuales'], true FROM facts2
    UNION ALL SELECT 'CL-' || commune_code, 'commune', CAST(year AS VARCHAR), 'cead_art27_drug_family', CAST(value AS DOUBLE), NULL, 'score_proxy', '0.3-compat', 'direct_predicate_family', NULL, NULL, 'direct_family_ley_20000', NULL, NULL, NULL, commune_code, 'c ' || commune_code, ['cead_estadisticas_delictuales'], true FROM facts2""")
def contract_union(spark, sf_dir):
    rows = sparse(spark, sf_dir).withColumns({"territory_id": F.concat(F.lit("CL-"), "commune_code"), "period": F.col("year").cast("string")})
    master = rows.withColumns({"score_eligible": F.lit(True), "aml_weight": F.lit(1.0), "aml_class": F.lit("predicate_direct"), "source_id": F.lit("lineitem"), "source_tier": F.lit("mirror_of_primary"), "article27_mapping_key": F.lit("group:401")})
    older = rows.select("territory_id", "period", "commune_code", F.concat(F.lit("c "), "commune_code").alias("commune_name_norm"), F.col("value").cast("double").alias("cead_aml_priority_score"), F.lit("direct_family_ley_20000").alias("article27_relation"))
    contract = export.integration_contract(priorities.regional_pressure(regional(spark, sf_dir)), export.predicate_features(master), older)
    return contract.select(
        "territory_id", "geography_level", "period", "signal_family", "score", "value", "metric", "score_version", "aml_relevance", "crime_category", "article27_mapping_key", "article27_relation", "aml_weight", "source_tier",
        F.col("join_keys.region_code").alias("join_region"), F.col("join_keys.commune_code").alias("join_commune"), F.col("join_keys.commune_name_norm").alias("join_name"), "source_families", "excludes_homicide_weight",
    )


@query("""
    WITH places AS (SELECT lower(n_name) AS name, lpad(CAST(n_nationkey + 1000 * n_regionkey AS VARCHAR), 5, '0') AS code FROM nation WHERE n_nationkey % 5 <> 0),
    rows AS (
        SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'region' ELSE 'commune' END AS level, n_name, lpad(CAST(c_custkey % 5 AS VARCHAR), 2, '0') AS region, CASE WHEN c_custkey % 2 = 0 THEN '99999' END AS old
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
    told AS (
        SELECT rows.*, code, CASE WHEN level = 'region' THEN NULL WHEN code IS NULL THEN 'name_fallback' WHEN left(code, 2) = region THEN 'official_cut' ELSE 'cut_region_mismatch' END AS status
        FROM rows LEFT JOIN places ON name = lower(n_name))
    SELECT c_custkey, status AS territory_key_status, CASE WHEN status = 'official_cut' THEN code ELSE old END AS commune_code,
           CASE WHEN status = 'official_cut' THEN 'CL-COM-' || code ELSE 'old' END AS territory_id, CASE WHEN status = 'official_cut' THEN 'CODE_EXACT' END AS territory_mapping_method
    FROM told""")
def attach_codes(spark, sf_dir):
    rows, known = _coded(spark, sf_dir)
    return places.codes_by_name(rows, known).select("c_custkey", "territory_key_status", "commune_code", "territory_id", "territory_mapping_method")


def _coded(spark, sf_dir):
    """Customers as rows of places, some with a code of their own and some that are regions; and the codes of most nations."""
    nation = table(spark, sf_dir, "nation")
    known = nation.where(F.col("n_nationkey") % 5 != 0).select(text.norm_name(F.col("n_name")).alias("name_norm"), F.lpad((F.col("n_nationkey") + 1000 * F.col("n_regionkey")).cast("string"), 5, "0").alias("commune_code"), F.col("n_nationkey").alias("ordinal"))
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(k % 7 == 0, "region").otherwise("commune").alias("territory_level"), F.col("n_name").alias("commune_name"), F.lpad((k % 5).cast("string"), 2, "0").alias("region_code"), F.when(k % 2 == 0, "99999").alias("commune_code"), F.lit("old").alias("territory_id"),
    )
    return rows, known


@query("""
    WITH places AS (SELECT lower(n_name) AS name, lpad(CAST(n_nationkey + 1000 * n_regionkey AS VARCHAR), 5, '0') AS code FROM nation WHERE n_nationkey % 5 <> 0),
    rows AS (SELECT lower(n_name) AS name, lpad(CAST(c_custkey % 5 AS VARCHAR), 2, '0') AS region FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0),
    told AS (SELECT rows.name, code, CASE WHEN code IS NULL THEN 'none' WHEN left(code, 2) = region THEN 'same' ELSE 'other' END AS status FROM rows LEFT JOIN places ON places.name = rows.name)
    SELECT 'cead_cut_join' AS source_id, false AS ok, count(DISTINCT name) AS input_communes, count(DISTINCT code) FILTER (WHERE status = 'same') AS matched_communes, count(DISTINCT name) FILTER (WHERE status = 'none') AS unmatched_communes,
           count(DISTINCT name) FILTER (WHERE status = 'other') AS region_mismatches, 'CL-COM-{CUT}' AS territory_id_format FROM told""")
def attach_codes_status(spark, sf_dir):
    return places.codes_status(places.codes_by_name(*_coded(spark, sf_dir)))


# Links of the test pages: <a href="/...">text</a>, addresses from the root of the page's host. The last of an address counts as event, the first as publication.
LINKS_CTES = r"""
    pieces AS (
        SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">[^<]*</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1)) AS inside,
               unnest(generate_series(1, len(regexp_extract_all(html, '<a href="/[^"]*">[^<]*</a>')))) AS link_at FROM pages),
    said AS (SELECT page_id, link_at, root || replace(href, '&amp;', '&') AS url, trim(regexp_replace(replace(replace(replace(replace(inside, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pieces)"""


@query(f"""
    WITH {LINKS_CTES}, hits AS (SELECT *, list_filter(['ción', 'que', 'the', 'und'], lambda k: contains(lower(title), k)) AS matched_keywords FROM said WHERE length(title) >= 3),
    best AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id DESC, link_at DESC) AS k FROM hits WHERE len(matched_keywords) > 0)
    SELECT 'url:' || sha1(url) AS event_id, 'pages' AS source_id, title, url, NULL::VARCHAR AS published_date, matched_keywords, 'official_publication_signal' AS event_type, 'observed_publication' AS data_status FROM best WHERE k = 1""")
def osint_events(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source_id"), "url", F.col("page_id").alias("ordinal"), "html")
    return osint.events(pages, ("the", "que", "und", "ción"), least_title=3).drop("retrieved_at")


@query(f"""
    WITH {LINKS_CTES}, hits AS (SELECT * FROM said WHERE contains(lower(title || ' ' || url), 'the') OR contains(lower(title || ' ' || url), 'der') OR contains(lower(title || ' ' || url), 'ción')),
    best AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, link_at) AS k FROM hits)
    SELECT 'pages' AS source_id, CASE WHEN title = '' THEN split_part(url, '/', -1) ELSE title END AS title, url, NULL::VARCHAR AS retrieved_at, 'official_discovery' AS publication_type, 'observed_link' AS data_status FROM best WHERE k = 1""")
def osint_publications(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source_id"), "url", F.col("page_id").alias("ordinal"), "html")
    return osint.publications(pages, ("the", "der", "ción"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
