"""Queries that write the driver's tables as pages, sheets and monthly rows, and read them back through the sources."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.bindings import DENSE_SQL, SPARSE_SQL, TIERED_SQL, dense, sparse, table, tiered
from comarca.files import new_folder, write_text
from comarca.functions import stats, text
from comarca.operators import classify, export, merge, places
from comarca.plans import publish, rollups
from comarca.queries import PRODUCER, norm_sql, query
from comarca.sources import communal, html, osint, pages, tables, xls
from comarca.streaming import upserts


def _written(c) -> Column:
    """A number as the pages write it: . for thousands, , for decimals."""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def _cells(*cells) -> Column:
    return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))


def _nations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


def _page(rows: DataFrame, keys: list[str], heading: str, row: Column, header: str = "") -> DataFrame:
    """One table for each key below a heading; a key has a few rows here."""
    body = F.concat_ws("", F.array_sort(F.collect_list(row)))
    return rows.groupBy(*keys).agg(F.concat(F.lit(f"<h5>{heading}</h5><table>{header}"), body, F.lit("</table>")).alias("html"))


def _district() -> tuple[Column, ...]:
    return (F.col("n_regionkey") + 1).alias("district"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("region_code"), F.lit("r").alias("region_name")


def _annual_pages(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    row = _cells(F.col("n_name"), _written(k * 1234.5), _written(k + 0.25), F.when(k % 2 == 0, "--").otherwise(_written(k * 2.0)), F.lit("1"))
    rows = _nations(spark, sf_dir).select(*_district(), row.alias("row"))
    return _page(rows, ["district", "region_code", "region_name"], "Tasas anuales denuncias según familia de delitos", F.col("row"), "<tr><th>Comuna</th><th>a</th><th>b</th><th>c</th><th>d</th></tr><tr><td>Distrito 1</td><td>1</td><td>1</td><td>1</td><td>1</td></tr>")


ANNUAL_CTE = """
    rates AS (
        SELECT n_regionkey + 1 AS district, n_name AS commune_name, 'delitos_contra_vida_integridad' AS cead_family_key, 'Delitos contra la vida o integridad de las personas' AS crime_category, n_nationkey * 1234.5::DOUBLE AS rate_100k FROM nation
        UNION ALL SELECT n_regionkey + 1, n_name, 'delitos_asociados_drogas', 'Delitos asociados a drogas', n_nationkey + 0.25::DOUBLE FROM nation
        UNION ALL SELECT n_regionkey + 1, n_name, 'delitos_propiedad_no_violentos', 'Delitos contra la propiedad no violentos', n_nationkey * 2.0::DOUBLE FROM nation WHERE n_nationkey % 2 = 1
        UNION ALL SELECT n_regionkey + 1, n_name, 'violencia_intrafamiliar', 'Violencia intrafamiliar', 1.0::DOUBLE FROM nation)"""


@query(f"""
    WITH {ANNUAL_CTE}
    SELECT *, cead_family_key = 'delitos_asociados_drogas' AS score_eligible, CASE cead_family_key WHEN 'delitos_asociados_drogas' THEN 'direct_family_ley_20000' WHEN 'delitos_contra_vida_integridad' THEN 'mixed_context' WHEN 'delitos_propiedad_no_violentos' THEN 'context_or_market_signal' ELSE 'context_only' END AS article27_relation,
           'annual' AS period_type, 'tasa_denuncias_100k' AS metric, 'observed_rate' AS data_status, 'denuncia_formal' AS observation_unit, 'CL-' || lpad(CAST(district - 1 AS VARCHAR), 2, '0') || '-' || replace(replace(lower(commune_name), ' ', '-'), '_', '-') AS territory_id FROM rates""")
def html_annual_rates(spark, sf_dir):
    return html.annual_rates(_annual_pages(spark, sf_dir)).select(
        "district", "commune_name", "cead_family_key", "crime_category", "rate_100k", "score_eligible", "article27_relation", "period_type", "metric", "data_status", "observation_unit", "territory_id",
    )


@query(f"""
    WITH {ANNUAL_CTE}, people AS (SELECT n_name AS commune_name, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey * 1000 END AS population FROM nation)
    SELECT district, commune_name, cead_family_key, population, CAST(round_even(rate_100k * population / 100000.0::DOUBLE, 0) AS BIGINT) AS estimated_frequency,
           CASE WHEN population IS NOT NULL THEN 'derived_from_published_rate_and_2024_population' ELSE 'unavailable' END AS frequency_status
    FROM rates JOIN people USING (commune_name)""")
def population_join(spark, sf_dir):
    k = F.col("n_nationkey")
    people = _nations(spark, sf_dir).select(_district()[1], text.norm(F.col("n_name")).alias("commune_name_norm"), F.when(k % 3 != 0, k * 1000).otherwise(0).cast("long").alias("population"))
    return html.with_population(html.annual_rates(_annual_pages(spark, sf_dir)), people).select("district", "commune_name", "cead_family_key", F.col("population").cast("int").alias("population"), "estimated_frequency", "frequency_status")


@query("""
    SELECT n_regionkey + 1 AS district, n_name AS commune_name, CAST(n_nationkey * 1100 + 3 AS BIGINT) AS value, n_nationkey / 4.0::DOUBLE AS rate_100k,
           CASE WHEN n_regionkey % 2 = 0 THEN 'quarantined_duplicate_section' ELSE 'usable' END AS quality_status, CASE WHEN n_regionkey % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS aml_weight
    FROM nation""")
def html_latest_rates(spark, sf_dir):
    k = F.col("n_nationkey")
    row = lambda extra: _cells(F.col("n_name"), F.lit("1"), _written(k * 1100 + 3), F.lit("257.163"), F.lit("260.000"), _written(k / 8 + extra), _written(k / 4))
    odd = F.col("n_regionkey") % 2
    rows = _nations(spark, sf_dir).select(*_district(), row(F.lit(0)).alias("drugs"), row(odd * 1.0).alias("life"), row(F.lit(5)).alias("family"))
    keys = ["district", "region_code", "region_name"]
    page = None
    for name, heading in (("drugs", "Delitos asociados a drogas"), ("life", "Delitos contra la vida"), ("family", "Violencia intrafamiliar")):
        part = _page(rows, keys, f"{heading}: frecuencia y tasa", F.col(name)).withColumnRenamed("html", f"html_{name}")
        page = part if page is None else page.join(part, keys)
    pages = page.select(*keys, F.concat("html_drugs", "html_life", "html_family").alias("html"))
    return html.latest_rates(pages).select("district", "commune_name", "value", "rate_100k", "quality_status", "aml_weight")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, lpad(CAST(1100 + c_nationkey AS VARCHAR), 5, '0') AS commune_code, o_orderpriority AS offense, count(*) AS cases_policiales
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def html_monthly_cases(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority")
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    counts = joined.groupBy("year", (F.col("c_nationkey") + 1100).alias("commune_code"), "o_orderpriority").agg(*[F.count_if(F.col("month") == m).alias(f"m{m}") for m in range(1, 13)])
    shown = [F.when(F.col(f"m{m}") > 0, F.format_number(F.col(f"m{m}"), 0)).otherwise("-") for m in range(1, 13)]
    head = "<tr><td>nota</td></tr><tr><th>Delito</th>" + "".join(f"<th>{m.capitalize()}</th>" for m in dims.MONTHS) + "</tr>"
    pages = _page(counts.select("year", "commune_code", _cells(F.col("o_orderpriority"), *shown).alias("row")), ["year", "commune_code"], "x", F.col("row"), head)
    return html.monthly_cases(pages).select("year", "month", "commune_code", "offense", "cases_policiales")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, lpad(CAST(1000 + n_nationkey * 37 AS VARCHAR), 5, '0') AS commune_code, n_name AS commune_name, o_orderpriority AS crime_category, CAST(count(*) AS BIGINT) AS value,
           'CL-' || lpad(CAST(1000 + n_nationkey * 37 AS VARCHAR), 5, '0') AS territory_id, 'mirror_of_primary' AS source_tier, 'usable_bridge' AS quality_status, 'cead_community_bridge' AS source_id
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) >= 1997 AND o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 GROUP BY ALL""")
def bridge_annualised(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(_nations(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    monthly = joined.select(
        F.col("n_name").alias("comuna"), F.when(F.col("o_orderkey") % 7 != 0, (F.col("n_nationkey") * 37 + 1000).cast("string")).otherwise("s/c").alias("cut_comuna"), F.lit("r").alias("region"), F.col("n_regionkey").alias("cut_region"), F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("?").alias("fecha"),
        F.col("o_orderpriority").alias("delito"), F.lit(1).alias("delito_n"),
    )
    return tables.annual_bridge(tables.monthly_bridge(monthly, 1997)).select("year", "commune_code", "commune_name", "crime_category", "value", "territory_id", "source_tier", "quality_status", "source_id")


#: The prosecutors' labels as a workbook's header writes them, and the region of each; the capital has four.
_OFFICES = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "RM CN", "RM OR", "RM OCC", "RM SUR", "XIV", "XV", "XVI")
_OFFICE_REGIONS = ("01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12", "13", "13", "13", "13", "14", "15", "16")


@query(f"""
    WITH offices(k, region_code) AS (VALUES {", ".join(f"({k}, '{r}')" for k, r in enumerate(_OFFICE_REGIONS))})
    SELECT region_code, CASE region_code WHEN '13' THEN 'Metropolitana de Santiago' WHEN '16' THEN 'Ñuble' END AS named, upper(o_orderpriority) AS crime_category, CAST(count(*) AS BIGINT) AS value, CAST(2024 AS INTEGER) AS source_year, 'delito_ingresado_en_SAF' AS observation_unit, 'observed' AS data_status
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN offices ON c_nationkey % 19 = k GROUP BY ALL""")
def workbook_unpivot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    sheet = F.when(F.col("o_orderstatus") == "O", "TB3.1").otherwise("other")
    counts = joined.groupBy(sheet.alias("sheet"), "o_orderpriority").agg(*[F.count_if(F.col("c_nationkey") % len(_OFFICES) == k).alias(f"n{k}") for k in range(len(_OFFICES))])
    row_at = (F.substring("o_orderpriority", 1, 1).cast("int") + 5).alias("row_at")
    body = counts.select("sheet", row_at, F.array(F.lit(None), F.concat(F.lit("  "), F.lower("o_orderpriority")), *[F.col(f"n{k}").cast("string") for k in range(len(_OFFICES))]).alias("cells"))
    ones = ["1"] * len(_OFFICES)
    fixed = [(None, "Categoría de  delitos", *_OFFICES)], [(None, "Total nacional", *ones), (None, "nota", *ones)]
    rows = [(s, at, list(c)) for s in ("TB3.1", "other") for base, part in ((1, fixed[0]), (20, fixed[1])) for at, c in enumerate(part, base)]
    rows += [("TB3.1", 0, ["IMPUTADOS CONOCIDOS"]), ("other", 0, ["IMPUTADOS DESCONOCIDOS"])]
    sheets = body.unionByName(spark.createDataFrame(rows, "sheet string, row_at int, cells array<string>")).withColumns({"file": F.lit("f"), "sheet_at": F.lit(0), "error": F.lit(None).cast("string")})
    named = F.when(F.col("region_code").isin("13", "16"), F.col("region_name")).alias("named")
    return tables.prosecution_workbook(sheets, 2024).where(F.col("value") > 0).select("region_code", named, "crime_category", "value", "source_year", "observation_unit", "data_status")


def _workbook_files(counts: DataFrame) -> DataFrame:
    """counts (year, sheet, priority, n0 .. n18) -> a workbook for each year: .xls in even years, .xlsx in odd ones, with a sheet that only looks like the right one after it."""
    head = (None, "Categoría de delitos", *_OFFICES)

    def book(key: tuple, rows: pa.Table) -> pa.Table:
        year = key[0].as_py()
        own = {name: [[title], list(head)] for name, title in (("Zeta", "Imputados conocidos"), ("TB3.2", "x"), ("Alfa", "Imputados conocidos"))}
        for r in sorted(rows.to_pylist(), key=lambda r: (r["sheet"], r["priority"])):
            cells = [r[f"n{k}"] for k in range(len(_OFFICES))]
            own[r["sheet"]].append([None, r["priority"], *cells])
            if r["sheet"] == "Zeta":
                own["Alfa"].append([None, r["priority"], *[n + 1000 for n in cells]])
        for cells in own.values():
            cells += [[None, "Total nacional", *[1] * len(_OFFICES)], [None, "nota", *[1] * len(_OFFICES)]]
        made = {name: dict(enumerate(cells)) for name, cells in own.items()}
        raw = xls.written(made) if year % 2 == 0 else tables.written(made)
        return pa.table({"file": [f"mp_{year}.xls{'x' * (year % 2)}"], "content": pa.array([raw], pa.binary())})

    return counts.groupBy("year").applyInArrow(book, "file string, content binary")


@query(f"""
    WITH offices(k, region_code) AS (VALUES {", ".join(f"({k}, '{r}')" for k, r in enumerate(_OFFICE_REGIONS))})
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, region_code, upper(o_orderpriority) AS crime_category, CAST(count(*) AS BIGINT) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN offices ON c_nationkey % 19 = k GROUP BY ALL""")
def workbook_history(spark, sf_dir):
    """Each year's orders as a workbook, old or new format in turn, and back: known suspects are open orders, unknown ones the others."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year"))
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    counts = joined.groupBy("year", F.when(F.col("o_orderstatus") == "O", "Zeta").otherwise("TB3.2").alias("sheet"), F.col("o_orderpriority").alias("priority")).agg(*[F.count_if(F.col("c_nationkey") % len(_OFFICES) == k).alias(f"n{k}") for k in range(len(_OFFICES))])
    every = joined.select("year").distinct().select("year", F.explode(F.array(F.lit("Zeta"), F.lit("TB3.2"))).alias("sheet")).select("year", "sheet", F.lit("SIN DATO").alias("priority"), *[F.lit(0).cast("long").alias(f"n{k}") for k in range(len(_OFFICES))])
    sheets = tables.sheets_of(_workbook_files(counts.unionByName(every)))
    records, _ = tables.prosecution_history(sheets, {f"mp_{y}.xls{x}": y for y in range(1990, 2010) for x in ("x" * (y % 2),)})
    return records.where(F.col("value") > 0).select("year", "region_code", "crime_category", "value")


@query("""
    WITH rows AS (SELECT row_number() OVER (ORDER BY p_partkey) AS k, p_partkey FROM part)
    SELECT 'parte ' || p_partkey AS name_norm, lpad(CAST(1000 + p_partkey % 90000 AS VARCHAR), 5, '0') AS commune_code, 'CL-COM-' || lpad(CAST(1000 + p_partkey % 90000 AS VARCHAR), 5, '0') AS territory_id FROM rows""")
def commune_workbook(spark, sf_dir):
    """Parts as places in an old workbook of many sheets, and back; sheets are read in their order until all are known."""
    size = 10_000

    def book(key: tuple, rows: pa.Table) -> pa.Table:
        own = {f"hoja {9999 - n}": {0: ["Listado"], 1: ["Código Comuna", "Nombre Comuna"], **{2 + k: [float(1000 + p % 90000), f" Parte {p}"] for k, p in enumerate(part)}} for n, part in enumerate([sorted(rows["p_partkey"].to_pylist())[i : i + size] for i in range(0, rows.num_rows, size)])}
        return pa.table({"file": [f"codes_{key[0].as_py()}.xls"], "content": pa.array([xls.written(own)], pa.binary())})

    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") / 50_000).cast("int").alias("file"))
    n = parts.count()
    # A task for each 50,000 rows: small as the parts are, whole workbooks come of them, and a task holds a few however many there are.
    dealt = parts.repartition(n // 50_000 + 1, "file")
    sheets = tables.sheets_of(dealt.groupBy("file").applyInArrow(book, "file string, content binary"))
    placed = sheets.withColumn("sheet_at", F.col("sheet_at") + 100 * F.regexp_extract("file", r"_(\d+)", 1).cast("int"))
    return tables.commune_codes(placed, least=n).select("name_norm", "commune_code", "territory_id")


@query(f"""
    WITH facts AS ({SPARSE_SQL})
    SELECT commune_code, CAST(year AS INTEGER) AS year, crime_category, CAST(value AS BIGINT) AS value, 'caso_policial' AS observation_unit, CAST(year AS VARCHAR) AS period FROM facts WHERE year >= 1995""")
def external_table(spark, sf_dir):
    """The facts as a snapshot of Parquet files with a manifest, a second snapshot beside them, and back through the manifest."""
    rows, _, _ = tables.external(spark, _snapshot(spark, sf_dir), 1995)
    return rows.select("commune_code", "year", "crime_category", "value", "observation_unit", "period")


def _snapshot(spark, sf_dir) -> str:
    """The path of a manifest whose files hold the facts; what is written after it is not of its snapshot."""
    folder = new_folder(spark, "external")
    rows = sparse(spark, sf_dir).select(F.col("year").cast("int").alias("year"), "commune_code", F.lit("c").alias("commune_name"), F.lit("01").alias("region_code"), F.lit("r").alias("region_name"), "crime_category", F.lit("casos_policiales").alias("metric"), F.col("value").cast("double").alias("value"), F.lit("x").alias("unused"))
    rows.write.parquet(f"{folder}/data")
    found = [{"path": f"data/{name}", "bytes": size} for name, size, _ in tables.listed(spark, f"{folder}/data") if name.endswith(".parquet")]
    write_text(spark, f"{folder}/manifest.json", json.dumps({"producer": "p", "snapshot": "s1", "files": found, "coverage": {"expected_communes": 400, "min_date": "1992-01-01"}}))
    rows.limit(5).write.mode("append").parquet(f"{folder}/data")
    return f"{folder}/manifest.json"


@query(f"""
    WITH facts AS ({SPARSE_SQL} ), kept AS (SELECT * FROM facts WHERE year >= 1995)
    SELECT count(*) AS records, count(DISTINCT commune_code) AS communes, 400::BIGINT AS expected_communes, count(DISTINCT crime_category) AS offenses, list_sort(list(DISTINCT CAST(year AS INTEGER))) AS years, count(DISTINCT commune_code) >= 340 AS ok, '1992-01-01' AS min_date, 's1' AS snapshot FROM kept""")
def external_status(spark, sf_dir):
    _, _, status = tables.external(spark, _snapshot(spark, sf_dir), 1995)
    return status.select("records", "communes", "expected_communes", "offenses", "years", "ok", "min_date", "snapshot")


@query(f"""
    WITH facts AS ({SPARSE_SQL}), lots AS (SELECT DISTINCT year, commune_code FROM facts WHERE year % 3 <> 0 OR commune_code < '00020'),
    tried AS (SELECT year, count(*) AS communes, count(*) >= 30 AS accepted FROM lots GROUP BY year)
    SELECT CAST(year AS INTEGER) AS year, communes, accepted, CAST((SELECT max(b.year) FROM tried b WHERE b.accepted AND b.year <= tried.year) AS INTEGER) AS visible FROM tried""")
def publish_gate(spark, sf_dir):
    """A lot of communes for each year; every third year's lot lacks most of them. After each, the version that readers see."""
    folder = new_folder(spark, "published")
    lots = sparse(spark, sf_dir).where((F.col("year") % 3 != 0) | (F.col("commune_code") < "00020")).select("year", "commune_code").distinct()
    years = [r["year"] for r in lots.select("year").distinct().orderBy("year").collect()]  # a few years
    seen = []
    for year in years:
        publish.publish(spark, {"lot": lots.where(F.col("year") == year)}, folder, str(year), {"coverage": publish.covers("lot", 30)})
        now = publish.pointed(spark, folder)
        seen.append((year, now and int(now["version"])))
    told = publish.status(spark, folder).select(F.col("version").cast("int").alias("year"), F.regexp_extract("told", r"^(\d+)", 1).cast("long").alias("communes"), F.col("ok").alias("accepted"))
    return told.join(F.broadcast(spark.createDataFrame(seen, "year int, visible int")), "year")


@query(f"""
    WITH facts AS (SELECT *, CASE WHEN source_tier = 'primary_direct' THEN 1 ELSE 0 END AS side, lpad(coalesce(commune_code, ''), 5, '0') AS code, {norm_sql('crime_category')} AS label FROM ({TIERED_SQL}) WHERE commune_code IS NOT NULL),
    best AS (SELECT *, row_number() OVER (PARTITION BY year, code, label ORDER BY side DESC, ordinal DESC) AS k FROM facts)
    SELECT year, code, label, value, source_tier FROM best WHERE k = 1""")
def cache_buckets(spark, sf_dir):
    """The cache in buckets, from two batches: all other rows first, then the direct ones over them. The facts are made once, as files that each batch is read from."""
    folder, facts = new_folder(spark, "cache"), new_folder(spark, "facts")
    tiered(spark, sf_dir).where(F.col("commune_code").isNotNull()).write.parquet(facts)
    rows = spark.read.parquet(facts)
    direct = F.col("source_tier").eqNullSafe("primary_direct")
    for n, batch in enumerate((rows.where(~direct), rows.where(direct))):
        upserts.upsert_batch(batch, n, folder, buckets=16)
    found = upserts.read_version(spark, folder, 1, rows.schema)
    return found.select("year", merge.keyed_code(F.col("commune_code")).alias("code"), text.norm(F.col("crime_category")).alias("label"), "value", "source_tier")


@query(f"""
    WITH facts AS ({DENSE_SQL})
    SELECT CAST(grouping_id(year, region_code, crime_category) AS INTEGER) AS grouping, year, region_code, crime_category, CAST(sum(value) AS BIGINT) AS value FROM facts
    GROUP BY GROUPING SETS ((year, region_code, crime_category), (year, region_code), (year, crime_category), (year), ())""")
def rollup_totals(spark, sf_dir):
    """Region, category, year and whole totals from one pass."""
    sets = [["year", "region_code", "crime_category"], ["year", "region_code"], ["year", "crime_category"], ["year"], []]
    found = rollups.totals(dense(spark, sf_dir), sets[0], sets)
    grouping = F.element_at(F.array(*[F.lit(g) for g in (0, 1, 2, 3, 7)]), F.col("level") + 1)
    return found.select(grouping.alias("grouping"), "year", "region_code", "crime_category", "value")


@query("""
    WITH told AS (SELECT doc_id, 'k' || doc_id AS v FROM documents)
    SELECT doc_id, sha256(v) AS sha256, octet_length(encode(v)) AS bytes FROM told""")
def raw_store(spark, sf_dir):
    """Texts' names as fetched bytes, stored twice, each content kept once, and read back by their evidence."""
    folder = new_folder(spark, "raw")
    raw = F.concat(F.lit("k"), F.col("doc_id").cast("string")).cast("binary")
    got = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), raw.alias("content"), F.sha2(raw, 256).alias("sha256"), F.length(raw).cast("long").alias("bytes"), F.lit("t").alias("retrieved_at"), F.lit(True).alias("ok"))
    evidence = pages.stored(got, folder)
    pages.stored(got, folder)
    back = pages.from_store(evidence, folder)
    return back.select(F.col("file").cast("long").alias("doc_id"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"))


@query("""
    WITH files AS (SELECT page_id, coalesce(html, '') AS t FROM pages)
    SELECT page_id, sha256(t) AS sha256, CAST(octet_length(encode(t)) AS BIGINT) AS bytes FROM files""")
def file_evidence(spark, sf_dir):
    """Digest and size of files."""
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.coalesce("html", F.lit("")).cast("binary").alias("content"), F.lit("2025-01-01").cast("timestamp").alias("modificationTime"))
    return tables.evidence(files).select(F.col("url").cast("long").alias("page_id"), "sha256", "bytes")


@query("""
    WITH rows AS (SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region, n_name, c_custkey % 4 <> 0 AS commune FROM customer JOIN nation ON c_nationkey = n_nationkey),
    known AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS region, n_name, lpad(CAST(n_nationkey * 11 AS VARCHAR), 5, '0') AS code FROM nation WHERE n_nationkey % 3 <> 0)
    SELECT c_custkey, CASE WHEN commune THEN code END AS commune_code, CASE WHEN commune AND code IS NOT NULL THEN 'CL-' || code ELSE 'old' END AS territory_id
    FROM rows LEFT JOIN known ON known.region = rows.region AND known.n_name = rows.n_name""")
def codes_by_region_and_name(spark, sf_dir):
    nation = _nations(spark, sf_dir)
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    known = nation.where(F.col("n_nationkey") % 3 != 0).select(code.alias("region_code"), text.norm(F.col("n_name")).alias("name_norm"), F.lpad((F.col("n_nationkey") * 11).cast("string"), 5, "0").alias("commune_code"), F.col("n_nationkey").alias("ordinal"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", code.alias("region_code"), text.norm(F.col("n_name")).alias("commune_name_norm"), F.when(F.col("c_custkey") % 4 != 0, "commune").otherwise("region").alias("territory_level"), F.lit(None).cast("string").alias("commune_code"), F.lit("old").alias("territory_id"),
    )
    return places.codes_attached(rows, known).select("c_custkey", "commune_code", "territory_id")


@query(f"""
    WITH facts AS ({SPARSE_SQL}), expected AS (SELECT DISTINCT commune_code FROM facts), seen AS (SELECT DISTINCT commune_code FROM facts WHERE year = 1998 AND value % 2 = 0 AND commune_code NOT LIKE '%3')
    SELECT commune_code, 'r' AS region_code FROM expected WHERE commune_code NOT IN (SELECT commune_code FROM seen)""")
def unavailable_communes(spark, sf_dir):
    rows = sparse(spark, sf_dir)
    return rollups.unavailable(rows.where((F.col("year") == 1998) & (F.col("value") % 2 == 0) & ~F.col("commune_code").endswith("3")), rows.select("commune_code", F.lit("r").alias("region_code")).distinct())


@query(f"""
    WITH facts AS ({SPARSE_SQL}), ends AS (SELECT commune_code, min(year) AS a, max(year) AS b FROM facts GROUP BY 1)
    SELECT commune_code, 'c ' || commune_code AS commune_name, '01' AS region_code, 'r' AS region_name FROM ends""")
def commune_list(spark, sf_dir):
    return tables.commune_list(sparse(spark, sf_dir).withColumns({"commune_name": F.concat(F.lit("c "), "commune_code"), "region_code": F.lit("01"), "region_name": F.lit("r")}))


@query("""
    SELECT 'COMARCA' AS radar_id, '1.0' AS interop_version, count(*) AS rows, count(*) FILTER (WHERE c_custkey % 3 <> 0) AS resolved, count(*) FILTER (WHERE c_custkey % 3 = 0) AS unresolved, 'CL-COM-{CUT}' AS territory_id_format FROM customer""")
def interop_counts(spark, sf_dir):
    code = F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 90000 + 1).cast("string")).otherwise("123456")
    return export.interop_status(export.adapted(table(spark, sf_dir, "customer").select(code.alias("commune_code")), export.Producer("COMARCA", "x")))


@query("""
    WITH rows AS (SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders),
    good AS (SELECT o_orderpriority AS source_id, count(*) AS n FROM rows WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
    SELECT source_id, n AS rows FROM good""")
def failure_isolation(spark, sf_dir):
    """A part for each priority; the urgent one fails in a task and costs its own rows alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    bad = F.when(F.col("o_orderpriority") == "1-URGENT", F.raise_error(F.lit("down")).cast("long")).otherwise(F.col("o_orderkey"))
    part = lambda p: lambda: orders.where(F.col("o_orderpriority") == p).select(F.col("o_orderpriority").alias("source_id"), bad.alias("k"))
    rows, status = tables.collected(spark, {p: part(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}, "source_id string, k long")
    good = status.where("ok").select("source_id")
    return rows.groupBy("source_id").agg(F.count("*").alias("rows")).join(good, "source_id")


@query(f"""
    WITH facts AS ({SPARSE_SQL})
    SELECT commune_code, CAST(year AS INTEGER) AS year, crime_category, CAST(value AS BIGINT) AS value, CASE WHEN value % 2 = 0 THEN commune_code END AS note FROM facts""")
def jsonl_round_trip(spark, sf_dir):
    """JSON lines with nulls and zeros in front, written and read back under the schema given."""
    folder = new_folder(spark, "jsonl")
    rows = sparse(spark, sf_dir).select("commune_code", F.col("year").cast("int").alias("year"), "crime_category", F.col("value").cast("long").alias("value"), F.when(F.col("value") % 2 == 0, F.col("commune_code")).alias("note"))
    export.write_jsonl(rows, f"{folder}/rows")
    return tables.jsonl(spark, f"{folder}/rows", rows.schema)


@query("""
    WITH said AS (SELECT page_id, page_id % 6 AS source, page_id % 6 <> 4 AS ok FROM pages)
    SELECT 's' || source AS source_id, bool_and(ok) AS ok, count(*) FILTER (WHERE ok) AS pages, CASE WHEN NOT bool_and(ok) THEN 'not saved' END AS error FROM said GROUP BY source""")
def page_replay(spark, sf_dir):
    """Targets with saved pages in their place; a sixth of them was never saved."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("s"), (F.col("page_id") % 6).cast("string")).alias("source_id"), F.concat(F.lit("u"), F.col("page_id").cast("string")).alias("url"), "html")
    saved = rows.where(F.col("page_id") % 6 != 4).select("url", "html", F.sha2("url", 256).alias("sha256"), F.lit(1).alias("bytes"), F.lit(200).alias("http_status"), F.lit("t").alias("retrieved_at"))
    return pages.page_status(pages.replayed(rows.select("source_id", "url"), saved))


@query(r"""
    SELECT page_id AS ordinal, page_id % 4 <> 1 AS ok, CASE WHEN page_id % 4 <> 1 THEN 'Página ' || page_id END AS title, CASE WHEN page_id % 4 = 1 THEN 'down' END AS error FROM pages""")
def probe_health(spark, sf_dir):
    """A health row for each page, in their order: title and state."""
    k, ok = F.col("page_id"), F.col("page_id") % 4 != 1
    rows = table(spark, sf_dir, "pages").select(k.alias("ordinal"), k.cast("string").alias("source_id"), F.concat(F.lit("u"), k.cast("string")).alias("url"), F.lit(1).alias("priority"))
    got = rows.select("url", F.when(F.col("ordinal") % 4 != 1, F.concat(F.lit("<head><title> Página\n "), F.col("ordinal").cast("string"), F.lit("</title></head>"))).alias("html"), F.lit("t").alias("retrieved_at"), F.lit(200).alias("http_status"), (F.col("ordinal") % 4 != 1).alias("ok"), F.when(F.col("ordinal") % 4 == 1, "down").alias("error"))
    return pages.probed(pages.probe_targets(rows), got).select("ordinal", "ok", "title", "error")


@query(r"""
    WITH pieces AS (
        SELECT page_id, page_id % 7 AS source, unnest(regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1)) AS inside FROM pages WHERE page_id % 7 <> 5)
    SELECT 's' || k AS source_id, k <> 5 AS ok, CASE WHEN k <> 5 THEN (SELECT count(*) FROM pieces WHERE source = k AND contains(lower(inside), 'the') AND length(inside) >= 3) END AS events, CASE WHEN k = 5 THEN 'down' END AS error
    FROM (SELECT unnest(generate_series(0, 6)) AS k) WHERE EXISTS (SELECT 1 FROM pages WHERE page_id % 7 = k)""")
def event_counts(spark, sf_dir):
    """Events by watched source, each page under an address of its own; one source is down."""
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("s"), (F.col("page_id") % 7).cast("string")).alias("source_id"), F.concat(F.lit("http://h/"), F.col("page_id").cast("string"), F.lit("/")).alias("url"), F.col("page_id").alias("ordinal"), "html")
    # Addresses are told apart by their page and place, so that every link counts.
    numbered = F.regexp_replace("html", '<a href="/', '<a href="')
    kept = rows.where(F.col("source_id") != "s5").withColumn("html", numbered)
    found = html.links(kept, base="url").where((F.length("title") >= 3) & F.contains(F.lower("title"), F.lit("the"))).select("source_id")
    watched = rows.select("source_id").distinct().select("source_id", (F.col("source_id") != "s5").alias("ok"), F.when(F.col("source_id") == "s5", "down").alias("error"))
    return osint.event_status(watched, found)


@query(f"""
    WITH facts AS ({SPARSE_SQL}), families(k, cead_family_key, article27_relation, aml_weight) AS (VALUES {", ".join(f"({k}, '{f}', '{v[0]}', {v[2]}::DOUBLE)" for k, (f, v) in enumerate(dims.FAMILIES.items()))})
    SELECT commune_code, year, crime_category, cead_family_key, article27_relation, aml_weight FROM facts JOIN families ON value % {len(dims.FAMILIES)} = k""")
def family_mapping(spark, sf_dir):
    key = F.array(*[F.lit(f) for f in dims.FAMILIES])[(F.col("value") % len(dims.FAMILIES)).cast("int")]
    return classify.family_mapped(sparse(spark, sf_dir).withColumn("cead_family_key", key)).select("commune_code", "year", "crime_category", "cead_family_key", "article27_relation", "aml_weight")


@query(f"WITH facts AS ({SPARSE_SQL}) SELECT commune_code, year, crime_category, value, true AS excludes_homicide_weight FROM facts WHERE value % 3 <> 0 AND value % 4 <> 0")
def predicate_features(spark, sf_dir):
    rows = sparse(spark, sf_dir).withColumns({"score_eligible": F.col("value") % 3 != 0, "aml_weight": (F.col("value") % 4).cast("double")})
    return export.predicate_features(rows).select("commune_code", "year", "crime_category", "value", "excludes_homicide_weight")


@query("""
    WITH rows AS (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem)
    SELECT a.l_orderkey, a.l_suppkey AS first_supplier, b.l_suppkey AS last_supplier FROM
        (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS k FROM rows) a JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC) AS k FROM rows) b ON a.l_orderkey = b.l_orderkey AND a.k = 1 AND b.k = 1""")
def first_and_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    order = [F.col("l_linenumber"), F.col("l_suppkey")]
    first = merge.one_per(rows, ["l_orderkey"], order).select("l_orderkey", F.col("l_suppkey").alias("first_supplier"))
    return first.join(merge.one_per(rows, ["l_orderkey"], order, last=True).select("l_orderkey", F.col("l_suppkey").alias("last_supplier")), "l_orderkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN ['cead_estadisticas_delictuales'] WHEN c_custkey % 3 = 0 OR c_mktsegment = 'BUILDING' THEN [c_mktsegment] ELSE [c_mktsegment, 'BUILDING'] END AS sources FROM customer")
def distinct_sources(spark, sf_dir):
    own, other = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")), F.when(F.col("c_custkey") % 5 == 0, "").when(F.col("c_custkey") % 3 != 0, "BUILDING")
    return table(spark, sf_dir, "customer").select("c_custkey", merge.distinct_sources([own, other], "cead_estadisticas_delictuales").alias("sources"))


@query("""
    WITH annual AS (SELECT n_name, count(*) AS victims FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 4 <> 0 GROUP BY 1),
    recent AS (SELECT n_name, count(*) AS victims FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 3 <> 0 AND c_acctbal > 0 GROUP BY 1)
    SELECT n_name AS commune_name, '2024' AS period, a.victims, coalesce(r.victims, 0) AS recent_h1_2025_victims, CASE WHEN r.victims IS NULL THEN 'derived_zero_not_listed_in_complete_positive_table' ELSE 'observed_positive' END AS recent_h1_2025_status FROM annual a LEFT JOIN recent r USING (n_name)
    UNION ALL SELECT n_name, '2025-H1', victims, victims, NULL FROM recent r WHERE NOT EXISTS (SELECT 1 FROM annual a WHERE a.n_name = r.n_name)""")
def homicide_anti_union(spark, sf_dir):
    joined = table(spark, sf_dir, "customer").join(F.broadcast(_nations(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    counted = lambda where: joined.where(where).groupBy(F.lit("r").alias("region_name"), F.col("n_name").alias("commune_name")).agg(F.count("*").alias("victims"))
    found = places.homicide_communes(counted(F.col("n_nationkey") % 4 != 0), counted((F.col("n_nationkey") % 3 != 0) & (F.col("c_acctbal") > 0)))
    return found.select("commune_name", "period", "victims", "recent_h1_2025_victims", "recent_h1_2025_status")


@query(r"""
    SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(t, '\b(20\d{2})\b', 1), lambda y: CAST(y AS INTEGER)), lambda y: y BETWEEN 2018 AND 2026))) AS years
    FROM (SELECT doc_id, coalesce(text, '') || ' 20' || (10 + doc_id % 20) || ' 2019 y 2024.' AS t FROM documents)""")
def page_years(spark, sf_dir):
    """Each text as a page, with other years in tags, scripts, styles and comments."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" 20"), (10 + F.col("doc_id") % 20).cast("string"), F.lit(" 2019 y 2024."))
    page = F.concat(F.lit('<html><head><style>.y2026 {}</style></head><body title="2023"><a href="x?anno=2025">'), text.html_escaped(said), F.lit("</a><script>var y = '2018';</script><!-- 2021 --></body></html>"))
    return html.page_years(table(spark, sf_dir, "documents").select("doc_id", page.alias("html")))


@query("""
    SELECT doc_id, coalesce(text, '') AS found, octet_length(encode(coalesce(text, ''))) AS bytes, sha256(coalesce(text, '')) AS sha256 FROM documents""")
def page_charsets(spark, sf_dir):
    """Each text as the bytes of a page, named by the header, the page or not at all; Western ones only where the text allows it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    western = ~F.col("t").rlike(r"[^\x00-\x7F\xA0-\xFF]") & (F.col("doc_id") % 2 == 0)
    meta = F.when(western & (F.col("doc_id") % 4 == 0), F.lit('<meta charset="iso-8859-1">')).otherwise("")
    whole = F.concat(meta, "t")
    raw = F.when(western, F.encode(F.when(western, whole).otherwise(""), "ISO-8859-1")).otherwise(F.encode(whole, "UTF-8"))
    kind = F.when(western & (F.col("doc_id") % 4 != 0), "text/html; charset=ISO-8859-1").when(~western & (F.col("doc_id") % 3 == 0), "text/html; charset=utf-8")
    read = docs.select("doc_id", raw.alias("content"), kind.alias("content_type"), F.length(meta).alias("skip")).withColumn("found", pages.text_of(F.col("content"), F.col("content_type")))
    found = F.substr("found", F.col("skip") + 1)
    return read.select("doc_id", found.alias("found"), F.octet_length(found).cast("long").alias("bytes"), F.sha2(found, 256).alias("sha256"))


@query("""
    WITH lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_orderkey % 3 AS kind FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT)::VARCHAR AS quantity, CASE WHEN kind = 0 THEN 'fila ' || l_linenumber ELSE l_linenumber::VARCHAR END AS label FROM lines""")
def page_tables(spark, sf_dir):
    """Each order as a page whose lines stand in a table under a heading with marks in it; other tables, headings without a table, scripts and tables in cells stand around."""
    before, after = (F.when(F.col("l_orderkey") % 3 == 0, F.lit(x)).otherwise("") for x in ("fila <strong>", "</strong><script>var casos = '<td>';</script>"))
    row = lambda x: F.concat(F.lit("<tr><td>"), before, x["number"].cast("string"), after, F.lit("</td><td>"), x["quantity"].cast("string"), F.lit("</td></tr>"))
    lines = F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").cast("long").alias("quantity"))))
    head = F.lit("<div><h5>Otra tabla</h5><table><tr><td>Casos <strong>por</strong> línea</td><td>0</td></tr></table></i><h4>Casos <em>por</em> <strong>línea</strong> &amp; pedido</h4><p>nota</p><table>")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("lines"))
    made = orders.select("l_orderkey", F.concat(head, F.concat_ws("", F.transform("lines", row)), F.lit("</table><h6>Casos por línea</h6></div>")).alias("html"))
    found = html.tables_under(made, {"lines": ("casos por linea pedido",)})
    return found.select("l_orderkey", F.regexp_extract(F.col("cells")[0], r"(\d+)$", 1).cast("long").alias("l_linenumber"), F.col("cells")[1].alias("quantity"), F.col("cells")[0].alias("label"))


@query("SELECT page_id % 5 AS topic, page_id % 5 <> 3 AS ok, CASE WHEN page_id % 5 <> 3 THEN [2018 + page_id % 7, 2025] END AS available_years, CASE WHEN page_id % 5 = 3 THEN 'down' END AS error FROM pages")
def topic_status(spark, sf_dir):
    """A topic's page names the years that it has; one in five is down."""
    k, ok = F.col("page_id"), F.col("page_id") % 5 != 3
    rows = table(spark, sf_dir, "pages").select(
        k.cast("string").alias("source_id"), (k % 5).alias("cead_family_key"), "url", F.when(ok, F.concat(F.lit("<p>de "), (2018 + k % 7).cast("string"), F.lit(" a <b>2025</b></p><script>2026</script>"))).alias("html"), F.lit("d").alias("sha256"), F.lit("t").alias("retrieved_at"),
        ok.alias("ok"), F.when(~ok, "down").alias("error"),
    )
    _, status = html.topic_rows(rows)
    return status.select((F.col("source_id").cast("long") % 5).alias("topic"), "ok", F.transform("available_years", lambda y: y.cast("long")).alias("available_years"), "error")


@query("""
    SELECT n_nationkey, lpad(CAST(n_nationkey * 7 AS VARCHAR), 5, '0') AS code, CASE WHEN n_nationkey % 2 = 0 THEN 'CL-' || lpad(CAST(n_nationkey * 7 AS VARCHAR), 5, '0') ELSE 'CL-0' || n_regionkey || '-' || replace(replace(lower(n_name), ' ', '-'), '_', '-') END AS territory_id FROM nation""")
def legacy_keys(spark, sf_dir):
    code = text.padded_code((F.col("n_nationkey") * 7).cast("double"), 5)
    region = F.lpad(F.col("n_regionkey").cast("string"), 2, "0")
    return _nations(spark, sf_dir).select("n_nationkey", code.alias("code"), text.legacy_commune_id(F.when(F.col("n_nationkey") % 2 == 0, code), region, F.col("n_name")).alias("territory_id"))


@query("""
    SELECT CAST(count(*) AS BIGINT) AS rows, CAST(min(o_orderdate) AS DATE)::VARCHAR AS min_date, CAST(max(o_orderdate) AS DATE)::VARCHAR AS max_date, count(DISTINCT c_nationkey) AS communes, count(DISTINCT o_orderpriority || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END) AS offenses,
           list_sort(list(DISTINCT CAST(year(o_orderdate) AS INTEGER))) AS years
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 <> 0""")
def bridge_stats(spark, sf_dir):
    """Dates, years, places and labels as they are written; rows whose code cannot be read do not count."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    joined = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    monthly = joined.select(
        F.lit("c").alias("comuna"), F.when(F.col("o_orderkey") % 7 != 0, F.col("c_nationkey").cast("string")).otherwise("s/c").alias("cut_comuna"), F.lit("r").alias("region"), F.lit(1).alias("cut_region"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
        F.concat("o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise("")).alias("delito"), F.lit(1).alias("delito_n"),
    )
    return tables.bridge_stats(tables.monthly_bridge(monthly, 1900))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Delitos asociados a drogas' ELSE 'CRÍMENES y simples delitos: Ley de Drogas' END AS crime_category FROM orders WHERE o_orderkey % 4 < 2""")
def drug_family(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    label = F.when(k == 0, "Delitos asociados a drogas").when(k == 1, "CRÍMENES y simples delitos: Ley de Drogas").when(k == 2, "Homicidios")
    return classify.drug_family(table(spark, sf_dir, "orders").select("o_orderkey", label.alias("crime_category")))


@query("""
    WITH counts AS (SELECT c_nationkey % 28 + 1 AS district, c_mktsegment || ' ' || (c_nationkey % 28 + 1) AS commune_name, count(*) AS n FROM customer GROUP BY ALL)
    SELECT 'annual' AS kind, CAST(district AS INTEGER) AS district, commune_name, CAST(n + 1000 AS BIGINT) AS population, CAST(n AS DOUBLE) AS rate_100k, CAST(round_even(n * (n + 1000) / 100000.0::DOUBLE, 0) AS BIGINT) AS frequency, 'usable' AS quality_status, 1.0::DOUBLE AS aml_weight FROM counts
    UNION ALL SELECT 'latest', CAST(district AS INTEGER), commune_name, n + 2000, CAST(n AS DOUBLE) / 4, n, CASE WHEN district % 3 = 0 THEN 'quarantined_duplicate_section' ELSE 'usable' END, CASE WHEN district % 3 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE FROM counts""")
def communal_control(spark, sf_dir):
    """The pages of the districts, made of customers by nation and segment, read, checked and put together; every third district repeats a section."""
    counts = table(spark, sf_dir, "customer").groupBy((F.col("c_nationkey") % 28 + 1).alias("district"), F.concat_ws(" ", "c_mktsegment", (F.col("c_nationkey") % 28 + 1).cast("string")).alias("name")).agg(F.count("*").alias("n"))
    n, odd = F.col("n"), F.col("district") % 3 != 0
    plain = lambda c: F.translate(F.format_number(c, 2), ",.", ".,")
    annual = _cells(F.col("name"), F.lit("--"), plain(n.cast("double")), F.lit("--"), F.lit("--"))
    late = lambda extra: _cells(F.col("name"), F.lit("1"), (n + extra).cast("string"), (n + 1000).cast("string"), (n + 2000).cast("string"), F.lit("1,5"), plain(n / 4))
    body = lambda c: F.concat(F.lit("<table>"), F.concat_ws("", F.array_sort(F.collect_list(c))), F.lit("</table>"))
    pages_ = counts.groupBy("district").agg(
        F.concat(F.lit("<h5>Tasas anuales denuncias según Familia de delitos</h5>"), body(annual)).alias("annual"),
        F.concat(F.lit("<h6>Delitos contra la vida: frecuencia y tasa</h6>"), body(late(F.when(odd, 1).otherwise(0))), F.lit("<h6>Violencia intrafamiliar: frecuencia y tasa</h6>"), body(late(F.lit(7))), F.lit("<h6>Delitos asociados a drogas: frecuencia y tasa</h6>"), body(late(F.lit(0)))).alias("latest"),
    )
    fetched = communal.targets(spark).join(pages_, "district").withColumns({"html": F.when(F.col("kind") == "annual", F.col("annual")).otherwise(F.col("latest")), "sha256": F.sha2("url", 256), "bytes": F.lit(1).cast("long"), "retrieved_at": F.lit("t"), "ok": F.lit(True), "error": F.lit(None).cast("string")}).drop("annual", "latest")
    rows, _, _ = communal.communal(fetched)
    late_ = F.col("period_type") == "q3_ytd"
    return rows.select(F.when(late_, "latest").otherwise("annual").alias("kind"), "district", "commune_name", "population", "rate_100k", F.when(late_, F.col("value")).otherwise(F.col("estimated_frequency")).alias("frequency"), "quality_status", "aml_weight")


@query("""
    WITH people AS (SELECT n_nationkey % 16 AS r, n_name, count(*) AS victims FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    recent AS (SELECT n_nationkey % 16 AS r, n_name, count(*) AS victims FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND n_nationkey % 3 <> 0 GROUP BY ALL),
    codes(r, code) AS (VALUES (0,'15'),(1,'01'),(2,'02'),(3,'03'),(4,'04'),(5,'05'),(6,'13'),(7,'06'),(8,'07'),(9,'16'),(10,'08'),(11,'09'),(12,'14'),(13,'10'),(14,'11'),(15,'12'))
    SELECT 'commune' AS territory_level, code AS region_code, p.n_name AS commune_name, CAST(p.victims AS BIGINT) AS value, CAST(coalesce(recent.victims, 0) AS BIGINT) AS recent_h1_2025_victims,
           CASE WHEN recent.victims IS NULL THEN 'derived_zero_not_listed_in_complete_positive_table' ELSE 'observed_positive' END AS recent_h1_2025_status, CAST(p.victims * 10 AS BIGINT) AS population
    FROM people p JOIN codes USING (r) LEFT JOIN recent ON recent.n_name = p.n_name
    UNION ALL SELECT 'region', code, NULL, CAST(sum(victims) AS BIGINT), NULL, NULL, NULL FROM people JOIN codes USING (r) GROUP BY code""")
def homicide_rows(spark, sf_dir):
    """Customers by nation as the three tables of victims, whose totals are checked against each other."""
    joined = table(spark, sf_dir, "customer").join(F.broadcast(_nations(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.col("n_nationkey") % len(dims.REGIONS)
    code, name = (F.array(*[F.lit(x) for x in part])[region] for part in (list(dims.REGIONS), list(dims.REGIONS.values())))
    by = [name.alias("region_name"), F.col("n_name").alias("commune_name")]
    annual = joined.groupBy(*by).agg(F.count("*").alias("victims"), F.lit(1.0).alias("rate_100k"), (F.count("*") * 10).alias("population"))
    recent = joined.where((F.col("c_acctbal") > 0) & (F.col("n_nationkey") % 3 != 0)).groupBy(*by).agg(F.count("*").alias("victims"))
    regions = joined.groupBy(F.lit(2024).alias("year"), F.lit("2024").alias("period"), F.lit("annual").alias("period_type"), code.alias("region_code"), name.alias("region_name")).agg(F.count("*").alias("victims"), F.lit(1.0).alias("rate_100k"))
    total = {"2024": joined.count(), "2025-H1": recent.agg(F.sum("victims")).first()[0]}
    late = joined.where((F.col("c_acctbal") > 0) & (F.col("n_nationkey") % 3 != 0)).groupBy(F.lit(2025).alias("year"), F.lit("2025-H1").alias("period"), F.lit("h1").alias("period_type"), code.alias("region_code"), name.alias("region_name")).agg(F.count("*").alias("victims"), F.lit(1.0).alias("rate_100k"))
    rows = places.homicide_rows(regions.unionByName(late), annual, recent, control=total)
    return rows.where(F.col("period") == "2024").select("territory_level", "region_code", "commune_name", "value", "recent_h1_2025_victims", "recent_h1_2025_status", "population")


@query("""
    SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code, c_acctbal AS amount FROM customer""")
def csv_round_trip(spark, sf_dir):
    """Codes keep their zeros through a CSV file, under the schema given."""
    folder = new_folder(spark, "csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("region_code"), F.col("c_acctbal").alias("amount"))
    rows.write.csv(folder, header=True)
    return tables.csv(spark, folder, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))


@query("""
    WITH rows AS (SELECT c_nationkey, count(*) AS n, sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS before FROM customer GROUP BY 1)
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS commune_code, n AS cases_policiales, round_even((n - before) * 100.0 / before, 1) AS yoy_pct, row_number() OVER (ORDER BY n DESC, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') DESC) AS place FROM rows""")
def dashboard_payload(spark, sf_dir):
    """What the page's data document holds of the activity, in its order."""
    folder = new_folder(spark, "dashboard")
    code = F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
    activity = table(spark, sf_dir, "customer").groupBy(code.alias("commune_code")).agg(F.count("*").alias("cases_policiales"), F.count_if(F.col("c_acctbal") > 0).alias("previous_cases_policiales"))
    activity = activity.withColumn("yoy_pct", stats.half_even((F.col("cases_policiales") - F.col("previous_cases_policiales")) * 100.0 / F.col("previous_cases_policiales"), 1))
    regions = activity.select(F.col("commune_code").alias("region_code"), F.col("commune_code").alias("region_name"), F.col("cases_policiales").cast("double").alias("pressure_score"), F.lit("alta").alias("pressure_level"))
    status = activity.select(F.col("commune_code").cast("int").alias("ordinal"), F.col("commune_code").alias("source_id"), F.lit(True).alias("ok"))
    export.dashboard(folder, {"coverage": {}}, activity, regions, dims.catalog(spark), status)
    shown = tables.document(spark, f"{folder}/data.json")["activity"]
    return spark.createDataFrame([(r["commune_code"], r["cases_policiales"], r["yoy_pct"], k) for k, r in enumerate(shown, 1)], "commune_code string, cases_policiales long, yoy_pct double, place long")


@query(f"""
    WITH facts AS ({DENSE_SQL})
    SELECT 'EVT-COMARCA-' || left(sha256('CL-COM-' || commune_code || '|' || year || '|' || crime_category || '|lineitem'), 24) AS event_id, 'CL-COM-' || commune_code AS territory_id, 'EVD-COMARCA-' || left(sha256('cead|d|2025'), 20) AS evidence_id, 'CURRENT' AS freshness_state,
           CAST(value AS BIGINT) AS value FROM facts""")
def interop_files(spark, sf_dir):
    """Events as the export's files hold them."""
    folder = new_folder(spark, "interop")
    lineage = spark.createDataFrame([("cead", "d", "2025")], "source_id string, content_sha256 string, retrieved_at string")
    export.interop_export(dense(spark, sf_dir).withColumn("source_id", F.lit("lineitem")), lineage, folder, PRODUCER)
    events = spark.read.json(f"{folder}/territory_events_fusion")
    return events.select("event_id", F.col("territory_ids")[0].alias("territory_id"), F.col("evidence_ids")[0].alias("evidence_id"), "temporal.freshness_state", F.col("attributes.value").alias("value"))


@query("""
    WITH told AS (SELECT page_id, page_id % 3 <> 2 AS ok FROM pages)
    SELECT page_id, ok, CASE WHEN ok THEN sha256('u' || page_id) END AS evidence_sha256, CASE WHEN NOT ok THEN 'down' END AS error, CASE WHEN NOT ok THEN true END AS static_rules_available FROM told""")
def legal_evidence(spark, sf_dir):
    """Status of legal documents, one for each page; the rules stand where a document is down."""
    ok = F.col("ordinal") % 3 != 2
    targets = table(spark, sf_dir, "pages").select(F.col("page_id").alias("ordinal"), F.col("page_id").cast("string").alias("source_id"), F.concat(F.lit("u"), F.col("page_id").cast("string")).alias("url"), F.lit("norma_juridica").alias("observation_unit"))
    got = targets.select("url", ok.alias("ok"), F.when(ok, F.sha2("url", 256)).alias("sha256"), F.lit(1).cast("long").alias("bytes"), F.lit("t").alias("retrieved_at"), F.when(~ok, "down").alias("error"))
    _, status = pages.legal_evidence(targets, got)
    return status.select(F.col("source_id").cast("long").alias("page_id"), "ok", "evidence_sha256", "error", "static_rules_available")
