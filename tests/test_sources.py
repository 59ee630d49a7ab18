import hashlib
import json
import random
import struct
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comarca import files, queries, source_queries  # noqa: F401  the last registers its queries
from comarca.sources import communal, html, osint, pages, tables, xls
from comarca.streaming import upserts

# The district table's columns are, in this order: life and integrity, drugs, property, domestic violence.
ANNUAL = """<h5>Tasas anuales denuncias según Familia de delitos</h5><table><tr><th>Nivel territorial</th><th>Violentos</th><th>Drogas</th><th>Propiedad</th><th>VIF</th></tr>
<tr><td>Arica</td><td>2.066,4</td><td>32,7</td><td>--</td><td>673,1</td></tr><tr><td>Distrito 1</td><td>2.000,0</td><td>33,0</td><td>1.100,0</td><td>600,0</td></tr></table>"""
SECTION = "<strong>{}: frecuencia y tasa</strong><table><tr><td>Talca</td><td>{}</td><td>12</td><td>257.163</td><td>260.000</td><td>4,0</td><td>4,6</td></tr></table>"


def test_annual_table(spark):
    pages = spark.createDataFrame([(1, "15", "Arica y Parinacota", ANNUAL)], "district int, region_code string, region_name string, html string")
    found = {r["cead_family_key"]: r for r in html.annual_rates(pages).collect()}
    assert {k: r["rate_100k"] for k, r in found.items()} == {"delitos_contra_vida_integridad": 2066.4, "delitos_asociados_drogas": 32.7, "violencia_intrafamiliar": 673.1}
    drugs = found["delitos_asociados_drogas"]
    assert (drugs["territory_id"], drugs["crime_category"], drugs["article27_relation"], drugs["score_eligible"], drugs["aml_weight"]) == ("CL-15-arica", "Delitos asociados a drogas", "direct_family_ley_20000", True, 1.0)
    assert (drugs["metric"], drugs["value"], drugs["period_type"], drugs["observation_unit"], drugs["data_status"], drugs["commune_code"]) == ("tasa_denuncias_100k", None, "annual", "denuncia_formal", "observed_rate", None)
    assert found["violencia_intrafamiliar"]["aml_weight"] == 0.0 and not found["delitos_contra_vida_integridad"]["score_eligible"]
    known = spark.createDataFrame([("15", "arica", 200_000), ("15", "x", 0)], "region_code string, commune_name_norm string, population long")
    row = html.with_population(html.annual_rates(pages), known).where("cead_family_key = 'delitos_asociados_drogas'").first()
    assert row["estimated_frequency"] == 65 and row["frequency_status"].startswith("derived")


def test_communal_control(spark):
    targets = communal.targets(spark)
    assert targets.count() == 56 and targets.where("district = 19").first()["region_name"] == "Ñuble" and targets.select("url").distinct().count() == 56
    latest = "".join(f"<h6>7.{k} {h}: Frecuencia y Tasa</h6><table><tr><td>Arica</td><td>575</td><td>{n}</td><td>257.163</td><td>259.064</td><td>223,6</td><td>160,8</td></tr></table>" for k, (h, n) in enumerate((("Delitos contra la vida", 424), ("Violencia Intrafamiliar", 9), ("Delitos asociados a Drogas", 424)), 1))
    text = F.when(F.col("kind") == "annual", ANNUAL).otherwise(latest)
    pages = targets.where("district = 1").withColumns({"html": text, "sha256": F.sha2("url", 256), "bytes": F.lit(9), "retrieved_at": F.lit("t"), "ok": F.lit(True), "error": F.lit(None).cast("string")})
    failed = targets.where("district = 2 AND kind = 'annual'").withColumns({c: F.lit(None).cast(t) for c, t in (("html", "string"), ("sha256", "string"), ("bytes", "int"), ("retrieved_at", "string"))} | {"ok": F.lit(False), "error": F.lit("down")})
    rows, evidence, status = communal.communal(pages.unionByName(failed), least=1)
    found = {(r["period"], r["cead_family_key"]): r for r in rows.collect()}
    assert len(found) == 4 and found["2024", "delitos_asociados_drogas"]["estimated_frequency"] == 84 and found["2024", "delitos_asociados_drogas"]["population"] == 257163
    late = found["2025-Q3", "delitos_asociados_drogas"]
    assert (late["quality_status"], late["value"], late["aml_weight"], late["metric"], late["period_type"]) == ("quarantined_duplicate_section", 424, 0.0, "denuncias", "q3_ytd") and late["source_url"].endswith("anno=2026&distrito=1")
    assert {r["evidence_id"] for r in evidence.collect()} == {"bcn:cead:annual2024:d1", "bcn:cead:q3_2025:d1"}
    told = {(r["source_id"], r["district"]): r for r in status.collect()}
    assert told["bcn_siit_cead_annual_2024", None]["ok"] and told["bcn_siit_cead_latest_2025", None]["quarantined_districts"] == [1] and told["bcn_siit_cead_annual_2024", 2]["error"] == "down"


@pytest.mark.parametrize(("other", "status", "weight"), [(10, "quarantined_duplicate_section", 0.0), (11, "usable", 1.0)])
def test_duplicate_sections_are_quarantined(spark, other, status, weight):
    page = "".join(SECTION.format(h, n) for h, n in (("Delitos asociados a drogas", 10), ("Delitos contra la vida", other), ("Violencia intrafamiliar", 12)))
    pages = spark.createDataFrame([(17, "07", "Maule", page)], "district int, region_code string, region_name string, html string")
    (row,) = html.latest_rates(pages).collect()
    assert (row["quality_status"], row["aml_weight"], row["pop_2024"]) == (status, weight, 257163.0)


def test_monthly_table(spark):
    page = "<table><tr><td>x</td></tr><tr><th>Delito</th><th>Enero</th><th>Febrero</th><th>Marzo</th></tr><tr><td>Drogas</td><td>12</td><td>1.003</td><td>-</td></tr></table>"
    found = html.monthly_cases(spark.createDataFrame([(2025, "1101", page)], "year int, commune_code string, html string")).orderBy("period").collect()
    assert [(r["period"], r["cases_policiales"], r["commune_code"]) for r in found] == [("2025-01", 12, "01101"), ("2025-02", 1003, "01101")]


def test_links_events_and_publications(spark):
    page = '<ul><li>Publicado 5/3/2024 <a href="/n?1">Nueva ley de <b>lavado</b> de activos</a></li><li><a href="/n?1">Otra nota sobre lavado de activos</a></li><li><a href="mailto:x">lavado de activos por correo</a></li><li><a href="/m">lavado</a></li></ul>'
    pages = spark.createDataFrame([("uaf", "https://u.cl/a", 0, page), ("uaf", "https://u.cl/a", 1, None)], "source_id string, url string, ordinal int, html string")
    (row,) = osint.events(pages, ["Lavado", "drogas"]).collect()
    assert row["title"] == "Otra nota sobre lavado de activos" and row["matched_keywords"] == ["lavado"] and row["url"] == "https://u.cl/n?1" and row["retrieved_at"] is None
    told = osint.event_status(spark.createDataFrame([("uaf", True, None), ("x", False, "down"), ("y", True, None)], "source_id string, ok boolean, error string"), osint.events(pages, ["Lavado"]))
    assert {r["source_id"]: (r["ok"], r["events"], r["error"]) for r in told.collect()} == {"uaf": (True, 1, None), "x": (False, None, "down"), "y": (True, 0, None)}
    assert "5/3/2024" in html.links(pages).where("link_at = 0").first()["around"]
    first = osint.publications(pages, ["ley"]).collect()
    assert [r["title"] for r in first] == ["Nueva ley de lavado de activos"]
    page = '<a href="/a"> Tráfico  ilícito</a><a href="mailto:sitia@x">correo</a><a href="/docs/casos%20policiales-trata.pdf"></a><a href="/b">Nada</a><a href="/a">HOMICIDIOS</a>'
    pages = spark.createDataFrame([("spd", "https://u.cl/x/", 0, page, "now")], "source_id string, url string, ordinal int, html string, retrieved_at string")
    listed = {r["url"]: (r["title"], r["retrieved_at"], r["publication_type"], r["data_status"]) for r in osint.publications(pages).collect()}
    kind = ("now", "official_discovery", "observed_link")
    assert listed == {"https://u.cl/a": ("Tráfico ilícito", *kind), "mailto:sitia@x": ("correo", *kind), "https://u.cl/docs/casos%20policiales-trata.pdf": ("casos%20policiales-trata.pdf", *kind)}
    page = 'de 2017 a 2020 y 2020, 2031 <a href="x?anno=2025">2021</a><script>var y = 2019;</script><style>.a2022 {}</style><!-- 2023 --><p title="2024">fin</p> 2018'
    assert [r["years"] for r in html.page_years(spark.createDataFrame([(0, page), (1, None)], "k int, html string")).orderBy("k").collect()] == [[2018, 2020, 2021], []]


def test_page_tree(spark):
    page = """<div><h5>Tasas <strong>anuales</strong> denuncias</h5></p><table><tr><td><strong>Otra cosa</strong> A &amp; B<script>var x = "<td>";</script></td><td>1</td></tr>
    <tr><td>fuera<table><tr><th>dentro</th></tr><tr></tr></table></td></tr></table><h6>Sin tabla anuales</h6><br/><h4>Otra cosa</h4><table><tr><td>segunda</td></tr></table><strong>tasas anuales denuncias</strong></div>"""
    pages = html.with_nodes(spark.createDataFrame([(1, page), (2, None)], "k int, html string"))
    under = lambda *needles: [r["cells"] for r in html.rows_under(pages, needles).orderBy("row_at").collect()]
    first = [["Otra cosa A & B", "1"], ["fuera dentro", "dentro"], ["dentro"]]
    assert under("tasas anuales denuncias") == first and under("anuales") == first and under("otra cosa") == [["dentro"]] and under("Sin tabla") == [["segunda"]] and under("nada") == []
    assert html.table_rows(spark.createDataFrame([(1, page)], "k int, html string")).groupBy("table_at").count().orderBy("table_at").select("count").collect() == [(3,), (1,), (1,)]
    rows, status = html.topic_rows(spark.createDataFrame([("s", "f", "u", "en 2020 y 2021", "d", "t", True, None), ("x", "f", "v", None, None, "t", False, "down")], "source_id string, cead_family_key string, url string, html string, sha256 string, retrieved_at string, ok boolean, error string"))
    assert [(r["available_years"], r["territorial_levels"]) for r in rows.collect()] == [([2020, 2021], ["country", "region", "commune"])]
    assert {r["source_id"]: (r["ok"], r["available_years"], r["error"]) for r in status.collect()} == {"s": (True, [2020, 2021], None), "x": (False, None, "down")}


def test_rows_leave_a_page_where_it_is_read(spark, monkeypatch):
    pages = ["<i>x</i><h4>Casos <em>por</em> día &amp; mes</h4></b><table><tr><td>a&nbsp;b<td>c</tr><tr></tr><tr><th>d<table><tr><td>e</td></tr></table></th></tr></table><h4>Casos por dia</h4>", "<h4>CASOS por día</h4><script>'<td></p'</script><table><tr><td>f<script>'<td>'</script><br>g", "<h4 class='x'>casos por dia</h4><!-- <table> --><table><tr><td title='>'>h</td></tr></table>", "<h4>casos por dia</h4>", "", None]
    frame = spark.createDataFrame(list(enumerate(pages)), "k int, html string")
    found = sorted((r["k"], r["row_at"], r["cells"]) for r in html.tables_under(frame, {"x": ("casos por dia",)}).collect())
    assert found == [(0, 0, ["a b c", "c"]), (0, 1, ["d e", "e"]), (0, 2, ["e"]), (1, 0, ["f g"]), (2, 0, ["h"])]
    assert found == sorted((r["k"], r["row_at"], r["cells"]) for r in html.rows_under(html.with_nodes(frame), ("casos por dia",)).collect())
    # A page that is cut at its tags is the tree that the parser makes of it.
    draw, bits = random.Random(1), ["<td>", "</td>", "<tr>", "</tr>", "<table>", "</table>", "<p>", "</p>", "<br>", "</br>", "<h4>", "</h4>", " a ", "b &amp; c", "&#65", "&", "d;", "<script>'<td>'</script>", "<style></style>"]
    made = ["".join(draw.choices(bits, k=12)) for _ in range(500)]
    tree = lambda page: [(*n[:3], t.text(at)) for t in [html._Tree(page)] for at, n in enumerate(t.nodes)]
    cut = [tree(page) for page in made]
    monkeypatch.setattr(html, "_PLAIN_TAGS", frozenset())
    assert cut == [tree(page) for page in made]
    # From the query's plan: rows leave the task that reads a page, not its nodes.
    monkeypatch.undo()
    plan = queries.QUERIES["page_tables"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "nodes" not in plan


def test_bridge(spark):
    rows = [("Iquique", "1101", "Tarapacá", 1, d, "Drogas", n) for d, n in (("2024-01-01", 3), ("2024-02-01", 4), ("2025-01-01", 5), ("x", 9), ("2024-03-01", None), ("2019-01-01", 1))]
    rows += [("Iquique", code, "Tarapacá", 1, "2024-01-01", "Drogas", 100) for code in (None, "s/c")]
    monthly = tables.monthly_bridge(spark.createDataFrame(rows, "comuna string, cut_comuna string, region string, cut_region int, fecha string, delito string, delito_n long"), 2020)
    assert {r["year"]: (r["value"], r["commune_code"], r["region_code"]) for r in tables.annual_bridge(monthly).collect()} == {2024: (7, "01101", "01"), 2025: (5, "01101", "01")}
    assert tables.bridge_stats(monthly).first().asDict() == {"rows": 3, "min_date": "2024-01-01", "max_date": "2025-01-01", "communes": 1, "offenses": 1, "years": [2024, 2025]}
    with pytest.raises(ValueError, match="cut_comuna"):
        tables.monthly_bridge(spark.createDataFrame([(1,)], "comuna int"), 2020)
    shape = "year string, commune_code double, commune_name string, region_code string, region_name string, crime_category string, metric string, value string, period string"
    row = lambda year, code, value, period=None: (year, code, "Iquique", "01", "Tarapacá", "a", "casos_policiales", value, period)
    found = tables.backbone(spark.createDataFrame([row("2024", 1101.0, "2.5"), row("2024", 1101.0, "7", "2024-H1"), row("2019", 1.0, "1"), row("2024", float("nan"), "nan")], shape), 2020)
    assert sorted((r["commune_code"], r["value"], r["period"], r["ultimate_source_id"], r["observation_unit"]) for r in found.collect()) == [("01101", 2, "2024", "cead_estadisticas_delictuales", "caso_policial"), ("01101", 7, "2024-H1", "cead_estadisticas_delictuales", "caso_policial")]
    assert [tuple(r) for r in tables.commune_list(found).collect()] == [("01101", "Iquique", "01", "Tarapacá")] and not tables.backbone_status(found).first()["ok"]
    with pytest.raises(ValueError, match="region_name"):
        tables.backbone(found.drop("region_name"), 2020)


def test_binary_workbooks():
    """Strings that run on over records, either kind of stream, packed numbers, values of formulas, and files that are broken."""
    r = random.Random(2)
    odd = {"Zeta": {0: ["á", "漢字", 1, 2.5, None, -7, 1 << 40], 3: [None, "x"]}, "Alfa": {0: ["x"]}}
    assert list(xls.sheets(xls.written(odd))) == [("Zeta", 0, 0, ["á", "漢字", "1", "2.5", None, "-7", str(1 << 40)]), ("Zeta", 0, 3, [None, "x"]), ("Alfa", 1, 0, ["x"])]
    big = {"s": {k: [f"fila {k} " + "漢é" * r.randint(0, 60), k, k / 7, "y" * r.randint(0, 9000)] for k in range(100)}}
    raw = xls.written(big)
    assert {row: cells for _, _, row, cells in xls.sheets(raw)} == {k: [v[0], str(v[1]), xls._number(v[2]), v[3]] for k, v in big["s"].items()}
    for n in (0, 100, 600, 5000, len(raw) // 2, len(raw) - 513):
        with pytest.raises((ValueError, struct.error)):
            list(xls.sheets(raw[:n]))
    loop = bytearray(raw)
    loop[512 + 4 * 50 : 512 + 4 * 51] = struct.pack("<I", 50)  # a sector that is its own successor
    with pytest.raises(ValueError, match="chain"):
        list(xls.sheets(bytes(loop)))
    record = lambda kind, fmt, *v: struct.pack("<HH", kind, struct.calcsize("<" + fmt)) + struct.pack("<" + fmt, *v)
    packed = lambda whole, hundredth: (whole << 2 | 2 | hundredth) & 0xFFFFFFFF
    body = record(xls.MULRK, "HHHIHIH", 0, 1, 0, packed(5, 0), 0, packed(-250, 1), 2) + record(xls.RK, "HHHI", 1, 0, 0, struct.unpack("<Q", struct.pack("<d", 1.5))[0] >> 32)
    body += record(xls.FORMULA, "HHHdHIH", 2, 0, 0, 6.25, 0, 0, 0) + record(xls.FORMULA, "HHHBBBBBBHHIH", 2, 1, 0, 0, 0, 0, 0, 0, 0, 0xFFFF, 0, 0, 0) + record(xls.STRING, "HB3s", 3, 0, b"abc")
    body += record(xls.BOOL_ERROR, "HHHBB", 3, 0, 0, 1, 0) + record(xls.BOOL_ERROR, "HHHBB", 3, 1, 0, 0x2A, 1) + record(xls.LABEL, "HHHHB2s", 3, 2, 0, 2, 0, b"hi") + record(xls.EOF, "")
    assert xls._cells(body, 0, []) == {0: {1: "5", 2: "-2.5"}, 1: {0: "1.5"}, 2: {0: "6.25", 1: "abc"}, 3: {0: "1", 1: "#N/A", 2: "hi"}}
    with pytest.raises(ValueError, match="cut off"):
        xls._cells(body[:-4], 0, [])


def test_external_table_is_pinned_to_its_manifest(spark, tmp_path):
    rows = [(2019 + k % 4, f"0110{k % 3}", "a", "01", "Tarapacá", f"c{k % 2}", "casos_policiales", k + 0.5, "unused") for k in range(24)]
    frame = spark.createDataFrame(rows, "year int, commune_code string, commune_name string, region_code string, region_name string, crime_category string, metric string, value double, unused string")
    frame.coalesce(1).write.parquet(str(tmp_path / "a"))
    frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))  # a second snapshot's file beside the first's
    first, second = sorted((tmp_path / "a").glob("*.parquet"))
    (tmp_path / "a/manifest.json").write_text(json.dumps({"producer": "p", "snapshot": "s1", "files": [{"path": first.name, "bytes": first.stat().st_size, "sha256": "d"}], "coverage": {"communes": 345, "min_date": "2019-01-01", "max_date": "2022-12-01"}}, indent=1))
    found, evidence, status = tables.external(spark, str(tmp_path / "a/manifest.json"), 2021)
    assert found.count() == 12 and {r["year"] for r in found.collect()} == {2021, 2022} and sorted(r["value"] for r in found.collect())[:2] == [2, 4]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(year,2021)" in plan and "unused" not in plan
    assert evidence.first()["bytes"] == first.stat().st_size and evidence.count() == 1
    told = status.first()
    assert (told["communes"], told["observed_communes"], told["expected_communes"], told["max_date"], told["years"], told["ok"], told["snapshot"]) == (345, 3, 346, "2022-12-01", [2021, 2022], False, "s1")
    (tmp_path / "a/manifest.json").write_text(json.dumps({"files": [{"path": first.name, "bytes": 1}]}))
    with pytest.raises(ValueError, match="not the files"):
        tables.external(spark, str(tmp_path / "a/manifest.json"), 2021)
    (tmp_path / "a/manifest.json").write_text(json.dumps({"files": [{"path": "gone.parquet"}]}))
    with pytest.raises(ValueError, match="gone"):
        tables.external(spark, str(tmp_path / "a/manifest.json"), 2021)


def workbook(path, sheets):
    path.parent.mkdir(exist_ok=True)
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        for k, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(f"{'ABCDEFGHIJ'[c]}{r}", v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/s{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def test_workbook(spark, tmp_path):
    table = lambda n: [["título"], [None, "Categoría  de delitos", "I", "RM CN", "RM OR", "RM OCC", "RM SUR", "otra"], [None, "Robos", n, 2, 3, 4, 5, 9], [None, "Total nacional", *[9] * 6], [None, "Nota", *[1] * 6]]
    workbook(tmp_path / "ministerio_publico_2024.xlsx", {"x": [["nada"]], "TB3.1": table(5), "hoja": [["IMPUTADOS DESCONOCIDOS"], *table(7)]})
    workbook(tmp_path / "ministerio_publico_2023.xlsx", {"TB3.1": table(5)})
    (tmp_path / "ministerio_publico_2022.xlsx").write_bytes(b"no workbook")
    sheets = tables.workbooks(spark, str(tmp_path))
    records, status = tables.prosecution_history(sheets, {f"ministerio_publico_{y}.xlsx": y for y in (2022, 2023, 2024)})
    assert {(r["year"], r["region_code"], r["region_name"]): r["value"] for r in records.collect()} == {(2024, "01", "Tarapacá"): 12, (2024, "13", "Metropolitana de Santiago"): 28}  # all four offices of the capital
    told = {r["year"]: (r["ok"], r["records"], r["error"]) for r in status.collect()}
    assert told[2024] == (True, 2, None) and not told[2023][0] and "no regional table" in told[2023][2] and not told[2022][0] and "BadZipFile" in told[2022][2]
    assert tables.prosecution_workbook(sheets.where(F.col("file").contains("2024")), 2024).count() == 2
    assert tables.evidence(spark.read.format("binaryFile").load(str(tmp_path))).first()["bytes"] > 0
    # The same sheets in either format are the same rows; of two sheets that fit, the workbook's first counts, not the alphabet's.
    both = {"Zeta": [["imputados conocidos"], *table(5)], "Alfa": [["imputados conocidos"], *table(100)], "hoja": [["IMPUTADOS DESCONOCIDOS"], *table(7)]}
    workbook(tmp_path / "z/ministerio_publico_2021.xlsx", both)
    old = xls.written({name: dict(enumerate(rows)) for name, rows in both.items()})
    (tmp_path / "z/ministerio_publico_2020.xls").write_bytes(old)
    (tmp_path / "z/ministerio_publico_2019.xls").write_bytes(old[:-700])
    sheets = tables.workbooks(spark, str(tmp_path / "z"))
    rows = {e: sorted(tuple(r) for r in sheets.where(F.col("file").endswith(e)).drop("file").collect()) for e in ("2021.xlsx", "2020.xls")}
    assert len(rows["2020.xls"]) == 18 and rows["2021.xlsx"] == rows["2020.xls"]
    records, status = tables.prosecution_history(sheets, {f"{y}.xls{x}": y for y, x in ((2019, ""), (2020, ""), (2021, "x"))})
    assert {(r["year"], r["region_code"]): r["value"] for r in records.collect()} == {(y, region): n for y in (2020, 2021) for region, n in (("01", 12), ("13", 28))}
    assert "cut off" in {r["year"]: r["error"] for r in status.collect()}[2019] or "sector" in {r["year"]: r["error"] for r in status.collect()}[2019]


def test_commune_sheet(spark):
    rows = [("s", 0, ["Listado"]), ("s", 1, ["Nombre Región", "Nombre Comuna", "Código Comuna 2018"])] + [("s", k + 1, ["Metropolitana", f"Comuna {k}", f"{13000 + k}.0"]) for k in range(1, 301)]
    sheet = spark.createDataFrame([*rows, ("s", 400, ["x", "mala", "123"])], "sheet string, row_at int, cells array<string>")
    found = {r["name_norm"]: r for r in tables.commune_codes(sheet).collect()}
    assert found["comuna 1"]["commune_code"] == "13001" and found["comuna 1"]["region_name"] == "Metropolitana" and found["comuna 1"]["territory_id"] == "CL-COM-13001" and len(found) == 300
    with pytest.raises(ValueError, match="communes found"):
        tables.commune_codes(sheet.where("row_at < 9"))
    # Sheets are read in the workbook's order, and no further once enough is known: a later sheet does not count.
    more = sheet.select("*", F.lit(1).alias("sheet_at")).unionByName(sheet.select(F.lit("a").alias("sheet"), "row_at", F.transform("cells", lambda c: F.replace(c, F.lit("130"), F.lit("990"))).alias("cells"), F.lit(2).alias("sheet_at")))
    more = more.unionByName(spark.createDataFrame([("z", 0, ["Comuna", "CUT comuna"], 0), ("z", 1, ["Comuna 1", "77777"], 0), ("z", 2, ["Otra", "77778"], 0)], "sheet string, row_at int, cells array<string>, sheet_at int"))
    ordered = {r["name_norm"]: r["commune_code"] for r in tables.commune_codes(more).collect()}
    assert ordered["comuna 1"] == "13001" and ordered["comuna 300"] == "13300" and ordered["otra"] == "77778" and len(ordered) == 301
    bare = spark.createDataFrame([("s", k, [str(1000 + k), "x", f"Arica {k}"]) for k in range(310)], "sheet string, row_at int, cells array<string>")
    guessed = {r["name_norm"]: r["commune_code"] for r in tables.commune_codes(bare).collect()}
    assert guessed["arica 7"] == "01007" and len(guessed) == 310


def test_files(spark, tmp_path):
    assert tables.jsonl(spark, str(tmp_path / "none.jsonl"), "a string").collect() == []
    (tmp_path / "a.jsonl").write_text('{"a": "01"}\n\n{"a": null}\n')
    assert sorted((r["a"] or "") for r in tables.jsonl(spark, str(tmp_path / "a.jsonl"), "a string").collect()) == ["", "01"]
    (tmp_path / "b.csv").write_text("region_code,n\n01,5\n")
    assert tables.csv(spark, str(tmp_path / "b.csv"), "region_code string, n int").first()["region_code"] == "01"
    (tmp_path / "c.json").write_text("{broken")
    assert tables.document(spark, str(tmp_path / "c.json"), 7) == 7 == tables.document(spark, str(tmp_path / "d.json"), 7)
    files.write_text(spark, str(tmp_path / "deep/e.json"), '{"á": 1}')
    assert tables.document(spark, str(tmp_path / "deep/e.json")) == {"á": 1}

    def broken():
        raise OSError("down")

    late = lambda: spark.range(1).select(F.raise_error(F.lit("late")).cast("int").alias("a"))  # noqa: E731  fails in a task, not in the plan
    rows, status = tables.collected(spark, {"good": lambda: spark.createDataFrame([(1,)], "a int"), "bad": broken, "late": late}, "a int")
    assert rows.count() == 1 and {r["source_id"]: r["ok"] for r in status.collect()} == {"good": True, "bad": False, "late": False}
    assert tables.or_last_good(rows.limit(0), rows).count() == 1


def test_a_workbook_leaves_its_task_in_parts():
    class Files:
        select, mapInArrow = lambda self, *_: self, lambda self, run, _: run

    raw = xls.written({"a": {k: [float(k)] for k in range(2500)}})
    batch = pa.RecordBatch.from_pydict({"file": ["x", "y"], "content": pa.array([raw, b"no workbook"], pa.binary())})
    found = list(tables.sheets_of(Files())(iter([batch])))
    assert max(b.num_rows for b in found) <= 1000
    rows = [r for b in found for r in b.to_pylist()]
    assert [(r["file"], r["cells"]) for r in rows[:-1]] == [("x", [str(k)]) for k in range(2500)] and rows[-1]["file"] == "y" and rows[-1]["error"]


def test_cache_reads_its_facts_from_files(spark, monkeypatch):
    seen, upsert = [], upserts.upsert_batch
    monkeypatch.setattr(upserts, "upsert_batch", lambda batch, *a, **b: seen.append(batch.inputFiles()) or upsert(batch, *a, **b))
    assert queries.QUERIES["cache_buckets"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 2 and all("/facts-" in f for batch in seen for f in batch)


def test_stream_upserts(spark, tmp_path):
    schema, out = "k int, v string, ordinal int", str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("".join(f'{{"k": {k}, "v": "a", "ordinal": 0}}\n' for k in range(200)))
    stream = lambda check, **more: upserts.upsert_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), out, str(tmp_path / check), ["k"], buckets=16, **more).awaitTermination()
    rows = lambda n: sorted((r["k"], r["v"]) for r in upserts.read_version(spark, out, n, schema).collect())
    stream("check")
    (tmp_path / "in/b.json").write_text('{"k": 2, "v": "c", "ordinal": 0}\n{"k": 2, "v": "d", "ordinal": 1}\n{"k": 500, "v": "e", "ordinal": 0}\n')
    stream("check")
    want = sorted({**{k: "a" for k in range(200)}, 2: "d", 500: "e"}.items())
    assert rows(0) == [(k, "a") for k in range(200)] and rows(1) == want
    # What a batch writes follows the batch: two keys touch two buckets at most, the others are taken over by name.
    written = [files.bytes_below(spark, f"{out}/data/version={n:012d}") for n in (0, 1)]
    touched = [b for b, v in upserts.manifest(spark, out, 1)["of"].items() if v == 1]
    assert 1 <= len(touched) <= 2 and written[1] < written[0] / 4 and len(upserts.manifest(spark, out, 1)["of"]) == 16
    # The batch again, as after a failure, gives the same version; a refused one leaves the rows and says so.
    upserts.upsert_batch(spark.read.schema(schema).json(str(tmp_path / "in/b.json")), 1, out, ["k"])
    assert rows(1) == want
    (tmp_path / "in/c.json").write_text('{"k": 3, "v": "z", "ordinal": 0}\n')
    stream("check", accept=lambda batch: batch.count() > 5)
    assert rows(2) == want and upserts.manifest(spark, out, 2)["rejected"] == [2]
    upserts.upsert_batch(spark.read.schema(schema).json(str(tmp_path / "in/c.json")).limit(0), 3, out, ["k"])
    upserts.rebucketed(spark, out, 3, schema, 4, ["k"])
    upserts.upsert_batch(spark.read.schema(schema).json(str(tmp_path / "in/c.json")), 5, out, ["k"])
    later = sorted({**dict(want), 3: "z"}.items())
    assert rows(4) == want and rows(5) == later and upserts.manifest(spark, out, 5)["buckets"] == 4
    assert upserts.swept(spark, out, keep=1) > 15 and rows(5) == later
    assert upserts.read_version(spark, out, -1, schema).count() == 0
    for gone in (0, 41):
        with pytest.raises(FileNotFoundError, match=f"version {gone}"):
            upserts.read_version(spark, out, gone, schema)


def test_text_of_pages(spark):
    """Charsets by mark, header, the page's own word, or none of them; and bytes that are no text in it."""
    cases = [
        ("áñ€", "cp1252", "text/html; charset=ISO-8859-1"), ("áñ", "latin-1", 'text/html; charset="latin1"'), ("áñ漢", "utf-8", "text/html;charset=UTF-8"), ('<meta charset="iso-8859-1">áñ', "latin-1", None), ("áñ", "latin-1", "text/html"), ("áñ漢", "utf-8", None),
        ('<META http-equiv="Content-Type" content="text/html; charset=windows-1252">“é”', "cp1252", ""), ("áñ", "utf-8-sig", "text/html; charset=iso-8859-1"), ("áñ", "utf-8", "text/html; charset=x-unknown"), ("", "utf-8", None),
    ]
    rows = spark.createDataFrame([(k, bytearray(t.encode(c)), h) for k, (t, c, h) in enumerate(cases)] + [(99, None, None), (98, bytearray(b"a\xffb"), "text/html; charset=utf-8")], "k int, content binary, content_type string")
    found = {r["k"]: r["t"] for r in rows.select("k", pages.text_of(F.col("content"), F.col("content_type")).alias("t")).collect()}
    assert [found[k] for k in range(len(cases))] == [t for t, _, _ in cases] and found[99] is None and found[98] == "a\ufffdb"


def test_requests_to_a_host_are_bounded():
    reader = pages._Reader(["http://a/1", "http://a/2", "http://b/1", "http://A/3", "http://a/1", "http://a/4", "http://a/5"], 1, 2, 0)
    parts = sorted(p.urls for p in reader.partitions())
    assert parts == [["http://A/3", "http://a/5"], ["http://a/1", "http://a/2"], ["http://b/1"]] or (sorted(sum(parts, [])) == ["http://A/3", "http://a/1", "http://a/2", "http://a/4", "http://a/5", "http://b/1"] and len(parts) == 3)
    assert [p.urls for p in pages._Reader([], 1, 2, 0).partitions()] == [[]]


def test_fetched_files_are_kept_as_they_are(spark, tmp_path):
    book = xls.written({"s": {0: ["a", 1]}})
    (tmp_path / "a.xls").write_bytes(book)
    (tmp_path / "copy.xls").write_bytes(book)
    (tmp_path / "l.html").write_bytes("<meta charset=latin1>á".encode("latin-1"))
    store, urls = str(tmp_path / "store"), [(tmp_path / n).as_uri() for n in ("a.xls", "copy.xls", "l.html", "none.xls")]
    got = pages.fetched(spark, urls)
    evidence = pages.stored(got, store)
    told = {r["url"]: r for r in evidence.collect()}
    assert len(told) == 3 and told[urls[0]]["sha256"] == hashlib.sha256(book).hexdigest() == told[urls[1]]["sha256"] and told[urls[0]]["bytes"] == len(book)
    assert {r["url"]: r["html"] for r in got.collect()}[urls[2]] == "<meta charset=latin1>á" and pages.in_store(spark, store).count() == 2
    pages.stored(got, store).collect()
    assert pages.in_store(spark, store).count() == 2  # nothing is kept twice
    cells = tables.sheets_of(pages.from_store(evidence.where(F.col("url").endswith(".xls")), store)).collect()
    assert sorted((r["file"], r["cells"]) for r in cells) == [(u, ["a", "1"]) for u in sorted(urls[:2])]
