"""Files as frames with the schema given, never inferred: codes keep their zeros, and a column of nulls keeps its type."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from comarca import dims
from comarca.files import held, listed, read_text, shared_folder
from comarca.functions.text import commune_id, norm, norm_name, padded_code
from comarca.operators.merge import anti_united, one_per
from comarca.sources import xls


def jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a JSON-lines file; none if there is no file. Blank lines are no rows."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def document(spark: SparkSession, path: str, default=None):
    """A JSON document, or the default where it is absent or broken."""
    text = read_text(spark, path)
    try:
        return default if text is None else json.loads(text)
    except ValueError:
        return default


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def require(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted({*columns} - {*frame.columns})
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return frame


EXTERNAL_COLUMNS = ("year", "commune_code", "commune_name", "region_code", "region_name", "crime_category", "metric", "value")


def backbone(frame: DataFrame, start_year: int) -> DataFrame:
    """Annual rows of the external table: years from start_year on, numeric values, rounded half to even. NaN is no value.

    A year that the table holds as a whole number is compared as it is, so that the filter reaches the files.
    """
    require(frame, EXTERNAL_COLUMNS)
    whole = frame.schema["year"].dataType.typeName() in ("byte", "short", "integer", "long")
    year = F.col("year") if whole else F.col("year").cast("string").try_cast("int")
    value = F.nanvl(F.col("value").cast("string").try_cast("double"), F.lit(None).cast("double"))
    rows = frame.where(year >= start_year).withColumns({"year": year.cast("int"), "value": F.bround(value, 0).cast("long")}).where(F.col("value").isNotNull())
    given = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in frame.columns else F.lit(None).cast("string")
    return rows.withColumns({
        "commune_code": padded_code(F.col("commune_code"), 5), "period": F.coalesce(given("period"), F.col("year").cast("string")), "territory_level": F.lit("commune"),
        "observation_unit": F.lit("caso_policial"), "acquisition_method": F.lit("external_cead_data_pipeline"), "ultimate_source_id": F.coalesce(given("ultimate_source_id"), F.lit("cead_estadisticas_delictuales")),
    })


MANIFEST = """producer string, snapshot string, generated_at string, files array<struct<path: string, bytes: long, sha256: string>>,
    coverage struct<communes: long, expected_communes: long, offenses: long, min_date: string, max_date: string, years: array<int>>"""


def manifest_files(spark: SparkSession, manifest: str) -> DataFrame:
    """The files that a manifest document names, with their true size; a missing one has none. Paths are beside the manifest unless they are whole."""
    folder = manifest.rsplit("/", 1)[0]
    told = spark.read.schema(MANIFEST).json(manifest, multiLine=True)
    files = told.select("snapshot", F.explode("files").alias("f")).select("snapshot", F.col("f.path").alias("path"), F.col("f.bytes").alias("bytes"), F.col("f.sha256").alias("sha256"))
    named = files.withColumn("path", F.when(F.col("path").rlike("^([a-z0-9]+:|/)"), F.col("path")).otherwise(F.concat(F.lit(f"{folder}/"), "path")))
    sizes = {}
    for r in named.select("path").collect():  # a snapshot's files, as its manifest lists them
        place = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        sizes[r["path"]] = store.getFileStatus(place).getLen() if store.exists(place) else None
    return named.join(spark.createDataFrame([*sizes.items()], "path string, found long"), "path")


def external(spark: SparkSession, manifest: str, start_year: int, least: int = dims.LEAST_COMMUNES, retrieved_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the external table, its evidence (a row for each file) and its status, pinned to the one snapshot that the manifest names.

    Only the manifest's files are read, whatever else lies beside them; a file that is missing or of another size is an error, so
    a snapshot that is being replaced is never read in halves. Needed columns are checked against the files' own schema, and only
    those and the year's rows are read. The status takes its coverage from the manifest, and what that lacks from the rows.
    """
    files = manifest_files(spark, manifest).orderBy("path").collect()
    if wrong := [f["path"] for f in files if f["found"] is None or f["bytes"] not in (None, f["found"])]:
        raise ValueError(f"not the files of the manifest: {', '.join(wrong[:5])}")
    if not files:
        raise ValueError("the manifest names no files")
    frame = spark.read.parquet(*[f["path"] for f in files])
    more = [c for c in ("period", "ultimate_source_id") if c in frame.columns]
    rows = backbone(require(frame, EXTERNAL_COLUMNS).select(*EXTERNAL_COLUMNS, *more), start_year)
    evidence = spark.createDataFrame([(f["path"], f["found"], f["sha256"], f["snapshot"]) for f in files], "url string, bytes long, sha256 string, snapshot string").select(
        F.concat(F.lit("cead:external:annual:"), F.substring_index("url", "/", -1)).alias("evidence_id"), F.lit("cead_data_pipeline_external").alias("source_id"), F.lit("cead_estadisticas_delictuales").alias("ultimate_source_id"), "url", F.lit(retrieved_at).cast("string").alias("retrieved_at"), "bytes", "sha256", "snapshot",
    )
    told = F.broadcast(spark.read.schema(MANIFEST).json(manifest, multiLine=True).select(F.col("producer").alias("__producer"), F.col("snapshot").alias("__snapshot"), F.col("coverage").alias("__told")))  # one row
    own = backbone_status(rows, least)
    known = lambda c: F.coalesce(F.col(f"__told.{c}"), F.col(c))
    status = own.join(told, F.col("records").isNotNull()).select(
        "source_id", "records", known("communes").alias("communes"), known("expected_communes").cast("long").alias("expected_communes"), known("offenses").alias("offenses"), known("years").alias("years"), "ok",
        F.col("__told.min_date").alias("min_date"), F.col("__told.max_date").alias("max_date"), F.col("__producer").alias("producer"), F.col("__snapshot").alias("snapshot"), F.col("communes").alias("observed_communes"),
    )
    return rows, evidence, status


def commune_list(rows: DataFrame) -> DataFrame:
    """The distinct communes of a backbone, by region and code."""
    return rows.select("commune_code", "commune_name", "region_code", "region_name").distinct().orderBy("region_code", "commune_code")


def backbone_status(rows: DataFrame, least: int = dims.LEAST_COMMUNES) -> DataFrame:
    """One row: what a backbone covers, and whether it suffices."""
    communes = F.countDistinct("commune_code")
    return rows.agg(
        F.lit("cead_data_pipeline_external").alias("source_id"), F.count("*").alias("records"), communes.alias("communes"), F.lit(dims.EXPECTED_COMMUNES).alias("expected_communes"),
        F.countDistinct("crime_category").alias("offenses"), F.array_sort(F.collect_set("year")).alias("years"), ((F.count("*") > 0) & (communes >= least)).alias("ok"),
    )


MONTHLY_COLUMNS = ("comuna", "cut_comuna", "region", "cut_region", "fecha", "delito", "delito_n")


def monthly_bridge(frame: DataFrame, start_year: int) -> DataFrame:
    """Monthly long rows with padded codes; rows without a date, a number or a readable commune code, or from before start_year, go."""
    require(frame, MONTHLY_COLUMNS)
    date = F.try_to_date(F.col("fecha").cast("string").substr(1, 10), "yyyy-MM-dd")
    rows = frame.withColumns({"fecha": date, "delito_n": F.nanvl(F.col("delito_n").cast("string").try_cast("double"), F.lit(None).cast("double")), "year": F.year(date)})
    kept = rows.where(F.col("fecha").isNotNull() & F.col("delito_n").isNotNull() & (F.col("year") >= start_year))
    coded = kept.withColumns({"commune_code": padded_code(F.col("cut_comuna"), 5), "region_code": padded_code(F.col("cut_region"), 2), "delito_norm": norm(F.col("delito"))})
    return coded.where(F.col("commune_code").isNotNull())


def annual_bridge(monthly: DataFrame) -> DataFrame:
    """Sums of a year by place and offense, as master rows of the mirror."""
    keys = ["year", "comuna", "commune_code", "region", "region_code", "delito", "delito_norm"]
    summed = monthly.groupBy(*keys).agg(F.bround(F.sum("delito_n"), 0).cast("long").alias("value"))
    return summed.select(
        "year", F.col("year").cast("string").alias("period"), F.lit("commune").alias("territory_level"), F.concat(F.lit("CL-"), "commune_code").alias("territory_id"), "commune_code", F.col("comuna").alias("commune_name"),
        "region_code", F.col("region").alias("region_name"), F.col("delito").alias("crime_category"), F.col("delito_norm").alias("crime_category_norm"), F.lit("casos_policiales").alias("metric"), "value", F.lit("cead_community_bridge").alias("source_id"), F.lit("cead_estadisticas_delictuales").alias("ultimate_source_id"), F.lit("mirror_of_primary").alias("source_tier"), F.lit("usable_bridge").alias("quality_status"),
    )


def bridge_stats(monthly: DataFrame) -> DataFrame:
    """One row: dates, communes, offenses (as they are written) and years."""
    return monthly.agg(
        F.count("*").alias("rows"), F.min("fecha").cast("string").alias("min_date"), F.max("fecha").cast("string").alias("max_date"), F.countDistinct("commune_code").alias("communes"), F.countDistinct("delito").alias("offenses"),
        F.array_sort(F.collect_set("year")).alias("years"),
    )


# Workbooks: a sheet is rows of cells; the frames keep (file, sheet, sheet_at, row_at, cells) and every rule is a column expression.

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
#: Rows of a sheet that leave a task together.
MANY = 1000
SHEET_SCHEMA = "file string, sheet string, sheet_at int, row_at int, cells array<string>, error string"


def _sheets(raw: bytes) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """(sheet, its place in the workbook, row number from 0, cells) of a workbook of either format."""
    if raw.startswith(xls.MAGIC):
        yield from xls.sheets(raw)
        return
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        targets = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for place, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", _NS)):
            target = targets[sheet.get(f"{{{_NS['r']}}}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for row in root.findall("m:sheetData/m:row", _NS):
                cells: list[str | None] = []
                for c in row.findall("m:c", _NS):
                    letters = re.match("[A-Z]*", c.get("r", "")).group()
                    at = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters))) - 1 if letters else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    v = c.find("m:v", _NS)
                    if c.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    elif v is not None:
                        cells[at] = shared[int(v.text)] if c.get("t") == "s" else v.text
                yield sheet.get("name"), place, int(row.get("r", 1)) - 1, cells


def written(sheets: Mapping[str, Mapping[int, Sequence[str | float | int | None]]]) -> bytes:
    """A workbook of the newer format with these sheets (name -> row number -> cells), in their order."""
    own, rel = _NS["m"], _NS["r"]
    cell = lambda v: f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' if isinstance(v, str) else "<c/>" if v is None else f"<c><v>{v}</v></c>"
    body = lambda rows: "".join(f'<row r="{k + 1}">{"".join(map(cell, cells))}</row>' for k, cells in sorted(rows.items()))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        named = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{own}" xmlns:r="{rel}"><sheets>{named}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        for k, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{own}"><sheetData>{body(rows)}</sheetData></worksheet>')
    return out.getvalue()


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """sheets_of() the files at a path."""
    return sheets_of(spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content"))


def sheets_of(files: DataFrame) -> DataFrame:
    """(file, sheet, sheet_at, row_at, cells, error) of workbooks (file, content), .xlsx or .xls: a file is one task's, and its sheets leave it row by row.

    A file that cannot be read is one row with its error, so one broken workbook costs its own rows and no others.
    """
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, file in enumerate(batch.column(0).to_pylist()):
                try:
                    rows = [(file, *x, None) for x in _sheets(batch.column(1)[k].as_py() or b"")] or [(file, None, None, None, None, "no rows")]
                except Exception as e:  # noqa: BLE001  whatever is wrong with the file, it becomes the file's status
                    rows = [(file, None, None, None, None, f"{type(e).__name__}: {e}"[:500])]
                for at in range(0, len(rows), MANY):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows[at : at + MANY], strict=True), kinds, strict=True)], ["file", "sheet", "sheet_at", "row_at", "cells", "error"])

    return files.select("file", "content").mapInArrow(run, SHEET_SCHEMA)


CATEGORY_HEAD = "CATEGORÍA DE DELITOS"


def regional_sheet(rows: DataFrame, sheet: str, needle: str, known: bool) -> DataFrame:
    """The regional table of each workbook as long rows: the sheet of that name, or the workbook's first that says the needle in its first rows; region columns unpivoted, up to the national total."""
    said = rows.where(F.col("row_at") < 15).select("file", "sheet", "sheet_at", F.regexp_replace(F.upper(F.concat_ws(" ", "cells")), r"\s+", " ").alias("text"))
    fits = said.groupBy("file", "sheet", "sheet_at").agg(F.max(F.contains("text", F.lit(needle))).alias("a"), F.max(F.contains("text", F.lit(CATEGORY_HEAD))).alias("b"))
    named = F.max(F.when(F.col("sheet") == sheet, F.col("sheet")))
    chosen = fits.groupBy("file").agg(F.coalesce(named, F.min_by("sheet", F.when(F.col("a") & F.col("b"), F.col("sheet_at")))).alias("sheet"))
    own = rows.join(chosen, ["file", "sheet"]).withColumn("upper", F.transform("cells", lambda c: F.trim(F.regexp_replace(F.upper(c), r"\s+", " "))))
    heads = own.where((F.col("row_at") < 50) & F.array_contains("upper", CATEGORY_HEAD))
    head = heads.groupBy("file").agg(F.min_by(F.struct(F.col("row_at").alias("head_at"), F.transform("cells", lambda c: F.trim(c)).alias("names"), (F.array_position("upper", CATEGORY_HEAD) - 1).cast("int").alias("category_at")), "row_at").alias("h")).select("file", "h.*")
    body = own.join(head, "file").where(F.col("row_at") > F.col("head_at")).withColumn("crime_category", F.get("upper", F.col("category_at")))
    stop = body.where(F.col("crime_category") == "TOTAL NACIONAL").groupBy("file").agg(F.min("row_at").alias("stop"))
    kept = body.join(stop, "file", "left").where(F.col("stop").isNull() | (F.col("row_at") < F.col("stop")))
    kept = kept.where(F.col("crime_category").isNotNull() & ~F.col("crime_category").isin(CATEGORY_HEAD, "NAN", "") & F.get("cells", F.col("category_at")).try_cast("double").isNull())
    regions = F.create_map(*[F.lit(x) for kv in dims.PROSECUTOR_REGIONS.items() for x in kv])
    cells = kept.select("file", "crime_category", "names", F.posexplode("cells").alias("at", "cell")).withColumn("prosecutor_region", F.get("names", F.col("at")))
    long = cells.select("file", regions[F.col("prosecutor_region")].alias("region_code"), "prosecutor_region", "crime_category", F.lit("known" if known else "unknown").alias("known_status"), F.col("cell").try_cast("double").cast("long").alias("value"))
    return long.where(F.col("region_code").isNotNull() & F.col("value").isNotNull())


def prosecution_history(rows: DataFrame, years: Mapping[str, int]) -> tuple[DataFrame, DataFrame]:
    """Records (known and unknown suspects together, by year, region and category) of workbooks, and a status row for each year.

    years: the end of a file's path -> its year. A workbook that cannot be read, or lacks either table, has a status and no records.
    Workbooks are parsed once; their cells are held.
    """
    rows = held(rows)
    year = F.coalesce(*[F.when(F.col("file").endswith(end), F.lit(y)) for end, y in years.items()])
    both = regional_sheet(rows, "TB3.1", "IMPUTADOS CONOCIDOS", True).unionByName(regional_sheet(rows, "TB3.2", "IMPUTADOS DESCONOCIDOS", False))
    tables = both.groupBy("file").agg(F.countDistinct("known_status").alias("tables"))
    files = rows.groupBy("file").agg(F.max("error").alias("error")).join(tables, "file", "left").withColumn("year", year)
    whole = files.where(F.col("tables") == 2).select("file", "year")
    names = F.create_map(*[F.lit(x) for kv in dims.REGIONS.items() for x in kv])
    summed = both.join(whole, "file").groupBy("year", "region_code", "crime_category").agg(F.sum("value").alias("value"))
    source = F.lit("ministerio_publico_estadisticas").alias("source_id")
    records = summed.select(
        "year", "region_code", names[F.col("region_code")].alias("region_name"), "crime_category", "value", F.lit("region").alias("territory_level"), F.lit("delitos_ingresados").alias("metric"),
        F.lit(None).cast("double").alias("rate_100k"), source, F.col("year").alias("source_year"), F.lit("delito_ingresado_en_SAF").alias("observation_unit"), F.lit("observed").alias("data_status"),
    )
    ok = F.coalesce(F.col("tables") == 2, F.lit(False))
    counts = records.groupBy("year").agg(F.count("*").alias("records"))
    error = F.when(~ok, F.coalesce("error", F.lit("no regional table of known and unknown suspects")))
    status = files.select("year", ok.alias("ok"), error.alias("error")).join(counts, "year", "left").select(source, "year", "ok", F.coalesce("records", F.lit(0)).alias("records"), "error")
    return records, status


def prosecution_workbook(rows: DataFrame, year: int) -> DataFrame:
    """The records of one year's workbooks."""
    return prosecution_history(rows, {"": year})[0]


def _upto_enough(found: DataFrame, enough: int, had: DataFrame | None = None) -> DataFrame:
    """Rows (sheet_at, name_norm) of the sheets in their order, as long as those before a sheet name too few places; had are names from before."""
    first = found.groupBy("name_norm").agg(F.min("sheet_at").alias("at"))
    if had is not None:
        first = first.join(had.select("name_norm").distinct(), "name_norm", "left_anti")
    sheets = found.select("sheet_at").distinct().join(first.groupBy(F.col("at").alias("sheet_at")).agg(F.count("*").alias("new")), "sheet_at", "left")
    before = F.coalesce(F.sum("new").over(Window.orderBy("sheet_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each sheet
    n = 0 if had is None else had.count()
    return found.join(F.broadcast(sheets.withColumn("before", before).where(F.col("before") + n < enough).select("sheet_at")), "sheet_at")


def commune_codes(rows: DataFrame, least: int = 300) -> DataFrame:
    """(name_norm, commune_code, commune_name, region_name, territory_id) of a workbook's rows (sheet, sheet_at, row_at, cells).

    A sheet's header names the columns: of its first 20 rows the first with a cell for the code and one for the name of the
    commune. Sheets are read in the workbook's order until they name `least` communes. Where no header gives enough, every column
    most of whose cells are four or five digits is paired with every column that names one of a few towns, again sheet by sheet.
    Of repeated names a header's last row counts, or a guess's first. Raises where fewer than `least` communes are found. The
    codes are a fixed list of some 346 places.
    """
    sheets = rows if "sheet_at" in rows.columns else rows.withColumn("sheet_at", F.lit(0))
    heads = sheets.where(F.col("row_at") < 20).withColumn("names", F.transform("cells", lambda c: norm_name(c)))
    at = lambda fits: F.array_position(F.transform("names", fits), F.lit(True)).cast("int") - 1
    code_at = at(lambda h: F.contains(h, F.lit("comuna")) & (F.contains(h, F.lit("codigo")) | F.contains(h, F.lit("cut"))))
    name_at = at(lambda h: F.contains(h, F.lit("comuna")) & (F.contains(h, F.lit("nombre")) | (h == "comuna")))
    region_at = at(lambda h: F.contains(h, F.lit("region")) & F.contains(h, F.lit("nombre")))
    named = heads.select("sheet_at", "row_at", code_at.alias("code_at"), name_at.alias("name_at"), region_at.alias("region_at")).where((F.col("code_at") >= 0) & (F.col("name_at") >= 0))
    head = named.groupBy("sheet_at").agg(F.min_by(F.struct("row_at", "code_at", "name_at", "region_at"), "row_at").alias("h"))
    cell = lambda k: F.get("cells", k)
    digits = lambda c: F.regexp_replace(F.substring_index(c, ".", 1), r"\D", "")
    body = sheets.join(F.broadcast(head), "sheet_at").where(F.col("row_at") > F.col("h.row_at"))
    region = F.when(F.col("h.region_at") >= 0, F.trim(cell(F.col("h.region_at"))))
    found = body.select("sheet_at", "row_at", digits(cell(F.col("h.code_at"))).alias("code"), F.trim(cell(F.col("h.name_at"))).alias("commune_name"), region.alias("region_name")).where(F.length("code").between(4, 5) & F.col("commune_name").isNotNull())
    out = one_per(_upto_enough(found.withColumn("name_norm", norm_name(F.col("commune_name"))), least), ["name_norm"], [F.col("sheet_at"), F.col("row_at")], last=True)
    if (n := out.count()) < least:
        cells = sheets.select("sheet_at", "row_at", "cells", F.posexplode("cells").alias("at", "cell"))
        towns = F.col("cell").rlike("(?i)Santiago|Arica|Iquique|Valpara")
        columns = cells.groupBy("sheet_at", "at").agg(F.avg(F.col("cell").rlike(r"^\d{4,5}(\.0)?$").cast("int")).alias("codes"), F.max(towns).alias("towns"))
        code, name = columns.where(F.col("codes") > 0.5).select("sheet_at", F.col("at").alias("code_at")), columns.where("towns").select("sheet_at", F.col("at").alias("name_at"))
        pairs = F.broadcast(code.join(name, "sheet_at"))  # a few columns of a few sheets
        guess = sheets.join(pairs, "sheet_at").select("sheet_at", "row_at", "code_at", "name_at", digits(cell(F.col("code_at"))).alias("code"), F.trim(cell(F.col("name_at"))).alias("commune_name"), F.lit(None).cast("string").alias("region_name"))
        guess = guess.where(F.length("code").between(4, 5) & (F.length("commune_name") >= 2)).withColumn("name_norm", norm_name(F.col("commune_name")))
        first = one_per(_upto_enough(guess, least, out), ["name_norm"], [F.col("sheet_at"), F.col("code_at"), F.col("name_at"), F.col("row_at")]).select(*out.columns)
        out = anti_united(out, first, ["name_norm"])
        n = out.count()
    if n < least:
        raise ValueError(f"{n} communes found, {least} at least are needed")
    code = F.lpad("code", 5, "0")
    return out.select("name_norm", code.alias("commune_code"), "commune_name", "region_name", commune_id(code).alias("territory_id"))


def collected(spark: SparkSession, parts: dict[str, Callable[[], DataFrame]], schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all parts that could be read, and a status row for each; a part that fails is a status, never rows of zeros.

    Frames are lazy, so a part counts as read only once Spark has run it: each is checkpointed in the shared folder by
    itself, and what fails then, in a task or in the plan, is its status.
    """
    shared_folder(spark)
    rows, status = spark.createDataFrame([], schema), []
    for name, read in parts.items():
        try:
            part = read().select(*rows.columns).checkpoint(eager=True)
            rows = rows.unionByName(part)
            status.append((name, True, None))
        except Exception as e:  # noqa: BLE001  whatever it is, it becomes the part's status
            status.append((name, False, f"{type(e).__name__}: {e}"[:500]))
    return rows, spark.createDataFrame(status, "source_id string, ok boolean, error string")


def or_last_good(frame: DataFrame, last: DataFrame) -> DataFrame:
    """The frame, or the last good one where it is empty."""
    return last if frame.isEmpty() else frame


def evidence(files: DataFrame) -> DataFrame:
    """Digest and size of files read as binaryFile."""
    return files.select(F.col("path").alias("url"), F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"), F.date_format(F.col("modificationTime"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("retrieved_at"))
