"""Pages as trees of numbered nodes, and the tables, links and sections that expressions find in them.

A page is parsed once, in the task that holds it, into an array of node rows: elements of interest with their number in document
order, the number at which they end, their visible text, and the open elements around them. What follows are expressions over that
array, without a shuffle: the next table after a heading is the least number beyond it, a table's rows are those within it, and
scripts and styles are no text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from comarca import dims
from comarca.functions.text import commune_code, is_commune, legacy_commune_id, norm, norm_or_none, once, parse_number, plain
from comarca.operators.classify import family_mapped
from comarca.plans.rollups import quarantined_duplicates

HEADINGS = ("h4", "h5", "h6", "strong")
CELLS = ("td", "th")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements whose text a reader does not see as the page's.
UNSEEN = {"script", "style", "template", "rt", "rp"}
#: Elements whose tags have no rules of their own: a page of these alone, without attributes, is read by cutting it at its tags; scripts and styles are cut out whole.
PLAIN = frozenset("html body div span p h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th strong em b i u small a ul ol li section article main header footer nav br hr".split())
_PLAIN_TAGS = PLAIN | {f"/{tag}" for tag in PLAIN} | {None}
_TAG = re.compile(r"<(?:(script|style)>(?:(?!</).)*</\1|(/?[a-z][a-z0-9]*))>", re.DOTALL)
#: Rows of pages that leave a task together, from so many on.
MANY = 1000
#: The whole page as a node.
PAGE = "#page"


class _Tree(HTMLParser):
    """Elements in document order: [tag, parent, end, first text, text after the last, attributes]; and the page's visible texts.

    An end tag closes the nearest open element of its name, and what is open within; one that closes nothing is passed over.
    """

    def __init__(self, page: str):
        parts = _TAG.split(page)
        if _PLAIN_TAGS.issuperset(parts[2::3]) and "<" not in "".join(parts[::3]):
            self.nodes = _grown(tuple(parts[1::3]), tuple(parts[2::3]))
            self.texts = [unescape(x) for x in parts[::3]] if "&" in page else parts[::3]
            return
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = [[PAGE, -1, 0, 0, 0, {}]]
        self.texts: list[str] = []
        self.open_, self.data = [0], []
        self.feed(page)
        self.close()
        self._flush()
        while self.open_:
            self._close()

    def _flush(self) -> None:
        """Data in a row is one text."""
        text = "".join(self.data).strip()
        self.data = []
        if text and not any(self.nodes[k][0] in UNSEEN for k in self.open_):
            self.texts.append(text)

    def _close(self) -> None:
        node = self.nodes[self.open_.pop()]
        node[2], node[4] = len(self.nodes) - 1, len(self.texts)

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.nodes.append([tag, self.open_[-1], 0, len(self.texts), 0, dict(attrs)])
        self.open_.append(len(self.nodes) - 1)
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_endtag(self, tag):
        self._flush()
        if any(self.nodes[k][0] == tag for k in self.open_[1:]):
            while self.nodes[self.open_[-1]][0] != tag:
                self._close()
            self._close()

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        self.data.append(data)

    def text(self, at: int) -> str:
        return " ".join(" ".join(self.texts[self.nodes[at][3] : self.nodes[at][4]]).split())

    def around(self, at: int, tag: str) -> list[int]:
        """The elements of a tag that an element lies in, outermost first."""
        out, at = [], self.nodes[at][1]
        while at > 0:
            if self.nodes[at][0] == tag:
                out.append(at)
            at = self.nodes[at][1]
        return out[::-1]


@lru_cache(maxsize=256)
def _grown(raw: tuple[str | None, ...], tags: tuple[str | None, ...]) -> list[list]:
    """The nodes of a page of PLAIN elements, from its tags (/ before those that close) and the scripts and styles between; a text stands before and after each of them. Pages of one template share them."""
    nodes: list[list] = [[PAGE, -1, 0, 0, 0, {}]]
    open_, names = [0], [PAGE]
    for k, (whole, tag) in enumerate(zip(raw, tags, strict=True), 1):
        if whole or tag in VOID:
            nodes.append([whole or tag, open_[-1], len(nodes), k, k, {}])
        elif tag[0] != "/":
            nodes.append([tag, open_[-1], 0, k, 0, {}])
            open_.append(len(nodes) - 1)
            names.append(tag)
        elif tag[1:] in names:
            while True:
                nodes[open_[-1]][2], nodes[open_[-1]][4] = len(nodes) - 1, k
                open_.pop()
                if names.pop() == tag[1:]:
                    break
    for at in open_:
        nodes[at][2], nodes[at][4] = len(nodes) - 1, len(tags) + 1
    return nodes


NODE = "struct<at:int,end:int,tag:string,text:string,cells:array<string>,within:array<int>>"
_NODE = pa.struct([("at", pa.int32()), ("end", pa.int32()), ("tag", pa.string()), ("text", pa.string()), ("cells", pa.list_(pa.string())), ("within", pa.list_(pa.int32()))])


def _nodes(page: str) -> list[dict]:
    """The page, its headings, tables and rows; a row has the texts of all cells within it, and the tables that it lies in."""
    tree, out, rows = _Tree(page), [], {}
    for at, (tag, _, end, *_) in enumerate(tree.nodes):
        if tag in CELLS:
            for row in tree.around(at, "tr"):
                rows[row]["cells"].append(tree.text(at))
        elif tag == "tr":
            rows[at] = {"at": at, "end": end, "tag": tag, "text": None, "cells": [], "within": tree.around(at, "table")}
            out.append(rows[at])
        elif tag in HEADINGS or tag in ("table", PAGE):
            out.append({"at": at, "end": end, "tag": tag, "text": None if tag == "table" else tree.text(at), "cells": None, "within": None})
    return out


def _per_page(pages: DataFrame, html: str, more: Sequence[str], columns: Mapping[str, tuple[str, pa.DataType]], rows_of: Callable[..., list[tuple]]) -> DataFrame:
    """pages without html, and the rows (a tuple of the columns each) that rows_of(html, *more) gives for each page."""
    keep = [c for c in pages.columns if c not in (html, *columns)]
    schema = StructType([*pages.select(*[F.col(f"`{c}`") for c in keep]).schema.fields, *StructType.fromDDL(", ".join(f"{n} {kind}" for n, (kind, _) in columns.items())).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
            own = [batch.column(c).take(pa.array(at)) for c in keep]
            return pa.RecordBatch.from_arrays(own + [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), columns.values(), strict=True)], [*keep, *columns])

        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column("__html")):
                found = rows_of(text.as_py() or "", *[batch.column(f"__{c}")[k].as_py() for c in more])
                at += [k] * len(found)
                rows += found
                if len(rows) >= MANY:
                    yield made(batch, at, rows)
                    at, rows = [], []
            if rows:
                yield made(batch, at, rows)

    read = [F.col(f"`{html}`").alias("__html"), *[F.col(f"`{c}`").alias(f"__{c}") for c in more]]
    return pages.select(*[F.col(f"`{c}`") for c in keep], *read).mapInArrow(run, schema)


def with_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, and `nodes`: a page's numbered elements. A null page is an empty one."""
    return _per_page(pages, html, (), {"nodes": (f"array<{NODE}>", pa.list_(_NODE))}, lambda page: [(_nodes(page),)])


def tagged(nodes: Column, *tags: str) -> Column:
    return F.filter(nodes, lambda n: n["tag"].isin(*tags))


def table_after(nodes: Column, needles: Sequence[str]) -> Column:
    """The number of the first table after the first heading that says all needles, normalised, and has a table after it."""
    tables = F.transform(tagged(nodes, "table"), lambda n: n["at"])
    says = lambda h: once(norm(h["text"]), lambda t: F.forall(F.array(*[F.lit(plain(n)) for n in needles]), lambda n: F.contains(t, n)))
    heading = F.get(F.filter(tagged(nodes, *HEADINGS), lambda h: (h["at"] < F.array_max(tables)) & says(h)), F.lit(0))["at"]
    return F.array_min(F.filter(tables, lambda t: t > heading))


def rows_within(nodes: Column, table: Column) -> Column:
    """Cells of the rows of a table, those of tables in it too, without rows that have none."""
    rows = F.filter(tagged(nodes, "tr"), lambda n: F.array_contains(n["within"], table) & (F.size(n["cells"]) > 0))
    return F.transform(rows, lambda n: n["cells"])


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, and each row with cells of each table: table_at, row_at (their numbers in the page), cells."""
    rows = with_nodes(pages, html).withColumn("__row", F.explode(tagged(F.col("nodes"), "tr"))).where(F.size("__row.cells") > 0)
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "nodes", "table_at", "row_at", "cells")]
    return rows.select(*kept, F.explode("__row.within").alias("table_at"), F.col("__row.at").alias("row_at"), F.col("__row.cells").alias("cells"))


def rows_under(pages: DataFrame, needles: Sequence[str]) -> DataFrame:
    """pages with nodes -> without them, and row_at and cells of the table under the heading that says all needles."""
    found = pages.withColumn("__table", table_after(F.col("nodes"), needles)).where(F.col("__table").isNotNull())
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("nodes", "row_at", "cells")]
    return found.select(*kept, F.posexplode(rows_within(F.col("nodes"), F.col("__table"))).alias("row_at", "cells"))


#: Pages of one template have the same headings.
_said = lru_cache(maxsize=256)(plain)


def _rows_under(tree: _Tree, needles: Sequence[str]) -> list[list[str]]:
    """What table_after() and rows_within() find, in a page that is at hand; needles are normalised. What lies in an element are the numbers up to its end."""
    tables = [at for at, n in enumerate(tree.nodes) if n[0] == "table"]
    for at in range(tables[-1] if tables else 0):
        if tree.nodes[at][0] in HEADINGS:
            said = _said(tree.text(at))
            if all(x in said for x in needles):
                table = next(t for t in tables if t > at)
                break
    else:
        return []
    within = lambda k, *tags: [x for x in range(k + 1, tree.nodes[k][2] + 1) if tree.nodes[x][0] in tags]
    rows = ([tree.text(cell) for cell in within(row, *CELLS)] for row in within(table, "tr"))
    return [cells for cells in rows if cells]


def tables_under(pages: DataFrame, needles: Mapping[str, Sequence[str]], html: str = "html") -> DataFrame:
    """pages without html, and the rows under each name's heading (the first that says its needles and has a table after it): under, row_at, cells.

    What rows_under() finds, told where the page is read: only these rows leave the task, not all nodes of the page.
    """
    sought = {name: [plain(x) for x in own] for name, own in needles.items()}

    def found(page: str) -> list[tuple]:
        tree = _Tree(page)
        return [(name, k, cells) for name, own in sought.items() for k, cells in enumerate(_rows_under(tree, own))]

    return _per_page(pages, html, (), {"under": ("string", pa.string()), "row_at": ("int", pa.int32()), "cells": ("array<string>", pa.list_(pa.string()))}, found)


def links(pages: DataFrame, html: str = "html", base: str | None = None) -> DataFrame:
    """pages without html, and each link: link_at, href, title, the text of the element around it, and its address against the column `base` (null where there is none)."""

    def found(page: str, *bases: str | None) -> list[tuple]:
        tree = _Tree(page)
        own = [(at, n[5]["href"]) for at, n in enumerate(tree.nodes) if n[0] == "a" and "href" in n[5]]
        return [(k, href or "", tree.text(at), tree.text(tree.nodes[at][1]), _joined(bases[0], href) if bases else None) for k, (at, href) in enumerate(own)]

    text = ("string", pa.string())
    return _per_page(pages, html, () if base is None else (base,), {"link_at": ("int", pa.int32()), "href": text, "title": text, "around": text, "target": text}, found)


def _joined(base: str | None, href: str | None) -> str | None:
    try:
        return urljoin(base or "", href or "")
    except ValueError:
        return None


def annual_rates(pages: DataFrame, families: Mapping[str, str] = dims.ANNUAL_FAMILIES) -> DataFrame:
    """pages (district, region_code, region_name, html) -> a row for each commune and family with a rate; columns by position."""
    rows = tables_under(pages, {"annual": ("tasas anuales denuncias", "familia de delitos")})
    name = F.element_at("cells", 1)
    kept = rows.where((F.size("cells") >= 5) & is_commune(name)).select(*DISTRICT, name.alias("commune_name"), F.posexplode(F.slice("cells", 2, 4)).alias("at", "cell"))
    key, label = (F.array(*[F.lit(f) for f in x])[F.col("at")] for x in (list(families), list(families.values())))
    long = kept.select("*", key.alias("cead_family_key"), label.alias("crime_category"), parse_number(F.col("cell")).alias("rate_100k")).where(F.col("rate_100k").isNotNull()).drop("at", "cell")
    return _communal(long, 2024, "2024", "annual").withColumns({
        "metric": F.lit("tasa_denuncias_100k"), "value": F.lit(None).cast("long"), "data_status": F.lit("observed_rate"), "quality_status": F.lit("usable"), "population": F.lit(None).cast("long"),
    })


def _communal(rows: DataFrame, year: int, period: str, period_type: str) -> DataFrame:
    """What annual and latest rows share: the family's weight, the commune's key and where they come from."""
    return family_mapped(rows).withColumns({
        "year": F.lit(year), "period": F.lit(period), "period_type": F.lit(period_type), "territory_level": F.lit("commune"), "commune_code": F.lit(None).cast("string"),
        "commune_name_norm": norm_or_none(F.col("commune_name")), "territory_id": legacy_commune_id(F.lit(None), F.col("region_code"), F.col("commune_name")), "estimated_frequency": F.lit(None).cast("long"),
        "source_id": F.lit("bcn_siit_cead_communal"), "ultimate_source_id": F.lit("cead_estadisticas_delictuales"), "observation_unit": F.lit("denuncia_formal"),
    })


#: The columns of a district's page.
DISTRICT = ("district", "region_code", "region_name")
SECTIONS = {"drugs": "delitos asociados a drogas", "life": "delitos contra la vida", "family": "violencia intrafamiliar"}
FIGURES = ("freq_2024", "freq_2025", "pop_2024", "pop_2025", "rate_2024", "rate_2025")


def latest_sections(pages: DataFrame) -> DataFrame:
    """Rows of the three sections with all six figures, from one reading of the pages."""
    found = tables_under(pages, {section: (heading, "frecuencia", "tasa") for section, heading in SECTIONS.items()}).select(*DISTRICT, F.col("under").alias("section"), "cells")
    kept = found.where((F.size("cells") >= 7) & is_commune(F.element_at("cells", 1)))
    figures = [parse_number(F.element_at("cells", k)).alias(f) for k, f in enumerate(FIGURES, 2)]
    return kept.select(*DISTRICT, "section", F.element_at("cells", 1).alias("commune_name"), *figures).dropna(subset=list(FIGURES))


def latest_rates(pages: DataFrame) -> DataFrame:
    """The drug section's rows; where it repeats another section row for row it is quarantined, ineligible and weighs nothing."""
    rows = latest_sections(pages)
    figures = [F.col("commune_name"), *[F.col(f) for f in FIGURES]]
    doubtful = quarantined_duplicates(rows, "district", "section", "drugs", ("life", "family"), figures)
    key = "delitos_asociados_drogas"
    drugs = rows.where(F.col("section") == "drugs").drop("section").join(doubtful, "district").withColumns({"cead_family_key": F.lit(key), "crime_category": F.lit(dims.ANNUAL_FAMILIES[key])})
    return _communal(drugs, 2025, "2025-Q3", "q3_ytd").withColumns({
        "metric": F.lit("denuncias"), "value": F.col("freq_2025").cast("long"), "rate_100k": F.col("rate_2025"), "population": F.col("pop_2025").cast("long"), "data_status": F.lit("observed_secondary_official"),
        "quality_status": F.when(F.col("duplicated"), "quarantined_duplicate_section").otherwise("usable"),
        "score_eligible": F.col("score_eligible") & ~F.col("duplicated"), "aml_weight": F.when(F.col("duplicated"), 0.0).otherwise(F.col("aml_weight")),
    })


def monthly_cases(pages: DataFrame) -> DataFrame:
    """pages (year, commune_code, html) -> a row for each offense and month; the header is the first row with three month names."""
    rows = table_rows(pages)
    months = F.array(*[F.lit(m) for m in dims.MONTHS])
    named = rows.withColumn("low", F.transform("cells", F.lower)).withColumn("hits", F.size(F.array_intersect("low", months)))
    head = named.where(F.col("hits") >= 3).groupBy("year", "commune_code", "table_at").agg(F.min_by(F.struct("row_at", "low"), "row_at").alias("head"))
    body = rows.join(head, ["year", "commune_code", "table_at"]).where(F.col("row_at") > F.col("head.row_at"))
    cells = body.select("year", "commune_code", F.trim(F.element_at("cells", 1)).alias("offense"), "head", F.posexplode("cells").alias("at", "cell"))
    month = F.array_position(months, F.get(F.col("head.low"), F.col("at"))).cast("int")
    digits = F.regexp_replace("cell", "[^0-9-]", "")
    found = cells.select("*", month.alias("month"), digits.alias("digits")).where((F.col("month") > 0) & F.col("digits").rlike(r"^-?\d+$"))
    code = commune_code(F.col("commune_code"))
    return found.select("year", "month", F.format_string("%04d-%02d", "year", "month").alias("period"), code.alias("commune_code"), "offense", F.col("digits").cast("long").alias("cases_policiales"))


def with_population(annual: DataFrame, populations: DataFrame) -> DataFrame:
    """annual rates with the population of (region_code, commune_name_norm) and the frequency it implies; none where it is 0 or unknown."""
    known = populations.select("region_code", "commune_name_norm", F.nullif(F.col("population"), F.lit(0)).alias("__population"))
    joined = annual.join(known, ["region_code", "commune_name_norm"], "left")
    return joined.withColumns({
        "population": F.coalesce("__population", "population"), "estimated_frequency": F.when(F.col("__population").isNotNull(), F.bround(F.col("rate_100k") * F.col("__population") / 100000.0, 0).cast("long")),
        "frequency_status": F.when(F.col("__population").isNotNull(), "derived_from_published_rate_and_2024_population").otherwise("unavailable"),
    }).drop("__population")


def page_years(pages: DataFrame, first: int = 2018, last: int = 2026, html: str = "html") -> DataFrame:
    """pages without html, and the distinct years that a page's visible text names: not its tags, scripts or styles."""
    text = F.get(tagged(F.col("nodes"), PAGE), F.lit(0))["text"]
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b(20(?:1[8-9]|2[0-9]))\b"), F.lit(1)), lambda y: y.cast("int"))
    found = F.array_sort(F.array_distinct(F.filter(years, lambda y: y.between(first, last))))
    return with_nodes(pages, html).withColumn("years", found).drop("nodes")


def topic_rows(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages (source_id, cead_family_key, url, html, sha256, retrieved_at, ok, error) of topics -> what each covers, and a status row for each."""
    told = page_years(pages.withColumn("__ok", F.coalesce("ok", F.lit(False))))
    rows = told.where("__ok").select("source_id", "cead_family_key", "url", F.col("years").alias("available_years"), F.array(*map(F.lit, ("country", "region", "commune"))).alias("territorial_levels"), "retrieved_at", "sha256")
    status = told.select("source_id", F.col("__ok").alias("ok"), F.when(F.col("__ok"), F.col("years")).alias("available_years"), F.when(~F.col("__ok"), F.coalesce("error", F.lit("not fetched"))).alias("error"))
    return rows, status
