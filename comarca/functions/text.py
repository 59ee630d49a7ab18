"""Text normalisation, keys and number parsing as column expressions."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decomposed() -> tuple[dict[str, str], dict[str, str]]:
    """Characters beyond ASCII whose compatibility form holds one ASCII character, and those whose form holds several. None lie beyond the first two planes."""
    one, more = {}, {}
    for c in (chr(p) for p in range(0x80, 0x20000) if not 0xD800 <= p < 0xE000):
        if unicodedata.decomposition(c):
            plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
            if plain:
                (one if len(plain) == 1 else more)[c] = plain
    return one, more


ONE, MORE = _decomposed()


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c computed once, however often f names it: what is said several times would be planned and compiled as often."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _ascii(c: Column) -> Column:
    """The compatibility decomposition's ASCII characters; all others are dropped.

    Every character decomposes for itself, so a map of characters is exact. Only texts that hold a character which becomes several
    are taken apart.
    """
    several = F.from_json(F.lit(json.dumps(MORE)), "map<string,string>")  # a constant, folded once
    apart = lambda x: F.array_join(F.transform(F.split(x, ""), lambda y: F.when(F.octet_length(y) == 1, y).otherwise(F.coalesce(several[y], y))), "")
    whole = lambda x: F.when(F.length(F.translate(x, "".join(MORE), "")) == F.length(x), x).otherwise(apart(x))
    rest = lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(F.regexp_replace(whole(x), r"[^\x00-\x7F]", ""))
    return once(F.translate(c, "".join(ONE), "".join(ONE.values())), rest)


def plain(value: str, keep: str = "") -> str:
    """norm() of a constant."""
    ascii_ = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode().lower()
    return re.sub(f"[^a-z0-9{keep}]+", " ", ascii_).strip()


def norm(c: Column, keep: str = "") -> Column:
    """Accents off, other non-ASCII dropped, lower case, runs of other characters one space; null gives the empty text.

    `keep` names further characters to keep.
    """
    return F.trim(F.regexp_replace(F.lower(_ascii(F.coalesce(c, F.lit("")))), f"[^a-z0-9{keep}]+", " "))


def norm_or_none(c: Column) -> Column:
    """norm() of a variant that reads a missing label as the word none."""
    return norm(F.coalesce(c, F.lit("None")))


def norm_name(c: Column) -> Column:
    """norm() of place names: apostrophes stay, a backtick is one."""
    return norm(F.replace(F.coalesce(c, F.lit("")), F.lit("`"), F.lit("'")), keep="'")


def slug(c: Column) -> Column:
    return F.regexp_replace(norm(c), "[^a-z0-9]+", "-")


def collapsed(c: Column) -> Column:
    """White space to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def parse_number(c: Column) -> Column:
    """A number written with . for thousands and , for decimals, with or without no-break spaces; null for dashes, blanks and what is no number."""
    bare = F.regexp_replace(c.cast("string"), r"^[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+$|\x{00A0}", "")
    plain = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~F.lower(plain).isin("", "-", "--", "nan") & plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), plain.try_cast("double"))


def padded_code(c: Column, width: int) -> Column:
    """A numeric code as digits with leading zeros; null where it is no number."""
    number = F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))
    digits = number.cast("long").cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def commune_code(c: Column) -> Column:
    """Five digits: non-digits dropped, zeros in front; null if nothing or more than five digits are left, or the value is 0."""
    digits = F.regexp_replace(c.cast("string"), r"\D", "")
    falsy = c.cast("string").isin("", "0")
    return F.when(~falsy & (F.length(digits) > 0) & (F.length(digits) <= 5), F.lpad(digits, 5, "0"))


def commune_id(code: Column) -> Column:
    return F.concat(F.lit("CL-COM-"), code)


def legacy_commune_id(code: Column, region: Column, name: Column) -> Column:
    """CL-<code>, else CL-<region>-<slug of the name>."""
    return F.coalesce(F.concat(F.lit("CL-"), code), F.concat(F.lit("CL-"), region, F.lit("-"), slug(name)))


def is_commune(name: Column) -> Column:
    return once(norm_or_none(name), lambda n: ~(n.startswith("distrito") | n.startswith("region") | n.isin("pais", "nivel territorial", "")))


def keyword_hits(title: Column, keywords: Iterable[str]) -> Column:
    """Sorted distinct keywords that the lower-cased title contains."""
    own = F.array(*[F.lit(k) for k in sorted({k.lower() for k in keywords})])
    return F.filter(own, lambda k: F.contains(F.lower(title), k))


def nearby_date(text: Column) -> Column:
    """The first day/month/year in a text as year-month-day, not checked against the calendar."""
    pattern = r"\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b"
    part = lambda k: F.regexp_extract(text, pattern, k)
    return F.when(part(0) != "", F.concat_ws("-", part(3), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")))


def thousands(c: Column) -> Column:
    """A whole number with . between thousands."""
    return F.translate(F.format_number(c, 0), ",", ".")


def signed_percent(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("s/d")).otherwise(F.format_string("%+.1f%%", c))


def html_escaped(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out
