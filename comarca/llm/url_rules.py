"""URL filtering by pattern rules, in DataFrame expressions only.

Every pattern rule names the literal tokens that a url must hold for its regular expression to match. A token that the
expression bounds on both sides is written plainly; of one that is open to the left (`*free`) or to the right (`php*`) a url
holds a token that ends or begins with it. A rule is indexed under the rarest of them, by the frequencies given (or by how
many rules share the token). A url's tokens (runs of letters and digits of the lower-cased url), and their ends and
beginnings of the lengths that open tokens have, look up candidate rules in the index, and only those run their expression.
The index is a constant of the plan: buckets by CRC-32 of the token, so that a look-up reads a few entries however many
rules there are, and no url is shuffled or joined. A candidate reaches its expression, a constant of its own, through a
tree of comparisons of its number. How rare a token is can be counted in the urls themselves (`frequencies`).

Site rules (host and path prefix, allow or block) come before the patterns; the longest that fits wins. They are found in an
index of the same form, by the host and what is left of it after each dot.

Cases: a null url, or one without ://, has an empty host and path and is allowed unless a rule says otherwise (none
does: every rule names a token or a host). Rows never meet, so repeated rows and ties change nothing; an empty table
stays empty. The new columns replace columns of the same names. Very long urls are read whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PatternRule:
    """pattern: a regular expression that both Java and RE2 read, run on the lower-cased url; tokens: literals which it implies, with * on the side that it leaves open."""

    name: str
    pattern: str
    tokens: tuple[str, ...]


@dataclass(frozen=True)
class SiteRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


SITE_RULES = (
    SiteRule("com", "/", "allow"),
    SiteRule("example.com", "/en/", "block"),
    SiteRule("www.example.com", "/en/", "allow"),
    SiteRule("net", "/es/", "block"),
    SiteRule("net", "/fr/", "block"),
)

PATTERN_RULES = (
    PatternRule("spam_farm", r"(^|[/.])spam-farm\.", ("spam", "farm")),
    PatternRule("cheap_pills", r"(^|[/.])cheap-pills\.", ("cheap", "pills")),
    PatternRule("casino", r"(^|[/.-])casino([/.-]|$)", ("casino",)),
    PatternRule("free_money", r"free-(money|cash)", ("*free",)),
    PatternRule("adult", r"(^|[/.-])(porn|xxx)([/.-]|$)", ()),
    PatternRule("login_page", r"/wp-login\.php", ("wp", "login", "php*")),
    PatternRule("tracker", r"[?&]utm_source=(ads|spam)(&|#|$)", ("utm", "source")),
    PatternRule("binary_file", r"\.(exe|apk|msi)([?#]|$)", ()),
)
#: Alternatives of a rule without one implied token: it is indexed under each of them.
EITHER = {"adult": ("porn", "xxx"), "binary_file": ("exe", "apk", "msi")}


def rarest(rules: Sequence[PatternRule], frequency: Mapping[str, int] | None = None, either: Mapping[str, Sequence[str]] = EITHER) -> dict[str, list[int]]:
    """Token -> numbers of the rules indexed under it."""
    shared = Counter(t for r in rules for t in {*r.tokens, *either.get(r.name, ())})
    common = lambda t: (frequency or {}).get(t, 0)
    cost = lambda t: (common(t), shared[t], -len(t), t)
    index: dict[str, list[int]] = {}
    for k, r in enumerate(rules):
        if not (r.tokens or either.get(r.name)):
            raise ValueError(f"rule {r.name} names no token")
        if odd := [t for t in (*r.tokens, *either.get(r.name, ())) if "*" in t[1:-1] or t[:1] == t[-1:] == "*" or not t]:
            raise ValueError(f"rule {r.name}: a token is open on one side at most: {odd}")
        for t in [min(r.tokens, key=cost)] if r.tokens else either[r.name]:
            index.setdefault(t, []).append(k)
    return index


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _looked_up(index: Mapping[str, Sequence[Column]], kind: str):
    """Column function: the entries of a key in a constant index, none for other keys. kind: an entry's type."""
    n = 1 << max(2, len(index)).bit_length()
    buckets: list[list[tuple[str, Sequence[Column]]]] = [[] for _ in range(n)]
    for key, entries in index.items():
        buckets[zlib.crc32(key.encode()) % n].append((key, entries))
    none = F.array().cast(f"array<struct<key:string,entries:array<{kind}>>>")
    bucket = lambda b: F.array(*[F.struct(F.lit(key).alias("key"), F.array(*entries).alias("entries")) for key, entries in b]) if b else none
    constant = F.array(*map(bucket, buckets))
    at = lambda key: F.element_at(constant, (F.crc32(key.cast("binary")) % n + 1).cast("int"))
    return lambda key: F.flatten(F.transform(F.filter(at(key), lambda e: e["key"] == key), lambda e: e["entries"]))


def site_rule(host: Column, path: Column, rules: Sequence[SiteRule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest site rule that fits, null without one; of two as long the one of the longer host."""
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    index: dict[str, list[Column]] = {}
    for r in rules:
        index.setdefault(r.host, []).append(F.struct(F.lit(len(r.name)).alias("size"), F.lit(len(r.host)).alias("host"), F.lit(r.path).alias("path"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")))
    own = _looked_up(index, "struct<size:int,host:int,path:string,name:string,verdict:string>")
    # The longest rule's host bounds how many labels from the right can matter.
    labels, most = F.split(host, r"\."), max(r.host.count(".") for r in rules) + 1
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    best = F.array_max(F.filter(F.flatten(F.transform(ends, own)), lambda r: F.startswith(path, r["path"])))
    return best["name"], best["verdict"]


def url_tokens(url: Column) -> Column:
    """Runs of letters and digits of a lower-cased url."""
    return F.regexp_extract_all(url, F.lit("([a-z0-9]+)"), F.lit(1))


def lowered(url: Column) -> Column:
    return F.coalesce(F.translate(url, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def token_keys(url: Column, tokens: Iterable[str]) -> Column:
    """A url's tokens, and their ends and beginnings of the lengths that the open ones of tokens have, behind and before a mark."""
    whole = url_tokens(url)
    # Shorter tokens than an open one come back whole, behind its mark: they are other keys, or none.
    end = lambda n: F.transform(whole, lambda t: F.concat(F.lit("*"), F.right(t, F.lit(n))))
    begin = lambda n: F.transform(whole, lambda t: F.concat(F.left(t, F.lit(n)), F.lit("*")))
    tokens = set(tokens)
    ends = [end(n) for n in sorted({len(t) - 1 for t in tokens if t[0] == "*"})]
    begins = [begin(n) for n in sorted({len(t) - 1 for t in tokens if t[-1] == "*"})]
    return F.array_distinct(F.concat(whole, *ends, *begins))


def frequencies(pages: DataFrame, url: str = "url", rules: Sequence[PatternRule] = PATTERN_RULES) -> dict[str, int]:
    """How many urls hold each of the rules' literal tokens: one number for each token of the rules reaches the driver."""
    named = sorted({t for r in rules for t in r.tokens})
    keys = pages.select(F.explode(token_keys(lowered(F.col(url)), named)).alias("key")).where(F.col("key").isin(*named))
    counts = {r["key"]: r["count"] for r in keys.groupBy("key").count().collect()} if named else {}
    return {t: counts.get(t, 0) for t in named}


def candidates(url: Column, rules: Sequence[PatternRule], frequency: Mapping[str, int] | None = None) -> Column:
    """Numbers of the pattern rules that a url's tokens fetch from the index."""
    index = rarest(rules, frequency)
    fetched = _looked_up({t: [F.lit(k) for k in ks] for t, ks in index.items()}, "int")
    return F.array_distinct(F.flatten(F.transform(token_keys(url, index), fetched)))


def matching(url: Column, rules: Sequence[PatternRule], frequency: Mapping[str, int] | None = None) -> Column:
    """Names of the pattern rules that match a lower-cased url; the expressions run on candidates only."""

    def runs(k: Column, low: int, high: int) -> Column:
        """Whether rule k of low..high-1 matches. The expression is a literal, compiled once."""
        if high - low == 1:
            return F.regexp(url, F.lit(rules[low].pattern))
        middle = (low + high) // 2
        return F.when(k < middle, runs(k, low, middle)).otherwise(runs(k, middle, high))

    if not rules:
        return F.array().cast("array<string>")
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.transform(F.filter(candidates(url, rules, frequency), lambda k: runs(k, 0, len(rules))), lambda k: F.element_at(names, k + 1))


def judged(pages: DataFrame, url: str = "url", sites: Sequence[SiteRule] = SITE_RULES, patterns: Sequence[PatternRule] = PATTERN_RULES, frequency: Mapping[str, int] | None = None) -> DataFrame:
    """Columns of pages with host, path, rule, matched (pattern rules) and verdict."""
    name, said = site_rule(F.col("host"), F.col("path"), sites)
    found = matching(lowered(F.col(url)), patterns, frequency)
    out = pages.withColumns({"matched": found, "host": host_of(F.col(url)), "path": path_of(F.col(url))}).withColumn("rule", name)
    return out.withColumn("verdict", F.coalesce(said, F.when(F.size("matched") > 0, "block").otherwise("allow")))
