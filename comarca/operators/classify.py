"""Rows annotated from the fixed dimensions. Every dimension is a few rows of constants, so each join is a broadcast."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.functions.text import norm, once


def taxonomy_annotated(rows: DataFrame, version: str = dims.TAXONOMY_VERSION) -> DataFrame:
    """aml_class, weight, confidence, rationale by exact label, else the default."""
    known = F.broadcast(dims.taxonomy(rows.sparkSession).select(F.col("label").alias("__label"), F.col("class").alias("__class"), F.col("weight").alias("__weight"), F.col("confidence").alias("__confidence"), F.col("rationale").alias("__rationale")))
    kind, weight, confidence, rationale = dims.TAXONOMY_DEFAULT
    joined = rows.join(known, F.col("crime_category") == F.col("__label"), "left")
    return joined.withColumns({
        "aml_class": F.coalesce("__class", F.lit(kind)), "weight": F.coalesce("__weight", F.lit(weight)),
        "confidence": F.coalesce("__confidence", F.lit(confidence)), "rationale": F.coalesce("__rationale", F.lit(rationale)), "legal_mapping_version": F.lit(version),
    }).drop("__label", "__class", "__weight", "__confidence", "__rationale")


def catalog_mapped(rows: DataFrame) -> DataFrame:
    """mapping key, aml_class, score_eligible, aml_weight, mapping_confidence, legal_basis by normalised label; homicide labels are context only."""
    spark = rows.sparkSession
    keys = F.broadcast(dims.label_keys(spark).select(F.col("label").alias("__norm_label"), F.col("mapping_key").alias("__key")))
    known = F.broadcast(dims.catalog(spark).select(F.col("mapping_key").alias("__mapping"), F.col("class").alias("__class"), F.col("eligible").alias("__eligible"), F.col("weight").alias("__weight"), F.col("confidence").alias("__confidence"), F.col("basis").alias("__basis")))
    kind, eligible, weight, confidence, basis = dims.CATALOG_DEFAULT
    joined = rows.withColumn("crime_category_norm", norm(F.col("crime_category"))).join(keys, F.col("crime_category_norm") == F.col("__norm_label"), "left").join(known, F.col("__key") == F.col("__mapping"), "left")
    homicide = F.col("crime_category_norm").isin(*dims.HOMICIDE_LABELS)
    return joined.withColumns({
        "article27_mapping_key": F.coalesce("__key", F.lit("default")),
        "aml_class": F.when(homicide, "context_only").otherwise(F.coalesce("__class", F.lit(kind))),
        "score_eligible": F.when(homicide, False).otherwise(F.coalesce("__eligible", F.lit(eligible))),
        "aml_weight": F.when(homicide, 0.0).otherwise(F.coalesce("__weight", F.lit(weight))),
        "mapping_confidence": F.coalesce("__confidence", F.lit(confidence)), "legal_basis": F.coalesce("__basis", F.lit(basis)),
    }).drop("__norm_label", "__key", "__mapping", "__class", "__eligible", "__weight", "__confidence", "__basis")


def family_mapped(rows: DataFrame) -> DataFrame:
    """article27_relation, score_eligible, aml_weight, mapping_confidence of the communal family."""
    known = F.broadcast(dims.families(rows.sparkSession).select(F.col("family_key").alias("cead_family_key"), F.col("relation").alias("article27_relation"), F.col("eligible").alias("score_eligible"), F.col("weight").alias("aml_weight"), F.col("confidence").alias("mapping_confidence")))
    return rows.drop("article27_relation", "score_eligible", "aml_weight", "mapping_confidence").join(known, "cead_family_key", "left")


def segments(rules: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(low, high, ordinal) of overlapping ranges (ordinal, low, high) cut into disjoint ones: the smallest ordinal holds what several cover.

    Rules are a table that people write, thousands at most; their ends are swept once on the driver.
    """
    rules = sorted(r for r in rules if r[1] <= r[2])
    opens: dict[int, list[int]] = {}
    closes: dict[int, list[int]] = {}
    for ordinal, low, high in rules:
        opens.setdefault(low, []).append(ordinal)
        closes.setdefault(high + 1, []).append(ordinal)
    out: list[tuple[int, int, int]] = []
    active: list[int] = []
    gone: set[int] = set()
    start = None
    for at in sorted({*opens, *closes}):
        while active and active[0] in gone:
            heapq.heappop(active)
        if active and start is not None:
            if out and out[-1][2] == active[0] and out[-1][1] == start - 1:
                out[-1] = (out[-1][0], at - 1, active[0])
            else:
                out.append((start, at - 1, active[0]))
        for ordinal in opens.get(at, ()):
            heapq.heappush(active, ordinal)
        gone.update(closes.get(at, ()))
        start = at
    return out


def ranged(rows: DataFrame, ranges: DataFrame, number: str, into: str = "range") -> DataFrame:
    """rows with the first of the ranges (ordinal, low, high, ...) that holds a number, as a struct of the range's columns; null where none does.

    The ranges become disjoint segments in a sorted array, where each number finds its segment by halving, as an expression of
    the row itself: no row meets a range that it does not lie in, however many ranges there are.
    """
    found = segments(tuple(r) for r in ranges.select("ordinal", "low", "high").collect())
    if not found:
        return rows.withColumn(into, F.lit(None).cast(ranges.schema.simpleString()))
    placed = rows.withColumn("__at", _rule_at(found, F.col(number)))
    rules = F.broadcast(ranges.select(F.col("ordinal").cast("long").alias("__rule"), F.struct(*ranges.columns).alias(into)))  # the rules themselves, a row each
    return placed.drop(into).join(rules, F.col("__at") == F.col("__rule"), "left").drop("__rule", "__at")


def _rule_at(found: list[tuple[int, int, int]], number: Column) -> Column:
    """The ordinal of the segment that holds a number; null if none does."""
    low, high, ordinals = (F.from_json(F.lit(json.dumps(x)), "array<long>") for x in zip(*found, strict=True))  # constants, folded once
    last = F.lit(len(found) - 1)
    # Halving: after all steps the last segment that starts at or below the number is left.
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(len(found).bit_length()))])
    step = lambda place, n: F.when((place + n <= last) & (F.get(low, F.least(place + n, last)) <= number), place + n).otherwise(place)
    inside = lambda at: F.when((at >= 0) & (F.get(high, F.greatest(at, F.lit(0))) >= number), F.get(ordinals, F.greatest(at, F.lit(0))))
    return once(F.aggregate(halves, F.lit(-1), step), inside)


def legal_classified(rows: DataFrame, code: str = "code", ranges: DataFrame | None = None) -> DataFrame:
    """legal_code, legal_class, legal_confidence, legal_basis, rule_type, rules_version: an exact code before one out of force, before the first range that holds it, before the default.

    Codes that are numbers match however they are written (zeros in front, text or number), and legal_code is the number; others
    have the default and stay as they are, without the white space around them. ranges are the fixed ones unless given.
    """
    spark = rows.sparkSession
    bare = F.trim(F.col(code).cast("string"))
    number = F.when(bare.rlike(r"^\d+$"), bare.try_cast("long"))
    exact = F.broadcast(dims.legal_codes(spark).select(F.col("code").alias("__code"), F.struct("class", "confidence", "basis", "rule_type").alias("__exact")))
    default = F.struct(*[F.lit(x).alias(n) for n, x in zip(("class", "confidence", "basis"), dims.LEGAL_DEFAULT, strict=True)], F.lit("default").alias("rule_type"))
    joined = rows.withColumn("__number", number).join(exact, F.col("__number") == F.col("__code"), "left")
    if ranges is None:  # the fixed ones are a few constants
        fixed = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("class", "confidence", "basis"), r[2:], strict=True)]) for r in dims.LEGAL_RANGES])
        at = _rule_at(segments((k, *r[:2]) for k, r in enumerate(dims.LEGAL_RANGES)), F.col("__number"))
        within = joined.withColumn("__range", F.get(fixed, at.cast("int")))
    else:
        within = ranged(joined, ranges, "__number", "__range")
    held = F.when(F.col("__range").isNotNull(), F.struct("__range.class", "__range.confidence", "__range.basis", F.lit("range").alias("rule_type")))
    rule = F.coalesce("__exact", held, default)
    return within.withColumn("__rule", rule).withColumns({
        "legal_code": F.coalesce(F.col("__number").cast("string"), bare), "legal_class": F.col("__rule.class"), "legal_confidence": F.col("__rule.confidence"), "legal_basis": F.col("__rule.basis"),
        "rule_type": F.col("__rule.rule_type"), "rules_version": F.lit(dims.LEGAL_VERSION),
    }).drop("__number", "__code", "__exact", "__range", "__rule")


def legal_summary(spark) -> DataFrame:
    """One row: the rules' version, the law and catalogue they rest on, how many there are, and the exact ones by class."""
    exact = dims.legal_codes(spark).where(F.col("rule_type") == "exact").groupBy("class").agg(F.count("*").alias("rules"))
    told = lambda of: F.struct(*[F.lit(v).alias(k) for k, v in of.items()])
    classes = F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "rules"))))
    return exact.agg(
        F.lit(dims.LEGAL_VERSION).alias("version"), told(dims.LEGAL_BASIS).alias("legal_basis"), told(dims.LEGAL_CATALOG).alias("catalog"), F.sum("rules").alias("exact_rules"), F.lit(len(dims.LEGAL_RANGES)).alias("range_rules"), classes.alias("classes"),
    )


def legal_use(classified: DataFrame) -> DataFrame:
    """Of legal_classified() rows: rows and distinct codes by class, basis and rule type."""
    return classified.groupBy("legal_class", "legal_confidence", "legal_basis", "rule_type").agg(F.count("*").alias("rows"), F.countDistinct("legal_code").alias("codes"))


def usable(status: Column) -> Column:
    """Whether a row of this quality status may be scored; a missing status may."""
    return status.isNull() | status.isin(*dims.USABLE_STATUSES)


def quality_normalised(rows: DataFrame) -> DataFrame:
    """usable_* read as usable, in any case."""
    q = F.col("quality_status")
    return rows.withColumn("quality_status", F.when(F.lower(q).startswith("usable_"), "usable").otherwise(q))


def drug_family(rows: DataFrame) -> DataFrame:
    return rows.where(norm(F.col("crime_category")).isin(dims.DRUG_FAMILY_LABEL, dims.DRUG_GROUP_LABEL))
