"""Unions with precedence. What the order of rows decides is decided by explicit columns, so plans may reorder freely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca import dims
from comarca.functions.text import norm


def one_per(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The first (or last) row of each key, by min_by / max_by: rows are sorted by key within a task, cut to one for each key before the shuffle, and again after it."""
    pick = F.max_by if last else F.min_by
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*keys).agg(pick(whole, F.struct(*order)).alias("__row")).select("__row.*")


def tier_rank(tier: Column, missing: int) -> Column:
    out = F.lit(dims.UNKNOWN_TIER)
    for name, rank in dims.SOURCE_TIERS.items():
        out = F.when(tier == name, rank).otherwise(out)
    return F.when(tier.isNull(), missing).otherwise(out)


def keyed_code(code: Column) -> Column:
    """The code as text with zeros in front, five digits at least; a missing one is all zeros."""
    raw = F.coalesce(code.cast("string"), F.lit(""))
    return F.when(F.length(raw) < 5, F.lpad(raw, 5, "0")).otherwise(raw)


def precedence_picked(rows: DataFrame, side: Column, ordinal: str = "ordinal", metric: str = "casos_policiales") -> DataFrame:
    """One row for each (year, code, normalised label): the lowest tier, then the lowest side, then the first by `ordinal`.

    Rows without a code or of another metric go. A missing tier contends at 90, and is written as rank 99.
    """
    kept = rows.withColumn("__side", side).where(F.col("commune_code").isNotNull() & (F.col("metric") == metric))
    keyed = kept.withColumns({"__code": keyed_code(F.col("commune_code")), "crime_category_norm": norm(F.col("crime_category"))})
    best = one_per(keyed, ["year", "__code", "crime_category_norm"], [tier_rank(F.col("source_tier"), dims.MISSING_TIER), F.col("__side"), F.col(ordinal)])
    return best.withColumn("source_rank", tier_rank(F.col("source_tier"), dims.UNKNOWN_TIER)).drop("__side", "__code")


def precedence_merged(bridge: DataFrame, direct: DataFrame, ordinal: str = "ordinal", metric: str = "casos_policiales") -> DataFrame:
    """precedence_picked() of two sources, bridge before direct."""
    both = bridge.withColumn("__from", F.lit(0)).unionByName(direct.withColumn("__from", F.lit(1)), allowMissingColumns=True)
    return precedence_picked(both, F.col("__from"), ordinal, metric).drop("__from")


def cache_keys() -> list[Column]:
    """Year, padded code and normalised label, however rows write them."""
    return [F.col("year").cast("int"), keyed_code(F.col("commune_code")), norm(F.col("crime_category"))]


def latest_picked(rows: DataFrame, side: Column, keys: Sequence[str | Column] | None = None, ordinal: str = "ordinal") -> DataFrame:
    """One row for each key: of the highest side the last by `ordinal`. Keys are the annual cache's unless given."""
    own = [F.col(k) if isinstance(k, str) else k for k in keys] if keys is not None else cache_keys()
    named = {f"__key{k}": c for k, c in enumerate(own)}
    keyed = rows.withColumns({**named, "__side": side})
    return one_per(keyed, list(named), [F.col("__side"), F.col(ordinal)], last=True).drop(*named, "__side")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str | Column] | None = None, ordinal: str = "ordinal") -> DataFrame:
    """old with the rows of new over those of the same keys; within either, the last by `ordinal`."""
    both = old.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)), allowMissingColumns=True)
    return latest_picked(both, F.col("__batch"), keys, ordinal).drop("__batch")


def gated(lot: DataFrame, least: int = dims.LEAST_COMMUNES, code: str = "commune_code") -> DataFrame:
    """The lot's rows if it covers enough communes, else none: an incomplete lot never replaces what is there."""
    enough = lot.agg((F.countDistinct(F.nullif(F.col(code), F.lit(""))) >= least).alias("__enough")).where("__enough")  # one row or none
    return lot.join(F.broadcast(enough), F.lit(True)).drop("__enough")


def family_replaced(contract: DataFrame, new: DataFrame, family: str) -> DataFrame:
    """The contract with one signal family's rows replaced; doing it again changes nothing."""
    return contract.where(~F.col("signal_family").eqNullSafe(family)).unionByName(new, allowMissingColumns=True)


def distinct_sources(columns: Sequence[Column], fallback: str) -> Column:
    """Distinct non-empty sources in order of the columns, else the fallback."""
    given = F.array_distinct(F.filter(F.array(*columns), lambda s: s.isNotNull() & (s != "")))
    return F.when(F.size(given) > 0, given).otherwise(F.array(F.lit(fallback)))


def anti_united(base: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """base and those rows of more whose keys base lacks."""
    return base.unionByName(more.join(base.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)
