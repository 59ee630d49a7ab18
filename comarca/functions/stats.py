"""Ranks, quantiles and robust scores as window expressions. Each is exact, and none gives a value where there is no observation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.files import held


def half_even(c: Column, digits: int) -> Column:
    """Half to even. Nine digits count: sums come in any order, and a tie must not depend on it."""
    return F.bround(F.round(c, 9), digits)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def tie_rank_percentile(value: Column, key: Column, by: Sequence[Column | str] = ()) -> Column:
    """100 * place / (n - 1), places 0.. by value, ties by key; 50 if alone."""
    w = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(w)
    return F.when(n == 1, F.lit(50.0)).otherwise(100.0 * (F.row_number().over(w.orderBy(value, key)) - 1) / (n - 1))


def with_percentiles(rows: DataFrame, of: Mapping[str, str], key: str) -> DataFrame:
    """rows (one for each key) with columns name: 100 * place / (n - 1), places 0.. by the column of[name], ties by key; 50 if alone.

    The same as tie_rank_percentile over all rows, for any number of them and for all figures at once: (figure, value, key) rows
    are dealt out in ranges, their numbers within a range come from a window, and those of the ranges before from the ranges'
    counts, a row for each figure and range. The rows' other columns go along with the first figure.
    """
    names, rest = list(of), [c for c in rows.columns if c != key]
    figures = F.array(*[F.struct(F.lit(k).alias("figure"), F.col(of[name]).cast("double").alias("value")) for k, name in enumerate(names)])
    whole = F.struct(*rest)
    long = rows.select(key, F.explode(figures).alias("__f"), whole.alias("__row")).select(key, "__f.figure", "__f.value", F.when(F.col("__f.figure") == 0, F.col("__row")).alias("__row"))
    dealt = held(long.repartitionByRange("figure", "value", key).withColumn("__range", F.spark_partition_id()))
    counts = dealt.groupBy("figure", "__range").agg(F.count("*").alias("__rows"))
    upto = Window.partitionBy("figure").orderBy("__range")
    before = counts.select("figure", "__range", (F.sum("__rows").over(upto) - F.col("__rows")).alias("__before"), F.sum("__rows").over(Window.partitionBy("figure")).alias("__n"))
    place = F.row_number().over(Window.partitionBy("figure", "__range").orderBy("value", key)) - 1 + F.col("__before")
    percentile = F.when(F.col("__n") == 1, F.lit(50.0)).otherwise(100.0 * place / (F.col("__n") - 1))
    placed = dealt.join(F.broadcast(before), ["figure", "__range"]).withColumn("__percentile", percentile)
    pivoted = placed.groupBy(key).agg(F.first("__row", ignorenulls=True).alias("__row"), *[F.max(F.when(F.col("figure") == k, F.col("__percentile"))).alias(name) for k, name in enumerate(names)])
    return pivoted.select(key, "__row.*", *names)


def at_rank(values: DataFrame, column: str, place: Callable[[int], int]) -> DataFrame:
    """One row `value`: the element of sorted values numbered place(n), from 0; nulls are no values. None where there is none.

    Values fall into bands that keep their order, an eighth of a doubling each; the bands' counts, some thousand at most, tell which
    one holds the place, and only that one's values are sorted. The values are read twice, so hold what is dear to make.
    """
    v = F.col(column).cast("double")
    band = F.floor(F.signum(v) * 8 * F.log2(1 + F.abs(v)))
    known = values.where(v.isNotNull())
    bands = sorted(tuple(r) for r in known.groupBy(band.alias("band")).count().collect())
    n = sum(rows for _, rows in bands)
    wanted = place(n)
    for one, rows in bands:
        if wanted < rows:
            break
        wanted -= rows
    inside = known.where((band == F.lit(one)) if bands else F.lit(False)).groupBy(v.alias("value")).agg(F.count("*").alias("__n"))
    return inside.withColumn("__until", F.sum("__n").over(Window.orderBy("value"))).where(F.col("__until") > wanted).agg(F.min("value").alias("value"))


def interpolated(value: Column, less: Column, equal: Column, n: Column, q: float, by: Sequence[Column | str]) -> Column:
    """Over tallied values (each with how many are less and equal): the quantile between the two elements around q * (n - 1), the same for all rows of `by`."""
    at = F.lit(q) * (n - 1)
    low, high = F.floor(at), F.ceil(at)
    pick = lambda place: F.max(F.when((less <= place) & (place < less + equal), value)).over(Window.partitionBy(*by))
    return pick(low) + (pick(high) - pick(low)) * (at - low)


def midrank_percentile(value: Column, by: Sequence[Column | str] = ()) -> Column:
    """100 * (how many are less + half of the equal) / n; 50 if alone."""
    w = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(w)
    o = w.orderBy(value)
    return F.when(n <= 1, F.lit(50.0)).otherwise(100.0 * ((F.rank().over(o) - 1) / n + F.cume_dist().over(o)) / 2)


def order_statistics(values: DataFrame, by: Sequence[str], column: str, quantiles: Mapping[str, float], upper_median: str | None = None) -> DataFrame:
    """A row for each key of `by`: interpolated quantiles of the column's values, and the element numbered n div 2; exact, from tallies, without a buffer."""
    tally = values.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("__v")).agg(F.count("*").alias("__equal"))
    whole = Window.partitionBy(*by)
    less = F.sum("__equal").over(whole.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__equal")
    placed = tally.withColumns({"__less": less, "__all": F.sum("__equal").over(whole)})
    found = {name: interpolated(F.col("__v"), F.col("__less"), F.col("__equal"), F.col("__all"), q, by) for name, q in quantiles.items()}
    if upper_median:
        place = F.floor(F.col("__all") / 2)
        found[upper_median] = F.max(F.when((F.col("__less") <= place) & (place < F.col("__less") + F.col("__equal")), F.col("__v"))).over(whole)
    return placed.withColumns(found).groupBy(*by).agg(*[F.max(name).alias(name) for name in found])


def upper_median(values: DataFrame, column: str) -> DataFrame:
    """One row `value`: the element numbered n div 2 (from 0) of the sorted values."""
    return at_rank(values, column, lambda n: n // 2)


def trend_score(current: Column, mean: Column) -> Column:
    """50 + 50 tanh of the relative change against the mean of earlier periods; 50 without any, 75 or 50 from a baseline of nothing."""
    change = F.try_divide(current - mean, mean)
    return F.when(mean.isNull(), 50.0).when(mean <= 0, F.when(current > 0, 75.0).otherwise(50.0)).otherwise(50 + 50 * F.tanh(change))


def anomaly_score(value: Column, median: Column, mad: Column, n: Column) -> Column:
    """50 + 50 tanh of a third of the robust z-score; 50 below three values, 75 / 50 / 25 if the deviations are nil."""
    z = 0.6745 * F.try_divide(value - median, mad)
    flat = F.when(value > median, 75.0).when(value < median, 25.0).otherwise(50.0)
    return F.when(n < 3, 50.0).when(mad == 0, flat).otherwise(50 + 50 * F.tanh(z / 3))


def priority_level(score: Column) -> Column:
    return F.when(score >= 80, "muy_alta").when(score >= 65, "alta").when(score >= 40, "media").when(score.isNotNull(), "baja")


def score_level(score: Column) -> Column:
    return F.when(score >= 80, "Muy alto").when(score >= 65, "Alto").when(score >= 45, "Medio").when(score >= 25, "Bajo").when(score.isNotNull(), "Muy bajo")
