import random
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from comarca.functions import stats

VALUES = st.lists(st.integers(-3, 6), min_size=1, max_size=12)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, values):
    return spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "k int, v double")


@FEW
@given(VALUES)
def test_ranks(spark, values):
    rows = frame(spark, values).select("k", stats.midrank_percentile(F.col("v")).alias("mid"), stats.tie_rank_percentile(F.col("v"), F.col("k")).alias("tie")).collect()
    order, n = sorted(range(len(values)), key=lambda k: (values[k], k)), len(values)
    for r in rows:
        v = values[r["k"]]
        mid = 50.0 if n == 1 else 100 * (sum(x < v for x in values) + 0.5 * sum(x == v for x in values)) / n
        tie = 50.0 if n == 1 else 100 * order.index(r["k"]) / (n - 1)
        assert abs(r["mid"] - mid) < 1e-9 and abs(r["tie"] - tie) < 1e-9


@FEW
@given(VALUES)
def test_upper_median(spark, values):
    assert stats.upper_median(frame(spark, values), "v").first()["value"] == sorted(values)[len(values) // 2]


def test_order_statistics(spark):
    """Bands, tallies and ranges against plain sorting, with many ties, few values, negative and very large ones, and nulls."""
    r = random.Random(3)
    values = [(k % 3, r.choice([0.0, 0.0, 1.0, -5.5, 1e12, r.random() * 10, float(r.randint(-1000, 1000))])) for k in range(400)] + [(7, 4.0), (8, None), (0, None)]
    rows = spark.createDataFrame([(k, g, v) for k, (g, v) in enumerate(values)], "k int, g int, v double").repartition(5)
    found = {x["g"]: x for x in stats.order_statistics(rows, ["g"], "v", {"q25": 0.25, "q50": 0.5, "q90": 0.9}, "upper").collect()}
    for g in (0, 1, 2, 7):
        own = sorted(v for h, v in values if h == g and v is not None)
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q90", 0.9)):
            at = q * (len(own) - 1)
            low, high = own[int(at)], own[min(len(own) - 1, int(at) + (at > int(at)))]
            assert abs(found[g][name] - (low + (high - low) * (at - int(at)))) <= 1e-9 * max(1, abs(high))
        assert found[g]["upper"] == own[len(own) // 2]
    assert set(found) == {0, 1, 2, 7}
    everything = sorted(v for _, v in values if v is not None)
    for place in (0, 1, len(everything) // 2, len(everything) - 1):
        assert stats.at_rank(rows, "v", lambda n, p=place: p).first()["value"] == everything[place]
    assert stats.at_rank(rows.limit(0), "v", lambda n: n // 2).first()["value"] is None
    ranked = {x["k"]: x for x in stats.with_percentiles(rows.withColumn("w", -F.col("v")), {"a": "v", "b": "w"}, "k").collect()}
    for name, sign in (("a", 1), ("b", -1)):
        order = sorted(range(len(values)), key=lambda k: (values[k][1] is not None, sign * (values[k][1] or 0), k))
        assert all(abs(ranked[k][name] - 100 * place / (len(values) - 1)) < 1e-9 for place, k in enumerate(order))
    assert ranked[0]["g"] == 0 and ranked[0]["v"] == values[0][1] and len(ranked) == len(values)


def test_anomaly_cases(spark):
    def scores(values):
        w = Window.partitionBy()
        med = frame(spark, values).withColumns({"m": F.median("v").over(w), "n": F.count("*").over(w)}).withColumn("d", F.abs(F.col("v") - F.col("m"))).withColumn("mad", F.median("d").over(w))
        return [r[0] for r in med.orderBy("k").select(stats.anomaly_score(F.col("v"), F.col("m"), F.col("mad"), F.col("n"))).collect()]

    assert scores([1, 9]) == [50.0, 50.0]
    assert scores([5, 5, 5, 9, 1]) == [50.0, 50.0, 50.0, 75.0, 25.0]
    spread = [1.0, 2.0, 4.0, 9.0]
    assert statistics.median(spread) == 3.0 and scores(spread)[0] < 50 < scores(spread)[3]


def test_trend_and_levels(spark):
    rows = spark.createDataFrame([(1.0, None), (0.0, 0.0), (2.0, 0.0), (4.0, 4.0)], "v double, m double")
    assert [r[0] for r in rows.select(stats.trend_score(F.col("v"), F.col("m"))).collect()] == [50.0, 50.0, 75.0, 50.0]
    marks = spark.createDataFrame([(80.0,), (65.0,), (45.0,), (40.0,), (25.0,), (1.0,), (None,)], "s double")
    assert [tuple(r) for r in marks.select(stats.priority_level(F.col("s")), stats.score_level(F.col("s"))).collect()] == [
        ("muy_alta", "Muy alto"), ("alta", "Alto"), ("media", "Medio"), ("media", "Bajo"), ("baja", "Bajo"), ("baja", "Muy bajo"), (None, None),
    ]
