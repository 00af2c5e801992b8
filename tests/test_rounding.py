import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from swaplens.functions.numbers import to_number, to_whole
from swaplens.functions.rounding import round_scaled, with_rounded


def _values():
    random.seed(7)
    near_ties = [n / 1000 for n in range(5, 4000, 10)] + [(n + 0.5) / 1e6 for n in range(1, 400)]
    eighths = [n / 8 for n in range(1, 200)]
    wide = [random.uniform(0, 1) * 10 ** random.randint(-9, 18) for _ in range(2000)]
    products = [round(random.uniform(0, 500), 2) * random.choice([0.5, 0.25, 1.5]) for _ in range(2000)]
    values = near_ties + eighths + wide + products + [0.0, 2.675, 1.005, 8.345, 1e300, 5e-324]
    return values + [-v for v in values]


def _fixed(x: float, places: int) -> float:
    """Nearest decimal to the exact value of the double, ties away from zero."""
    return float(Decimal(x).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)) if abs(x) < 1e20 else x


def test_rounds_by_exact_value(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "v DOUBLE")
    even = with_rounded(df, {"r2": F.col("v"), "w2": F.col("v") + 0.0}, 2)
    both = with_rounded(with_rounded(even, {"r6": F.col("v")}, 6), {"up": F.col("v")}, 2, ties="up")
    for row in both.collect():
        assert row.r2 == round(row.v, 2) == row.w2
        assert row.r6 == round(row.v, 6)
        assert row.up == _fixed(row.v, 2)


def test_null_nan_infinity_pass(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (math.inf,), (-math.inf,)], "v DOUBLE")
    got = [r.r for r in with_rounded(df, {"r": F.col("v")}, 2).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [math.inf, -math.inf]


def test_filter_on_rounded_value_is_not_inlined(spark):
    df = with_rounded(spark.range(10), {"r": F.col("id") / 3}, 2).where("r > 1")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert df.count() == 6


def test_round_scaled(spark):
    got = spark.range(1).select(round_scaled(F.lit(2.675), 2), round_scaled(F.lit(0.125), 2)).first()
    assert tuple(got) == (2.68, 0.12)


def test_text_to_number(spark):
    texts = ["1", " 2 ", "-3.5", "1e3", ".5", "5.", "x", "", "5d", "1f", "0x1p3", "NaN", "inf", None, "1.2.3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = [r.n for r in df.select("i", to_number(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [1.0, 2.0, -3.5, 1000.0, 0.5, 5.0] + [None] * 9
    whole = [r.n for r in df.select("i", to_whole(F.col("t")).alias("n")).orderBy("i").collect()]
    assert whole == [1, 2, None, 1000, None, 5] + [None] * 9
