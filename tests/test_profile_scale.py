import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import profile as P


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_selected_quantiles_equal_the_buffered_ones(spark, kind):
    draw = random.Random(3)
    rows = [(g, float(x)) for g in ("a", None) for x in [draw.gauss(0, 1) * 10 ** draw.randint(-3, 15) for _ in range(1500)] + [0.0, 7.0, 7.0, 7.0]]
    rows += [("one", 5.0), ("two", -3.0), ("two", 4.0), ("same", 2.0), ("same", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double").select("g", F.col("x").cast(kind))
    many, few = (sorted(map(tuple, P.describe(df, ["x"], ["g"], 6, max_distinct=m).collect()), key=str) for m in (10, 10**6))
    assert many == few and len(many) == 5


def test_quantiles_of_extreme_doubles(spark):
    draw = random.Random(4)
    values = [s * m * 2.0**e for s in (-1, 1) for e in range(-1070, 1020, 55) for m in (1, 1 + draw.random(), 1.75)] + [math.inf, -math.inf, 0.0, 1.0, 1.0 + 2**-52, 1.0 + 2**-51]
    vc = spark.createDataFrame([(1, v, draw.randint(1, 3)) for v in values], "k int, value double, cnt bigint")
    got = P.exact_quantiles(vc, ["k"], [0.0, 0.5, 0.501, 0.9, 1.0]).first()["pct"]
    want = vc.groupBy("k").agg(F.percentile("value", F.array(*[F.lit(q) for q in (0.0, 0.5, 0.501, 0.9, 1.0)]), F.col("cnt")).alias("p")).first()["p"]
    assert got == want


def test_density_is_the_exact_curve(spark):
    draw = random.Random(5)
    for values in ([draw.gauss(10, 3) for _ in range(300)] + [500.0, 501.0], [1.0, 2.0, 2.0, 9.0], [-1e6, 1e6, 3.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        got = [(r["point"], r["density"]) for r in P.density_curve(df, "x", 50, 18).orderBy("point").collect()]
        x = np.array(values)
        h = x.std(ddof=1) * len(x) ** -0.2
        want = np.exp(-0.5 * ((np.linspace(x.min(), x.max(), 50)[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
        assert [p for p, _ in got] == list(range(50))
        assert np.abs(np.array([d for _, d in got]) - want).max() < 1e-14 / h + 1e-18  # the second part is the rounding
    for values in ([], [3.0], [3.0, 3.0]):
        assert P.density_curve(spark.createDataFrame([(v,) for v in values], "x double"), "x").count() == 0
