import math
import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tessera.operators import order_stats as o


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)


def samples():
    rng = random.Random(7)
    spread = [rng.gauss(0, 100) for _ in range(4000)]
    hot = [5.0] * 2000 + [rng.random() * 10 for _ in range(3000)]            # a third of the rows equal
    few = [float(rng.randrange(4)) for _ in range(3000)]
    return {"spread": spread, "hot": hot, "few": few, "one": [3.0], "two": [2.0, 1.0], "equal": [4.0] * 500}


@pytest.mark.parametrize("name", samples())
@pytest.mark.parametrize("size", [64, 8192])
def test_percentiles_equal_numpy(spark, monkeypatch, name, size):
    values = samples()[name]
    monkeypatch.setattr(o, "SKETCH_SIZE", size)
    fractions = [0.0, 0.05, 1 / 3, 0.5, 0.95, 0.99, 1.0]
    got = o.exact_percentiles(frame(spark, values), "x", fractions)
    assert got == pytest.approx(list(np.percentile(values, [f * 100 for f in fractions])), abs=1e-9)


def test_scans_do_not_depend_on_the_number_of_cuts(spark, monkeypatch):
    honest, scans = o._scan, []

    def counted(data, columns):
        scans.append(len(columns))
        return honest(data, columns)

    monkeypatch.setattr(o, "_scan", counted)
    # Small, so that several levels are needed; sketches draw at random, and smaller ones now and then need one more.
    monkeypatch.setattr(o, "SKETCH_SIZE", 256)
    df = frame(spark, samples()["spread"])
    used = []
    for fractions in ([0.5], [0.01, 0.2, 0.4, 0.6, 0.8, 0.99]):
        scans.clear()
        got = o.exact_percentiles(df, "x", fractions)
        assert got == pytest.approx(list(np.percentile(samples()["spread"], [f * 100 for f in fractions])))
        used.append(len(scans))
    assert max(used) <= 8 and abs(used[0] - used[1]) <= 2


def test_unknown_values(spark):
    assert o.exact_percentiles(frame(spark, [None, None]), "x", [0.5]) == [None]
    assert o.exact_percentiles(frame(spark, [None, 1, math.nan, 3]), "x", [0.5]) == [2.0]
    assert o.percent_rank_cutoffs(frame(spark, []), "x", [0.5]) == [None]


@pytest.mark.parametrize("name", samples())
def test_tiers_equal_the_window(spark, name):
    df = frame(spark, samples()[name]).withColumn("x", F.round("x", 2))
    rank = F.percent_rank().over(Window.orderBy("x"))
    want = df.withColumn("r", rank).select(
        "x", F.when(F.col("r") >= 0.8, "High").when(F.col("r") >= 0.4, "Medium").otherwise("Low").alias("tier"))
    got = o.tier_by_percent_rank(df, "x", [(0.4, "Medium"), (0.8, "High")], "Low")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_nulls_rank_lowest(spark):
    df = frame(spark, [None, None, None, 1, 2])
    got = o.tier_by_percent_rank(df, "x", [(0.75, "top"), (1.0, "peak")], "rest")
    assert {r["x"]: r["tier"] for r in got.collect()} == {None: "rest", 1.0: "top", 2.0: "peak"}
