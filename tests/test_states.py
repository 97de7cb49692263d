"""States that can be merged: moments, gold partials, sketches, and exact ranks."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cleaning, detector, moments, partials, ranks
from tessera.plans import layers, queries
from tessera.schema import ACTIVITY

DAY = 86_400_000
START = 1_704_067_200_000


# ---------------------------------------------------------------- moments

def _data(rows=500, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=rows)
    return np.column_stack([a, 1e8 + 0.3 * a + rng.normal(size=rows), 1e12 + 2 * a + 3 * rng.normal(size=rows)])


def _frame(spark, x, groups=7):
    rows = [(i % groups, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "day int, a double, b double, c double").repartition(5)


def _check(state, x):
    want = np.cov(x.T, bias=True)
    assert state.n == len(x)
    assert np.allclose(np.array(state.means) - x.mean(axis=0), 0, atol=1e-3)
    got = np.array(state.comoments) / state.n
    assert np.allclose(got, want[np.triu_indices(3)], rtol=1e-6, atol=1e-6)


def test_moments_far_from_zero_equal_numpy(spark):
    x = _data()
    _check(moments.states(_frame(spark, x), ["a", "b", "c"]).first(), x)


def test_merged_days_are_the_whole(spark):
    x = _data()
    days = moments.states(_frame(spark, x), ["a", "b", "c"], ["day"])
    assert days.count() == 7
    _check(moments.merged(days, 3).first(), x)
    # Merging in two steps changes nothing, and groups stay apart.
    halves = moments.merged(days.withColumn("half", F.col("day") % 2), 3, ["half"])
    _check(moments.merged(halves.drop("half"), 3).first(), x)
    own = {r.day: r for r in moments.merged(days, 3, ["day"]).collect()}
    for d in range(7):
        _check(own[d], x[d::7])


def test_moments_of_nothing_and_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "g int, a double")
    got = {r.g: (r.n, r.means[0], r.comoments[0]) for r in moments.states(df, ["a"], ["g"]).collect()}
    assert got == {None: (2, 2.0, 2.0), 1: (1, 5.0, 0.0)}
    assert moments.states(df.where("false"), ["a"]).count() == 0
    assert moments.merged(moments.states(df.where("false"), ["a"], ["g"]), 1).count() == 0


def test_detector_fits_alike_from_kept_days(spark):
    rng = random.Random(5)
    rows = [(s, START + d * DAY + h * 3_600_000, 39, *[rng.random() * 9 + 1e7 for _ in ACTIVITY])
            for s in range(6) for d in range(5) for h in range(0, 24, 3)]
    schema = "square_id int, time_interval long, country_code int, " + ", ".join(f"{c} double" for c in ACTIVITY)
    silver = cleaning.silver(spark.createDataFrame(rows, schema), F.timestamp_seconds(F.lit(START // 1000 + 10 ** 7)))
    plain, kept = detector.fit(silver), detector.fit(silver, days=detector.day_states(silver))
    assert np.allclose(plain.scale, kept.scale, rtol=1e-9) and np.allclose(plain.mean, kept.mean, rtol=1e-12)
    assert plain.threshold == pytest.approx(kept.threshold, rel=1e-6)
    x = np.array([r[3:] for r in rows])
    assert np.allclose(plain.scale[:5], x.std(axis=0), rtol=1e-8)


# ---------------------------------------------------------------- ranks

def _ranked(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(6)


def test_ranks_share_ties_and_put_nulls_first(spark):
    values = [3.0, None, 1.0, 3.0, 2.0, None, 3.0, 7.0]
    got = {r.id: (r["rank"], r.percent_rank) for r in ranks.with_percent_rank(
        ranks.with_rank(_ranked(spark, values), ["v"]), ["v"]).collect()}
    order = sorted((v is not None, v or 0) for v in values)
    for i, v in enumerate(values):
        before = order.index((v is not None, v or 0))
        assert got[i] == (before + 1, before / 7)
    down = {r.id: r["rank"] for r in ranks.with_rank(_ranked(spark, values), ["v"], descending=True).collect()}
    assert [down[i] for i in range(8)] == [2, 7, 6, 2, 5, 7, 2, 1]


@pytest.mark.parametrize("n, tiles", [(1, 4), (3, 4), (10, 4), (12, 4), (57, 5)])
def test_ntile_equals_the_window_function(spark, n, tiles):
    df = _ranked(spark, [float(k * 7 % n) for k in range(n)])
    want = {r.id: r.t for r in df.selectExpr("id", f"ntile({tiles}) OVER (ORDER BY v, id) AS t").collect()}
    assert {r.id: r.tile for r in ranks.with_ntile(df, ["v", "id"], tiles).collect()} == want


def test_ranks_of_many_rows_without_an_unpartitioned_window(spark):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE hash(id) % 1000 END AS v").repartition(7)
    made = ranks.with_percent_rank(df, ["v"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert all("windowspecdefinition(_part" in line for line in plan.splitlines() if "Window [" in line)
    want = df.selectExpr("id", "percent_rank() OVER (ORDER BY v) AS p")
    assert made.join(want, "id").where("percent_rank <> p").count() == 0 and made.count() == 20_000


def test_rank_of_an_empty_table_and_a_clashing_column(spark):
    empty = _ranked(spark, [1.0]).where("false")
    assert ranks.with_rank(empty, ["v"]).count() == 0
    with pytest.raises(ValueError, match="_part"):
        ranks.with_rank(empty.withColumn("_part", F.lit(1)), ["v"])


# ---------------------------------------------------------------- gold partials

def _line(square, ms, value):
    return "\t".join([str(square), str(ms), "39", *[str(value)] * 5])


def _deliver(folder, days):
    folder.mkdir(exist_ok=True)
    for day, (squares, value) in days.items():
        lines = [_line(s, START + (day - 1) * DAY + s * 600_000, value) for s in squares]
        (folder / f"sms-call-internet-mi-2024-01-{day:02d}.txt").write_text("".join(x + "\n" for x in lines))


def _as_of():
    return F.timestamp_seconds(F.lit((START + 30 * DAY) // 1000))


def test_a_reload_reads_its_own_days_only_and_equals_a_rebuild(spark, tmp_path):
    lake = layers.Layout(str(tmp_path / "lake"), str(tmp_path / "raw"))
    _deliver(tmp_path / "raw", {1: (range(1, 30), 1.0), 2: (range(1, 20), 50.0), 3: (range(5, 9), 2.0)})
    layers.run_bronze(spark, lake, "b1")
    layers.run_silver(spark, lake, "b1", _as_of())
    layers.run_gold(spark, lake, "b1")
    _deliver(tmp_path / "again", {2: (range(10, 40), 3.0)})
    again = layers.Layout(lake.root, str(tmp_path / "again"))
    layers.run_bronze(spark, again, "b2", reload_days=True)
    layers.run_silver(spark, again, "b2", _as_of(), days=("2024-01-02", "2024-01-02"))
    # Files of other silver days whose rows nobody could read.
    hidden = {}
    for day in ("01", "03"):
        folder = tmp_path / "lake/silver/cdr_records" / f"date=2024-01-{day}"
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                hidden[folder / name] = (folder / name).read_bytes()
                content = hidden[folder / name]
                footer = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
                (folder / name).write_bytes(content[:4] + bytes(footer - 4) + content[footer:])
            elif name.endswith(".crc"):
                hidden[folder / name] = (folder / name).read_bytes()
                (folder / name).unlink()
    layers.run_gold(spark, again, "b2", days=("2024-01-02", "2024-01-02"))
    names = {"hourly_grid_activity": "avg_internet", "daily_country_usage": "total_internet", "grid_heatmap": "total_activity"}
    read = lambda name: sorted(
        tuple(r) for r in spark.read.parquet(lake.table(f"gold.{name}")).drop("_gold_processed_at", "_gold_batch_id").collect())
    kept = {name: read(name) for name in names}
    for path, content in hidden.items():
        path.write_bytes(content)
    spark.catalog.clearCache()
    layers.run_gold(spark, again, "b3")
    assert kept == {name: read(name) for name in names}
    usage = spark.read.parquet(lake.table("gold.daily_country_usage")).collect()
    assert {str(r.date): (r.active_squares, r.total_internet) for r in usage} == {
        "2024-01-01": (29, 29.0), "2024-01-02": (30, 90.0), "2024-01-03": (4, 8.0)}


def test_a_day_that_became_empty_leaves_the_states(spark, tmp_path):
    lake = layers.Layout(str(tmp_path / "lake"), str(tmp_path / "raw"))
    _deliver(tmp_path / "raw", {d: (range(1, 5), 1.0) for d in (1, 2, 3)})
    layers.run_bronze(spark, lake, "b1")
    layers.run_silver(spark, lake, "b1", _as_of())
    layers.run_gold(spark, lake, "b1")
    silver = spark.read.parquet(lake.table("silver.cdr_records"))
    target = lake.table("state.day_partials")
    from tessera.sources import sinks
    only = partials.day_partials(silver.where("date = '2024-01-03'"))
    assert sinks.replace_days(only, target, "date", ("2024-01-02", "2024-01-03")) == 4
    left = spark.read.parquet(target).select(F.col("date").cast("string").alias("d")).distinct().collect()
    assert sorted(r.d for r in left) == ["2024-01-01", "2024-01-03"]


def test_sketches_unite_over_any_days(spark):
    rows = spark.range(60_000).selectExpr(
        "CAST(id % 3 AS INT) AS country_code", "date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS date",
        "CAST(hash(id) % 9000 AS INT) AS square_id")
    sketches = partials.square_sketches(rows)
    assert sketches.count() == 30
    for key in ([], ["country_code"], ["country_code", "date"]):
        exact, guess = partials.exact_squares(rows, key), partials.distinct_squares(sketches, key)
        both = exact.join(guess, key) if key else exact.crossJoin(guess)
        bad = both.where(~partials.within_bound(F.col("estimated_squares"), F.col("exact_squares")))
        assert bad.count() == 0 and both.count() == {0: 1, 1: 3, 2: 30}[len(key)]


def test_one_digest_in_the_gold_plans(spark):
    """Filters pushed towards the injection carry its digest as a column, not once for each of its uses."""
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    for name in ("hourly_grid_activity", "daily_country_usage"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("md5(") == 1
