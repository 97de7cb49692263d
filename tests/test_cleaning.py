import math

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_sample
from tessera.operators import aggregates, cleaning
from tessera.schema import NATURAL_KEY, RAW_ACTIVITY

NOW = 1_706_745_600_000


def as_of():
    return F.timestamp_seconds(F.lit(NOW // 1000))


def records(spark, *rows):
    return spark.createDataFrame(rows, RAW_ACTIVITY)


def flags(row):
    return row["_has_negative_activity"], row["_is_future_timestamp"], row["_is_null_activity"]


def by_square(df):
    return {r["square_id"]: r for r in df.collect()}


def test_flags_describe_raw_values_and_values_are_cleaned(spark):
    df = records(
        spark,
        (1, NOW, 39, None, 1.0, 2.0, 3.0, 4.0),            # one blank is no fault
        (2, NOW, 39, None, None, None, None, None),
        (3, NOW, 39, -5.0, None, 1.0, 1.0, 1.0),
        (4, NOW, 39, math.nan, 1.0, 1.0, 1.0, 1.0),
        (5, NOW + 1, 39, math.nan, None, None, None, None),
        (6, None, 39, 1.0, 1.0, 1.0, 1.0, 1.0),
        (7, 9_000_000_000_000_000_000, 39, 1.0, 1.0, 1.0, 1.0, 1.0),
    )
    rows = by_square(cleaning.flag_and_clean(df, as_of()))
    assert flags(rows[1]) == (False, False, False)
    assert flags(rows[2]) == (False, False, True)
    assert flags(rows[3]) == (True, False, False)
    assert flags(rows[4]) == (False, False, False)
    assert flags(rows[5]) == (False, True, True)
    assert flags(rows[6]) == (False, False, False) and rows[6]["event_time"] is None
    assert flags(rows[7]) == (False, True, False) and rows[7]["event_time"] is None
    assert [rows[i]["sms_in"] for i in (1, 2, 3, 4)] == [0.0, 0.0, 0.0, 0.0]
    assert rows[1]["internet"] == 4.0
    assert (rows[1]["hour_of_day"], rows[1]["day_of_week"], str(rows[1]["date"])) == (0, 5, "2024-02-01")
    assert {r["square_id"] for r in cleaning.current(cleaning.flag_and_clean(df, as_of())).collect()} == {1, 2, 3, 4}


def test_deduplication_keeps_the_first_in_a_fixed_order(spark):
    copies = [(1, NOW, 39, float(v), 0.0, 0.0, 0.0, 0.0) for v in (3, 1, 2)]
    other = [(1, NOW, 40, None, 0.0, 0.0, 0.0, 0.0), (None, None, None, 7.0, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    kept = cleaning.deduplicate(records(spark, *copies, *other).repartition(4))
    assert sorted((r["country_code"] or 0, r["sms_in"]) for r in kept.collect()) == [(0, 7.0), (39, 1.0), (40, None)]


def test_copies_are_cut_down_before_the_shuffle(spark):
    hot = spark.range(100_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE CAST(id AS INT) END AS square_id", "0L AS time_interval",
        "39 AS country_code", "CAST(id AS DOUBLE) AS sms_in")
    kept = cleaning.deduplicate(hot)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    one = kept.where("square_id = 1").collect()
    assert len(one) == 1 and one[0]["sms_in"] == 0.0


def test_counts_add_up(spark):
    df = records(
        spark,
        (1, NOW, 39, 1.0, 1.0, 1.0, 1.0, 1.0), (1, NOW, 39, 2.0, 1.0, 1.0, 1.0, 1.0),
        (2, NOW, 39, -1.0, 1.0, 1.0, 1.0, 1.0), (3, NOW + 5, 39, 1.0, 1.0, 1.0, 1.0, 1.0),
    )
    silver = cleaning.silver(df, as_of())
    assert cleaning.stage_counts(df, silver).first().asDict() == {
        "rows_before": 4, "rows_after": 3, "dropped": 1, "suspicious_flagged": 2}
    assert cleaning.suspicious(silver).count() + cleaning.clean(silver).count() == silver.count()


def test_hourly_and_daily(spark):
    hour = 3_600_000
    day = NOW - 24 * hour
    df = cleaning.silver(records(
        spark,
        (1, day, 39, 1.0, 0.0, 0.0, 0.0, 10.0), (1, day + 600_000, 39, 3.0, 0.0, 0.0, 0.0, 30.0),
        (2, day + hour, 39, 5.0, 0.0, 0.0, 0.0, 1.0), (2, NOW + hour, 39, 99.0, 0.0, 0.0, 0.0, 99.0),
    ), as_of())
    hourly = {(r["square_id"], r["hour_of_day"]): r for r in aggregates.hourly_grid_activity(df).collect()}
    assert set(hourly) == {(1, 0), (2, 1)}
    assert (hourly[1, 0]["avg_sms_in"], hourly[1, 0]["peak_internet"], hourly[1, 0]["record_count"]) == (2.0, 30.0, 2)
    daily = aggregates.daily_country_usage(df).collect()
    assert [(r["total_sms_in"], r["record_count"], r["active_squares"]) for r in daily] == [(9.0, 3, 2)]


def test_heatmap_positions_and_tiers(spark):
    squares = [0, 1, 100, 101, 10_000]
    df = cleaning.silver(records(spark, *[(s, NOW, 39, float(i), 0.0, 0.0, 0.0, 0.0)
                                          for i, s in enumerate(squares)]), as_of())
    rows = by_square(aggregates.grid_heatmap(df))
    assert [(rows[s]["grid_row"], rows[s]["grid_col"]) for s in squares] == [
        (0, -1), (0, 0), (0, 99), (1, 0), (99, 99)]
    assert [rows[s]["activity_tier"] for s in squares] == ["Low", "Low", "Medium", "Medium", "High"]
    single = aggregates.grid_heatmap(df.where("square_id = 1")).collect()
    assert [r["activity_tier"] for r in single] == ["Low"]


def test_sample_is_repeatable_and_near_its_fraction(spark):
    df = spark.range(20_000).selectExpr("CAST(id AS INT) AS square_id", "id AS time_interval", "39 AS country_code")
    a = {tuple(r) for r in hash_sample(df, 0.1, NATURAL_KEY).collect()}
    b = {tuple(r) for r in hash_sample(df.repartition(7, "time_interval"), 0.1, NATURAL_KEY).collect()}
    assert a == b and 1800 < len(a) < 2200


def test_scratch_is_empty_after_release(spark):
    from pathlib import Path

    from tessera.session import materialize, scratch, scratch_dir

    with scratch(spark):
        folder = Path(scratch_dir(spark).removeprefix("file:")) / "tessera"
        before = set(folder.iterdir()) if folder.exists() else set()
        assert materialize(spark.range(10), "probe").count() == 10
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) <= before


def test_infinite_bounds(spark):
    from tessera.operators.rules import Rule

    df = spark.createDataFrame([(1.0,), (-5.0,)], "x double")
    rule = Rule("x", "float", test=("in_range", 0, float("inf")))
    assert [r[0] for r in df.selectExpr(rule.broken_sql()).collect()] == [False, True]
