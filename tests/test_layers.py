import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import commerce, governance
from tessera.plans import layers
from tessera.schema import ACTIVITY, RAW_ACTIVITY
from tessera.sources import activity, sinks
from tessera.streaming import ingest

DAY = 86_400_000
START = 1_704_067_200_000


def day_file(folder, day, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"sms-call-internet-mi-2024-01-{day:02d}.txt").write_text("".join(line + "\n" for line in lines))


def line(square, ms, *values):
    return "\t".join([str(square), str(ms), "39", *["" if v is None else str(v) for v in values]])


@pytest.fixture()
def layout(tmp_path):
    raw = tmp_path / "raw"
    day_file(raw, 1, [line(s, START + s * 600_000, 1.5, None, 2.0, 0.0, s) for s in range(1, 41)]
             + [line(1, START + 600_000, 9.0, 1.0, 1.0, 1.0, 1.0)])
    day_file(raw, 2, [line(s, START + DAY + s * 600_000, 1.0, 1.0, 1.0, -3.0, s) for s in range(1, 21)])
    return layers.Layout(str(tmp_path / "lake"), str(raw))


def as_of():
    return F.timestamp_seconds(F.lit((START + 30 * DAY) // 1000))


def test_bronze_keeps_every_line_and_notes_bad_ones(spark, tmp_path):
    raw = tmp_path / "raw"
    day_file(raw, 1, [line(1, START, 1.5, None, 2.0, 0.0, 3.0), "x\ty\tz", line(2, "soon", 1, 1, 1, 1, 1)])
    (raw / "notes.txt").write_text("not a daily file\n")
    bad = activity.rejects_of(activity.bronze(spark, str(raw), "b1")).collect()
    assert len(bad) == 2 and all(r["_source_file"].endswith("01.txt") for r in bad)
    bronze = activity.bronze(spark, str(raw), "b1").orderBy(F.col("square_id").asc_nulls_last()).collect()
    assert [r["square_id"] for r in bronze] == [1, 2, None]
    assert bronze[0]["sms_out"] is None and str(bronze[0]["_date_partition"]) == "2024-01-01"
    assert bronze[1]["time_interval"] is None and bronze[1]["_date_partition"] is None
    assert bronze[0]["_batch_id"] == "b1" and bronze[0]["_pipeline_version"] == activity.PIPELINE_VERSION


def test_rejects_are_written_with_file_and_text(spark, tmp_path):
    raw, lake = tmp_path / "raw", layers.Layout(str(tmp_path / "lake"), str(tmp_path / "raw"))
    bad = ["x\ty\tz", line(2, "soon", 1, 1, 1, 1, 1)]
    day_file(raw, 1, [line(1, START, 1.5, None, 2.0, 0.0, 3.0), *bad])

    def texts(bronze):
        rows = activity.rejects_of(spark.read.parquet(bronze)).collect()
        return sorted((r["_corrupt_record"], r["_source_file"][-6:], r["_batch_id"]) for r in rows)

    parses, writes = [], []
    read, write = activity.read_raw, sinks.write_table
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(activity, "read_raw", lambda *a: parses.append(a) or read(*a))
        patch.setattr(sinks, "write_table", lambda df, *a, **k: writes.append(df) or write(df, *a, **k))
        assert layers.run_bronze(spark, lake, "b1") == 3
    # One parse of the files, and one of the writes reads them.
    assert len(parses) == 1
    assert [df._jdf.queryExecution().optimizedPlan().toString().count("csv") > 0 for df in writes].count(True) == 1
    want = sorted((t, "01.txt", "b1") for t in bad)
    assert texts(lake.table("bronze.cdr_records")) == want
    files = spark.read.parquet(lake.files).collect()
    assert [(r["batch_id"], r["file"][-6:], r["row_count"], r["rejected"]) for r in files] == [("b1", "01.txt", 3, 2)]
    target, progress = str(tmp_path / "streamed"), str(tmp_path / "progress")
    for _ in range(2):
        ingest.ingest_new_files(spark, lake.raw, target, progress, "b1").awaitTermination()
    assert texts(target) == want and spark.read.parquet(target).count() == 3
    other = tmp_path / "other"
    day_file(other, 2, [line(1, START + DAY, 1, 1, 1, 1, 1)])
    layers.run_bronze(spark, layers.Layout(lake.root, str(other)), "b2", reload_days=True)
    assert texts(lake.table("bronze.cdr_records")) == want
    assert sorted(r["batch_id"] for r in spark.read.parquet(lake.files).collect()) == ["b1", "b2"]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "n int, k string")
    sinks.write_micro_batch(first, target, 0, ["k"])
    assert sinks.write_micro_batch(first.where("n < 9"), target, 1, ["k"], top=F.max("n")) == {"top": 3}
    # Its first attempt had written other partitions.
    for _ in range(2):
        sinks.write_micro_batch(first.where("k = 'a'"), target, 1, ["k"])
        rows = sorted((r["n"], r["_micro_batch"]) for r in spark.read.parquet(target).collect())
        assert rows == [(1, 0), (1, 1), (2, 0), (3, 0)]


def test_labelled_files(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        ",".join(RAW_ACTIVITY.fieldNames()) + ",is_anomaly_injected,anomaly_type\n1,5,39,1,2,3,4,5,true,dead_zone\n")
    row = activity.read_labelled(spark, str(tmp_path / "l.csv")).first()
    assert row["is_anomaly_injected"] is True and row["internet"] == 5.0


def test_nothing_to_ingest(spark, tmp_path):
    assert layers.run_bronze(spark, layers.Layout(str(tmp_path / "lake"), str(tmp_path / "none")), "b1") is None
    assert activity.read_table_if_present(spark, str(tmp_path / "none")) is None


def test_all_layers(spark, layout):
    layers.run_all(spark, layout, "b1", as_of())
    read = lambda name: spark.read.parquet(layout.table(name))
    assert read("bronze.cdr_records").count() == 61
    assert read("silver.cdr_records").count() == read("silver.anomaly_scores").count() == 60
    assert read("gold.grid_heatmap").count() == 40
    assert read("gold.daily_country_usage").count() == 2
    assert read("gold.anomaly_summary").agg(F.sum("count")).first()[0] == 60
    lineage = {r["table"]: r for r in layers.lineage(spark, layout).where("layer = 'silver'").collect()}
    assert lineage["cdr_records"]["rows_before"] == 61 and lineage["cdr_records"]["dropped"] == 1
    assert lineage["cdr_records"]["suspicious_flagged"] == 20
    flows = {r["final"].split("/")[-1]: r["steps"] for r in
             governance.lineage_flow(layers.lineage(spark, layout)).collect()}
    assert flows == {"hourly_grid_activity": 3, "daily_country_usage": 3, "grid_heatmap": 3, "anomaly_summary": 4}
    document = layers.quality(spark, layout).first()
    assert document["overall_quality_score"] == 100.0
    assert document["validation_results"][0]["null_counts"]["country_code"] == 0
    report = spark.read.text(f"{layout.reports}/silver_quality_b1").collect()
    assert "### cdr_records — ✅ PASS" in [r[0] for r in report]
    facts = json.loads(spark.read.text(f"{layout.reports}/governance_facts_b1").first()[0])
    assert set(facts) == {"quality", "lineage", "anomaly", "gold", "missing"} and facts["missing"] == [] and facts["anomaly"][0]["total_records"] == 60
    entries = {r["table_name"]: r for r in spark.read.json(layout.catalog).collect()}
    assert entries["silver.cdr_records"]["row_count"] == 60
    assert entries["bronze.cdr_records"]["pii_columns"] == ["square_id"]
    assert {r["status"] for r in layers.sla_status(spark, layout).collect()} == {"met"}
    late = F.timestamp_seconds(F.unix_seconds(F.current_timestamp()) + 40 * 3600)
    assert {r["table_name"]: r["status"] for r in layers.sla_status(spark, layout, late).collect()}[
        "bronze.cdr_records"] == "breached"


def test_a_task_reads_few_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    raw, tasks = tmp_path / "raw", []
    for day in range(60):       # a partition each; by Spark's own settings a task would read seven of them
        day_file(raw, day, [line(s, START + day * DAY + s * 600_000, 1, 1, 1, 1, 1) for s in range(1, 8)])
    silver, settings = layers.cleaning.silver, ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in settings]

    def counted(records, *more):
        tasks.append(records.rdd.getNumPartitions())
        return silver(records, *more)

    monkeypatch.setattr(layers.cleaning, "silver", counted)
    monkeypatch.setattr(sinks, "FILE_ROWS", 5)
    lake = layers.Layout(str(tmp_path / "lake"), str(raw))
    layers.run_bronze(spark, lake, "b1")
    assert layers.run_silver(spark, lake, "b1", as_of())["rows_after"] == 420
    files = 120                 # seven rows a day: two files
    assert len(list((tmp_path / "lake" / "bronze").rglob("*.parquet"))) == files
    assert tasks == [files // 4]
    assert [spark.conf.get(name) for name in settings] == before


def test_a_reload_reads_and_writes_few_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    raw, again, tasks = tmp_path / "raw", tmp_path / "again", []
    for folder, days in ((raw, range(60)), (again, range(10, 50))):
        for day in days:
            day_file(folder, day, [line(s, START + day * DAY + s * 600_000, 1, 1, 1, 1, 1) for s in range(1, 8)])
    silver, later = layers.cleaning.silver, F.timestamp_seconds(F.lit((START + 90 * DAY) // 1000))

    def counted(records, *more):
        tasks.append(records.rdd.getNumPartitions())
        return silver(records, *more)

    monkeypatch.setattr(layers.cleaning, "silver", counted)
    monkeypatch.setattr(sinks, "FILE_ROWS", 5)
    reloaded = ("2024-01-11", "2024-02-19")
    first, second = (layers.Layout(str(tmp_path / "lake"), str(folder)) for folder in (raw, again))
    layers.run_bronze(spark, first, "b1")
    layers.run_silver(spark, first, "b1", later)
    layers.run_bronze(spark, second, "b2", reload_days=True)
    assert layers.run_silver(spark, second, "b2", later, reloaded)["rows_after"] == 280
    assert tasks == [120 // 4, 80 // 4]         # seven rows a day: two files, four of them a task
    states = layers.run_partials(spark, second, reloaded)
    assert states.agg(F.sum("record_count")).first()[0] == 280
    assert len(list((tmp_path / "lake" / "state").rglob("*.parquet"))) == 80


def test_a_single_day_is_replaced(spark, layout, tmp_path):
    layers.run_bronze(spark, layout, "b1")
    layers.run_silver(spark, layout, "b1", as_of())
    day_file(tmp_path / "new", 2, [line(1, START + DAY, 1, 1, 1, 1, 1)])
    again = layers.Layout(layout.root, str(tmp_path / "new"))
    assert layers.run_bronze(spark, again, "b2", reload_days=True) == 1
    stats = layers.run_silver(spark, again, "b2", as_of(), days=("2024-01-02", "2024-01-02"))
    assert stats["rows_before"] == stats["rows_after"] == 1
    per_day = spark.read.parquet(layout.table("silver.cdr_records")).groupBy("date").count().collect()
    assert {str(r["date"]): r["count"] for r in per_day} == {"2024-01-01": 40, "2024-01-02": 1}
    assert layers.quality(spark, again).first()["batch_id"] == "b2"
    history = governance.batch_history(layers.lineage(spark, again)).where("layer = 'bronze'").collect()
    assert {r["batch_id"]: r["rows"] for r in history} == {"b1": 61, "b2": 1}


def test_gold_without_scores_skips_the_summary(spark, layout):
    layers.run_bronze(spark, layout, "b1")
    layers.run_silver(spark, layout, "b1", as_of())
    counts = layers.run_gold(spark, layout, "b1")
    assert set(counts) == {"hourly_grid_activity", "daily_country_usage", "grid_heatmap"}
    for name, count in counts.items():
        assert spark.read.parquet(layout.table(f"gold.{name}")).count() == count
    assert layers.gold_metrics(spark, layout).where("metric = 'row_count'").count() == 3


def test_sorted_tables_are_counted_once(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "hash(id) AS h").repartition(6)
    assert sinks.write_table(df, str(tmp_path / "s"), sort_by=["h"]) == {"rows": 5000}
    hot = spark.range(3000).selectExpr("id", "id % 3 AS p")
    assert sinks.write_table(hot, str(tmp_path / "p"), partition_by="p", big=F.count_if(F.expr("id >= 1000"))) == {
        "rows": 3000, "big": 2000}


def test_stream_takes_each_file_once(spark, tmp_path, layout):
    target, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")
    run = lambda batch: ingest.ingest_new_files(spark, layout.raw, target, progress, batch).awaitTermination()
    run("b1")
    assert spark.read.parquet(target).count() == 61
    day_file(tmp_path / "raw", 3, [line(1, START + 2 * DAY, 1, 1, 1, 1, 1)])
    run("b2")
    run("b3")
    per_batch = {r["_batch_id"]: r["count"] for r in spark.read.parquet(target).groupBy("_batch_id").count().collect()}
    assert per_batch == {"b1": 61, "b2": 1}
    with pytest.raises(ValueError, match="written by a stream"):
        sinks.write_table(spark.read.parquet(target), target, partition_by="_date_partition", only_given_partitions=True)
    assert spark.read.parquet(target).count() == 62


def test_lineage_depth_and_cycles(spark):
    tables = spark.createDataFrame(
        [("raw", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("raw", "z"),
         ("in", "p"), ("p", "q"), ("q", "p"), ("x", "y"), ("y", "x")], "source string, target string")
    flows = {(r["flow"], r["steps"], r["cycle"]) for r in governance.lineage_flow(tables).collect()}
    assert flows == {("raw > z", 1, False), ("raw > a > b > c > d > e > f", 6, False),
                     ("in > p > q > p", 3, True), ("x > y > x", 2, True)}


def test_metrics_of_missing_and_empty_tables(spark):
    empty = spark.createDataFrame([], "country_code int, date date, total_internet double")
    rows = governance.gold_metrics(None, empty, None).collect()
    assert {r["metric"]: r["value"] for r in rows} == {
        "row_count": 0.0, "total_internet": 0.0, "unique_countries": 0.0, "active_days": 0.0, "columns": 3.0}


# ---------------------------------------------------------------- commerce

def shop(spark):
    orders = spark.createDataFrame(
        [(1, 10, 100.0, "2024-01-01"), (2, 10, -5.0, "2024-01-01"), (3, 99, 5000.0, "2024-01-02"),
         (4, 11, 120.0, "2030-01-01"), (5, None, 110.0, None)],
        "o_orderkey long, o_custkey long, o_totalprice double, d string",
    ).selectExpr("o_orderkey", "o_custkey", "o_totalprice", "CAST(d AS TIMESTAMP) AS o_orderdate")
    lines = spark.createDataFrame(
        [(1, 7, 2.0, 50.0, 0.1), (1, 8, 1.0, 50.0, 0.0), (2, 7, 0.0, 10.0, 0.0), (3, 7, 1.0, 20.0, 0.5),
         (1, 7, 1.0, 30.0, 0.0)],
        "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double")
    parts = spark.createDataFrame([(7, "A", "PROMO"), (8, "B", "SMALL"), (9, "B", "SMALL")],
                                  "p_partkey long, p_brand string, p_type string")
    customers = spark.createDataFrame([(10,), (11,), (11,)], "c_custkey long")
    return orders, lines, parts, customers


def test_revenue_and_performance(spark):
    orders, lines, parts, _ = shop(spark)
    rows = {(str(r["order_date"]), r["category"]): r for r in commerce.daily_revenue(orders, lines, parts).collect()}
    first = rows["2024-01-01", "PROMO"]
    assert (first["gross_revenue"], first["net_revenue"], first["order_count"]) == (90.0, 85.0, 2)
    assert len(rows) == 3
    sold = {r["p_brand"]: r for r in commerce.product_performance(lines, parts).collect()}
    assert sold["A"]["units_sold"] == 4.0 and sold["A"]["line_count"] == 4
    assert sold["A"]["avg_discount"] == pytest.approx(0.15) and sold["B"]["parts_sold"] == 1
    assert {r["category"]: r["net_revenue"] for r in commerce.sales_by_category(lines, parts).collect()} == {
        "PROMO": 95.0, "SMALL": 50.0}


def test_order_flags_and_risk(spark):
    orders, lines, _, customers = shop(spark)
    flagged = commerce.flag_orders(orders, lines, customers, as_of(), 10.0)
    rows = {r["o_orderkey"]: [r[f] for f in commerce.ORDER_FLAGS] for r in flagged.collect()}
    assert rows == {
        1: [False] * 5, 2: [True, False, False, True, False], 3: [False, False, True, False, True],
        4: [False, True, False, False, False], 5: [False, False, False, False, True]}
    risk = {r["flag"]: (r["order_count"], r["amount"]) for r in commerce.amount_at_risk(flagged).collect()}
    assert risk["_is_orphan_customer"] == (2, 5110.0) and risk["any_flag"] == (4, 5225.0)
    assert [r["o_orderkey"] for r in commerce.orphans(orders, "o_custkey", customers, "c_custkey").collect()] == [3]
    checked = commerce.referential_integrity([("x", orders, "o_custkey", customers, "c_custkey")]).first()
    assert (checked["child_rows"], checked["orphan_rows"]) == (4, 1)


def test_customer_value(spark):
    orders = spark.createDataFrame([(i, i % 8, float(i % 8)) for i in range(80)],
                                   "o_orderkey long, o_custkey long, o_totalprice double"
                                   ).withColumn("o_orderdate", F.lit("2024-01-01").cast("timestamp"))
    ltv = commerce.customer_ltv(orders)
    tiers = {r["o_custkey"]: r["ltv_tier"] for r in ltv.collect()}
    assert [tiers[i] for i in range(8)] == ["Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold",
                                            "Platinum", "Platinum"]
    assert {r["ltv_tier"]: r["count"] for r in commerce.ltv_tier_rollup(ltv).collect()} == {
        "Bronze": 2, "Silver": 2, "Gold": 2, "Platinum": 2}
    assert [r["o_custkey"] for r in commerce.top_customers(orders, 2).collect()] == [7, 6]
    copies = commerce.duplicate_summary([("o", orders, ["o_custkey"])]).first()
    assert (copies["rows_before"], copies["rows_after"], copies["dropped"]) == (80, 8, 72)


def test_activity_columns_are_all_known():
    assert sorted(activity.EVENT_COLUMNS.values()) == sorted(ACTIVITY)
