import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import commerce, report, rules
from tessera.operators.rules import Rule
from tessera.schema import NATURAL_KEY


def test_every_kind_of_violation(spark):
    df = spark.createDataFrame(
        [(1, "5", 0.0, "a", True), (None, "x", -1.0, "z'q", False), (11, None, math.nan, None, None)],
        "id int, text string, amount double, word string, flag boolean",
    )
    ruleset = [
        Rule("id", "int", ("in_range", 1, 10), nullable=False),
        Rule("text", "int", ("greater_than", 0)),
        Rule("amount", "float", ("at_least", 0)),
        Rule("amount", "float", nullable=False),
        Rule("word", "string", ("one_of", "a", "z'q")),
        Rule("flag", "boolean"),
        Rule("absent", "int"),
    ]
    rows = rules.checks(df, ruleset, "t").collect()
    assert [(r["column_name"], r["failed_rows"], r["passed"]) for r in rows] == [
        ("id", 2, False), ("text", 1, False), ("amount", 1, False), ("amount", 1, False),
        ("word", 0, True), ("flag", 0, True), ("absent", 3, False)]
    result = rules.validate(df, ruleset[:2] + ruleset[4:], "t", ["flag"]).first()
    assert (result["checks_total"], result["checks_passed"], result["passed"]) == (5, 2, False)
    assert [f.split(":")[0] for f in result["failures"]] == ["id", "text", "absent"]
    assert result["null_counts"]["text"] == 1 and result["duplicate_count"] == 0


def test_unknown_test_is_refused():
    with pytest.raises(ValueError):
        Rule("a", "int", ("odd",)).broken_sql()


def test_empty_table_passes_unless_a_column_is_missing(spark):
    empty = spark.createDataFrame([], "id int")
    assert rules.validate(empty, [Rule("id", "int", nullable=False)], "t", ["id"]).first()["passed"]
    assert not rules.validate(empty, [Rule("other", "int")], "t", ["id"]).first()["passed"]


def test_all_copies_of_a_key_are_counted(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, None), (2, 1, None), (3, 1, 1)],
                               "square_id int, time_interval long, country_code int")
    assert rules.duplicate_count(df, NATURAL_KEY).first()[0] == 5
    check = rules.uniqueness_check(df, "square_id", "t").first()
    assert (check["failed_rows"], check["passed"]) == (5, False)
    assert {r["column_name"]: r["null_count"] for r in rules.null_counts(df).collect()} == {
        "square_id": 0, "time_interval": 0, "country_code": 2}


def test_score_and_bands(spark):
    results = spark.createDataFrame([(10, 10), (5, 10), (0, 0)], "checks_passed long, checks_total long")
    row = rules.quality_score(results).first()
    assert (row["quality_score"], row["band"]) == (50.0, "red")
    assert tuple(rules.quality_score(results.where("false")).first()) == (0.0, "red")
    bands = spark.createDataFrame([(90.0,), (89.9,), (70.0,), (69.9,)], "s double").select(rules.band(F.col("s")))
    assert [r[0] for r in bands.collect()] == ["green", "amber", "amber", "red"]


def orders(spark, **changes):
    row = {"o_orderkey": 1, "o_custkey": 2, "o_orderstatus": "F", "o_totalprice": 5.0,
           "o_orderpriority": "2-HIGH", **changes}
    return spark.createDataFrame([row], "o_orderkey long, o_custkey long, o_orderstatus string, "
                                        "o_totalprice double, o_orderpriority string")


def test_order_rules(spark):
    good = rules.validate(orders(spark), commerce.ORDER_RULES, "orders", ["o_orderkey"]).first()
    assert good["passed"] and good["checks_passed"] == good["checks_total"]
    bad = rules.validate(orders(spark, o_orderstatus="INVALID"), commerce.ORDER_RULES, "orders", ["o_orderkey"]).first()
    assert not bad["passed"]


def test_product_price_must_be_positive(spark):
    part = spark.createDataFrame([(1, "PROMO", -10.0, 5)],
                                 "p_partkey long, p_type string, p_retailprice double, p_size int")
    rows = rules.checks(part, commerce.PRODUCT_RULES, "part").where("NOT passed").collect()
    assert [r["column_name"] for r in rows] == ["p_retailprice"]


def test_report_document_and_lines(spark):
    stats = spark.createDataFrame([("orders", 1000, 990, 10, 5)],
                                  "table string, rows_before long, rows_after long, dropped long, "
                                  "suspicious_flagged long")
    results = spark.createDataFrame(
        [("orders", True, 5, 5, [], {"a": 0}, 990, 0), ("parts", False, 4, 2, ["x: bad", "y: bad"], {}, 1234, 2)],
        "table string, passed boolean, checks_total long, checks_passed long, failures array<string>, "
        "null_counts map<string,bigint>, row_count long, duplicate_count long")
    document = report.quality_document("silver", "TEST_001", stats, results.where("passed"), F.lit("now"))
    assert document.first()["overall_quality_score"] == 100.0
    both = report.quality_document("silver", "TEST_002", stats, results, F.lit("now"))
    lines = [r["line"] for r in report.markdown(both).orderBy("line_no").collect()]
    assert lines[0] == "# Data Quality Report — SILVER Layer"
    assert lines[3] == "## Overall Quality Score: 🟡 75.0%"
    assert "| orders | 1,000 | 990 | 10 | 5 suspicious |" in lines
    assert "### orders — ✅ PASS" in lines and "### parts — ❌ FAIL" in lines
    assert lines[lines.index("### parts — ❌ FAIL"):] == [
        "### parts — ❌ FAIL", "- Checks: 2/4 passed", "- Rows: 1,234 | Duplicates: 2",
        "- **Failures:**", "  - `x: bad`", "  - `y: bad`", ""]
    latest = report.latest_documents(document.unionByName(both)).collect()
    assert [r["batch_id"] for r in latest] == ["TEST_002"]


def test_nulls_of_columns_without_rules(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "id int, more string, other string")
    got = rules.validate(df, [Rule("id", "int"), Rule("gone", "int")], "t", ["id"]).first()["null_counts"]
    assert got == {"id": 0, "gone": 2, "more": 2, "other": 1}


def test_two_rules_on_one_column(spark):
    df = spark.createDataFrame([(1, None), (5, "x"), (None, "y")], "a int, b string")
    both = [rules.Rule("a", "int", ("at_least", 2)), rules.Rule("a", "int", nullable=False), rules.Rule("b", "string")]
    row = rules.validate(df, both, "t", ["a"]).first()
    assert row["checks_total"] == 3 and row["checks_passed"] == 1
    assert row["null_counts"] == {"a": 1, "b": 1}
