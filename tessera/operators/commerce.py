"""Star-schema operators: revenue, customer value, product performance, order checks.

Fact rows are summed on the join key before or right after each join, so that one
order, part or customer holding a large share of the rows reaches a shuffle as
partial sums. Dimensions are not hinted: Spark broadcasts one if its measured
size is below the limit and joins by shuffle, with skew splitting, if not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.order_stats import exact_percentiles, tier_by_percent_rank
from tessera.operators.rules import Rule

# ---- fixed values: tiers by percent rank of lifetime value ----
LTV_TIERS = [(0.75, "Platinum"), (0.50, "Gold"), (0.25, "Silver")]
LTV_LOWEST = "Bronze"

ORDER_RULES = [
    Rule("o_orderkey", "int", ("at_least", 0), nullable=False),
    Rule("o_custkey", "int", nullable=False),
    Rule("o_orderstatus", "string", ("one_of", "F", "O", "P")),
    Rule("o_totalprice", "float", ("at_least", 0)),
    Rule("o_orderpriority", "string",
         ("one_of", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
]
CUSTOMER_RULES = [
    Rule("c_custkey", "int", nullable=False),
    Rule("c_name", "string", nullable=False),
    Rule("c_mktsegment", "string",
         ("one_of", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    Rule("c_acctbal", "float", ("at_least", 0)),
]
PRODUCT_RULES = [
    Rule("p_partkey", "int", nullable=False),
    Rule("p_type", "string", nullable=False),
    Rule("p_retailprice", "float", ("greater_than", 0)),
    Rule("p_size", "int", ("in_range", 1, 50)),
]
LINE_RULES = [
    Rule("l_orderkey", "int", nullable=False),
    Rule("l_quantity", "float", ("greater_than", 0)),
    Rule("l_discount", "float", ("in_range", 0, 1)),
    Rule("l_extendedprice", "float", ("at_least", 0)),
]


def _net() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def daily_revenue(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Revenue before and after discount, and orders, per order day and category.

    Raw lines meet the part for its category; they are summed per order and category
    before they meet their order, which also makes the number of orders a plain count.
    """
    per_order = (
        lineitem.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "p_type")
        .agg(F.sum("l_extendedprice").alias("gross"), F.sum(_net()).alias("net"))
    )
    dates = orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    return (
        per_order.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("order_date", F.col("p_type").alias("category"))
        .agg(
            F.sum("gross").alias("gross_revenue"),
            F.sum("net").alias("net_revenue"),
            F.count(F.lit(1)).alias("order_count"),
        )
    )


def customer_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("lifetime_value"),
        F.count(F.lit(1)).alias("order_count"),
        F.min(F.to_date("o_orderdate")).alias("first_order"),
        F.max(F.to_date("o_orderdate")).alias("last_order"),
    )


def customer_ltv(orders: DataFrame) -> DataFrame:
    """Lifetime value per ordering customer and its tier; equal values share a tier."""
    return tier_by_percent_rank(customer_totals(orders), "lifetime_value", LTV_TIERS, LTV_LOWEST, "ltv_tier")


def ltv_tier_rollup(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("ltv_tier").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("lifetime_value").alias("mean"),
        F.sum("lifetime_value").alias("sum"),
    )


def _per_part(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_partkey").agg(
        F.sum("l_extendedprice").alias("gross"),
        F.sum(_net()).alias("net"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_discount").alias("discount"),
        F.count(F.lit(1)).alias("lines"),
    )


def product_performance(lineitem: DataFrame, part: DataFrame,
                        by: tuple[str, ...] = ("p_brand", "p_type")) -> DataFrame:
    """Revenue, quantity and mean discount per brand and category.

    Lines are summed per part first, so the join sees each part once.
    """
    products = part.select("p_partkey", *by)
    return (
        _per_part(lineitem)
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(*by)
        .agg(
            F.sum("gross").alias("gross_revenue"),
            F.sum("net").alias("net_revenue"),
            F.sum("quantity").alias("units_sold"),
            (F.sum("discount") / F.sum("lines")).alias("avg_discount"),
            F.sum("lines").alias("line_count"),
            F.count(F.lit(1)).alias("parts_sold"),
        )
    )


def sales_by_category(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return product_performance(lineitem, part, ("p_type",)).select(
        F.col("p_type").alias("category"), "net_revenue", "units_sold", "line_count"
    )


def top_customers(orders: DataFrame, n: int = 10) -> DataFrame:
    totals = customer_totals(orders)
    return totals.orderBy(F.round("lifetime_value", 6).desc(), "o_custkey").limit(n)


# ---------------------------------------------------------------- order checks

def flag_orders(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, as_of: Column | None = None,
                extreme_factor: float = 10.0) -> DataFrame:
    """Orders with five quality flags; no row is dropped.

    Extreme means above ``extreme_factor`` times the median amount. Both lookups
    hold each key once, so the joins neither multiply rows nor need the orders
    of one customer in one task.
    """
    now = F.current_timestamp() if as_of is None else as_of
    median = exact_percentiles(orders, "o_totalprice", [0.5])[0]
    amount = F.col("o_totalprice")
    extreme = F.lit(False) if median is None else F.coalesce(amount > F.lit(extreme_factor * median), F.lit(False))
    empty_lines = (
        lineitem.where(F.col("l_quantity") <= 0)
        .select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("_zero", F.lit(True))
    )
    known = customer.select(F.col("c_custkey").alias("o_custkey")).distinct().withColumn("_known", F.lit(True))
    return (
        orders.join(empty_lines, "o_orderkey", "left")
        .join(known, "o_custkey", "left")
        .withColumns(
            {
                "_is_negative_amount": F.coalesce(amount < 0, F.lit(False)),
                "_is_future_order": F.coalesce(F.col("o_orderdate").cast("timestamp") > now, F.lit(False)),
                "_is_extreme_amount": extreme,
                "_has_zero_quantity": F.coalesce("_zero", F.lit(False)),
                "_is_orphan_customer": F.col("_known").isNull(),
            }
        )
        .select(*orders.columns, *ORDER_FLAGS)
    )


ORDER_FLAGS = ["_is_negative_amount", "_is_future_order", "_is_extreme_amount",
               "_has_zero_quantity", "_is_orphan_customer"]


def amount_at_risk(flagged: DataFrame) -> DataFrame:
    """Orders and money per flag, and for orders with any flag; one pass."""
    tests = {name: F.col(name) for name in ORDER_FLAGS}
    tests["any_flag"] = reduce(Column.__or__, [F.col(name) for name in ORDER_FLAGS])
    measured = flagged.agg(
        *[m for i, test in enumerate(tests.values()) for m in (
            F.count_if(test).alias(f"n_{i}"),
            F.coalesce(F.sum(F.when(test, F.col("o_totalprice"))), F.lit(0.0)).alias(f"sum_{i}"),
        )]
    )
    rows = [
        F.struct(F.lit(name).alias("flag"), F.col(f"n_{i}").alias("order_count"), F.col(f"sum_{i}").alias("amount"))
        for i, name in enumerate(tests)
    ]
    return measured.select(F.inline(F.array(*rows)))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    keys = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(keys, key, "left_anti").select(*child.columns)


def referential_integrity(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Child rows and orphan rows of each relation.

    Children are counted per key before the join, so a key with very many
    children is one row in it.
    """
    parts = []
    for name, child, key, parent, parent_key in relations:
        counted = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("n"))
        keys = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_known", F.lit(True))
        parts.append(
            counted.join(keys, "_key", "left").agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
                F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(name).alias("relation"), "child_rows", "orphan_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def duplicate_summary(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Rows, distinct natural keys and surplus copies of each table."""
    parts = []
    for name, df, key in tables:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
            ).select(
                F.lit(name).alias("table_name"), "rows_before", "rows_after",
                (F.col("rows_before") - F.col("rows_after")).alias("dropped"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
