"""Declarative column rules, checked for a whole table in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.activity import number_sql, string_sql
from tessera.schema import NATURAL_KEY

_CASTS = {"int": "bigint", "float": "double", "string": "string", "boolean": "boolean"}


def _bound(value: float | int) -> str:
    """Whole numbers as they are; others, infinities among them, as exact doubles."""
    return str(value) if isinstance(value, int) else number_sql(value)


@dataclass(frozen=True)
class Rule:
    """Type, range and nullability of one column.

    ``test`` is None or one of ``("in_range", low, high)``, ``("greater_than", x)``,
    ``("at_least", x)``, ``("one_of", a, b, ...)``.
    """

    column: str
    dtype: str
    test: tuple | None = None
    nullable: bool = True

    @property
    def text(self) -> str:
        parts = [self.dtype]
        if self.test:
            parts.append(f"{self.test[0]}({', '.join(str(a) for a in self.test[1:])})")
        if not self.nullable:
            parts.append("not_null")
        return " ".join(parts)

    def broken_sql(self) -> str:
        """True, never null, where the row breaks the rule. NaN counts as missing."""
        name = f"`{self.column}`"
        value, missing = f"try_cast({name} AS {_CASTS[self.dtype]})", f"{name} IS NULL"
        if self.dtype == "float":
            missing += f" OR coalesce(isnan({value}), false)"
        kind, *args = self.test or (None,)
        if kind is None:
            holds = "true"
        elif kind == "in_range":
            holds = f"{value} BETWEEN {_bound(args[0])} AND {_bound(args[1])}"
        elif kind == "greater_than":
            holds = f"{value} > {_bound(args[0])}"
        elif kind == "at_least":
            holds = f"{value} >= {_bound(args[0])}"
        elif kind == "one_of":
            holds = f"{value} IN ({', '.join(string_sql(a) if isinstance(a, str) else str(a) for a in args)})"
        else:
            raise ValueError(f"unknown test {kind}")
        return (
            f"CASE WHEN {missing} THEN {str(not self.nullable).lower()} "
            f"WHEN {value} IS NULL THEN true ELSE NOT ({holds}) END"
        )


# ---- fixed values: the rules of the silver activity table ----
ACTIVITY_RULES = [
    Rule("square_id", "int", ("in_range", 1, 10_000), nullable=False),
    Rule("time_interval", "int", ("greater_than", 0), nullable=False),
    Rule("country_code", "int"),
    Rule("sms_in", "float", ("at_least", 0)),
    Rule("sms_out", "float", ("at_least", 0)),
    Rule("call_in", "float", ("at_least", 0)),
    Rule("call_out", "float", ("at_least", 0)),
    Rule("internet", "float", ("at_least", 0)),
    Rule("hour_of_day", "int", ("in_range", 0, 23)),
    Rule("day_of_week", "int", ("in_range", 1, 7)),
]


def _others(df: DataFrame, rules: list[Rule]) -> list[str]:
    ruled = {rule.column for rule in rules}
    return [c for c in df.columns if c not in ruled]


def _measured(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: the row count, per rule the violations and nulls, and the nulls of columns without rules."""
    have = set(df.columns)
    measures = ["count(1) AS row_count"]
    for i, rule in enumerate(rules):
        there = rule.column in have
        measures.append(f"{f'count_if({rule.broken_sql()})' if there else 'count(1)'} AS failed_{i}")
        measures.append(f"{f'count_if(`{rule.column}` IS NULL)' if there else 'count(1)'} AS null_{i}")
    measures += [f"count_if(`{c}` IS NULL) AS other_{i}" for i, c in enumerate(_others(df, rules))]
    return df.selectExpr(*measures)


def _passed_sql(df: DataFrame, rules: list[Rule], i: int) -> str:
    # A missing column fails even where the table is empty.
    return f"(failed_{i} = 0)" if rules[i].column in df.columns else "false"


def checks(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """One row per rule."""
    rows = [
        f"struct({string_sql(table)} AS table_name, {string_sql(rule.column)} AS column_name, "
        f"{string_sql(rule.text)} AS rule, failed_{i} AS failed_rows, null_{i} AS null_rows, "
        f"{_passed_sql(df, rules, i)} AS passed)"
        for i, rule in enumerate(rules)
    ]
    return _measured(df, rules).selectExpr(f"inline(array({', '.join(rows)}))")


def uniqueness_check(df: DataFrame, column: str, table: str) -> DataFrame:
    """The same kind of row for a uniqueness rule: all members of repeated values fail."""
    failed = duplicate_count(df, [column]).scalar()
    return df.agg(F.count_if(F.col(column).isNull()).alias("null_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("rule"),
        failed.alias("failed_rows"),
        "null_rows",
        (failed == 0).alias("passed"),
    )


def duplicate_count(df: DataFrame, key: list[str] = NATURAL_KEY) -> DataFrame:
    """Rows whose key occurs more than once, all copies counted.

    Copies are counted in the map tasks, so a key repeated very often is shuffled
    as one row per task.
    """
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row per column, from one pass."""
    counted = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS `{c}`" for c in df.columns])
    rows = [f"struct({string_sql(c)} AS column_name, `{c}` AS null_count)" for c in df.columns]
    return counted.selectExpr(f"inline(array({', '.join(rows)}))")


def validate(df: DataFrame, rules: list[Rule], table: str, key: list[str] = NATURAL_KEY) -> DataFrame:
    """One result row per table: totals, failure texts, nulls per column, duplicates."""
    passed = [_passed_sql(df, rules, i) for i in range(len(rules))]
    tally = " + ".join(f"CAST({p} AS BIGINT)" for p in passed)
    texts = ", ".join(
        f"CASE WHEN NOT {p} THEN {string_sql(f'{r.column}: {r.text}')} END" for p, r in zip(passed, rules))
    # Once per column, however many rules it has.
    places = {r.column: f"null_{i}" for i, r in enumerate(rules)} | {
        c: f"other_{i}" for i, c in enumerate(_others(df, rules))}
    nulls = ", ".join(f"{string_sql(c)}, {place}" for c, place in places.items())
    return _measured(df, rules).select(
        F.lit(table).alias("table"),
        F.expr(f"({tally}) = {len(rules)}").alias("passed"),
        F.lit(len(rules)).cast("bigint").alias("checks_total"),
        F.expr(tally).alias("checks_passed"),
        F.expr(f"array_compact(array({texts}))").alias("failures"),
        F.expr(f"map({nulls})").alias("null_counts"),
        "row_count",
        duplicate_count(df, key).scalar().alias("duplicate_count"),
    )


def mean_score() -> Column:
    """Mean share of passed checks in percent; 0 without results."""
    share = F.coalesce(F.try_divide(F.col("checks_passed"), F.col("checks_total")), F.lit(0.0))
    return F.coalesce(F.round(F.avg(share) * 100, 1), F.lit(0.0))


def quality_score(results: DataFrame) -> DataFrame:
    """The score over all tables and its colour."""
    return results.agg(mean_score().alias("quality_score")).withColumn("band", band(F.col("quality_score")))


def band(score: Column) -> Column:
    return F.when(score >= 90, "green").when(score >= 70, "amber").otherwise("red")
