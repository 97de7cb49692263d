"""Quality reports as documents and as Markdown lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.operators.rules import band, mean_score
from tessera.schema import QUALITY_DOCUMENT


def quality_document(layer: str, batch_id: str, stats: DataFrame, results: DataFrame,
                     generated_at: Column | None = None) -> DataFrame:
    """One row holding the score, the table statistics and the validation results.

    ``stats`` and ``results`` have one row per table, so the collected arrays are
    as long as the list of tables. Each is evaluated once.
    """
    when = F.current_timestamp().cast("string") if generated_at is None else generated_at
    element = {n: QUALITY_DOCUMENT[n].dataType.elementType for n in ("table_stats", "validation_results")}

    def packed(name: str) -> Column:
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in element[name]]
        by_table = lambda a, b: F.when(a["table"] < b["table"], -1).when(a["table"] > b["table"], 1).otherwise(0)
        return F.array_sort(F.collect_list(F.struct(*fields)), by_table)

    statistics = stats.agg(packed("table_stats").alias("rows")).scalar()
    return results.agg(
        mean_score().alias("overall_quality_score"), packed("validation_results").alias("validation_results")
    ).select(
        F.lit(layer).alias("layer"),
        F.lit(batch_id).alias("batch_id"),
        when.alias("generated_at"),
        "overall_quality_score",
        statistics.alias("table_stats"),
        "validation_results",
    )


def latest_documents(documents: DataFrame) -> DataFrame:
    """The newest document of each layer, by batch id; of one batch the one generated last."""
    everything = F.struct(*documents.columns)
    return documents.groupBy("layer").agg(F.max_by(everything, F.struct("batch_id", "generated_at")).alias("d")).select("d.*")


def markdown(documents: DataFrame) -> DataFrame:
    """Report lines of each document, numbered.

    A document lists tables and failed checks, so its lines are few; they are
    numbered per document.
    """
    line = lambda section, table, item, text: F.struct(
        F.lit(section).alias("section"), table.alias("table"), F.lit(item).alias("item"), text.alias("line")
    )
    none = F.lit("")
    number = lambda c: F.when(c.isNull(), "N/A").otherwise(F.format_string("%,d", c))
    score = F.col("overall_quality_score")
    # The marks and the wording of the report.
    mark = (
        F.when(band(score) == "green", "🟢").when(band(score) == "amber", "🟡").otherwise("🔴")
    )
    head = F.array(
        line(0, none, 0, F.format_string("# Data Quality Report — %s Layer", F.upper("layer"))),
        line(0, none, 1, F.format_string("**Batch:** `%s`  |  **Generated:** %s", "batch_id", "generated_at")),
        line(0, none, 2, F.lit("")),
        line(0, none, 3, F.format_string("## Overall Quality Score: %s %s%%", mark, score.cast("string"))),
        line(0, none, 4, F.lit("")),
        line(0, none, 5, F.lit("## Table Statistics")),
        line(0, none, 6, F.lit("")),
        line(0, none, 7, F.lit("| Table | Rows Before | Rows After | Dropped | Notes |")),
        line(0, none, 8, F.lit("|-------|-------------|------------|---------|-------|")),
    )
    note = lambda s: F.when(
        F.coalesce(s["suspicious_flagged"], F.lit(0)) > 0,
        F.format_string("%d suspicious", s["suspicious_flagged"]),
    ).otherwise("")
    stats = F.transform(
        "table_stats",
        lambda s: line(1, s["table"], 0, F.format_string(
            "| %s | %s | %s | %d | %s |", s["table"], number(s["rows_before"]), number(s["rows_after"]),
            F.coalesce(s["dropped"], F.lit(0)), note(s))),
    )
    title = F.array(
        line(2, none, 0, F.lit("")),
        line(2, none, 1, F.lit("## Schema Validation Results")),
        line(2, none, 2, F.lit("")),
    )

    def result_lines(r: Column) -> Column:
        status = F.when(r["passed"], "✅ PASS").otherwise("❌ FAIL")
        first = F.array(
            line(3, r["table"], 0, F.format_string("### %s — %s", r["table"], status)),
            line(3, r["table"], 1, F.format_string(
                "- Checks: %d/%d passed", r["checks_passed"], r["checks_total"])),
            line(3, r["table"], 2, F.format_string(
                "- Rows: %,d | Duplicates: %d", r["row_count"], r["duplicate_count"])),
        )
        failures = F.when(
            F.size(r["failures"]) > 0,
            F.concat(
                F.array(line(3, r["table"], 3, F.lit("- **Failures:**"))),
                F.transform(r["failures"], lambda f: line(3, r["table"], 4, F.format_string("  - `%s`", f))),
            ),
        ).otherwise(F.filter(first, lambda _: F.lit(False)))
        return F.concat(first, failures, F.array(line(3, r["table"], 5, F.lit(""))))

    body = F.concat(head, stats, title, F.flatten(F.transform("validation_results", result_lines)))
    numbered = documents.select("layer", "batch_id", F.posexplode(body).alias("at", "l"))
    return numbered.select("layer", "batch_id", (F.col("at") + 1).alias("line_no"), F.col("l.line").alias("line"))
