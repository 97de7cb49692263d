"""The same queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

from tessera.operators.governance import CATALOG

_ACTIVITY = ["sms_in", "sms_out", "call_in", "call_out", "internet"]
_EVENTS = {"sms_in": "click", "sms_out": "view", "call_in": "purchase", "call_out": "signup", "internet": "error"}
_KEY = "square_id, time_interval, country_code"
_FLAGS = "_has_negative_activity, _is_future_timestamp, _is_null_activity"


def _each(template: str, separator: str = ", ") -> str:
    return separator.join(template.replace("{c}", c).replace("{e}", _EVENTS[c]).replace("{i}", str(i))
                          for i, c in enumerate(_ACTIVITY))


def _lane(position: int) -> str:
    return f"CAST(concat('0x', substr(digest, {position}, 8)) AS BIGINT)"


_RECORDS = f"""
records AS (
  SELECT CAST(user_id % 10000 + 1 AS INTEGER) AS square_id,
         epoch_ms(ts) - epoch_ms(ts) % 600000 AS time_interval,
         CAST(user_id % 7 + 39 AS INTEGER) AS country_code,
         {_each("CASE WHEN event_type = '{e}' THEN value END AS {c}")}
  FROM events)"""

_ARRIVED = f"""{_RECORDS},
cells AS (SELECT {_KEY}, {_each("sum({c}) AS {c}")} FROM records GROUP BY {_KEY}),
arrived AS (
  SELECT *, CAST(make_timestamp(time_interval * 1000) AS DATE) AS date,
         square_id % 7 = 3 AND day(make_timestamp(time_interval * 1000)) <= 4 AS held
  FROM cells)"""

_INJECTED = f"""{_RECORDS},
digests AS (
  SELECT *, md5(concat_ws('|', CAST(square_id AS VARCHAR), CAST(time_interval AS VARCHAR),
                          CAST(country_code AS VARCHAR), '42')) AS digest
  FROM records),
draws AS (
  SELECT *, {_lane(1)} % 10000 < 500 AS chosen, {_lane(9)} % 100 AS pct, {_lane(17)} AS size, {_lane(25)} AS pick
  FROM digests),
kinds AS (
  SELECT *, CASE WHEN NOT chosen THEN NULL WHEN pct < 35 THEN 'activity_spike' WHEN pct < 55 THEN 'dead_zone'
                 WHEN pct < 75 THEN 'negative_activity' WHEN pct < 90 THEN 'future_timestamp'
                 ELSE 'null_activity' END AS anomaly_type
  FROM draws),
injected AS (
  SELECT square_id,
         CASE WHEN anomaly_type = 'future_timestamp' THEN 1735689600000 + (size % 52560) * 600000
              ELSE time_interval END AS time_interval,
         country_code,
         {_each('''CASE WHEN anomaly_type = 'activity_spike' THEN {c} * CAST(size % 36 + 15 AS DOUBLE)
              WHEN anomaly_type = 'dead_zone' THEN 0e0
              WHEN anomaly_type = 'negative_activity' AND pick % 5 = {i} THEN -CAST(size % 120 + 1 AS DOUBLE)
              WHEN anomaly_type = 'null_activity' THEN NULL ELSE {c} END AS {c}''')},
         chosen AS is_anomaly_injected, anomaly_type
  FROM kinds)"""


def _flagged(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {_KEY}, {_each("greatest(coalesce({c}, 0e0), 0e0) AS {c}")},
         CAST(date_part('hour', make_timestamp(time_interval * 1000)) AS INTEGER) AS hour_of_day,
         CAST(date_part('dayofweek', make_timestamp(time_interval * 1000)) + 1 AS INTEGER) AS day_of_week,
         CAST(make_timestamp(time_interval * 1000) AS DATE) AS date,
         {_each("coalesce({c} < 0, false)", " OR ")} AS _has_negative_activity,
         time_interval > 1706745600000 AS _is_future_timestamp,
         {_each("{c} IS NULL", " AND ")} AS _is_null_activity
  FROM {source})"""


_DEDUPED = f"""{_INJECTED},
copies AS (
  SELECT *, row_number() OVER (PARTITION BY {_KEY}
                               ORDER BY {_each("{c} ASC NULLS LAST")}, is_anomaly_injected, anomaly_type) AS copy
  FROM injected),
deduped AS (SELECT * FROM copies WHERE copy = 1)"""

_SILVER = f"{_DEDUPED},{_flagged('silver', 'deduped')}"
_SILVER_COLUMNS = (f"{_KEY}, {', '.join(_ACTIVITY)}, hour_of_day, day_of_week, "
                   f"CAST(date AS VARCHAR) AS date, {_FLAGS}")
_ANY = "(_has_negative_activity OR _is_future_timestamp OR _is_null_activity)"

_FEATURE_NAMES = [f"{c}_norm" for c in [*_ACTIVITY, "hour_of_day", "day_of_week"]]
_F = [*_ACTIVITY, "hour_of_day / 23e0", "day_of_week / 6e0"]
_MODEL = f"""{_SILVER},
x AS (SELECT *, {', '.join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(_F))} FROM silver),
fitted AS (
  SELECT count(*) AS n,
         {', '.join(f"avg(x{i}) AS m{i}, CASE WHEN stddev_pop(x{i}) = 0 THEN 1e0 ELSE stddev_pop(x{i}) END AS s{i}"
                    for i in range(7))}
  FROM x WHERE NOT {_ANY}),
errors AS (
  SELECT x.*, ({' + '.join(f"((x{i} - m{i}) / s{i}) * ((x{i} - m{i}) / s{i})" for i in range(7))}) / 7e0
              AS reconstruction_error
  FROM x CROSS JOIN fitted),
cut AS (SELECT quantile_cont(reconstruction_error, 0.95) AS threshold FROM errors WHERE NOT {_ANY})"""

_SCORES = f"""{_MODEL},
decided AS (
  SELECT errors.*, reconstruction_error - threshold > 1e-9 AS is_anomaly_predicted FROM errors CROSS JOIN cut),
scores AS (
  SELECT {_KEY}, {', '.join(_ACTIVITY)}, hour_of_day, day_of_week, reconstruction_error, is_anomaly_predicted,
         CASE WHEN NOT is_anomaly_predicted THEN 'normal'
              WHEN _is_future_timestamp THEN 'future_timestamp'
              WHEN _is_null_activity THEN 'null_activity'
              WHEN _has_negative_activity THEN 'negative_activity'
              WHEN greatest({', '.join(_ACTIVITY)}) < 0.01 THEN 'dead_zone'
              ELSE 'activity_spike' END AS anomaly_type_predicted, {_FLAGS}
  FROM decided)"""

_LABELLED = f"""{_SCORES},
labels_by_key AS (
  SELECT {_KEY}, bool_or(is_anomaly_injected) AS is_anomaly_injected, max(anomaly_type) AS anomaly_type
  FROM injected GROUP BY ALL),
evaluated AS (
  SELECT s.*, coalesce(l.is_anomaly_injected, false) AS is_anomaly_injected, l.anomaly_type
  FROM scores s LEFT JOIN labels_by_key l
    ON s.square_id = l.square_id AND s.time_interval = l.time_interval AND s.country_code = l.country_code)"""
_LABELLED = _LABELLED.replace("GROUP BY ALL", f"GROUP BY {_KEY}")

_CURRENT = "WHERE NOT _is_future_timestamp"
_HOURLY = f"""
hourly AS (
  SELECT square_id, hour_of_day, day_of_week, {_each("avg({c}) AS avg_{c}")}, max(internet) AS peak_internet,
         count(*) AS record_count
  FROM silver {_CURRENT} GROUP BY square_id, hour_of_day, day_of_week)"""
_DAILY = f"""
daily AS (
  SELECT country_code, date, {_each("sum({c}) AS total_{c}")}, count(*) AS record_count,
         count(DISTINCT square_id) AS active_squares
  FROM silver {_CURRENT} GROUP BY country_code, date)"""
_HEATMAP = f"""
totals AS (
  SELECT square_id, {_each("sum({c}) AS total_{c}")}, max(internet) AS peak_internet, count(*) AS record_count,
         {_each("sum({c})", " + ")} AS total_activity,
         CAST(trunc((square_id - 1) / 100) AS INTEGER) AS grid_row,
         CAST((square_id - 1) % 100 AS INTEGER) AS grid_col
  FROM silver {_CURRENT} GROUP BY square_id),
ranked AS (SELECT *, percent_rank() OVER (ORDER BY round(total_activity, 6)) AS pr FROM totals),
heatmap AS (
  SELECT * EXCLUDE (pr), CASE WHEN pr >= 0.80 THEN 'High' WHEN pr >= 0.40 THEN 'Medium' ELSE 'Low' END
         AS activity_tier
  FROM ranked)"""

# ---- rules: table, key, and per column its text and the rows that break it ----
_NEG = lambda c: (c, f"float at_least(0)", f"{c} < 0")
_ACT_RULES = [
    ("square_id", "int in_range(1, 10000) not_null", "square_id IS NULL OR square_id NOT BETWEEN 1 AND 10000"),
    ("time_interval", "int greater_than(0) not_null", "time_interval IS NULL OR time_interval <= 0"),
    ("country_code", "int", "false"),
    *[_NEG(c) for c in _ACTIVITY],
    ("hour_of_day", "int in_range(0, 23)", "hour_of_day NOT BETWEEN 0 AND 23"),
    ("day_of_week", "int in_range(1, 7)", "day_of_week NOT BETWEEN 1 AND 7"),
]
_RAW_RULES = _ACT_RULES[:-2] + [(c, t, "missing") for c, t, _ in _ACT_RULES[-2:]]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_quoted = lambda items: ", ".join(f"'{i}'" for i in items)
_COMMERCE_RULES = {
    "orders": [
        ("o_orderkey", "int at_least(0) not_null", "o_orderkey IS NULL OR o_orderkey < 0"),
        ("o_custkey", "int not_null", "o_custkey IS NULL"),
        ("o_orderstatus", "string one_of(F, O, P)", "o_orderstatus NOT IN ('F', 'O', 'P')"),
        ("o_totalprice", "float at_least(0)", "o_totalprice < 0"),
        ("o_orderpriority", f"string one_of({', '.join(_PRIORITIES)})",
         f"o_orderpriority NOT IN ({_quoted(_PRIORITIES)})"),
    ],
    "customer": [
        ("c_custkey", "int not_null", "c_custkey IS NULL"),
        ("c_name", "string not_null", "c_name IS NULL"),
        ("c_mktsegment", f"string one_of({', '.join(_SEGMENTS)})", f"c_mktsegment NOT IN ({_quoted(_SEGMENTS)})"),
        ("c_acctbal", "float at_least(0)", "c_acctbal < 0"),
    ],
    "part": [
        ("p_partkey", "int not_null", "p_partkey IS NULL"),
        ("p_type", "string not_null", "p_type IS NULL"),
        ("p_retailprice", "float greater_than(0)", "p_retailprice <= 0"),
        ("p_size", "int in_range(1, 50)", "p_size NOT BETWEEN 1 AND 50"),
    ],
    "lineitem": [
        ("l_orderkey", "int not_null", "l_orderkey IS NULL"),
        ("l_quantity", "float greater_than(0)", "l_quantity <= 0"),
        ("l_discount", "float in_range(0, 1)", "l_discount NOT BETWEEN 0 AND 1"),
        ("l_extendedprice", "float at_least(0)", "l_extendedprice < 0"),
    ],
}
_RULE_TABLES = [
    ("silver", "silver", _KEY, _ACT_RULES),
    ("raw", "injected", _KEY, _RAW_RULES),
    ("orders", "orders", "o_orderkey", _COMMERCE_RULES["orders"]),
    ("customer", "customer", "c_custkey", _COMMERCE_RULES["customer"]),
    ("part", "part", "p_partkey", _COMMERCE_RULES["part"]),
    ("lineitem", "lineitem", "l_orderkey, l_linenumber", _COMMERCE_RULES["lineitem"]),
]


def _checks(name: str, source: str, rules: list) -> list[str]:
    parts = []
    for column, text, broken in rules:
        if broken == "missing":
            failed, nulls, passed = "count(*)", "count(*)", "false"
        else:
            failed = f"count(*) FILTER (WHERE {broken})"
            nulls, passed = f"count(*) FILTER (WHERE {column} IS NULL)", f"{failed} = 0"
        parts.append(f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{text}' AS rule, "
                     f"{failed} AS failed_rows, {nulls} AS null_rows, {passed} AS passed FROM {source}")
    return parts


def _duplicates(source: str, key: str) -> str:
    return (f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
            f"(SELECT count(*) AS n FROM {source} GROUP BY {key}) WHERE n > 1)")


def _unique(name: str, column: str) -> str:
    return (f"SELECT '{name}' AS table_name, '{column}' AS column_name, 'unique' AS rule, "
            f"{_duplicates(name, column)} AS failed_rows, count(*) FILTER (WHERE {column} IS NULL) AS null_rows, "
            f"{_duplicates(name, column)} = 0 AS passed FROM {name}")


_ALL_CHECKS = "checks AS (" + " UNION ALL ".join(
    f"SELECT *, {order} AS position FROM ({part})"
    for name, source, _, rules in _RULE_TABLES
    for order, part in enumerate(_checks(name, source, rules))) + ")"
_RESULTS = f"""{_SILVER}, {_ALL_CHECKS},
facts AS ({" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, {_duplicates(source, key)} AS duplicate_count FROM {source}"
    for name, source, key, _ in _RULE_TABLES)}),
tally AS (
  SELECT table_name, bool_and(passed) AS passed, count(*) AS checks_total,
         count(*) FILTER (WHERE passed) AS checks_passed,
         coalesce(string_agg(column_name || ': ' || rule, '; ' ORDER BY position) FILTER (WHERE NOT passed), '')
           AS failures
  FROM checks GROUP BY table_name),
results AS (SELECT * FROM tally JOIN facts USING (table_name))"""

_BAND = "CASE WHEN quality_score >= 90 THEN 'green' WHEN quality_score >= 70 THEN 'amber' ELSE 'red' END"

_PER_DAY = f"""WITH {_RECORDS}
SELECT CAST(CAST(make_timestamp(time_interval * 1000) AS DATE) AS VARCHAR) AS date_partition, 'b1' AS batch_id,
       count(*) AS row_count, count(*) AS rows_with_source,
       {_each("round(sum({c}), 4) AS total_{c}")}, {_each("count({c}) AS known_{c}")}
FROM records GROUP BY 1"""

# ---- layers written from the injected records (without labels) ----
_PLAIN = (f"{_INJECTED}, plain AS (SELECT {_KEY}, {', '.join(_ACTIVITY)} FROM injected)")
_LAYERS = f"{_SCORES},{_HOURLY},{_DAILY},{_HEATMAP}"
_LINEAGE = f"""{_LAYERS},
written AS (
  SELECT 'bronze' AS layer, 'b1' AS batch_id, 'ingest_lines' AS pipeline, 'cdr_records' AS table_name,
         'raw' AS source, 'bronze/cdr_records' AS target, (SELECT count(*) FROM injected) AS row_count,
         CAST(NULL AS BIGINT) AS rows_before, CAST(NULL AS BIGINT) AS dropped,
         CAST(NULL AS BIGINT) AS suspicious_flagged
  UNION ALL SELECT 'silver', 'b1', 'flag_and_deduplicate', 'cdr_records', 'bronze/cdr_records',
         'silver/cdr_records', (SELECT count(*) FROM silver), (SELECT count(*) FROM injected),
         (SELECT count(*) FROM injected) - (SELECT count(*) FROM silver),
         (SELECT count(*) FROM silver WHERE {_ANY})
  UNION ALL SELECT 'silver', 'b1', 'score_records', 'anomaly_scores', 'silver/cdr_records',
         'silver/anomaly_scores', (SELECT count(*) FROM scores), NULL, NULL, NULL
  UNION ALL SELECT 'gold', 'b1', 'aggregate_squares', 'hourly_grid_activity', 'silver/cdr_records',
         'gold/hourly_grid_activity', (SELECT count(*) FROM hourly), NULL, NULL, NULL
  UNION ALL SELECT 'gold', 'b1', 'aggregate_squares', 'daily_country_usage', 'silver/cdr_records',
         'gold/daily_country_usage', (SELECT count(*) FROM daily), NULL, NULL, NULL
  UNION ALL SELECT 'gold', 'b1', 'aggregate_squares', 'grid_heatmap', 'silver/cdr_records',
         'gold/grid_heatmap', (SELECT count(*) FROM heatmap), NULL, NULL, NULL
  UNION ALL SELECT 'gold', 'b1', 'aggregate_squares', 'anomaly_summary', 'silver/anomaly_scores',
         'gold/anomaly_summary', (SELECT count(DISTINCT anomaly_type_predicted) FROM scores), NULL, NULL, NULL)"""

_METRICS = f"""
SELECT 'hourly_grid_activity' AS table_name, 'row_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM hourly
UNION ALL SELECT 'hourly_grid_activity', 'columns', 10
UNION ALL SELECT 'daily_country_usage', 'columns', 9
UNION ALL SELECT 'grid_heatmap', 'columns', 12
UNION ALL SELECT 'daily_country_usage', 'row_count', count(*) FROM daily
UNION ALL SELECT 'daily_country_usage', 'total_internet', round(coalesce(sum(total_internet), 0), 4) FROM daily
UNION ALL SELECT 'daily_country_usage', 'unique_countries', count(DISTINCT country_code) FROM daily
UNION ALL SELECT 'daily_country_usage', 'active_days', count(DISTINCT date) FROM daily
UNION ALL SELECT 'grid_heatmap', 'row_count', count(*) FROM heatmap
UNION ALL SELECT 'grid_heatmap', 'tier_' || activity_tier, count(*) FROM heatmap GROUP BY activity_tier"""

# Declared facts stand in the catalog itself; the SQL counts rows and quotes the texts.
_SOURCES = {
    "bronze.cdr_records": "injected", "silver.cdr_records": "silver", "silver.anomaly_scores": "scores",
    "gold.hourly_grid_activity": "hourly", "gold.daily_country_usage": "daily", "gold.grid_heatmap": "heatmap",
    "gold.anomaly_summary": "(SELECT DISTINCT anomaly_type_predicted FROM scores)",
}
_CATALOG_ROWS = [
    (name, e.layer, e.description, e.owner_team, e.sensitivity, ",".join(e.pii_columns), e.sla_freshness_hours,
     ",".join(e.primary_key), e.partition_key, ",".join(e.tags), e.regulatory_notes, _SOURCES[name])
    for name, e in CATALOG.items()]
_CATALOG = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{layer}' AS layer, '{text}' AS description, '{owner}' AS owner_team, "
    f"'{level}' AS sensitivity, '{pii}' AS pii_columns, 'daily' AS refresh_schedule, {sla} AS sla_freshness_hours, "
    f"'{key}' AS primary_key, {'CAST(NULL AS VARCHAR)' if part is None else repr(part)} AS partition_key, "
    f"'{tags}' AS tags, '{notes}' AS regulatory_notes, count(*) AS row_count FROM {source}"
    for name, layer, text, owner, level, pii, sla, key, part, tags, notes, source in _CATALOG_ROWS)

_COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}

_DOUBLES = lambda *names: [(n, "double") for n in names]
_COUNT = ("record_count", "bigint")
_GOLD_COLUMNS = {
    "hourly_grid_activity": [("square_id", "int"), ("hour_of_day", "int"), ("day_of_week", "int"),
                             *_DOUBLES(*[f"avg_{c}" for c in _ACTIVITY], "peak_internet"), _COUNT],
    "daily_country_usage": [("country_code", "int"), ("date", "date"), *_DOUBLES(*[f"total_{c}" for c in _ACTIVITY]),
                            ("active_squares", "bigint"), _COUNT],
    "grid_heatmap": [("square_id", "int"), *_DOUBLES(*[f"total_{c}" for c in _ACTIVITY], "peak_internet"), _COUNT,
                     ("total_activity", "double"), ("grid_row", "int"), ("grid_col", "int"), ("activity_tier", "string")],
    "anomaly_summary": [("anomaly_type_predicted", "string"), ("count", "bigint"),
                        *_DOUBLES("avg_reconstruction_error", "avg_internet")],
}

_TOTALS = """
totals AS (
  SELECT o_custkey, sum(o_totalprice) AS lifetime_value, count(*) AS order_count,
         CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order
  FROM orders GROUP BY o_custkey)"""
_LTV = f"""{_TOTALS},
placed AS (SELECT *, percent_rank() OVER (ORDER BY round(lifetime_value, 6)) AS pr FROM totals),
ltv AS (
  SELECT * EXCLUDE (pr), CASE WHEN pr >= 0.75 THEN 'Platinum' WHEN pr >= 0.5 THEN 'Gold'
                              WHEN pr >= 0.25 THEN 'Silver' ELSE 'Bronze' END AS ltv_tier
  FROM placed)"""
_LTV_COLUMNS = ("o_custkey, round(lifetime_value, 4) AS lifetime_value, order_count, "
                "CAST(first_order AS VARCHAR) AS first_order, CAST(last_order AS VARCHAR) AS last_order")

_ORDER_FLAGS = """
flagged AS (
  SELECT o_orderkey, o_custkey, o_totalprice,
         o_totalprice < 0 AS _is_negative_amount,
         o_orderdate > TIMESTAMP '2001-01-01 00:00:00' AS _is_future_order,
         o_totalprice > 1.9e0 * (SELECT quantile_cont(o_totalprice, 0.5) FROM orders) AS _is_extreme_amount,
         EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity <= 0) AS _has_zero_quantity,
         NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) AS _is_orphan_customer
  FROM orders)"""
_RISKS = ["_is_negative_amount", "_is_future_order", "_is_extreme_amount", "_has_zero_quantity",
          "_is_orphan_customer"]


def _relation(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return (f"SELECT '{name}' AS relation, count(*) AS child_rows, "
            f"count(*) FILTER (WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphan_rows "
            f"FROM {child} WHERE {key} IS NOT NULL")


def _copies(name: str, key: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {name}))"
    return (f"SELECT '{name}' AS table_name, count(*) AS rows_before, {distinct} AS rows_after, "
            f"count(*) - {distinct} AS dropped FROM {name}")


def _report() -> str:
    """Report lines with their place; section and order give the line number."""
    fixed = ["# Data Quality Report — SILVER Layer", "**Batch:** `b1`  |  **Generated:** 2024-02-01", ""]
    after = ["", "## Table Statistics", "", "| Table | Rows Before | Rows After | Dropped | Notes |",
             "|-------|-------------|------------|---------|-------|"]
    title = ["", "## Schema Validation Results", ""]
    parts = [f"SELECT 0 AS a, '' AS b, {i} AS c, '{t}' AS line" for i, t in enumerate(fixed)]
    parts.append(f"""SELECT 1, '', 0, '## Overall Quality Score: ' || {_BAND.replace("'green'", "'🟢'")
                 .replace("'amber'", "'🟡'").replace("'red'", "'🔴'")} || ' ' || CAST(quality_score AS VARCHAR) || '%'
                 FROM score""")
    parts += [f"SELECT 2, '', {i}, '{t}'" for i, t in enumerate(after)]
    parts.append(f"""SELECT 3, '', 0, format('| cdr_records | {{:,}} | {{:,}} | {{}} | {{}} suspicious |',
                 (SELECT count(*) FROM injected), (SELECT count(*) FROM silver),
                 (SELECT count(*) FROM injected) - (SELECT count(*) FROM silver),
                 (SELECT count(*) FROM silver WHERE {_ANY}))""")
    parts += [f"SELECT 4, '', {i}, '{t}'" for i, t in enumerate(title)]
    parts.append("""SELECT 5, table_name, 0, '### ' || table_name || ' — ' ||
                 CASE WHEN passed THEN '✅ PASS' ELSE '❌ FAIL' END FROM mine""")
    parts.append("SELECT 5, table_name, 1, format('- Checks: {}/{} passed', checks_passed, checks_total) FROM mine")
    parts.append("SELECT 5, table_name, 2, format('- Rows: {:,} | Duplicates: {}', row_count, duplicate_count) FROM mine")
    parts.append("SELECT 5, table_name, 3, '- **Failures:**' FROM mine WHERE NOT passed")
    parts.append("""SELECT 5, table_name, 4 + position, '  - `' || column_name || ': ' || rule || '`'
                 FROM checks WHERE NOT passed AND table_name IN ('silver', 'raw')""")
    parts.append("SELECT 5, table_name, 100, '' FROM mine")
    return f"""WITH {_RESULTS},
mine AS (SELECT * FROM results WHERE table_name IN ('silver', 'raw')),
score AS (SELECT round(avg(checks_passed / checks_total) * 100, 1) AS quality_score FROM mine),
lines AS ({" UNION ALL ".join(parts)})
SELECT CAST(row_number() OVER (ORDER BY a, b, c) AS INTEGER) AS line_no, line FROM lines"""


ORACLE: dict[str, str] = {
    "bronze_ingest": _PER_DAY,
    "stream_ingest": _PER_DAY,
    "bronze_rejects": f"""WITH {_RECORDS}
SELECT CASE WHEN country_code % 2 = 0 THEN concat_ws(chr(9), square_id, 'soon', country_code, '1', '1', '1', '1', '1')
            ELSE concat_ws(chr(9), square_id, time_interval) END AS line, 'b1' AS batch_id,
       count(*) AS row_count, count(*) AS rows_with_source
FROM records WHERE time_interval % 12000000 = 0 GROUP BY 1""",
    "file_lineage": f"""WITH {_RECORDS},
days AS (SELECT CAST(make_timestamp(time_interval * 1000) AS DATE) AS day, count(*) AS n FROM records GROUP BY 1)
SELECT 'b1' AS batch_id, CAST(day AS VARCHAR) AS day, n + CASE WHEN day(day) % 3 = 0 THEN 1 ELSE 0 END AS row_count,
       CAST(CASE WHEN day(day) % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS rejected, true AS has_ingest_time FROM days""",
    "stream_daily_usage": f"""WITH {_ARRIVED}
SELECT country_code, CAST(date AS VARCHAR) AS date, {_each("round(sum(coalesce({c}, 0)), 4) AS total_{c}")},
       count(*) AS record_count, count(DISTINCT square_id) AS active_squares
FROM arrived WHERE NOT held GROUP BY country_code, date""",
    "stream_late_rows": f"""WITH {_ARRIVED}
SELECT 'late' AS verdict, country_code, CAST(date AS VARCHAR) AS date, count(*) AS row_count
FROM arrived WHERE held GROUP BY country_code, date""",
    "cdr_activity": f"""WITH {_RECORDS}
SELECT {_KEY}, {_each("round(sum({c}), 4) AS {c}")} FROM records GROUP BY {_KEY}""",
    "country_series_union": f"""WITH {_RECORDS}
SELECT CASE WHEN country_code IS NOT DISTINCT FROM 39 THEN 'home' ELSE 'foreign' END AS series, country_code, count(*) AS row_count,
       count(DISTINCT square_id) AS squares FROM records GROUP BY 1, 2""",
    "inject_anomalies": f"WITH {_INJECTED} SELECT * FROM injected",
    "anomaly_type_counts": f"""WITH {_INJECTED}
SELECT anomaly_type, count(*) AS count FROM injected WHERE is_anomaly_injected GROUP BY anomaly_type""",
    "anomaly_labels": f"""WITH {_INJECTED}
SELECT {_KEY}, bool_or(is_anomaly_injected) AS is_anomaly_injected, max(anomaly_type) AS anomaly_type
FROM injected GROUP BY {_KEY} HAVING bool_or(is_anomaly_injected)""",
    "injected_preview": f"""WITH {_INJECTED}
SELECT {_KEY}, anomaly_type, internet FROM injected WHERE is_anomaly_injected
ORDER BY {_KEY}, anomaly_type, internet ASC NULLS LAST LIMIT 10""",
    "silver_flags": f"WITH {_INJECTED},{_flagged('flagged', 'injected')} SELECT {_SILVER_COLUMNS} FROM flagged",
    "silver_dedup": f"WITH {_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
    "stage_counts": f"""WITH {_SILVER}
SELECT (SELECT count(*) FROM injected) AS rows_before, count(*) AS rows_after,
       (SELECT count(*) FROM injected) - count(*) AS dropped,
       count(*) FILTER (WHERE {_ANY}) AS suspicious_flagged FROM silver""",
    "suspicious_rows": f"WITH {_SILVER} SELECT {_KEY}, {_FLAGS} FROM silver WHERE {_ANY}",
    "clean_rows": f"WITH {_SILVER} SELECT {_KEY}, {', '.join(_ACTIVITY)} FROM silver WHERE NOT {_ANY}",
    "lenient_numbers": """
SELECT event_type, count(*) AS row_count,
       count(*) FILTER (WHERE TRY_CAST(raw AS DOUBLE) IS NULL) AS unreadable,
       sum(coalesce(TRY_CAST(raw AS DOUBLE), 0)) AS total
FROM (SELECT event_type, unnest([regexp_extract(props, '"k": *([^},]*)', 1), props]) AS raw FROM events)
GROUP BY event_type""",
    "hash_sample_rows": f"""WITH {_SILVER},
hashed AS (
  SELECT *, md5(concat_ws('|', CAST(square_id AS VARCHAR), CAST(time_interval AS VARCHAR),
                          CAST(country_code AS VARCHAR), 'sample-42')) AS digest FROM silver)
SELECT {_KEY}, {', '.join(_ACTIVITY)} FROM hashed WHERE {_lane(1)} % 1000000 < 100000""",
    "null_counts": f"WITH {_INJECTED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM injected"
        for c in [*_KEY.split(", "), *_ACTIVITY, "is_anomaly_injected", "anomaly_type"]),
    "duplicate_count": f"""WITH {_RECORDS}
SELECT 'records' AS table_name, {_duplicates("records", _KEY)} AS duplicate_count
UNION ALL SELECT 'lineitem', {_duplicates("lineitem", "l_orderkey, l_linenumber")}""",
    "validation_checks": f"WITH {_SILVER} " + " UNION ALL ".join(
        _checks("silver", "silver", _ACT_RULES) + _checks("raw", "injected", _RAW_RULES)),
    "validation_result": f"""WITH {_RESULTS}
SELECT table_name, passed, checks_total, checks_passed, failures, row_count, duplicate_count FROM results""",
    "validation_nulls": f"""WITH {_SILVER}, {_ALL_CHECKS}
SELECT table_name, column_name, null_rows AS null_count FROM checks""",
    "quality_score": f"""WITH {_RESULTS},
score AS (SELECT round(avg(checks_passed / checks_total) * 100, 1) AS quality_score FROM results)
SELECT quality_score, {_BAND} AS band FROM score""",
    "quality_scorecard": f"""WITH {_RESULTS},
scored AS (SELECT *, round(checks_passed / checks_total * 100, 1) AS quality_score FROM results)
SELECT CASE table_name WHEN 'silver' THEN 'silver' WHEN 'raw' THEN 'bronze' ELSE 'commerce' END AS layer,
       table_name, quality_score, {_BAND} AS band, failures AS issues FROM scored""",
    "quality_report": _report(),
    "commerce_rules": " UNION ALL ".join(
        [p for name in ("orders", "customer", "part", "lineitem") for p in _checks(name, name, _COMMERCE_RULES[name])]
        + [_unique("orders", "o_orderkey"), _unique("customer", "c_custkey"), _unique("part", "p_partkey")]),
    "hourly_grid_activity": f"""WITH {_SILVER},{_HOURLY}
SELECT * REPLACE ({_each("round(avg_{c}, 8) AS avg_{c}")}) FROM hourly""",
    "daily_country_usage": f"""WITH {_SILVER},{_DAILY}
SELECT * REPLACE ({_each("round(total_{c}, 4) AS total_{c}")}, CAST(date AS VARCHAR) AS date) FROM daily""",
    "grid_heatmap": f"""WITH {_SILVER},{_HEATMAP}
SELECT * REPLACE ({_each("round(total_{c}, 4) AS total_{c}")}, round(total_activity, 4) AS total_activity)
FROM heatmap""",
    "square_percent_rank": f"""WITH {_SILVER},{_HEATMAP}
SELECT square_id, round(total_activity, 6) AS total_activity, round(pr, 9) AS percent_rank FROM ranked""",
    "country_squares": f"""WITH {_SILVER},
spans AS (
  SELECT country_code, square_id, unnest(['whole', 'day ' || CAST(date AS VARCHAR),
                                          'week ' || CAST(weekofyear(date) AS VARCHAR)]) AS span
  FROM silver {_CURRENT})
SELECT country_code, span, count(DISTINCT square_id) AS exact_squares, true AS sketch_within_bound
FROM spans GROUP BY country_code, span""",
    "tier_distribution": f"""WITH {_SILVER},{_HEATMAP}
SELECT activity_tier, count(*) AS count FROM heatmap GROUP BY activity_tier""",
    "pca_moments": f"WITH {_MODEL} " + " UNION ALL ".join(
        f"SELECT '{_FEATURE_NAMES[i]}' AS left_column, '{_FEATURE_NAMES[j]}' AS right_column, "
        f"round(avg(x{i}), 6) AS left_mean, round(avg(x{j}), 6) AS right_mean, "
        f"round(covar_pop(x{i}, x{j}), 6) AS covariance, count(*) AS row_count FROM x WHERE NOT {_ANY}"
        for i in range(7) for j in range(i, 7)),
    "anomaly_summary": f"""WITH {_SCORES}
SELECT anomaly_type_predicted, count(*) AS count, round(avg(reconstruction_error), 6) AS avg_reconstruction_error,
       round(avg(internet), 6) AS avg_internet FROM scores GROUP BY anomaly_type_predicted""",
    "gold_metrics": f"WITH {_SILVER},{_HOURLY},{_DAILY},{_HEATMAP} {_METRICS}",
    "zscore_model": f"WITH {_MODEL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(m{i}, 6) AS mean, round(s{i}, 6) AS scale, 0 AS rank, "
        f"n AS training_samples, 95e0 AS threshold_percentile, round(threshold, 6) AS anomaly_threshold "
        f"FROM fitted CROSS JOIN cut"
        for i, name in enumerate([f"{c}_norm" for c in _ACTIVITY] + ["hour_of_day_norm", "day_of_week_norm"])),
    "zscore_scores": f"""WITH {_SCORES}
SELECT * REPLACE (round(reconstruction_error, 6) AS reconstruction_error) FROM scores""",
    "error_percentiles": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({f} AS DOUBLE) AS fraction, round(quantile_cont({c}, {f}), 6) AS cut FROM {t}"
        for t, c in [("events", "value"), ("lineitem", "l_extendedprice")] for f in (0.5, 0.95, 0.99)),
    "anomaly_stats": f"""WITH {_SCORES}
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_anomaly_predicted) AS anomalies_detected,
       count(*) FILTER (WHERE reconstruction_error > (SELECT quantile_cont(reconstruction_error, 0.99) FROM scores))
         AS high_risk_count,
       round(count(*) FILTER (WHERE is_anomaly_predicted) * 100e0 / count(*), 2) AS anomaly_rate_pct
FROM scores""",
    "anomaly_bundle": f"""WITH {_SCORES},
risky AS (SELECT * FROM scores
          WHERE reconstruction_error > (SELECT quantile_cont(reconstruction_error, 0.99) FROM scores)),
classes AS (SELECT anomaly_type_predicted || ':' || CAST(count(*) AS VARCHAR) AS c FROM scores
            GROUP BY anomaly_type_predicted),
top AS (SELECT * FROM risky ORDER BY internet DESC, {_KEY} LIMIT 5)
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_anomaly_predicted) AS anomalies_detected,
       (SELECT count(*) FROM risky) AS high_risk_count,
       (SELECT string_agg(c, ',' ORDER BY c) FROM classes) AS classes,
       (SELECT string_agg(concat_ws(':', CAST(square_id AS VARCHAR), CAST(time_interval AS VARCHAR),
                                    CAST(country_code AS VARCHAR)), ',' ORDER BY internet DESC, {_KEY}) FROM top)
         AS top_internet
FROM scores""",
    "anomaly_breakdown": f"""WITH {_SCORES}
SELECT anomaly_type_predicted, count(*) AS count, round(avg(internet), 6) AS avg_internet
FROM scores GROUP BY anomaly_type_predicted""",
    "top_internet_spikes": f"""WITH {_SCORES}
SELECT {_KEY}, internet FROM scores
WHERE reconstruction_error > (SELECT quantile_cont(reconstruction_error, 0.99) FROM scores)
ORDER BY internet DESC, {_KEY} LIMIT 5""",
    "top_anomalies": f"""WITH {_SCORES}
SELECT {_KEY}, round(reconstruction_error, 6) AS reconstruction_error, anomaly_type_predicted
FROM scores WHERE is_anomaly_predicted ORDER BY scores.reconstruction_error DESC, {_KEY} LIMIT 10""",
    "error_histogram": f"""WITH {_SCORES},
span AS (SELECT min(reconstruction_error) AS low, (max(reconstruction_error) - min(reconstruction_error)) / 100e0 AS width
         FROM scores),
binned AS (
  SELECT CAST(least(floor((reconstruction_error - low) / width) + 1, 100) AS INTEGER) AS bin, low, width
  FROM scores CROSS JOIN span),
counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
SELECT CAST(every AS INTEGER) AS bin, round(low + (every - 1) * width, 6) AS bin_start,
       round(low + every * width, 6) AS bin_end, coalesce(n, 0) AS count
FROM range(1, 101) AS r(every) CROSS JOIN span LEFT JOIN counted ON bin = every""",
    "labelled_scores": f"""WITH {_LABELLED}
SELECT {_KEY}, is_anomaly_predicted, anomaly_type_predicted, is_anomaly_injected, anomaly_type FROM evaluated""",
    "confusion_matrix": f"""WITH {_LABELLED}
SELECT count(*) FILTER (WHERE is_anomaly_injected AND is_anomaly_predicted) AS true_positive,
       count(*) FILTER (WHERE NOT is_anomaly_injected AND is_anomaly_predicted) AS false_positive,
       count(*) FILTER (WHERE is_anomaly_injected AND NOT is_anomaly_predicted) AS false_negative,
       count(*) FILTER (WHERE NOT is_anomaly_injected AND NOT is_anomaly_predicted) AS true_negative
FROM evaluated""",
    "classification_report": f"""WITH {_LABELLED},
sides AS (
  SELECT 'anomaly' AS class, is_anomaly_injected AS truth, is_anomaly_predicted AS guess FROM evaluated
  UNION ALL SELECT 'normal', NOT is_anomaly_injected, NOT is_anomaly_predicted FROM evaluated),
counted AS (
  SELECT class, count(*) FILTER (WHERE truth AND guess) AS hit, count(*) FILTER (WHERE NOT truth AND guess) AS wrong,
         count(*) FILTER (WHERE truth AND NOT guess) AS missed FROM sides GROUP BY class),
rated AS (
  SELECT class, hit, coalesce(hit / nullif(hit + wrong, 0), 0) AS precision,
         coalesce(hit / nullif(hit + missed, 0), 0) AS recall,
         coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0), 0) AS f1, hit + missed AS support FROM counted),
every AS (
  SELECT class, precision, recall, f1, support FROM rated
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support),
                   CAST(sum(support) AS BIGINT) FROM rated
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM rated
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rated)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM every""",
    "lineage_tables": f"WITH {_LINEAGE} SELECT * FROM written",
    "batch_history": f"WITH {_LINEAGE} SELECT layer, table_name, batch_id, row_count FROM written",
    "lineage_flow": f"""WITH RECURSIVE {_LINEAGE},
chain AS (
  SELECT source AS origin, target AS final, source || ' > ' || target AS flow, 1 AS steps, [source, target] AS path,
         source = target AS cycle
  FROM written WHERE source NOT IN (SELECT target FROM written)
  UNION ALL
  SELECT origin, target, flow || ' > ' || target, steps + 1, list_append(path, target), list_contains(path, target)
  FROM chain JOIN written ON final = source WHERE NOT cycle)
SELECT origin, final, flow, steps, cycle, row_count FROM chain JOIN written ON final = target
WHERE cycle OR final NOT IN (SELECT source FROM written)""",
    "lineage_impact": f"""WITH RECURSIVE {_LINEAGE},
ways AS (
  SELECT source AS origin, target AS final, 1 AS steps FROM written
  UNION SELECT origin, target, steps + 1 FROM ways JOIN written ON final = source),
near AS (SELECT origin, final, min(steps) AS steps FROM ways GROUP BY origin, final)
SELECT origin AS table_name, 'downstream' AS direction, final AS other, steps FROM near
UNION ALL SELECT final, 'upstream', origin, steps FROM near""",
    "model_metadata": f"""WITH {_MODEL}
SELECT n AS training_samples, 95e0 AS threshold_percentile, round(threshold, 6) AS anomaly_threshold,
       '{",".join(_FEATURE_NAMES)}' AS features, CAST(0 AS INTEGER) AS bottleneck FROM fitted CROSS JOIN cut""",
    "layer_gold_columns": " UNION ALL ".join(
        f"SELECT 'gold.{t}' AS table_name, {i + 1} AS position, '{c}' AS column_name, '{kind}' AS data_type, "
        "CAST(0 AS BIGINT) AS null_count"
        for t, columns in _GOLD_COLUMNS.items()
        for i, (c, kind) in enumerate([*columns, ("_gold_processed_at", "timestamp"), ("_gold_batch_id", "string")])),
    "optional_tables": """
SELECT 'events' AS table_name, true AS present, count(*) AS row_count FROM events
UNION ALL SELECT 'orders', true, count(*) FROM orders UNION ALL SELECT 'refunds', false, 0""",
    "ordered_lines": "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS files_out_of_order FROM lineitem",
    "data_catalog": f"WITH {_LAYERS} {_CATALOG}",
    "catalog_columns": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i + 1} AS position, '{c}' AS column_name, '{kind}' AS data_type, "
        f"count(*) AS row_count, count(*) - count({c}) AS null_count FROM {t}"
        for t, columns in _COLUMNS.items() for i, (c, kind) in enumerate(columns)),
    "sla_status": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, 24 AS sla_freshness_hours,
       round((1706745600 - floor(epoch(max({c})))) / 3600e0, 4) AS actual_hours,
       CASE WHEN (1706745600 - floor(epoch(max({c})))) / 3600e0 <= 24 THEN 'met' ELSE 'breached' END AS status
FROM {t}""" for t, c in [("events", "ts"), ("orders", "o_orderdate")]),
    "layer_freshness": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {entry.sla_freshness_hours} AS sla_freshness_hours, 'met' AS status"
        for name, entry in CATALOG.items()),
    "layer_scorecard": f"""WITH {_RESULTS},
scored AS (SELECT *, round(checks_passed / checks_total * 100, 1) AS quality_score FROM results)
SELECT 'silver' AS layer, 'cdr_records' AS table_name, quality_score, {_BAND} AS band, failures AS issues
FROM scored WHERE table_name = 'silver'""",
    "layer_gold_metrics": f"WITH {_SILVER},{_HOURLY},{_DAILY},{_HEATMAP} {_METRICS}",
    "governance_facts": f"""WITH {_LINEAGE}, {_ALL_CHECKS},
metrics AS ({_METRICS}),
facts AS (
  SELECT 'quality' AS part, 'silver' AS name, count(*) FILTER (WHERE passed) * 100e0 / count(*) AS value
  FROM checks WHERE table_name = 'silver'
  UNION ALL SELECT 'lineage', layer || '.' || table_name, row_count FROM written
  UNION ALL SELECT 'anomaly', 'total_records', count(*) FROM scores
  UNION ALL SELECT 'anomaly', 'anomalies_detected', count(*) FROM scores WHERE is_anomaly_predicted
  UNION ALL SELECT 'anomaly', 'high_risk_count', count(*) FROM scores
  WHERE reconstruction_error > (SELECT quantile_cont(reconstruction_error, 0.99) FROM scores)
  UNION ALL SELECT 'gold', table_name || '.' || metric, value FROM metrics
  UNION ALL SELECT 'missing', 'parts', 0)
SELECT part, name, round(CAST(value AS DOUBLE), 4) AS value FROM facts""",
    "latest_quality": f"""WITH {_RESULTS}
SELECT 'silver' AS layer, 'b1' AS batch_id,
       (SELECT round(checks_passed / checks_total * 100, 1) FROM results WHERE table_name = 'silver')
         AS overall_quality_score,
       'cdr_records' AS table_name, (SELECT count(*) FROM injected) AS rows_before, count(*) AS rows_after,
       (SELECT count(*) FROM injected) - count(*) AS dropped,
       count(*) FILTER (WHERE {_ANY}) AS suspicious_flagged FROM silver""",
    "daily_revenue": """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, p_type AS category,
       round(sum(l_extendedprice), 4) AS gross_revenue,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_revenue,
       count(DISTINCT o_orderkey) AS order_count
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2""",
    "customer_ntile": """
SELECT o_custkey, lifetime_value, CAST(ntile(4) OVER (ORDER BY lifetime_value, o_custkey) AS INTEGER) AS quarter
FROM (SELECT o_custkey, round(sum(o_totalprice), 4) AS lifetime_value FROM orders GROUP BY o_custkey)""",
    "customer_ltv": f"WITH {_LTV} SELECT {_LTV_COLUMNS}, ltv_tier FROM ltv",
    "ltv_tier_rollup": f"""WITH {_LTV}
SELECT ltv_tier, count(*) AS count, round(avg(lifetime_value), 2) AS mean, round(sum(lifetime_value), 2) AS sum
FROM ltv GROUP BY ltv_tier""",
    "product_performance": """
SELECT p_brand, p_type, round(sum(l_extendedprice), 4) AS gross_revenue,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_revenue, sum(l_quantity) AS units_sold,
       round(avg(l_discount), 8) AS avg_discount, count(*) AS line_count,
       count(DISTINCT l_partkey) AS parts_sold
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand, p_type""",
    "sales_by_category": """
SELECT p_type AS category, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net_revenue,
       sum(l_quantity) AS units_sold, count(*) AS line_count
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type""",
    "top_customers": f"""WITH {_TOTALS}
SELECT {_LTV_COLUMNS} FROM totals ORDER BY round(totals.lifetime_value, 6) DESC, o_custkey LIMIT 10""",
    "order_flags": f"WITH {_ORDER_FLAGS} SELECT * FROM flagged",
    "amount_at_risk": f"WITH {_ORDER_FLAGS} " + " UNION ALL ".join(
        f"SELECT '{name}' AS flag, count(*) AS order_count, round(coalesce(sum(o_totalprice), 0), 2) AS amount "
        f"FROM flagged WHERE {test}"
        for name, test in [*[(r, r) for r in _RISKS], ("any_flag", f"({' OR '.join(_RISKS)})")]),
    "orphan_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "lines_of_missing_orders": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 3)""",
    "orphan_events": """
SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "orphan_check": " UNION ALL ".join([
        _relation("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
        _relation("lineitem.orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _relation("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey"),
        _relation("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _relation("customer.nation", "customer", "c_nationkey", "nation", "n_nationkey"),
        _relation("events.supplier", "events", "user_id", "supplier", "s_suppkey"),
    ]),
    "lineitem_dedup": """
SELECT * EXCLUDE (copy) REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
             l_shipdate) AS copy FROM lineitem) WHERE copy = 1""",
    "commerce_dedup": " UNION ALL ".join([
        _copies("orders", "o_orderkey"), _copies("customer", "c_custkey"), _copies("part", "p_partkey"),
        _copies("lineitem", "l_orderkey, l_linenumber"),
    ]),
}
_DENSE_RECORDS = f"""
records AS (
  SELECT CAST(user_id % 20 + 1 AS INTEGER) AS square_id, epoch_ms(ts) - epoch_ms(ts) % 21600000 AS time_interval,
         CAST((user_id % 20 + 1) % 7 + 39 AS INTEGER) AS country_code,
         {_each("CAST(sum(CASE WHEN event_type = '{e}' THEN CAST(value AS DECIMAL(18, 2)) END) AS DOUBLE) AS {c}")}
  FROM events GROUP BY 1, 2, 3)"""
ORACLE |= {f"dense_{name}": ORACLE[full].replace(_RECORDS, _DENSE_RECORDS) for name, full in (
    ("silver_flags", "silver_dedup"), ("heatmap", "grid_heatmap"), ("zscore_scores", "zscore_scores"))}
ORACLE["dense_mixture"] = f"""WITH {_SILVER}
SELECT count(*) AS rows_scored, count(*) FILTER (WHERE NOT {_ANY}) AS training_rows, true AS nearer, true AS threshold_holds
FROM silver""".replace(_RECORDS, _DENSE_RECORDS)
ORACLE["bucketed_dedup"] = ORACLE["silver_dedup"]
ORACLE["bucketed_duplicates"] = f"""WITH {_INJECTED},
sizes AS (SELECT {_KEY}, count(*) AS n, bool_or(is_anomaly_injected) AS marked FROM injected GROUP BY {_KEY})
SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_count,
       CAST(coalesce(sum(n) FILTER (WHERE marked), 0) AS BIGINT) AS labelled_rows FROM sizes"""
ORACLE["bounded_sample_rows"] = f"""WITH {_SILVER}
SELECT {_KEY}, {', '.join(_ACTIVITY)} FROM silver
ORDER BY CAST(concat('0x', substr(md5(concat_ws('|', CAST(square_id AS VARCHAR), CAST(time_interval AS VARCHAR),
              CAST(country_code AS VARCHAR), 'sample-42')), 1, 12)) AS BIGINT), {_KEY} LIMIT 500"""
ORACLE["box_activity"] = f"""WITH {_SILVER},
placed AS (
  SELECT *, CAST(trunc((square_id - 1) / 100) AS INTEGER) AS grid_row, CAST((square_id - 1) % 100 AS INTEGER) AS grid_col
  FROM silver)
SELECT grid_row, grid_col, hour_of_day, {_each("round(sum({c}), 4) AS total_{c}")}, count(*) AS record_count FROM placed
WHERE grid_row BETWEEN 0 AND 3 AND grid_col BETWEEN 8 AND 23 AND hour_of_day BETWEEN 6 AND 11
GROUP BY grid_row, grid_col, hour_of_day"""
# The bottleneck by a second engine: cyclic Jacobi rotations of the correlations, as lists of 49 entries.
_TURNS = [(i, j) for i in range(7) for j in range(i + 1, 7)]
_at = lambda i, j: f"a[{i} * 7 + {j} + 1]"
_BOTTLENECK = f"""
correlations AS (
  SELECT [{', '.join(f"covar_pop(x{i}, x{j}) / any_value(s{i} * s{j})" for i in range(7) for j in range(7))}] AS a
  FROM x CROSS JOIN fitted WHERE NOT {_ANY}),
turned AS (
  SELECT 0 AS step, a, [{', '.join("1e0" if i == j else "0e0" for i in range(7) for j in range(7))}] AS v FROM correlations
  UNION ALL
  SELECT step + 1,
         list_transform(range(49), lambda k:
           CASE WHEN k // 7 = p THEN c * b[p * 7 + k % 7 + 1] - s * b[q * 7 + k % 7 + 1]
                WHEN k // 7 = q THEN s * b[p * 7 + k % 7 + 1] + c * b[q * 7 + k % 7 + 1] ELSE b[k + 1] END),
         list_transform(range(49), lambda k:
           CASE WHEN k % 7 = p THEN c * v[k + 1] - s * v[k - p + q + 1]
                WHEN k % 7 = q THEN s * v[k - q + p + 1] + c * v[k + 1] ELSE v[k + 1] END)
  FROM (
    SELECT *, list_transform(range(49), lambda k:
             CASE WHEN k % 7 = p THEN c * a[k + 1] - s * a[k - p + q + 1]
                  WHEN k % 7 = q THEN s * a[k - q + p + 1] + c * a[k + 1] ELSE a[k + 1] END) AS b
    FROM (
      SELECT *, t / sqrt(1 + t * t) AS s, 1 / sqrt(1 + t * t) AS c
      FROM (
        SELECT *, CASE WHEN {_at('p', 'q')} = 0 THEN 0e0 WHEN tau >= 0 THEN 1 / (tau + sqrt(1 + tau * tau))
                       ELSE 1 / (tau - sqrt(1 + tau * tau)) END AS t
        FROM (
          SELECT *, CASE WHEN {_at('p', 'q')} = 0 THEN 0e0
                         ELSE ({_at('q', 'q')} - {_at('p', 'p')}) / (2 * {_at('p', 'q')}) END AS tau
          FROM (
            SELECT *, [{', '.join(str(i) for i, _ in _TURNS)}][step % 21 + 1] AS p,
                   [{', '.join(str(j) for _, j in _TURNS)}][step % 21 + 1] AS q
            FROM turned WHERE step < 315)))))),
axes AS (
  SELECT k, a[k * 8 + 1] AS variance, list_transform(range(7), lambda i: v[i * 7 + k + 1]) AS direction
  FROM (SELECT *, unnest(range(7)) AS k FROM turned WHERE step = 315)),
left_out AS (SELECT list(direction) AS directions FROM (SELECT * FROM axes ORDER BY variance, k LIMIT 3)),
errors AS (
  SELECT x.*, list_sum(list_transform(directions, lambda d: pow(list_dot_product(
           [{', '.join(f"(x{i} - m{i}) / s{i}" for i in range(7))}], d), 2))) / 7e0 AS reconstruction_error
  FROM x CROSS JOIN fitted CROSS JOIN left_out),
cut AS ("""
_whole = _SCORES.index("\nerrors AS ("), _SCORES.index("\ncut AS (") + len("\ncut AS (")
_PCA_SCORES = _SCORES[:_whole[0]] + _BOTTLENECK + _SCORES[_whole[1]:]
ORACLE["pca_scores"] = ORACLE["zscore_scores"].replace(_SCORES, _PCA_SCORES).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["pca_anomaly_summary"] = ORACLE["anomaly_summary"].replace(_SCORES, _PCA_SCORES).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["labelled_scores"] = ORACLE["labelled_scores"].replace(_SCORES, _PCA_SCORES).replace("WITH ", "WITH RECURSIVE ", 1)
# Days delivered again leave the same gold tables.
ORACLE |= {f"reloaded_{name}": ORACLE[full] for name, full in (
    ("hourly_activity", "hourly_grid_activity"), ("daily_usage", "daily_country_usage"), ("heatmap", "grid_heatmap"))}
