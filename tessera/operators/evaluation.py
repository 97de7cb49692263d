"""Detector evaluation: injected anomalies, label join, confusion matrix, histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.hashing import draw_sql, key_digest_sql
from tessera.schema import ACTIVITY, NATURAL_KEY, SLOT_MS

# ---- fixed values: share of each anomaly type, in percent, and its size ----
TYPE_SHARES = [
    ("activity_spike", 35),
    ("dead_zone", 20),
    ("negative_activity", 20),
    ("future_timestamp", 15),
    ("null_activity", 10),
]
SPIKE_TIMES = (15, 50)
NEGATIVE_BETWEEN = (1, 120)
FUTURE_FROM_MS = 1_735_689_600_000      # 2025-01-01 00:00 UTC
FUTURE_SLOTS = 365 * 144
RATE = 0.05


def _type_sql(number: str) -> str:
    upto, whens = 0, []
    for name, share in TYPE_SHARES:
        upto += share
        whens.append(f"WHEN {number} % 100 < {upto} THEN '{name}'")
    return f"CASE {' '.join(whens)} END"


def _between_sql(number: str, low: int, high: int) -> str:
    return f"({number} % {high - low + 1} + {low})"


def inject_anomalies(records: DataFrame, rate: float = RATE, seed: int = 42) -> DataFrame:
    """A labelled copy of ``records`` with a share of the rows made anomalous.

    Which rows, which type and how strong follow from a digest of the natural key,
    so any attempt of any task makes the same choice. Projections; no shuffle.
    """
    lane = lambda i: draw_sql("_digest", i)
    # Generated, not projected: filters on what follows are pushed down as far as here, with the
    # digest as a column, instead of further, with one digest for each of its uses.
    digested = records.selectExpr("*", f"explode(array({key_digest_sql(NATURAL_KEY, seed)})) AS _digest")
    chosen = digested.selectExpr("*", f"{lane(0)} % 10000 < {int(round(rate * 10_000))} AS is_anomaly_injected")
    labelled = chosen.selectExpr(
        "*",
        f"CASE WHEN is_anomaly_injected THEN {_type_sql(lane(1))} END AS anomaly_type",
        f"{lane(2)} AS _size",
        f"{lane(3)} AS _pick",
    )
    changed = {
        "time_interval": f"""CASE WHEN anomaly_type = 'future_timestamp'
            THEN {FUTURE_FROM_MS} + (_size % {FUTURE_SLOTS}) * {SLOT_MS} ELSE time_interval END"""
    }
    for position, name in enumerate(ACTIVITY):
        changed[name] = f"""CASE
            WHEN anomaly_type = 'activity_spike' THEN {name} * {_between_sql('_size', *SPIKE_TIMES)}
            WHEN anomaly_type = 'dead_zone' THEN 0D
            WHEN anomaly_type = 'negative_activity' AND _pick % {len(ACTIVITY)} = {position}
                THEN -CAST({_between_sql('_size', *NEGATIVE_BETWEEN)} AS DOUBLE)
            WHEN anomaly_type = 'null_activity' THEN NULL
            ELSE {name} END"""
    return labelled.selectExpr(
        *[f"{changed[c]} AS {c}" if c in changed else c for c in records.columns],
        "is_anomaly_injected",
        "anomaly_type",
    )


def labels_of(injected: DataFrame) -> DataFrame:
    """One label per anomalous natural key; a key is anomalous if any of its rows is.

    Normal keys need no label, so only the anomalous share is shuffled.
    """
    return injected.where("is_anomaly_injected").groupBy(*NATURAL_KEY).agg(
        F.max("is_anomaly_injected").alias("is_anomaly_injected"),
        F.max("anomaly_type").alias("anomaly_type"),
    )


def with_labels(scores: DataFrame, labels: DataFrame, null_safe: bool = True) -> DataFrame:
    """Scores with their labels; rows without a label count as normal.

    Keys are compared null-safely; with ``null_safe`` off by plain equality, for keys without nulls, which
    lets a table that lies in buckets of the key stay where it is. ``labels`` holds each key once, so the join
    cannot multiply rows; Spark broadcasts the labels if their size allows it and
    splits oversized partitions of the scores otherwise.
    """
    right = labels.select(
        *[F.col(k).alias(f"_label_{k}") for k in NATURAL_KEY], "is_anomaly_injected", "anomaly_type"
    )
    match = [F.col(k).eqNullSafe(F.col(f"_label_{k}")) if null_safe else F.col(k) == F.col(f"_label_{k}")
             for k in NATURAL_KEY]
    joined = scores.join(right, match, "left").drop(*[f"_label_{k}" for k in NATURAL_KEY])
    return joined.fillna(False, subset=["is_anomaly_injected"])


def confusion_matrix(evaluated: DataFrame) -> DataFrame:
    truth, guess = F.col("is_anomaly_injected"), F.col("is_anomaly_predicted")
    return evaluated.agg(
        F.count_if(truth & guess).alias("true_positive"),
        F.count_if(~truth & guess).alias("false_positive"),
        F.count_if(truth & ~guess).alias("false_negative"),
        F.count_if(~truth & ~guess).alias("true_negative"),
    )


def classification_report(evaluated: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes and their averages; 0 where undefined.

    Row ``accuracy`` holds the accuracy in all three columns; ``macro avg`` is the plain mean
    of the classes, ``weighted avg`` the mean by support.
    """
    ratio = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    def side(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + missed).alias("recall"), ratio(hit * 2, hit * 2 + wrong + missed).alias("f1"),
            (hit + missed).alias("support"))

    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    sides = confusion_matrix(evaluated).select(
        side("anomaly", tp, fp, fn).alias("a"), side("normal", tn, fn, fp).alias("n"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"))
    total = F.col("a.support") + F.col("n.support")
    scores = ["precision", "recall", "f1"]
    macro = lambda c: (F.col(f"a.{c}") + F.col(f"n.{c}")) / 2
    weighted = lambda c: ratio(F.col(f"a.{c}") * F.col("a.support") + F.col(f"n.{c}") * F.col("n.support"), total)
    row = lambda name, score: F.struct(
        F.lit(name).alias("class"), *(score(c).alias(c) for c in scores), total.alias("support"))
    return sides.select(F.inline(F.array(
        F.col("a"), F.col("n"), row("accuracy", lambda c: F.col("accuracy")), row("macro avg", macro),
        row("weighted avg", weighted))))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Equal-width bins 1 .. ``bins`` over the finite values; the last bin is closed, empty bins are listed.

    Values that are no finite numbers are counted in rows of their own, without edges:
    bin -1 for NaN, 0 for minus infinity, ``bins`` + 1 for infinity. Nulls do not count.
    One value alone gets a range of one around it; without finite values there are no bins.
    Two passes: the range, then one row per bin and map task into the shuffle.
    """
    v = F.col(value).cast("double")
    limit = F.lit(float("inf"))
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)
    low, high = df.agg(F.min(F.when(finite, v)), F.max(F.when(finite, v))).first()
    known = low is not None
    if known and low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins if known else 1.0
    # The upper end belongs to the last bin, as in the usual plotting rule.
    inside = F.least(F.floor((v - F.lit(low if known else 0.0)) / F.lit(width)) + 1, F.lit(bins))
    number = F.when(F.isnan(v), -1).when(v == -limit, 0).when(v == limit, bins + 1).otherwise(inside)
    # The list of bins goes through the same aggregation, with rows that count nothing.
    every = df.sparkSession.range(1, bins + 1 if known else 1).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).alias("one"))
    rows = df.where(v.isNotNull()).select(number.cast("int").alias("bin"), F.lit(1).alias("one"))
    start = F.when(F.col("bin").between(1, bins), F.lit(low) + (F.col("bin") - 1) * F.lit(width))
    return rows.unionByName(every).groupBy("bin").agg(F.sum("one").alias("count")).select(
        "bin", start.alias("bin_start"), (start + F.lit(width)).alias("bin_end"), "count")
