"""Reconstruction-error anomaly detection.

A row's error is the part of its standardised features that a low-dimensional
linear bottleneck cannot reproduce. Fitting needs means, variances and covariances
of the clean rows (two aggregations, or the merged states of days kept before) plus
an exact percentile; scoring is column arithmetic with the fitted numbers, so rows
never leave the executors.

``rank=4`` keeps four components. ``rank=0`` keeps none: the error is then the
mean squared z-score.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.activity import (
    anomaly_class_sql, cleaned_sql, lenient_number_sql, number_sql, present,
)
from tessera.operators import moments
from tessera.operators.cleaning import clean
from tessera.operators.order_stats import exact_percentiles
from tessera.schema import ACTIVITY, FLAGS, NATURAL_KEY
from tessera.session import materialize

# ---- fixed values: the features and the columns of a score table ----
FEATURES = [f"{c}_norm" for c in ACTIVITY] + ["hour_of_day_norm", "day_of_week_norm"]
SCORE_COLUMNS = (
    NATURAL_KEY + ACTIVITY + ["hour_of_day", "day_of_week"]
    + ["reconstruction_error", "is_anomaly_predicted", "anomaly_type_predicted"] + FLAGS
)
BOTTLENECK = 4
PERCENTILE = 95.0


def features_sql(df: DataFrame) -> list[str]:
    """Activities without negatives, hour / 23 and weekday / 6; missing becomes 0.

    Activities may arrive as text; unreadable numbers count as missing.
    """
    have = set(df.columns)
    activity = [cleaned_sql(f"try_cast({c} AS DOUBLE)") if c in have else "0D" for c in ACTIVITY]
    calendar = [
        f"{lenient_number_sql(c)} / {scale}D" if c in have else "0D"
        for c, scale in (("hour_of_day", 23), ("day_of_week", 6))
    ]
    return activity + calendar


@dataclass(frozen=True)
class Detector:
    """Fitted numbers: about sixty, whatever the size of the data."""

    mean: list[float]
    scale: list[float]
    unexplained: list[list[float]]   # directions the bottleneck cannot reproduce
    rank: int
    training_samples: int
    percentile: float
    threshold: float | None = None
    features: list[str] = field(default_factory=lambda: list(FEATURES))

    def error(self, df: DataFrame) -> Column:
        """Mean over the features of the squared residual."""
        unit = [
            f"(({f}) - {number_sql(m)}) / {number_sql(s)}"
            for f, m, s in zip(features_sql(df), self.mean, self.scale)
        ]
        squares = []
        for direction in self.unexplained:
            terms = [f"({z}) * {number_sql(w)}" for z, w in zip(unit, direction) if w != 0.0]
            along = " + ".join(terms)
            squares.append(f"({along}) * ({along})")
        return F.expr(f"({' + '.join(squares)}) / {len(unit)}D" if squares else "0D")

    def parameters(self, spark: SparkSession) -> DataFrame:
        """One row per feature, with the shared numbers repeated."""
        rows = [
            (name, m, s, [d[i] for d in self.unexplained], self.rank, self.training_samples,
             self.percentile, self.threshold)
            for i, (name, m, s) in enumerate(zip(self.features, self.mean, self.scale))
        ]
        return spark.createDataFrame(
            rows,
            "feature string, mean double, scale double, unexplained array<double>, rank int, "
            "training_samples bigint, threshold_percentile double, anomaly_threshold double",
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.parameters(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Detector":
        rows = {r["feature"]: r for r in spark.read.parquet(path).collect()}
        ordered = [rows[name] for name in FEATURES]
        shared = ordered[0]
        return Detector(
            [r["mean"] for r in ordered],
            [r["scale"] for r in ordered],
            [list(d) for d in zip(*[r["unexplained"] for r in ordered])],
            shared["rank"], shared["training_samples"],
            shared["threshold_percentile"], shared["anomaly_threshold"],
        )

    def metadata(self) -> str:
        return json.dumps(
            {
                "training_samples": self.training_samples,
                "threshold_percentile": self.percentile,
                "anomaly_threshold": self.threshold,
                "features": self.features,
                "bottleneck": self.rank,
            }
        )


def feature_rows(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The features as columns, with the columns to ``keep``."""
    return rows.selectExpr(*(keep or []), *[f"{text} AS {name}" for text, name in zip(features_sql(rows), FEATURES)])


def _moments(rows: DataFrame, pairs: bool) -> dict:
    """n, means, deviations and, with ``pairs``, covariances."""
    x = feature_rows(rows)
    if pairs:
        return of_state(moments.states(x, FEATURES).first())
    measures = ["count(1) AS n"]
    for i, name in enumerate(FEATURES):
        measures += [f"avg({name}) AS mean_{i}", f"stddev_pop({name}) AS std_{i}"]
    return x.selectExpr(*measures).first().asDict()


def of_state(found) -> dict:
    """The row of a state as n, means, deviations and covariances; no rows without one."""
    if found is None:
        return {"n": 0}
    out = {"n": found.n, **{f"mean_{i}": m for i, m in enumerate(found.means)}}
    for (i, j), c in zip(combinations_with_replacement(range(len(FEATURES)), 2), found.comoments):
        out[f"std_{i}" if i == j else f"cov_{i}_{j}"] = math.sqrt(max(c, 0.0) / found.n) if i == j else c / found.n
    return out


def unexplained(found: dict, scale: list[float], rank: int) -> list[list[float]]:
    """Unit directions left out by the ``rank`` leading principal components."""
    size = len(FEATURES)
    if rank == 0:
        return np.eye(size).tolist()
    correlation = np.zeros((size, size))
    for i in range(size):
        correlation[i, i] = (found[f"std_{i}"] / scale[i]) ** 2
        for j in range(i + 1, size):
            correlation[i, j] = correlation[j, i] = found[f"cov_{i}_{j}"] / (scale[i] * scale[j])
    _, directions = np.linalg.eigh(correlation)      # ascending eigenvalues
    return directions[:, : size - rank].T.tolist()


def day_states(silver: DataFrame, day: str = "date") -> DataFrame:
    """Moments of the clean rows' features per day: what ``fit`` needs of a day, whatever it held."""
    return moments.states(feature_rows(clean(silver), [f"`{day}`"]), FEATURES, [day])


def fit(silver: DataFrame, rank: int = BOTTLENECK, percentile: float = PERCENTILE,
        days: DataFrame | None = None) -> Detector:
    """Fit on rows without quality flags; the threshold is a percentile of their errors.

    ``silver`` is read a few times and should be a written table. ``days`` holds its
    ``day_states``, written before; then only the threshold reads the rows.
    """
    training = clean(silver)
    found = (_moments(training, pairs=rank > 0) if days is None
             else of_state(moments.merged(days, len(FEATURES)).first()))
    if not found["n"]:
        raise ValueError("no clean rows to fit on")
    size = range(len(FEATURES))
    mean = [found[f"mean_{i}"] for i in size]
    # A constant feature is left unscaled.
    scale = [found[f"std_{i}"] or 1.0 for i in size]
    shape = Detector(mean, scale, unexplained(found, scale, rank), rank, found["n"], percentile)
    errors = training.select(shape.error(training).alias("error"))
    threshold = exact_percentiles(errors, "error", [percentile / 100.0])[0]
    return Detector(**{**shape.__dict__, "threshold": threshold})


def score(silver: DataFrame, detector: Detector, tolerance: float = 0.0) -> DataFrame:
    """Every row with its error, decision and class.

    A row is anomalous when its error exceeds the threshold. ``tolerance`` is the
    least excess that counts, for comparing engines that round differently.
    """
    scored = silver.withColumn("reconstruction_error", detector.error(silver))
    excess = f"reconstruction_error - {number_sql(detector.threshold)}"
    scored = scored.withColumn("is_anomaly_predicted", F.expr(f"{excess} > {number_sql(tolerance)}"))
    scored = scored.withColumn("anomaly_type_predicted", F.expr(anomaly_class_sql("is_anomaly_predicted")))
    return scored.select(*present(scored, SCORE_COLUMNS))


def fit_and_score(silver: DataFrame, rank: int = BOTTLENECK, percentile: float = PERCENTILE,
                  tolerance: float = 0.0) -> tuple[Detector, DataFrame]:
    """Fit and score an unwritten silver frame, computing it once."""
    table = materialize(silver, "silver")
    detector = fit(table, rank, percentile)
    return detector, score(table, detector, tolerance)


def anomaly_statistics(scores: DataFrame) -> DataFrame:
    """Totals, anomaly rate and the rows above the 99th percentile of the error, as one row.

    ``scores`` is read a few times and should be a written table.
    """
    cut = exact_percentiles(scores, "reconstruction_error", [0.99])[0]
    risky = F.col("reconstruction_error") > F.lit(cut)
    counted = scores.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_anomaly_predicted").alias("anomalies_detected"),
        F.count_if(risky).alias("high_risk_count"),
    )
    rate = F.col("anomalies_detected") * 100.0 / F.nullif(F.col("total_records"), F.lit(0))
    return counted.withColumn("anomaly_rate_pct", F.coalesce(F.round(rate, 2), F.lit(0.0)))


def anomaly_breakdown(scores: DataFrame) -> DataFrame:
    return scores.groupBy("anomaly_type_predicted").agg(
        F.count(F.lit(1)).alias("count"), F.avg("internet").alias("avg_internet")
    )


def top_internet_spikes(scores: DataFrame, n: int = 5) -> DataFrame:
    """Largest internet values among rows above the 99th percentile of the error."""
    cut = exact_percentiles(scores, "reconstruction_error", [0.99])[0]
    risky = scores.where(F.col("reconstruction_error") > F.lit(cut))
    return risky.orderBy(F.desc("internet"), *NATURAL_KEY).limit(n)


def anomaly_bundle(scores: DataFrame) -> DataFrame:
    """All anomaly facts in one row: the statistics, the classes, and the largest internet values.

    Classes and values are a handful of entries, whatever the number of rows.
    """
    classes = anomaly_breakdown(scores).agg(F.sort_array(F.collect_list(F.struct(
        "anomaly_type_predicted", "count", F.round("avg_internet", 6).alias("avg_internet")))))
    # Ties in the order of the spikes themselves: the largest value first, then the key upwards.
    ranked = F.struct(F.col("internet").isNull(), -F.col("internet"), *NATURAL_KEY, "internet")
    spikes = top_internet_spikes(scores).agg(F.transform(F.sort_array(F.collect_list(ranked)), lambda x: F.struct(
        x["internet"].alias("internet"), *(x[k].alias(k) for k in NATURAL_KEY))))
    return anomaly_statistics(scores).select(
        "*", classes.scalar().alias("breakdown"), spikes.scalar().alias("top_internet"))


def top_anomalies(scores: DataFrame, n: int = 10) -> DataFrame:
    return (
        scores.where("is_anomaly_predicted")
        .orderBy(F.desc("reconstruction_error"), *NATURAL_KEY)
        .limit(n)
    )
