"""A nonlinear bottleneck: the rows are split into clusters, each with a linear bottleneck of its own.

Clusters are found by k-means on the standardised features, one aggregation per round. The moments of
all clusters come from one further pair of aggregations, whatever their number. Scoring is column
arithmetic: the nearest centre, then the residual against that cluster's bottleneck.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.activity import number_sql
from tessera.functions.hashing import bounded_sample
from tessera.operators import detector, moments
from tessera.operators.cleaning import clean
from tessera.operators.detector import FEATURES, Detector
from tessera.operators.order_stats import exact_percentiles
from tessera.schema import NATURAL_KEY

CLUSTERS = 4
ROUNDS = 20
START_ROWS = 2_000      # rows, by key hash, from which the first centres are chosen


@dataclass(frozen=True)
class Mixture:
    """Centres in standardised features and a ``Detector`` for each; a few hundred numbers."""

    mean: list[float]
    scale: list[float]
    centres: list[list[float]]
    parts: list[Detector]
    training_samples: int
    percentile: float
    threshold: float | None = None

    def _unit(self, df: DataFrame) -> list[str]:
        return [f"(({f}) - {number_sql(m)}) / {number_sql(s)}"
                for f, m, s in zip(detector.features_sql(df), self.mean, self.scale)]

    def with_cluster(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """The number of the nearest centre; of equally near ones the first."""
        return _nearest(df, self._unit(df), self.centres, name)

    def error(self, df: DataFrame, cluster: str = "cluster") -> Column:
        """Mean over the features of the squared residual; ``df`` has its clusters."""
        value = F.lit(None).cast("double")
        for k, part in enumerate(self.parts):
            value = F.when(F.col(cluster) == k, part.error(df)).otherwise(value)
        return value


def _nearest(df: DataFrame, unit: list[str], centres: list[list[float]], name: str) -> DataFrame:
    """Distances are computed once, as a column, and compared."""
    parts = [" + ".join(f"({z} - {number_sql(c)}) * ({z} - {number_sql(c)})" for z, c in
                        zip([f"_z[{i}]" for i in range(len(unit))], centre)) for centre in centres]
    placed = df.withColumn("_z", F.expr(f"array({', '.join(unit)})")).withColumn("_d", F.expr(f"array({', '.join(parts)})"))
    return placed.withColumn(name, F.expr("CAST(array_position(_d, array_min(_d)) - 1 AS INT)")).drop("_z", "_d")


def first_centres(rows: np.ndarray, k: int) -> list[list[float]]:
    """Rows in the middle of ``k`` equal shares along the direction of most variance; fixed by the rows."""
    _, _, right = np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)
    order = np.argsort((rows - rows.mean(axis=0)) @ right[0], kind="stable")
    chosen = [rows[order[int((i + 0.5) * len(rows) / k)]] for i in range(k)]
    return np.unique(chosen, axis=0).tolist()


def fit(silver: DataFrame, clusters: int = CLUSTERS, rank: int = detector.BOTTLENECK,
        percentile: float = detector.PERCENTILE, rounds: int = ROUNDS) -> Mixture:
    """Fit on rows without quality flags; ``silver`` is read once a round and should be a written table.

    The first centres come from ``START_ROWS`` rows chosen by key hash; every round then reads all rows.
    A cluster that loses all its rows is left out.
    """
    training = clean(silver)
    plain = detector.fit(silver, rank, percentile)
    mean, scale = plain.mean, plain.scale
    unit = [f"(({f}) - {number_sql(m)}) / {number_sql(s)}"
            for f, m, s in zip(detector.features_sql(training), mean, scale)]
    start = bounded_sample(training, START_ROWS, NATURAL_KEY).orderBy(*NATURAL_KEY).selectExpr(*unit).collect()
    centres = first_centres(np.array(start, float), clusters)
    for _ in range(rounds):
        found = _nearest(training, unit, centres, "cluster").groupBy("cluster").agg(
            *[F.avg(F.expr(z)).alias(f"c_{i}") for i, z in enumerate(unit)]).orderBy("cluster").collect()
        moved = [[float(v) for v in r[1:]] for r in found]
        if len(moved) == len(centres) and np.allclose(moved, centres, rtol=0, atol=1e-9):
            break
        centres = moved
    shape = Mixture(mean, scale, centres, [], plain.training_samples, percentile)
    placed = shape.with_cluster(training)
    states = moments.states(detector.feature_rows(placed, ["cluster"]), FEATURES, ["cluster"])
    parts: list[Detector | None] = [None] * len(centres)
    for state in states.collect():
        # Own mean and directions, on the scale of all rows, so that errors of clusters compare.
        found = detector.of_state(state)
        parts[state.cluster] = Detector([found[f"mean_{i}"] for i in range(len(FEATURES))], scale,
                                        detector.unexplained(found, scale, rank), rank, found["n"], percentile)
    held = [k for k, part in enumerate(parts) if part is not None]
    shape = Mixture(mean, scale, [centres[k] for k in held], [parts[k] for k in held], plain.training_samples, percentile)
    rows = shape.with_cluster(training)
    threshold = exact_percentiles(rows.select(shape.error(rows).alias("error")), "error", [percentile / 100.0])[0]
    return Mixture(**{**shape.__dict__, "threshold": threshold})


def score(silver: DataFrame, model: Mixture) -> DataFrame:
    """Every row with its cluster, error and decision."""
    placed = model.with_cluster(silver)
    return placed.withColumn("reconstruction_error", model.error(placed)).withColumn(
        "is_anomaly_predicted", F.expr(f"reconstruction_error > {number_sql(model.threshold)}"))
