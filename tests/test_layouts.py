"""Bounded samples, tables along a curve, bucketed tables, and the clustered bottleneck."""

import glob
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.functions.curve import interleaved_sql
from tessera.functions.hashing import bounded_sample
from tessera.operators import cleaning, detector, evaluation, mixture, rules
from tessera.schema import ACTIVITY, NATURAL_KEY, RAW_ACTIVITY
from tessera.sources import sinks

START = 1_704_067_200_000


# ---------------------------------------------------------------- samples

@pytest.mark.parametrize("n", [0, 1, 40, 100, 150, 400])
def test_bounded_sample_is_the_sorted_head(spark, n):
    """Keys repeat, one of them in a third of the rows: ties are cut in the order of all columns."""
    rows = [(i if i % 3 else 7, i % 11, None if i % 5 == 0 else "x") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, v int, _draw string").repartition(4)
    want = df.orderBy(F.expr("CAST(conv(substring(md5(concat_ws('|', CAST(k AS STRING), 'sample-42')), 1, 12), 16, 10) AS BIGINT)"),
                      *[F.col(c).asc_nulls_last() for c in df.columns]).limit(n)
    plain = lambda d: sorted(map(tuple, d.collect()), key=str)
    got = bounded_sample(df, n, ["k"])
    assert got.columns == df.columns and plain(got) == plain(want)


def test_bounded_sample_of_nothing(spark):
    assert bounded_sample(spark.range(0), 5, ["id"]).count() == 0


# ---------------------------------------------------------------- curve

def test_interleaved_bits(spark):
    def place(a, b, c):
        bits = ""
        for i in range(2, -1, -1):
            bits += "".join(format(v, f"0{n}b")[n - 1 - i] for v, n in ((a, 3), (b, 3), (c, 2)) if i < n)
        return int(bits, 2)

    df = spark.createDataFrame([(a, b, c) for a in range(8) for b in range(8) for c in range(4)], "a int, b int, c int")
    got = df.selectExpr("*", f"{interleaved_sql([('a', 3), ('b', 3), ('c', 2)])} AS p").collect()
    assert all(r.p == place(r.a, r.b, r.c) for r in got) and len({r.p for r in got}) == 256
    odd = spark.createDataFrame([(None, -5, 99)], "a int, b int, c int")
    assert odd.selectExpr(f"{interleaved_sql([('a', 3), ('b', 3), ('c', 2)])} AS p").first().p == place(0, 0, 3)


def _row_groups(folder, box):
    """Row groups that a filter on the box would have to read."""
    met = total = 0
    for name in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
            total += 1
            met += all(stats[c].min <= high and stats[c].max >= low for c, (low, high) in box.items())
    return met, total


def test_a_box_reads_fewer_row_groups_along_the_curve(spark, tmp_path):
    df = spark.range(64 * 64 * 24).selectExpr(
        "CAST(pmod(xxhash64(id), 64) AS INT) AS grid_row", "CAST(pmod(xxhash64(id, 1), 64) AS INT) AS grid_col",
        "CAST(pmod(xxhash64(id, 2), 24) AS INT) AS hour_of_day", "id")
    box = {"grid_row": (8, 15), "grid_col": (32, 39), "hour_of_day": (8, 11)}
    test = " AND ".join(f"{c} BETWEEN {a} AND {b}" for c, (a, b) in box.items())
    curved, plain, by_row = (str(tmp_path / n) for n in ("curved", "plain", "by_row"))
    rows = sinks.write_clustered(df, curved, [("grid_row", 6), ("grid_col", 6), ("hour_of_day", 5)], 64)
    df.repartition(64).write.parquet(plain)
    df.repartitionByRange(64, "grid_row").write.parquet(by_row)
    assert rows == df.count() == spark.read.parquet(curved).count()
    read = lambda path: sorted(r.id for r in spark.read.parquet(path).where(test).collect())
    assert read(curved) == read(plain) != []
    curve, unsorted, one = (_row_groups(p, box)[0] for p in (curved, plain, by_row))
    assert curve * 4 <= unsorted and curve < one


# ---------------------------------------------------------------- buckets

def test_operators_on_the_key_of_a_bucketed_table_do_not_shuffle_it(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(1, 60), START + rng.randrange(40) * 600_000, 39, *[rng.random() * 9 for _ in ACTIVITY])
            for _ in range(3_000)]
    df = evaluation.inject_anomalies(spark.createDataFrame(rows, RAW_ACTIVITY))
    table = sinks.write_bucketed(df, str(tmp_path / "b"), "bronze_in_buckets", NATURAL_KEY, 5)
    try:
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        labels = evaluation.labels_of(table)
        labelled = evaluation.with_labels(table.drop("is_anomaly_injected", "anomaly_type").hint("merge"), labels, null_safe=False)
        as_of = F.timestamp_seconds(F.lit(START // 1000 + 10 ** 8))
        for made in (cleaning.silver(table, as_of), table.groupBy(*NATURAL_KEY).count(), labelled):
            assert "Exchange" not in plan(made), plan(made)
        plain = lambda d: sorted(map(tuple, d.collect()), key=str)
        assert plain(cleaning.silver(table, as_of)) == plain(cleaning.silver(df, as_of))
        assert rules.duplicate_count(table).first() == rules.duplicate_count(df).first()
        wanted = evaluation.with_labels(df.drop("is_anomaly_injected", "anomaly_type"), evaluation.labels_of(df))
        assert plain(labelled) == plain(wanted)
    finally:
        spark.sql("DROP TABLE IF EXISTS bronze_in_buckets")


# ---------------------------------------------------------------- clustered bottleneck

def test_mixture_equals_numpy(spark):
    rng = np.random.default_rng(4)
    parts = []
    for centre in (2.0, 40.0, 90.0):      # three clouds, each flat in directions of its own
        flat = rng.normal(size=(120, 2)) @ rng.normal(size=(2, 5)) + 0.05 * rng.normal(size=(120, 5))
        parts.append(np.abs(flat + centre))
    x = np.vstack(parts)
    rows = [(i, START + i * 600_000, 39, *map(float, r)) for i, r in enumerate(x)]
    silver = cleaning.silver(spark.createDataFrame(rows, RAW_ACTIVITY), F.timestamp_seconds(F.lit(START // 1000 + 10 ** 8)))
    model = mixture.fit(silver, clusters=3, rank=2)

    ordered = sorted((r.square_id, [r[c] for c in ACTIVITY] + [r.hour_of_day / 23, r.day_of_week / 6]) for r in silver.collect())
    f = np.array([v for _, v in ordered])
    z = (f - f.mean(axis=0)) / np.where(f.std(axis=0) > 0, f.std(axis=0), 1.0)
    centres = np.array(mixture.first_centres(z, 3))
    for _ in range(50):
        near = ((z[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([z[near == k].mean(axis=0) for k in range(len(centres))])
    assert np.allclose(sorted(map(tuple, model.centres)), sorted(map(tuple, centres)), atol=1e-6)
    want = np.zeros(len(z))
    for k in range(len(centres)):
        own = z[near == k]
        away = own - own.mean(axis=0)
        _, directions = np.linalg.eigh(np.cov(own.T, bias=True))
        want[near == k] = ((away @ directions[:, :5]) ** 2).sum(axis=1) / 7
    got = {r.square_id: r.reconstruction_error for r in mixture.score(silver, model).collect()}
    assert np.allclose([got[i] for i, _ in ordered], want, atol=1e-6)
    assert model.threshold == pytest.approx(np.quantile(want, 0.95), rel=1e-5)
    linear = detector.fit(silver, rank=2)
    assert want.mean() < silver.select(F.avg(linear.error(silver))).first()[0]
