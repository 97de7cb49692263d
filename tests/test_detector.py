import os
import random

import numpy as np
import pytest
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import cleaning, detector, evaluation
from tessera.plans import queries
from tessera.schema import ACTIVITY, FLAGS, NATURAL_KEY, RAW_ACTIVITY

START = 1_704_067_200_000
SCORED = ("square_id int, time_interval long, country_code int, internet double, reconstruction_error double, "
          "is_anomaly_predicted boolean, anomaly_type_predicted string")


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        base = rng.lognormvariate(1, 0.5)
        rows.append((i % 50 + 1, START + i * 600_000, 39, base * rng.uniform(0.8, 1.2), base, base * 0.5,
                     rng.uniform(0, 3), base * 2 + rng.uniform(0, 1)))
    records = spark.createDataFrame(rows, RAW_ACTIVITY)
    path = str(tmp_path_factory.mktemp("silver") / "t")
    as_of = F.timestamp_seconds(F.lit((START + 10**11) // 1000))
    cleaning.silver(evaluation.inject_anomalies(records), as_of).write.parquet(path)
    return spark.read.parquet(path)


def matrix(df):
    f = detector.features_sql(df)
    return np.array(df.selectExpr(*f).collect(), dtype=float)


def test_pca_errors_equal_a_direct_computation(silver):
    model = detector.fit(silver, rank=4)
    train, everything = matrix(cleaning.clean(silver)), matrix(silver)
    mean, std = train.mean(axis=0), train.std(axis=0)
    z = (train - mean) / std
    _, directions = np.linalg.eigh(z.T @ z / len(z))
    kept = directions[:, -4:]
    residual = lambda x: ((x - x @ kept @ kept.T) ** 2).mean(axis=1)
    threshold = np.percentile(residual(z), 95)
    assert model.training_samples == len(train)
    assert model.threshold == pytest.approx(threshold, rel=1e-6)
    want = residual((everything - mean) / std)
    got = [r[0] for r in detector.score(silver, model).select("reconstruction_error").collect()]
    assert sorted(got) == pytest.approx(sorted(want), rel=1e-6, abs=1e-9)


def test_labelled_scores_are_decided_by_the_bottleneck(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    rows = queries.silver(spark, sf).toPandas()
    x = np.column_stack([*(rows[c].to_numpy() for c in ACTIVITY), rows["hour_of_day"] / 23, rows["day_of_week"] / 6])
    kept = ~rows[FLAGS].to_numpy(dtype=bool).any(axis=1)
    z = (x - x[kept].mean(axis=0)) / x[kept].std(axis=0)
    _, directions = np.linalg.eigh(z[kept].T @ z[kept] / kept.sum())
    decided = lambda errors: errors - np.percentile(errors[kept], 95) > queries.TOLERANCE
    whole, plain = (decided((part ** 2).sum(axis=1) / 7) for part in (z @ directions[:, :3], z))
    assert (whole != plain).any()
    want = dict(zip(map(tuple, rows[NATURAL_KEY].to_numpy()), whole))
    got = queries.labelled_scores(spark, sf).collect()
    assert {tuple(r[k] for k in NATURAL_KEY): r["is_anomaly_predicted"] for r in got} == want and len(got) == len(rows)


def test_directions_agree_with_spark_ml(silver):
    model = detector.fit(silver, rank=4)
    train = cleaning.clean(silver).selectExpr(
        *[f"(({f}) - {m}) / {s} AS f{i}" for i, (f, m, s) in
          enumerate(zip(detector.features_sql(silver), model.mean, model.scale))])
    vectors = VectorAssembler(inputCols=train.columns, outputCol="v").transform(train)
    components = PCA(k=4, inputCol="v", outputCol="p").fit(vectors).pc.toArray()
    # What the bottleneck keeps is orthogonal to what it leaves out.
    assert np.abs(np.array(model.unexplained) @ components).max() < 1e-6


def test_about_five_percent_of_clean_rows_exceed_the_threshold(silver):
    for rank in (0, 2, 4):
        model = detector.fit(silver, rank)
        flagged = detector.score(cleaning.clean(silver), model).where("is_anomaly_predicted").count()
        assert flagged / model.training_samples == pytest.approx(0.05, abs=0.002)


def test_spikes_err_more_than_normal_rows(silver):
    for rank in (0, 4):
        scores = detector.score(silver.select("*"), detector.fit(silver, rank))
        labelled = evaluation.with_labels(scores, silver.select(*NATURAL_KEY, "is_anomaly_injected", "anomaly_type"))
        mean = {r[0]: r[1] for r in labelled.groupBy("anomaly_type").agg(F.avg("reconstruction_error")).collect()}
        assert mean["activity_spike"] > 5 * mean[None]


def test_model_survives_saving(spark, silver, tmp_path):
    model = detector.fit(silver, rank=4)
    model.save(spark, str(tmp_path / "m"))
    assert detector.Detector.load(spark, str(tmp_path / "m")) == model
    assert '"training_samples"' in model.metadata()


def test_constant_and_missing_features(spark):
    rows = [(i, START, 39, 1.0, 1.0, 1.0, 1.0, float(i)) for i in range(1, 30)]
    df = cleaning.silver(spark.createDataFrame(rows, RAW_ACTIVITY))
    model = detector.fit(df, rank=4)
    assert model.scale[0] == 1.0 and model.threshold < 1e-20
    text = df.select(*NATURAL_KEY, F.lit("oops").alias("sms_in"), F.lit("2.5").alias("sms_out"))
    assert matrix(text.limit(1)).tolist() == [[0, 2.5, 0, 0, 0, 0, 0]]
    with pytest.raises(ValueError):
        detector.fit(df.where("false"))


def test_classes_follow_their_order(spark):
    base = {"_has_negative_activity": False, "_is_future_timestamp": False, "_is_null_activity": False,
            **{c: 1.0 for c in ACTIVITY}, "odd": True}
    cases = [
        ({"odd": False, "_is_future_timestamp": True}, "normal"),
        ({"_is_future_timestamp": True, "_has_negative_activity": True}, "future_timestamp"),
        ({"_is_null_activity": True, "_has_negative_activity": True}, "null_activity"),
        ({"_has_negative_activity": True, **{c: 0.0 for c in ACTIVITY}}, "negative_activity"),
        ({c: 0.009 for c in ACTIVITY}, "dead_zone"),
        ({"internet": 0.01, **{c: 0.0 for c in ACTIVITY[:-1]}}, "activity_spike"),
    ]
    from tessera.functions.activity import anomaly_class_sql
    for change, want in cases:
        row = spark.createDataFrame([{**base, **change}])
        assert row.selectExpr(anomaly_class_sql("odd")).first()[0] == want


def test_error_equal_to_the_threshold_is_normal(silver):
    model = detector.fit(silver, rank=0)
    top = silver.withColumn("e", model.error(silver)).agg(F.max("e")).first()[0]
    same = detector.Detector(**{**model.__dict__, "threshold": top})
    assert detector.score(silver, same).where("is_anomaly_predicted").count() == 0


def test_injection_is_repeatable_and_keeps_every_row(spark, silver):
    records = spark.range(20_000).selectExpr(
        "CAST(id % 10000 + 1 AS INT) AS square_id", f"{START} + id * 600000 AS time_interval",
        "39 AS country_code", *[f"1D AS {c}" for c in ACTIVITY])
    a = evaluation.inject_anomalies(records)
    b = evaluation.inject_anomalies(records.repartition(5))
    assert a.count() == 20_000 and a.exceptAll(b).count() == 0
    chosen = a.where("is_anomaly_injected")
    assert 850 < chosen.count() < 1150
    counts = {r[0]: r[1] for r in evaluation.value_counts(chosen, "anomaly_type").collect()}
    for name, share in evaluation.TYPE_SHARES:
        assert counts[name] / chosen.count() == pytest.approx(share / 100, abs=0.05)
    assert chosen.where("anomaly_type = 'activity_spike' AND NOT sms_in BETWEEN 15 AND 50").count() == 0
    assert chosen.where("anomaly_type = 'negative_activity' AND least(sms_in, sms_out, call_in, call_out, internet) "
                        "NOT BETWEEN -120 AND -1").count() == 0
    assert a.where("NOT is_anomaly_injected AND anomaly_type IS NOT NULL").count() == 0


def test_evaluation_against_labels(spark):
    key = [(1, 1, 1), (2, 1, 1), (3, 1, None), (4, 1, 1)]
    scores = spark.createDataFrame(
        [(*k, 1.0, 0.5, p, "x") for k, p in zip(key, [True, True, False, False])], SCORED)
    labels = spark.createDataFrame(
        [(1, 1, 1, True, "a"), (1, 1, 1, False, None), (3, 1, None, True, "b"), (4, 1, 1, False, None)],
        "square_id int, time_interval long, country_code int, is_anomaly_injected boolean, anomaly_type string")
    joined = evaluation.with_labels(scores, evaluation.labels_of(labels))
    assert joined.count() == 4
    assert tuple(evaluation.confusion_matrix(joined).first()) == (1, 1, 1, 1)
    report = {r["class"]: r for r in evaluation.classification_report(joined).collect()}
    assert report["anomaly"]["precision"] == report["normal"]["recall"] == 0.5 and report["normal"]["support"] == 2
    assert report["accuracy"]["f1"] == report["macro avg"]["recall"] == report["weighted avg"]["precision"] == 0.5
    assert report["accuracy"]["support"] == 4
    nothing = evaluation.classification_report(joined.where("false")).collect()
    assert [(r["f1"], r["support"]) for r in nothing] == [(0.0, 0)] * 5


def test_histogram_counts_every_value_once(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS x")
    bins = evaluation.histogram(df, "x", 10).orderBy("bin").collect()
    want, _ = np.histogram(np.arange(1001), bins=10)
    assert [r["count"] for r in bins] == want.tolist() and bins[-1]["bin_end"] == 1000.0
    one = evaluation.histogram(df.where("x = 5"), "x").collect()
    assert len(one) == 100 and [(r["bin"], r["count"]) for r in one if r["count"]] == [(51, 1)]
    assert evaluation.histogram(df.where("false"), "x").count() == 0


def test_histogram_sets_other_numbers_apart_and_lists_empty_bins(spark):
    odd = [float("nan"), float("inf"), float("inf"), float("-inf"), None, 0.0, 10.0, 9.9]
    df = spark.createDataFrame([(v,) for v in odd], "x double")
    got = {r["bin"]: (r["bin_start"], r["count"]) for r in evaluation.histogram(df, "x", 10).collect()}
    assert len(got) == 13 and got[-1] == (None, 1) and got[0] == (None, 1) and got[11] == (None, 2)
    assert [got[b][1] for b in range(1, 11)] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 2]


def test_statistics_of_scores(spark):
    rows = [(i, 1, 1, float(i), float(i), i >= 950, "a" if i >= 950 else "normal") for i in range(1000)]
    scores = spark.createDataFrame(rows, SCORED)
    assert detector.anomaly_statistics(scores).first().asDict() == {
        "total_records": 1000, "anomalies_detected": 50, "high_risk_count": 10, "anomaly_rate_pct": 5.0}
    assert [r["internet"] for r in detector.top_internet_spikes(scores).collect()] == [999, 998, 997, 996, 995]
    assert [r["square_id"] for r in detector.top_anomalies(scores, 2).collect()] == [999, 998]
    bundle = detector.anomaly_bundle(scores).first()
    assert bundle["total_records"] == 1000 and [x["internet"] for x in bundle["top_internet"]] == [999, 998, 997, 996, 995]
    assert {x["anomaly_type_predicted"]: x["count"] for x in bundle["breakdown"]} == {"a": 50, "normal": 950}
    empty = detector.anomaly_statistics(scores.where("false")).first()
    assert (empty["total_records"], empty["anomaly_rate_pct"]) == (0, 0.0)
