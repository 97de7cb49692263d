"""The event-time stream: copies, slow rows, late rows, rows from the future, restarts."""

from pyspark.sql import functions as F

from tessera.sources import sinks
from tessera.streaming import usage

DAY = 86_400_000
START = 1_704_067_200_000


def _file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join("\t".join(map(str, r)) + "\n" for r in rows))


def _row(square, day, hour, value=1.0, country=39):
    return (square, START + (day - 1) * DAY + hour * 3_600_000, country, *[value] * 5)


def _as_of():
    return F.timestamp_seconds(F.lit((START + 60 * DAY) // 1000))


def test_three_arrivals(spark, tmp_path):
    raw, root, progress = tmp_path / "raw", str(tmp_path / "usage"), str(tmp_path / "progress")
    take = lambda: usage.take_new_files(spark, str(raw), root, progress, "*.txt", _as_of())
    usage_rows = lambda: sorted((str(r.date), r.country_code, r.record_count, r.active_squares, r.total_internet)
                                for r in usage.daily_usage(spark, root).collect())
    aside = lambda: sorted((r.verdict, r.square_id) for r in usage.set_aside(spark, root).collect())

    _file(raw, "1.txt", [_row(1, 1, 5), _row(2, 1, 6, -4.0), _row(1, 3, 1), (7, "soon", 39, 1, 1, 1, 1, 1),
                         _row(8, 400, 1)])       # unreadable time; a year ahead: must not move the mark
    take()
    assert aside() == [("future", 8), ("undated", 7)]
    assert usage_rows() == [("2024-01-01", 39, 2, 2, 1.0), ("2024-01-03", 39, 1, 1, 1.0)]

    # The mark is day 3, 1 o'clock: day 1, 5 o'clock is within 48 hours; day 1, 1 o'clock is not.
    _file(raw, "2.txt", [_row(1, 1, 5), _row(3, 1, 7, 2.0), _row(4, 1, 1), _row(5, 1, 0), _row(1, 10, 0, 3.0, 40)])
    take()
    assert aside() == [("future", 8), ("late", 4), ("late", 5), ("undated", 7)]
    want = [("2024-01-01", 39, 3, 3, 3.0), ("2024-01-03", 39, 1, 1, 1.0), ("2024-01-10", 40, 1, 1, 3.0)]
    assert usage_rows() == want

    for _ in range(2):      # nothing new
        take()
    assert usage_rows() == want and len(aside()) == 4

    _file(raw, "3.txt", [_row(9, 3, 1), _row(1, 10, 0, 3.0, 40), _row(2, 10, 1, 5.0, 40)])
    take()
    assert usage_rows() == [*want[:2], ("2024-01-10", 40, 2, 2, 8.0)]
    assert aside()[2] == ("late", 5) and ("late", 9) in aside()


def test_an_arrival_cut_short_is_taken_again(spark, tmp_path):
    """Arrivals written without their micro-batch being committed: replaced, not added to."""
    raw, root, progress = tmp_path / "raw", str(tmp_path / "usage"), str(tmp_path / "progress")
    half = spark.createDataFrame([(1, START, 39, *[1.0] * 5)], usage.RAW_ACTIVITY).selectExpr(
        "*", "timestamp_millis(time_interval) AS event_time", "'in_time' AS verdict")
    sinks.write_micro_batch(half, f"{root}/arrivals", 0, ["verdict"])
    _file(raw, "1.txt", [_row(1, 1, 0), _row(2, 1, 1)])
    usage.take_new_files(spark, str(raw), root, progress, "*.txt", _as_of())
    row = usage.daily_usage(spark, root).first()
    assert (row.record_count, row.active_squares, row.total_internet) == (2, 2, 2.0)


def test_states_by_cores_and_as_begun(spark, tmp_path):
    """As many partitions of the state as the cores can use, not one per shuffle partition; the checkpoint keeps them."""
    raw, root, progress = tmp_path / "raw", str(tmp_path / "usage"), tmp_path / "progress"
    states = lambda: len([p for p in (progress / "usage" / "state" / "0").iterdir() if p.name.isdigit()])
    few, most = spark.conf.get("spark.sql.shuffle.partitions"), 4 * spark.sparkContext.defaultParallelism
    try:
        for name, wanted in (("1.txt", str(most + 8)), ("2.txt", "2")):
            spark.conf.set("spark.sql.shuffle.partitions", wanted)
            _file(raw, name, [_row(int(name[0]), 1, 0), _row(9, 1, 1)])
            usage.take_new_files(spark, str(raw), root, str(progress), "*.txt", _as_of())
            assert states() == most
            assert spark.conf.get("spark.sql.shuffle.partitions") == wanted
        row = usage.daily_usage(spark, root).first()
        assert (row.record_count, row.active_squares) == (3, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)


def test_nothing_has_arrived(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    usage.take_new_files(spark, str(tmp_path / "raw"), str(tmp_path / "u"), str(tmp_path / "p"), "*.txt")
    assert not (tmp_path / "u" / "usage").exists()
