from datetime import timedelta

from telemetry_rows import at
from pyspark.sql import functions as F

from fieldpulse.operators import windows
from fieldpulse.operators.skew import HotGroups
from fieldpulse.operators.windows import WindowPolicy


def classes(frame, policy=windows.DEFAULT_POLICY):
    rows = windows.lateness_class(frame, policy).orderBy("delivery_seq").collect()
    return [row["lateness"] for row in rows]


def test_lateness_bounds_belong_to_the_accepting_side(deliveries):
    frame = deliveries(
        ("a", "00:10", "00:59", 1.0),
        ("b", "00:10", "01:00.000000", 1.0),
        ("c", "00:10", "01:00.000001", 1.0),
        ("d", "00:10", "01:10.000000", 1.0),
        ("e", "00:10", "01:10.000001", 1.0),
        ("f", "05:00", "00:30", 1.0),
    )
    assert classes(frame) == ["ON_TIME", "ON_TIME", "LATE_ACCEPTED", "LATE_ACCEPTED", "LATE_DROPPED",
                              "ON_TIME"]


def test_drop_too_late_agrees_with_the_classes(deliveries):
    frame = deliveries(*[(str(i), "00:10", f"01:{s:09.6f}", 1.0)
                         for i, s in enumerate((0, 9.999999, 10, 10.000001, 30))])
    kept = {row["idempotency_key"] for row in windows.drop_too_late(frame).collect()}
    accepted = windows.lateness_class(frame).where("lateness <> 'LATE_DROPPED'")
    assert kept == {row["idempotency_key"] for row in accepted.collect()} == {"0", "1", "2"}


def test_windows_are_half_open(deliveries):
    frame = deliveries(("a", "00:59.999999", "01:00", 1.0), ("b", "01:00", "01:01", 1.0))
    starts = [r["window_start"] for r in windows.window_key(frame).orderBy("delivery_seq").collect()]
    assert starts == [at("00:00"), at("01:00")]


def test_close_after_moves_the_closing_time_only(deliveries):
    frame = deliveries(("a", "00:10", "02:05", 1.0), ("b", "00:10", "02:11", 1.0))
    policy = WindowPolicy(close_after=timedelta(minutes=2))
    assert classes(frame, policy) == ["LATE_ACCEPTED", "LATE_DROPPED"]
    assert windows.window_key(frame, policy).first()["window_start"] == at("00:00")


def test_late_by(deliveries):
    frame = deliveries(("a", "00:10", "01:00", 1.0), ("b", "00:10", "01:05", 1.0),
                       ("c", "00:10", "01:11.5", 1.0))
    late = windows.late_by(windows.lateness_class(frame)).orderBy("delivery_seq").collect()
    assert [row["late_by"] for row in late] == [None, timedelta(seconds=5), timedelta(seconds=11.5)]
    dropped = windows.late_dropped_rows(frame).collect()
    assert [(row["idempotency_key"], row["late_by"]) for row in dropped] == [
        ("c", timedelta(seconds=11.5))]
    assert windows.late_counts(frame).first().asDict() == {"late_accepted": 1, "late_dropped": 1}


def test_load_pattern(deliveries):
    frame = deliveries(*[(str(i), "00:10", "00:20", 20.0 + i % 10) for i in range(100)])
    row = windows.window_metrics(frame).first()
    assert (row["average"], row["p95"], row["count"]) == (24.5, 29.0, 100)


def test_current_window_has_no_row_without_data(deliveries):
    frame = deliveries(("a", "00:10", "00:20", 4.0), ("b", "01:10", "01:20", 8.0))
    assert [row["p95"] for row in windows.current_window(frame, at("01:59")).collect()] == [8.0]
    assert windows.current_window(frame, at("07:00")).count() == 0


def test_current_window_bounds_reach_the_scan(spark, deliveries, tmp_path, capsys):
    deliveries(("a", "00:10", "00:20", 4.0)).write.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        windows.current_window(spark.read.parquet(str(tmp_path / "r")), at("00:30")).explain()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(recorded_at" in pushed and "LessThan(recorded_at" in pushed


def test_session_zone_does_not_move_windows(spark, deliveries):
    frame = deliveries(("a", "00:10", "00:20", 4.0))
    policy = WindowPolicy(bin=timedelta(days=1))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        start = windows.window_key(frame, policy).select(F.col("window_start").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert start == "2026-09-25 00:00:00"


def test_only_the_given_windows(deliveries, monkeypatch):
    frame = deliveries(("a", "00:10", "00:20", 4.0), ("b", "01:10", "01:20", 8.0), ("c", "01:20", "01:21", 6.0))
    only = windows.window_key(frame).where("idempotency_key = 'c'").select(*windows.WINDOW_KEYS)
    for bound in (1_000, 0):
        monkeypatch.setattr(windows, "MAX_BROADCAST_BYTES", bound)
        rows = windows.window_metrics(frame, only=only, hot=HotGroups(min_rows=1)).collect()
        assert [(row["average"], row["p95"], row["count"]) for row in rows] == [(7.0, 8.0, 2)]
