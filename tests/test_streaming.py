import datetime
import statistics

import pytest

from trailmark.streaming import replay, windows

SCHEMA = "ts timestamp, prev string, curr string, n bigint, day string"


def at(day, hour, minute=0):
    return datetime.datetime(2024, 1, day, hour, minute)


ROWS = [
    (at(1, 1, 5), "A", "B", 1, "2024-01-01"),
    (at(1, 1, 50), "A", "B", 2, "2024-01-01"),
    (at(1, 2), "A", "B", 4, "2024-01-01"),
    (at(2, 9), "A", "C", 8, "2024-01-02"),
    (at(3, 0), "A", "B", 500, "2024-01-03"),
]


def replayed(spark, path, end=True):
    df = spark.createDataFrame(ROWS, SCHEMA)
    replay.write_replay(df, path, "day")
    if end:
        replay.end_replay(df, path, "ts")
    return replay.open_replay(spark, path, df.schema)


def windows_of(rows):
    return sorted((str(r["window_start"]), r["prev"], r["curr"], r["n"]) for r in rows)


WANT = [
    ("2024-01-01 01:00:00", "A", "B", 3),
    ("2024-01-01 02:00:00", "A", "B", 4),
    ("2024-01-02 09:00:00", "A", "C", 8),
    ("2024-01-03 00:00:00", "A", "B", 500),
]


def test_append_gives_every_window_once(spark, tmp_path):
    stream = windows.window_counts(replayed(spark, str(tmp_path / "in")))
    query = replay.run_to_end(replay.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert windows_of(spark.read.parquet(str(tmp_path / "out")).collect()) == WANT
    assert replay.dropped_rows(query) == 0
    assert windows_of(windows.window_counts(spark.createDataFrame(ROWS, SCHEMA)).collect()) == WANT


def test_open_windows_wait(spark, tmp_path):
    stream = windows.window_counts(replayed(spark, str(tmp_path / "in"), end=False))
    replay.run_to_end(replay.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert windows_of(spark.read.parquet(str(tmp_path / "out")).collect()) == WANT[:3]


def test_update_mode(spark, tmp_path):
    stream = windows.window_counts(replayed(spark, str(tmp_path / "in"), end=False))
    query = (
        stream.writeStream.outputMode("update").format("memory").queryName("updates")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    replay.run_to_end(query)
    assert windows_of(spark.table("updates").collect()) == WANT


def test_console(spark, tmp_path):
    stream = windows.window_counts(replayed(spark, str(tmp_path / "in"), end=False))
    query = replay.run_to_end(replay.show_updates(stream, str(tmp_path / "cp")))
    assert not query.isActive and query.exception() is None


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "in")
    # newest first; a batch is judged by the watermark its predecessor ran with, so the third is late
    replay.write_replay(df, path, "day", newest_first=True)
    stream = windows.window_counts(replay.open_replay(spark, path, df.schema))
    query = replay.run_to_end(replay.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert replay.dropped_rows(query) > 0


def test_alerts(spark, tmp_path):
    base = spark.createDataFrame([("A", "B", 3.0, 1.0)], "prev string, curr string, baseline_median double, baseline_mad double")
    scored = windows.score_windows(windows.window_counts(replayed(spark, str(tmp_path / "in"))), base)
    replay.run_to_end(replay.append_to(windows.alerts(scored), str(tmp_path / "out"), str(tmp_path / "cp")))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["n"], round(r["deviation_ratio"], 3)) for r in rows] == [(500, 166.667)]


def window_rows():
    rows = [("A", "B", at(day, hour), 10 * day + hour) for day in range(1, 8) for hour in (1, 5, 9)]
    return rows + [("C", "B", at(3, 2), 7), ("C", "B", at(6, 2), 21)]


def running(rows):
    """Each window against the mean and deviation of the edge's windows before it, row by row."""
    out = {}
    for prev, curr, start, n in sorted(rows, key=lambda r: r[2]):
        before = [r[3] for r in rows if r[:2] == (prev, curr) and r[2] < start]
        std = statistics.stdev(before) if len(before) > 1 else None
        mean = statistics.fmean(before) if before else None
        out[prev, curr, str(start)] = (n, len(before), mean, std, (n - mean) / (std + 0.01) if std is not None else None)
    return out


def scored(spark, folder, rows, keep="30 days"):
    df = spark.createDataFrame([(*r, str(r[2].date())) for r in rows], "prev string, curr string, window_start timestamp, n bigint, day string")
    replay.write_replay(df, f"{folder}/in", "day")
    stream = windows.running_scores(replay.open_replay(spark, f"{folder}/in", df.schema), keep=keep)
    replay.run_to_end(replay.put_batches(stream, f"{folder}/out", f"{folder}/cp"))
    return spark.read.parquet(f"{folder}/out")


def test_running_scores_equal_those_of_all_rows(spark, tmp_path):
    got = {(r.prev, r.curr, str(r.window_start)): (r.n, r.seen, r.baseline_mean, r.baseline_std, r.z_score) for r in scored(spark, tmp_path, window_rows()).collect()}
    want = running(window_rows())
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key][:2] == values[:2]
        assert all((a is None and b is None) or a == pytest.approx(b) for a, b in zip(got[key][2:], values[2:], strict=True))


def test_forgotten_edges_start_anew(spark, tmp_path):
    rows = [("A", "B", at(1, 1), 5), ("A", "B", at(1, 3), 7), *[("X", "Y", at(day, 1), 1) for day in range(2, 12)], ("A", "B", at(12, 1), 9)]
    found = {str(r.window_start): r.seen for r in scored(spark, tmp_path, rows, keep="3 days").filter("prev = 'A'").collect()}
    assert found == {str(at(1, 1)): 0, str(at(1, 3)): 1, str(at(12, 1)): 0}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = scored(spark, tmp_path, window_rows())
    before = sorted(map(str, rows.collect()))
    again = spark.createDataFrame(rows.filter("batch = 2").drop("batch").collect(), rows.drop("batch").schema)
    replay.put_batch(again, 2, f"{tmp_path}/out")
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out").collect())) == before


def test_slices_are_read_in_order(spark, tmp_path):
    df = spark.createDataFrame([(at(d, 1), "A", "B", d, f"2024-01-{d:02d}") for d in range(1, 9)], SCHEMA)
    replay.write_replay(df, str(tmp_path / "in"), "day", files_per_slice=2)
    seen = []
    query = (
        replay.open_replay(spark, str(tmp_path / "in"), df.schema)
        .writeStream.foreachBatch(lambda rows, k: seen.append([r.n for r in rows.collect()]))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    replay.run_to_end(query)
    assert seen == [[d] for d in range(1, 9)]
