"""Streams with state: co-grouped counts, late rows, closed windows, files that arrive later."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill import ExactNameLoad, Targets
from waybill.sources.topics import folder_topics, publish_to_folder
from waybill.storage import SharedFiles
from waybill.streaming import counts
from waybill.streaming.arrivals import file_arrivals, start_loads_on_arrival, timed_messages, with_arrivals
from waybill.streaming.counts import CountStore
from waybill.streaming.loader import start_exact_name_loads
from waybill.streaming.windows import (
    counts_in_time,
    late_rows,
    latest_counts,
    start_appended,
    start_counts_with_late_rows,
    start_windowed_counts,
    windowed_cogroup,
    windowed_counts,
)

START = datetime(2024, 1, 1)
ROWS = "ts timestamp, k string"


def at(second, k="a"):
    return (START + timedelta(seconds=second), k)


def write(spark, folder, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, files=1_000):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", files).parquet(folder)


def counted(frame, *columns):
    return {(int((r["window_start"] - START).total_seconds()), *[r[c] for c in columns[:-1]]): r[columns[-1]] for r in frame.collect()}


# --- co-group ----------------------------------------------------------------------------


def test_cogroup_on_streams_equals_tables(spark, tmp_path):
    valid = [at(s, k) for s, k in ((0, "a"), (0.5, "a"), (1, "a"), (1, "b"), (5, "b"))]
    refused = [at(s, k) for s, k in ((0.2, "a"), (1.5, "c"), (7, "b"), (7.1, "b"))]
    end = [at(1000, "end")]
    for name, rows in (("valid", valid), ("refused", refused)):
        write(spark, f"{tmp_path}/{name}", rows + end)
    expected = windowed_cogroup(spark.createDataFrame(valid, ROWS), spark.createDataFrame(refused, ROWS), "ts", ["k"])
    both = windowed_cogroup(stream(spark, f"{tmp_path}/valid"), stream(spark, f"{tmp_path}/refused"), "ts", ["k"])
    start_appended(both, f"{tmp_path}/out", f"{tmp_path}/cp", "cogroup").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/batch=*")
    order = ["window_start", "k"]
    assert got.sort(order).collect() == expected.sort(order).collect()
    sides = {(r["k"], r["number_inserted_rows"], r["number_rejected_rows"]) for r in got.collect()}
    assert {("a", 2, 1), ("a", 1, 0), ("b", 1, 0), ("c", 0, 1), ("b", 0, 2)} == sides


# --- late rows ---------------------------------------------------------------------------


def test_counted_and_late_rows_are_all_rows(spark, tmp_path):
    batches = [[at(0), at(0.5), at(10)], [at(0.7), at(9.5), at(10.5), at(12)], [at(8), at(11.9), at(13), at(13)], [at(0)]]
    for rows in batches:
        write(spark, f"{tmp_path}/in", rows)

    def run():
        start_counts_with_late_rows(
            stream(spark, f"{tmp_path}/in", 1), "ts", f"{tmp_path}/out", f"{tmp_path}/cp", "late", ["k"], lateness="1 second"
        ).awaitTermination()

    run()
    # Watermarks before the batches: none, 9, 11, 12.
    late = sorted((r["ts"] - START).total_seconds() for r in late_rows(spark, f"{tmp_path}/out", ROWS).collect())
    assert late == [0, 0.7, 8]
    got = counted(counts_in_time(spark, f"{tmp_path}/out", ["k"], lateness="1 second"), "k", "n")
    assert got == {(0, "a"): 2, (9, "a"): 1, (10, "a"): 2, (11, "a"): 1, (12, "a"): 1, (13, "a"): 2}
    assert sum(got.values()) + len(late) == sum(map(len, batches))
    # A batch that is repeated after a crash before its commit changes nothing.
    for commit in (tmp_path / "cp" / "commits").glob("*3*"):
        commit.unlink()
    run()
    assert counted(counts_in_time(spark, f"{tmp_path}/out", ["k"], lateness="1 second"), "k", "n") == got
    assert late_rows(spark, f"{tmp_path}/out", ROWS).count() == 3


# --- closed windows ----------------------------------------------------------------------


@pytest.mark.parametrize("merge", ["latest", "sum"])
def test_closed_windows_are_put_together(spark, tmp_path, monkeypatch, merge):
    monkeypatch.setattr(counts, "COMPACT_EVERY", 2)
    store = CountStore(spark, str(tmp_path), ("k",), merge=merge)
    expected = {}
    for number in range(13):
        rows = [(START + timedelta(seconds=s), "a", number + 1) for s in (number, number + 1)]
        store.write(spark.createDataFrame(rows, "window_start timestamp, k string, n long"), number)
        for t, k, n in rows:
            key = (int((t - START).total_seconds()), k)
            expected[key] = n if merge == "latest" else expected.get(key, 0) + n
        assert counted(store.read(), "k", "n") == expected
        if number % 2:  # a repeated batch, as after a crash
            store.write(spark.createDataFrame(rows, "window_start timestamp, k string, n long"), number)
            assert counted(store.read(), "k", "n") == expected
    files = SharedFiles(spark)
    assert len(files.glob(f"{tmp_path}/batch=*")) == 1 and len(files.glob(f"{tmp_path}/open/through=*")) == 1
    assert len(files.glob(f"{tmp_path}/closed/tier=*/through=*")) <= 4


def test_a_crash_within_the_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counts, "COMPACT_EVERY", 2)
    store = CountStore(spark, str(tmp_path))

    def batch(number):
        return spark.createDataFrame([(START + timedelta(seconds=number), number + 1)], "window_start timestamp, n long")

    store.write(batch(0), 0)
    with monkeypatch.context() as broken:
        broken.setattr(SharedFiles, "remove", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.write(batch(1), 1)
    assert counted(store.read(), "n") == {(0,): 1, (1,): 2}
    store.write(batch(1), 1)
    store.write(batch(2), 2)
    assert counted(store.read(), "n") == {(0,): 1, (1,): 2, (2,): 3}
    assert not SharedFiles(spark).any(f"{tmp_path}/batch=0")


def test_a_reader_opens_few_frames_of_a_long_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counts, "COMPACT_EVERY", 3)
    for second in range(7):
        write(spark, f"{tmp_path}/in", [at(second), at(second + 0.5)])
    query = start_windowed_counts(
        windowed_counts(stream(spark, f"{tmp_path}/in", 1), "ts", ["k"]), f"{tmp_path}/counts", f"{tmp_path}/cp", "closed"
    )
    query.awaitTermination()
    assert counted(latest_counts(spark, f"{tmp_path}/counts", ["k"]), "k", "n") == {(s, "a"): 2 for s in range(7)}
    assert len(SharedFiles(spark).glob(f"{tmp_path}/counts/batch=*")) < 3


def test_a_trigger_with_a_pause(spark, tmp_path):
    write(spark, f"{tmp_path}/in", [at(0), at(1)])
    query = start_windowed_counts(
        windowed_counts(stream(spark, f"{tmp_path}/in"), "ts"), f"{tmp_path}/counts", f"{tmp_path}/cp", "paused", every="1 second"
    )
    try:
        query.processAllAvailable()
        write(spark, f"{tmp_path}/in", [at(1.5)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert counted(latest_counts(spark, f"{tmp_path}/counts"), "n") == {(0,): 1, (1,): 2}


# --- arrivals ----------------------------------------------------------------------------


def envelopes(spark, folder, *rows):
    frame = spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v), i, START + timedelta(seconds=s)) for v, i, s in rows], "value string, message_id string, message_ts timestamp")
    publish_to_folder(frame, "t", folder)


def test_messages_wait_for_their_file(spark, targets, tmp_path):
    made = Targets(targets.results, targets.rejects, create=True)
    for name in ("one", "two", "late"):
        (tmp_path / f"{name}.csv").write_text(f"h\n{name},1,1.5\n")
    message = [{"address": f"{tmp_path}/{n}.csv", "destination": "t"} for n in ("one", "two", "late", "none")]
    envelopes(
        spark, f"{tmp_path}/messages", (message[0], "m0", 0), (message[1], "m1", 5), (message[2], "m2", 5), (message[3], "m3", 6), ("{", "m4", 7),
        ({"address": "end", "destination": "t"}, "end", 9_000),
    )
    files = [({"file": f"file://{tmp_path}/one.csv"}, "f0", 50), ({"file": f"{tmp_path}//two.csv"}, "f1", -50)]
    files += [({"file": f"{tmp_path}/late.csv"}, "f2", 700), ("no event", "f3", 1), ({"file": "other"}, "f4", 9_000)]
    envelopes(spark, f"{tmp_path}/files", *files)
    start_loads_on_arrival(
        folder_topics(spark, f"{tmp_path}/messages"), folder_topics(spark, f"{tmp_path}/files"), ExactNameLoad(spark, made),
        f"arrive_{targets.results}", f"{tmp_path}/cp",
    ).awaitTermination()
    assert sorted(r["name"] for r in spark.table(made.result("t")).collect()) == ["one", "two"]
    letters = sorted((r["message_id"], r["reason"]) for r in spark.table(made.dead_letters).collect())
    assert letters == [("m2", "file_not_found"), ("m3", "file_not_found"), ("m4", "invalid_message_format")]


def test_the_same_join_on_tables(spark):
    data = [('{"address": "/x", "destination": "t"}', "1", START), ('{"address": "/y", "destination": "t"}', "2", START)]
    messages = timed_messages(spark.createDataFrame(data, "value string, message_id string, message_ts timestamp"))
    events = [('{"file": "file:///x"}', START + timedelta(seconds=9)), ('{"file": 3}', START), ("{", START)]
    arrivals = file_arrivals(spark.createDataFrame(events, "value string, message_ts timestamp"))
    got = {r["message_id"]: r["arrived"] is not None for r in with_arrivals(messages, arrivals).collect()}
    assert got == {"1": True, "2": False} and arrivals.count() == 1


def test_exact_name_loads_of_a_stream(spark, targets, tmp_path):
    made = Targets(targets.results, targets.rejects, create=True)
    (tmp_path / "tabledata2.csv").write_text("h\nAnn,20,red\n")
    envelopes(
        spark, f"{tmp_path}/topic", ({"address": f"{tmp_path}/tabledata2.csv", "destination": "colors"}, "1", 0),
        ({"fileURL": f"{tmp_path}/none.csv", "destination": "colors"}, "2", 0), ({"address": 3, "destination": "colors"}, "3", 0),
    )
    start_exact_name_loads(
        folder_topics(spark, f"{tmp_path}/topic"), ExactNameLoad(spark, made), f"exact_{targets.results}", f"{tmp_path}/cp"
    ).awaitTermination()
    assert [tuple(r) for r in spark.table(made.result("colors")).collect()] == [("Ann", 20, "red")]
    letters = {(r["message_id"], r["reason"]) for r in spark.table(made.dead_letters).collect()}
    assert letters == {("2", "file_not_found"), ("3", "invalid_message_format")}


def test_no_late_rows(spark, tmp_path):
    assert late_rows(spark, str(tmp_path), ROWS).count() == 0
    with pytest.raises(FileNotFoundError):
        CountStore(spark, str(tmp_path)).read()
    assert F is not None
