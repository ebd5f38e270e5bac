"""Streams: repeated batches, windows, several topics, publishing."""

import json

from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, FileLoad, JsonRouting, Targets, create_load_tables, dispatch, struct
from waybill.operators.routing import event_messages
from waybill.sources.topics import folder_topics, publish_file_to_folder, publish_to_folder, union_topics
from waybill.streaming.loader import query_id, run_per_batch, start_file_loads, start_json_routing, start_roads, stored_batches
from waybill.streaming.windows import latest_counts, start_windowed_counts, windowed_counts


def test_published_lines_come_back(spark, tmp_path):
    (tmp_path / "messages.json").write_text('{"a":1}\n\n{"a":2}\n')
    publish_file_to_folder(spark, f"{tmp_path}/messages.json", "t1", f"{tmp_path}/topic")
    got = []
    query = run_per_batch(
        folder_topics(spark, f"{tmp_path}/topic"), "published", f"{tmp_path}/cp",
        lambda batch, load_id: got.extend((load_id, r["value"], r["topic"]) for r in batch.collect()),
    )
    query.awaitTermination()
    load_id = f"published-{query_id(spark, f'{tmp_path}/cp')}-0"
    assert sorted(got) == [(load_id, '{"a":1}', "t1"), (load_id, '{"a":2}', "t1")]


def test_several_batches_load_once(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    for i in range(5):
        (tmp_path / f"client{i}.csv").write_text(f"NAME,AGE\nn{i},{i}\n")
        message = json.dumps({"fileURL": f"{tmp_path}/client{i}.csv", "destination": "age"})
        publish_to_folder(spark.createDataFrame([(message,)], "value string").coalesce(1), "t", f"{tmp_path}/topic")
    name = f"stream_{targets.results}"

    def start():
        stream = folder_topics(spark, f"{tmp_path}/topic", files_per_batch=1)
        return start_file_loads(stream, FileLoad(spark, targets), name, f"{tmp_path}/cp")

    start().awaitTermination()
    start().awaitTermination()
    assert sorted(tuple(r) for r in spark.table(targets.result("age")).collect()) == [(f"n{i}", i) for i in range(5)]
    assert spark.table(targets.monitoring).count() == 10
    assert len(stored_batches(spark, name)) <= 2


def one_line_files(tmp_path, numbers):
    for n in numbers:
        (tmp_path / f"client{n}.csv").write_text(f"NAME,AGE\nn{n},20\n")
    return [json.dumps({"fileURL": f"{tmp_path}/client{n}.csv", "destination": "age"}) for n in numbers]


def run_file_loads(spark, targets, topic, name, checkpoint):
    start_file_loads(folder_topics(spark, topic), FileLoad(spark, targets), name, checkpoint).awaitTermination()


def test_same_name_new_checkpoint_and_new_messages_loads_them(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    for part, numbers in (("one", range(3)), ("two", range(10, 13))):
        messages = [(m,) for m in one_line_files(tmp_path, numbers)]
        publish_to_folder(spark.createDataFrame(messages, "value string"), "t", f"{tmp_path}/{part}")
        run_file_loads(spark, targets, f"{tmp_path}/{part}", f"again_{targets.results}", f"{tmp_path}/cp_{part}")
    names = {r[0] for r in spark.table(targets.result("age")).select("NAME").collect()}
    assert names == {f"n{n}" for n in [*range(3), *range(10, 13)]}


def test_a_repeated_batch_of_one_checkpoint_is_not_loaded_twice(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    messages = [(m,) for m in one_line_files(tmp_path, [1])]
    publish_to_folder(spark.createDataFrame(messages, "value string"), "t", f"{tmp_path}/topic")
    checkpoint = tmp_path / "cp"
    for _ in range(2):
        run_file_loads(spark, targets, f"{tmp_path}/topic", f"repeat_{targets.results}", str(checkpoint))
        for commit in (checkpoint / "commits").iterdir():  # as after a crash before the commit
            commit.unlink()
    assert spark.table(targets.result("age")).count() == 1
    assert spark.table(targets.monitoring).count() == 2


def test_roads_from_two_streams(spark, targets, tmp_path):
    made = Targets(targets.results, targets.rejects, create=True)
    for topic in ("t1", "t2", "t3"):
        frame = spark.createDataFrame([('{"k":1}',), ('{"k":2}',)], "value string")
        publish_to_folder(frame, topic, f"{tmp_path}/{topic}")
    stream = union_topics(*[folder_topics(spark, f"{tmp_path}/{t}") for t in ("t1", "t2", "t3")])
    roads = {"t1": "output1", "t2": "output2", "t3": "output3"}
    start_roads(
        stream, JsonRouting(spark, made, struct(k="INTEGER")), roads, f"roads_{targets.results}", f"{tmp_path}/cp"
    ).awaitTermination()
    for table in roads.values():
        assert sorted(r["k"] for r in spark.table(made.result(table)).collect()) == [1, 2]


def test_routing_stream(spark, targets, tmp_path):
    made = Targets(targets.results, targets.rejects, create=True)
    frame = spark.createDataFrame([('{"k":1,"target_table":"a"}',), ('{"k":2,"target_table":"b"}',)], "value string")
    publish_to_folder(frame, "t", f"{tmp_path}/topic")
    start_json_routing(
        folder_topics(spark, f"{tmp_path}/topic"), JsonRouting(spark, made, struct(k="INTEGER")),
        f"route_{targets.results}", f"{tmp_path}/cp",
    ).awaitTermination()
    assert spark.table(made.result("a")).collect()[0]["k"] == 1


def write_times(spark, folder, *times):
    frame = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp("t").alias("ts"))
    frame.coalesce(1).write.mode("append").parquet(folder)


def test_windows_drop_late_rows(spark, tmp_path):
    folder = f"{tmp_path}/in"
    counts, checkpoint = f"{tmp_path}/counts", f"{tmp_path}/cp"

    def run(lateness):
        stream = spark.readStream.schema("ts timestamp").parquet(folder)
        start_windowed_counts(
            windowed_counts(stream, "ts", lateness=lateness), counts, checkpoint, "late"
        ).awaitTermination()

    write_times(spark, folder, "2024-01-01 00:00:00.1Z", "2024-01-01 00:00:00.9Z", "2024-01-01 00:00:05Z")
    run("0 seconds")
    # A second before the watermark is late; the open second is not.
    write_times(spark, folder, "2024-01-01 00:00:00.5Z", "2024-01-01 00:00:05.5Z", "2024-01-01 00:00:07Z")
    run("0 seconds")
    got = {str(r["window_start"])[-8:]: r["n"] for r in latest_counts(spark, counts).collect()}
    assert got == {"00:00:00": 2, "00:00:05": 2, "00:00:07": 1}


def test_windows_allow_lateness(spark, tmp_path):
    folder = f"{tmp_path}/in"
    counts, checkpoint = f"{tmp_path}/counts", f"{tmp_path}/cp"
    for times in (("2024-01-01 00:00:00Z", "2024-01-01 00:01:01Z"), ("2024-01-01 00:00:59Z",)):
        write_times(spark, folder, *times)
        stream = spark.readStream.schema("ts timestamp").parquet(folder)
        counted = windowed_counts(stream, "ts", window="60 seconds", lateness="2 minutes")
        start_windowed_counts(counted, counts, checkpoint, "lateness").awaitTermination()
    got = {str(r["window_start"])[-8:]: r["n"] for r in latest_counts(spark, counts).collect()}
    assert got == {"00:00:00": 2, "00:01:00": 1}


def test_dispatch_by_size(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    (tmp_path / "client1.csv").write_text("NAME,AGE\nsmall,1\n")
    (tmp_path / "client2.csv").write_text("NAME,AGE\n" + "big,20\n" * 50 + "big,99\n")
    bodies = [
        json.dumps({"fileURL": f"{tmp_path}/client1.csv", "destination": "age"}),
        json.dumps({"fileURL": f"{tmp_path}/client2.csv", "destination": "age",
                    "partition_depth": [12, 25], "partition_key": "AGE"}),
        json.dumps({"fileURL": f"{tmp_path}/client3.csv", "destination": "age"}),
        "{",
    ]
    events = spark.createDataFrame([(b, str(i)) for i, b in enumerate(bodies)], "body string, message_id string")
    events = events.select("message_id", F.base64(F.col("body").cast("binary")).alias("data"), F.current_timestamp().alias("message_ts"))
    load = FileLoad(spark, targets)
    topic = f"{tmp_path}/topic"
    for _ in range(2):  # the second time, everything is done already
        dispatch(event_messages(events), lambda rows: publish_to_folder(rows, "small", topic), load, 100, targets.results)
    assert spark.table(targets.result("age")).count() == 50
    assert spark.table(targets.reject("age")).count() == 1
    reasons = sorted(r["reason"] for r in spark.table(targets.dead_letters).collect())
    assert reasons == ["file_not_found", "invalid_message_format"]
    start_file_loads(
        folder_topics(spark, topic), load, f"small_{targets.results}", f"{tmp_path}/cp"
    ).awaitTermination()
    assert spark.table(targets.result("age")).filter("NAME = 'small'").count() == 1
    assert spark.table(targets.result("age")).count() == 51


def test_dead_letters_of_json_keep_id_and_time(spark, targets):
    from waybill import JsonRouting as Routing

    made = Targets(targets.results, targets.rejects, create=True)
    rows = [('{"k":1,"target_table":"a"}', "m1"), ("{", "m2"), ('{"k":2,"target_table":"click\\n"}', "m3"), ('{"k":3}', "m4")]
    frame = spark.createDataFrame(rows, "value string, message_id string").selectExpr(
        "value", "'t' AS topic", "message_id", "timestamp'2024-01-01 00:00:00' AS message_ts"
    )
    Routing(spark, made, struct(k="INTEGER")).run(frame)
    letters = {r["message_id"]: r for r in spark.table(made.dead_letters).collect()}
    assert sorted(letters) == ["m2", "m3", "m4"]
    assert {r["timestamp"] for r in letters.values()} == {"2024-01-01 00:00:00"}
    assert spark.table(made.result("a")).count() == 1
