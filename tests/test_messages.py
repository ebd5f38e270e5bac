"""Messages: parsing, checks, dead letters, routing."""

import base64

import pytest
from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, FileLoad, create_load_tables, messages_frame, parse_messages
from waybill.operators.joins import Size, attach, beside_list
from waybill.operators.messages import prepare_messages
from waybill.operators.routing import event_messages, route_by_size, rows_with_target

GOOD = '{"fileURL":"/in/client1.csv","destination":"age"}'
MESSAGES = {
    "good": (GOOD, ""),
    "predicate": (GOOD[:-1] + ',"partition_depth":[12,25.5],"partition_key":"AGE"}', ""),
    "bad json": (GOOD[:-1], "invalid_message_format"),
    "empty": ("", "invalid_message_format"),
    "array": ("[1]", "invalid_message_format"),
    "no destination": ('{"fileURL":"/in/client1.csv"}', "invalid_message_format"),
    "number url": ('{"fileURL":5,"destination":"age"}', "invalid_message_format"),
    "null url": ('{"fileURL":null,"destination":"age"}', "invalid_message_format"),
    "extra": (GOOD[:-1] + ',"x":1}', ""),
    "no layout": ('{"fileURL":"/in/my_client.csv","destination":"age"}', "no_structure"),
    "case": ('{"fileURL":"/in/Client.csv","destination":"age"}', "no_structure"),
    "no table": ('{"fileURL":"/in/client1.csv","destination":"Age"}', "unknown_destination"),
    "no key": (GOOD[:-1] + ',"partition_depth":[1,2],"partition_key":"age"}', "unknown_partition_key"),
    "bad bound": (GOOD[:-1] + ',"partition_depth":["x",2],"partition_key":"AGE"}', "invalid_partition_bounds"),
    "one bound": (GOOD[:-1] + ',"partition_depth":[1],"partition_key":"AGE"}', "invalid_partition_bounds"),
}


def envelopes(spark, messages):
    rows = [(k, bytearray(v, "utf-8")) for k, v in messages.items()]
    frame = spark.createDataFrame(rows, "message_id string, value binary")
    return frame.withColumn("message_ts", F.timestamp_seconds(F.lit(1704067200)))


def test_problems(spark):
    parsed = parse_messages(envelopes(spark, {k: v[0] for k, v in MESSAGES.items()}))
    got = {r["message_id"]: r["problem"] for r in prepare_messages(parsed, DEFAULT_REGISTRY).collect()}
    assert got == {k: v[1] for k, v in MESSAGES.items()}


def test_strict_keys(spark):
    parsed = parse_messages(envelopes(spark, {k: v[0] for k, v in MESSAGES.items()}), strict_keys=True)
    bad = {r["message_id"] for r in parsed.collect() if r["problem"]}
    assert bad == {k for k, v in MESSAGES.items() if v[1] == "invalid_message_format"} | {"extra"}


def test_dead_letters_of_a_load(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    (tmp_path / "client1.csv").write_text("NAME,AGE\nAnn,20\n")
    messages = {
        "ok": f'{{"fileURL":"{tmp_path}/client1.csv","destination":"age"}}',
        "gone": f'{{"fileURL":"{tmp_path}/client2.csv","destination":"age"}}',
        "glob gone": f'{{"fileURL":"{tmp_path}/client9*.csv","destination":"age"}}',
        "bad": "{",
    }
    FileLoad(spark, targets).run(parse_messages(envelopes(spark, messages)))
    letters = {r["message_id"]: r["reason"] for r in spark.table(targets.dead_letters).collect()}
    assert letters == {
        "gone": "file_not_found", "glob gone": "file_not_found", "bad": "invalid_message_format",
    }
    events = sorted(r["event"] for r in spark.table(targets.monitoring).collect())
    assert events == ["START", "START", "START", "SUCCESS"]
    assert {r["timestamp"] for r in spark.table(targets.monitoring).collect()} == {"2024-01-01 00:00:00"}


def test_nothing_but_bad_messages(spark, targets):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    FileLoad(spark, targets).run(parse_messages(envelopes(spark, {"bad": "{"})))
    assert spark.table(targets.dead_letters).count() == 1
    assert spark.table(targets.monitoring).count() == 0


def test_events(spark):
    data = base64.b64encode(GOOD.encode()).decode()
    rows = [("1", "t", data), ("2", "t", base64.b64encode(b"{").decode())]
    got = event_messages(spark.createDataFrame(rows, "message_id string, message_ts string, data string")).collect()
    assert {r["message_id"]: (r["fileURL"], r["problem"]) for r in got} == {
        "1": ("/in/client1.csv", ""), "2": (None, "invalid_message_format"),
    }


def test_size_route(spark):
    messages = messages_frame(
        spark, [{"fileURL": u, "destination": "age", "id": u, "timestamp": "t"} for u in ("a", "b", "c", "d")]
    )
    sizes = spark.createDataFrame([("a", 10**9 - 1), ("b", 10**9), ("d", 6 * 10**8), ("d", 6 * 10**8)], "fileURL string, length long")
    got = {r["fileURL"]: r["route"] for r in route_by_size(messages, sizes).collect()}
    assert got == {"a": "stream", "b": "batch", "c": None, "d": "batch"}


def test_rows_with_target(spark):
    rows = {
        "1": '{"name":"J","age":62,"height":1.66,"target_table":"Out1"}',
        "2": '{"name":"J","target_table":"a b"}',
        "3": '{"name":"J"}',
        "4": "{",
        "5": '{"name":"J","age":"x","target_table":"out2"}',
    }
    got = rows_with_target(envelopes(spark, rows)).collect()
    assert sorted((r["target"] or "", r["problem"]) for r in got) == sorted(
        [("out1", ""), ("a b", "invalid_table_name"), ("", "invalid_message_format"),
         ("", "invalid_message_format"), ("out2", "invalid_message_format")]
    )
    kept = rows_with_target(envelopes(spark, {"1": rows["1"]}), keep_field=True).first()
    assert kept["target_table"] == "Out1"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, how):
    big = spark.range(0, 3000, 1, 7).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k49", 4), ("none", 5)], "k string, v int")
    fits, too_big = Size(5, 100), Size(10**9, 10**12)
    expected = sorted(map(tuple, attach(big, small, ["k"], how, fits).collect()), key=repr)
    for salts in (1, 8):
        got = attach(big, small, ["k"], how, too_big, salts)
        assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_beside_list(spark):
    side = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    got = beside_list(spark.range(2), side).collect()
    assert all([tuple(x) for x in r["side"]] == [(1, "a"), (2, None)] for r in got)
