"""The three-message scenario, as batch and as stream."""

import json

import pytest

from waybill import DEFAULT_REGISTRY, FileLoad, create_load_tables, load_file, messages_frame
from waybill.sources.topics import folder_topics, publish_to_folder
from waybill.streaming.loader import start_file_loads

FILES = {
    "client1.csv": "NAME,AGE\r\nAnn,20\r\nBob,99\r\n",
    "telephone2.csv": "name,number\r\nx,1\r\ny\r\n",
    "address1.csv": "name,address\r\nx,a\r\ny,b\r\n",
}


@pytest.fixture()
def scenario(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, newline="")
    return [
        {"fileURL": f"{tmp_path}/client1.csv", "destination": "age",
         "partition_depth": [12, 25], "partition_key": "AGE"},
        {"fileURL": f"{tmp_path}/telephone2.csv", "destination": "telephone"},
        {"fileURL": f"{tmp_path}/address1.csv", "destination": "address"},
    ]


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def check_deltas(spark, targets):
    assert rows(spark, targets.result("age")) == [("Ann", 20)]
    assert rows(spark, targets.result("telephone")) == [("x", "1")]
    assert rows(spark, targets.result("address")) == [("x", "a"), ("y", "b")]
    assert [r[1:] for r in rows(spark, targets.reject("age"))] == [
        ("not in queried partition", "client1.csv", "['Bob', '99']")
    ]
    assert [r[1:] for r in rows(spark, targets.reject("telephone"))] == [
        ("error_line_index", "telephone2.csv", "['y']")
    ]
    assert rows(spark, targets.reject("address")) == []
    events = sorted(r[1:] for r in rows(spark, targets.monitoring))
    assert events == [
        ("START", 0, 0), ("START", 0, 0), ("START", 0, 0),
        ("SUCCESS", 2, 0), ("WARNING", 1, 1), ("WARNING", 1, 1),
    ]


def test_batch(spark, targets, scenario):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    messages = [{**m, "timestamp": "2024-01-01 00:00:00", "id": i} for i, m in enumerate(scenario)]
    load = FileLoad(spark, targets)
    load_id = load.run(messages_frame(spark, messages))
    check_deltas(spark, targets)
    load.run(messages_frame(spark, messages), load_id)
    check_deltas(spark, targets)


def test_batch_one_file(spark, targets, scenario):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    load_file(spark, scenario[0]["fileURL"], "age", "20240101", "000", [12, 25], "AGE", targets=targets)
    assert rows(spark, targets.result("age")) == [("Ann", 20)]
    assert spark.table(targets.reject("age")).count() == 1
    assert rows(spark, targets.monitoring) == [("20240101", "START", 0, 0), ("20240101", "WARNING", 1, 1)]
    assert spark.table(targets.result("telephone")).count() == 0


def test_stream(spark, targets, scenario, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    lines = spark.createDataFrame([(json.dumps(m),) for m in scenario], "value string")
    publish_to_folder(lines, "files", str(tmp_path / "topic"))
    query = start_file_loads(
        folder_topics(spark, str(tmp_path / "topic"), ["files"]),
        FileLoad(spark, targets), f"load_{targets.results}", str(tmp_path / "checkpoint"),
    )
    query.awaitTermination()
    check_deltas(spark, targets)


def test_missing_tables_are_an_error(spark, targets, scenario):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        load_file(spark, scenario[1]["fileURL"], "telephone", "t", "1", targets=targets)
