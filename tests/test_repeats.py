"""Every step of every plan broken between its commit and its marker, and loads continued with other settings."""

import json

import pytest
from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, ExactNameLoad, FileLoad, InferredLoad, JsonRouting, Targets, create_load_tables, dispatch, struct
from waybill.operators.messages import parse_messages
from waybill.storage import SharedFiles


class Broken(Exception):
    pass


@pytest.fixture()
def breaking(monkeypatch):
    """The first marker of every step is lost, as in a crash after the step's commit."""
    seen, mark = set(), SharedFiles.mark

    def lose(self, path):
        if "/done/" in path and path not in seen:
            seen.add(path)
            raise Broken(path)
        mark(self, path)

    monkeypatch.setattr(SharedFiles, "mark", lose)
    return seen


def until_done(run):
    for _ in range(60):
        try:
            return run()
        except Broken:
            pass
    raise AssertionError("does not finish")


def by_load(targets):
    return Targets(targets.results, targets.rejects, create=True, by_load=True)


def rows(spark, table, drop=("load_id", "step")):
    return sorted((tuple(r) for r in spark.table(table).drop(*drop).collect()), key=repr)


def envelopes(spark, *values):
    data = [(v if isinstance(v, str) else json.dumps(v), f"m{i}") for i, v in enumerate(values)]
    return spark.createDataFrame(data, "value string, message_id string").withColumn("message_ts", F.lit("t"))


def test_file_load(spark, targets, tmp_path, breaking):
    create_load_tables(spark, targets, DEFAULT_REGISTRY, by_load=True)
    (tmp_path / "client1.csv").write_text("NAME,AGE\nAnn,20\nBob\n")
    messages = parse_messages(
        envelopes(spark, {"fileURL": f"{tmp_path}/client1.csv", "destination": "age"}, {"fileURL": f"{tmp_path}/client2.csv", "destination": "age"})
    )
    until_done(lambda: FileLoad(spark, targets, parallel_writes=1).run(messages, f"file-{targets.results}"))
    assert rows(spark, targets.result("age")) == [("Ann", 20)]
    assert len(rows(spark, targets.reject("age"))) == 1
    assert rows(spark, targets.monitoring) == [("t", "START", 0, 0), ("t", "START", 0, 0), ("t", "WARNING", 1, 1)]
    assert [r[1:3] for r in rows(spark, targets.dead_letters)] == [("file_not_found", "m1")]
    assert len(breaking) >= 6


def test_exact_name_load(spark, targets, tmp_path, breaking):
    made = by_load(targets)
    (tmp_path / "tabledata2.csv").write_text("h\nAnn,20,red\n")
    (tmp_path / "else.csv").write_text("h\nBob,30,1.75\n")
    from waybill.operators.messages import located_messages

    messages = located_messages(
        envelopes(
            spark, {"address": f"{tmp_path}/tabledata2.csv", "destination": "colors"}, {"fileURL": f"{tmp_path}/else.csv", "destination": "heights"},
            {"address": f"{tmp_path}/none.csv", "destination": "colors"}, "{", {"address": "x", "destination": "a b"},
        )
    )
    until_done(lambda: ExactNameLoad(spark, made).run(messages, f"exact-{targets.results}"))
    assert rows(spark, made.result("colors")) == [("Ann", 20, "red")]
    assert rows(spark, made.result("heights")) == [("Bob", 30, 1.75)]
    letters = {(r[2], r[1]) for r in rows(spark, made.dead_letters)}
    assert letters == {("m2", "file_not_found"), ("m3", "invalid_message_format"), ("m4", "invalid_table_name")}
    assert len(rows(spark, made.dead_letters)) == 3


def test_inferred_load(spark, targets, tmp_path, breaking):
    made = by_load(targets)
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.csv").write_text(f"name,age\n{name},1\nshort\n")
    values = [{"fileURL": f"{tmp_path}/{n}.csv", "destination": "people"} for n in ("a", "b", "c", "none")]
    until_done(lambda: InferredLoad(spark, made, parallel_tables=1).run(envelopes(spark, *values), f"inferred-{targets.results}"))
    assert rows(spark, made.result("people")) == [("a", 1), ("b", 1), ("c", 1)]
    assert len(rows(spark, made.reject("people"))) == 3
    assert [r[1:3] for r in rows(spark, made.dead_letters)] == [("file_not_found", "m3")]


def test_json_routing(spark, targets, breaking):
    made = by_load(targets)
    values = [{"k": i, "target_table": f"t{i % 2}"} for i in range(4)] + ["{"]
    routing = JsonRouting(spark, made, struct(k="INTEGER"), parallel_writes=1)
    until_done(lambda: routing.run(envelopes(spark, *values), f"json-{targets.results}"))
    assert rows(spark, made.result("t0")) == [(0,), (2,)] and rows(spark, made.result("t1")) == [(1,), (3,)]
    assert len(rows(spark, made.dead_letters)) == 1


def test_dispatch(spark, targets, tmp_path, breaking):
    create_load_tables(spark, targets, DEFAULT_REGISTRY, by_load=True)
    (tmp_path / "client1.csv").write_text("NAME,AGE\n" + "big,20\n" * 50)
    messages = parse_messages(envelopes(spark, {"fileURL": f"{tmp_path}/client1.csv", "destination": "age"}, "{"))
    load = FileLoad(spark, targets, parallel_writes=1)
    until_done(lambda: dispatch(messages, lambda rows: None, load, 100, f"d-{targets.results}"))
    assert len(rows(spark, targets.result("age"))) == 50
    assert len(rows(spark, targets.monitoring)) == 2 and len(rows(spark, targets.dead_letters)) == 1


def six_files(tmp_path, prefix):
    for n in range(6):
        (tmp_path / f"{prefix}{n}.csv").write_text(f"NAME,AGE,H\nn{n},20\n" if prefix == "client" else f"h\nn{n},20,1.5\n")
    return [f"{tmp_path}/{prefix}{n}.csv" for n in range(6)]


def test_a_continued_exact_name_load_keeps_its_slices(spark, targets, tmp_path, monkeypatch):
    made = Targets(targets.results, targets.rejects, create=True)
    messages = spark.createDataFrame([(str(n), u, "t") for n, u in enumerate(six_files(tmp_path, "x"))], "message_id string, fileURL string, destination string")
    with monkeypatch.context() as broken:
        broken.setattr(ExactNameLoad, "_write_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ExactNameLoad(spark, made, urls_per_slice=1).run(messages, f"kept-{targets.results}")
    ExactNameLoad(spark, made, urls_per_slice=4).run(messages, f"kept-{targets.results}")
    assert [r[0] for r in rows(spark, made.result("t"))] == [f"n{n}" for n in range(6)]


def test_a_continued_dispatch_keeps_its_slices(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    values = [{"fileURL": u, "destination": "age"} for u in six_files(tmp_path, "client")]
    messages = parse_messages(envelopes(spark, *values))
    published = []

    def publish(frame):
        published.extend(r["message_id"] for r in frame.collect())
        if len(published) < 3:
            return
        if len(published) == 3:
            raise Broken

    with pytest.raises(Broken):
        dispatch(messages, publish, FileLoad(spark, targets, urls_per_slice=1), 10**9, f"slices-{targets.results}")
    dispatch(messages, publish, FileLoad(spark, targets, urls_per_slice=4), 10**9, f"slices-{targets.results}")
    assert set(published) == {f"m{n}" for n in range(6)}
