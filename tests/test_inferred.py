"""Loads with the schema found in the file: fields, kinds, many messages at once."""

import json

import pytest
from pyspark.sql import functions as F

from waybill import InferredLoad, Targets, struct
from waybill.operators.messages import located_messages, parse_messages
from waybill.operators.routing import rows_with_target
from waybill.operators.tables import create_table
from waybill.sources.inferred import delimited_fields, header_names


def envelopes(spark, *values):
    data = [(v if isinstance(v, str) else json.dumps(v), f"m{i:03d}") for i, v in enumerate(values)]
    return spark.createDataFrame(data, "value string, message_id string").withColumn("message_ts", F.lit("t"))


def rows(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


def letters(spark, made):
    return sorted((r["message_id"], r["reason"]) for r in spark.table(made.dead_letters).collect())


@pytest.fixture()
def made(targets):
    return Targets(targets.results, targets.rejects, create=True)


FIELDS = {
    "": [""], ",": ["", ""], "a,b": ["a", "b"], '"a,b",c': ["a,b", "c"], '"a ""x"" b",': ['a "x" b', ""], '"",x': ["", "x"],
    'a"b,c': ['a"b', "c"], '""""': ['"'], '"open,b': ['"open', "b"], ',"x"': ["", "x"], "a,,": ["a", "", ""],
}


def test_fields(spark):
    frame = spark.createDataFrame([(line,) for line in FIELDS], "line string")
    got = frame.select("line", delimited_fields(F.col("line")).alias("f")).collect()
    assert {r["line"]: r["f"] for r in got} == FIELDS


def test_a_long_quoted_field(spark):
    line = '"' + 'x""' * 200_000 + '",y'
    got = spark.createDataFrame([(line,)], "line string").select(delimited_fields(F.col("line")).alias("f")).first()["f"]
    assert got == ['x"' * 200_000, "y"]


def test_header_names(spark):
    frame = spark.createDataFrame([(["a", "", "A", "b"],)], "h array<string>")
    assert frame.select(header_names(F.col("h"))).first()[0] == ["a0", "_c1", "A2", "b"]


def test_a_lone_carriage_return_is_part_of_its_value(spark, made, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"n,s\r\n1,x\ry\r\n2,z\r\n")
    InferredLoad(spark, made).run(envelopes(spark, {"fileURL": f"{tmp_path}/a.csv", "destination": "t"}))
    assert rows(spark, made.result("t")) == [(1, "x\ry"), (2, "z")]


def test_good_bad_good(spark, made, tmp_path):
    for name, text in (("a", "n,x\n1,1\n"), ("b", "n,x\n1,one\n"), ("c", "x,n\n3,3\n"), ("d", "n,x\n,2\n"), ("e", "n\n1\n"), ("f", ""), ("g", "n,x\ntrue,1\nFalse,2\n"), ("h", "n,x\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    values = [{"fileURL": f"{tmp_path}/{n}.csv", "destination": d} for n, d in (("a", "T"), ("b", "t"), ("c", "t"), ("d", "t"), ("e", "t"), ("f", "t"), ("g", "t"), ("h", "empty"))]
    InferredLoad(spark, made).run(envelopes(spark, *values))
    assert rows(spark, made.result("t")) == [(1, 1), (3, 3)]
    assert letters(spark, made) == [
        ("m001", "schema_mismatch: x: STRING in the file, INTEGER in the table"),
        ("m003", "schema_mismatch: n: FLOAT in the file, INTEGER in the table"),
        ("m004", "schema_mismatch: x: not in the file"),
        ("m005", "empty_file"),
        ("m006", "no_declared_kind: n"),
    ]
    assert spark.table(made.result("empty")).schema == struct(n="STRING", x="STRING")


def test_widening_and_exact_schemas(spark, made, tmp_path):
    create_table(spark, made.result("t"), struct(n="FLOAT", s="STRING"))
    (tmp_path / "a.csv").write_text("n,s,more\n1,2,3\n")
    values = {"fileURL": f"{tmp_path}/a.csv", "destination": "t"}
    InferredLoad(spark, made).run(envelopes(spark, values))
    InferredLoad(spark, made, exact_schema=True, widen=True).run(envelopes(spark, values))
    assert [r for _, r in letters(spark, made)] == [
        "schema_mismatch: more: not in the table",
        "schema_mismatch: n: INTEGER in the file, FLOAT in the table; s: INTEGER in the file, STRING in the table",
    ]
    InferredLoad(spark, made, widen=True).run(envelopes(spark, values))
    assert rows(spark, made.result("t")) == [(1.0, "2")]


def test_a_glob_is_one_message_and_a_file_may_have_two(spark, made, tmp_path):
    (tmp_path / "a1.csv").write_text("n,s\n1,x\n")
    (tmp_path / "a2.csv").write_text("s,n\ny,2.5\n")
    values = [{"fileURL": f"{tmp_path}/a*.csv", "destination": "t"}, {"address": f"{tmp_path}/a1.csv", "destination": "u"}, {"fileURL": f"{tmp_path}/a1.csv", "destination": "v"}]
    InferredLoad(spark, made).run(envelopes(spark, *values))
    assert rows(spark, made.result("t")) == [(1.0, "x"), (2.5, "y")]
    assert rows(spark, made.result("u")) == rows(spark, made.result("v")) == [(1, "x")]


def test_odd_column_names(spark, made, tmp_path):
    (tmp_path / "a.csv").write_text('a`b,"c,d",e.f\n1,2,x\n')
    InferredLoad(spark, made).run(envelopes(spark, {"fileURL": f"{tmp_path}/a.csv", "destination": "t"}))
    frame = spark.table(made.result("t"))
    assert frame.columns == ["a`b", "c,d", "e.f"] and rows(spark, made.result("t")) == [(1, 2, "x")]


def jobs(spark, run):
    tag = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))


def test_jobs_do_not_grow_with_messages(spark, targets, tmp_path):
    made = Targets(targets.results, targets.rejects, create=True)
    for i in range(40):
        (tmp_path / f"f{i}.csv").write_text(f"n,s\n{i},x\n")

    def load(numbers, table):
        values = [{"fileURL": f"{tmp_path}/f{i}.csv", "destination": table} for i in numbers]
        frame = envelopes(spark, *values)
        return jobs(spark, lambda: InferredLoad(spark, made, parallel_tables=1).run(frame))

    few, many = load(range(2), "few"), load(range(40), "many")
    assert spark.table(made.result("many")).count() == 40
    assert many <= few + 8, (few, many)


# --- one parse ---------------------------------------------------------------------------


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_payloads_are_parsed_once(spark):
    frame = spark.createDataFrame([('{"k":1,"target_table":"a"}', "1", "t")], "value string, message_id string, message_ts string")
    assert plan_of(rows_with_target(frame, struct(k="INTEGER"))).count("from_json") == 1
    strict = plan_of(parse_messages(frame, strict_keys=True))
    assert strict.count("from_json") == 1 and strict.lower().count("parsejson") == 1
    assert plan_of(located_messages(frame)).lower().count("parsejson") == 1
