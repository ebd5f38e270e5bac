"""Judging, typing and rendering of single lines."""

import math

import pytest
from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, Registry, SourceLayout, messages_frame, struct
from waybill.functions.casts import to_float, to_integer
from waybill.functions.text import bucket_of, list_text, object_of, split_fields, utc_text
from waybill.operators import outputs
from waybill.operators.lines import attach_messages, judge_lines, named_fields, typed_columns
from waybill.operators.messages import prepare_messages


def judge(spark, lines, destination="age", file="client1.csv", registry=DEFAULT_REGISTRY, mode="reject", **predicate):
    message = {"fileURL": f"/in/{file}", "destination": destination, "id": "m", "timestamp": "t", **predicate}
    bridge = prepare_messages(messages_frame(spark, [message]), registry)
    assert [r["problem"] for r in bridge.collect()] == [""]
    frame = spark.createDataFrame([("f", line) for line in lines], "file_path string, line string")
    return judge_lines(attach_messages(frame, bridge.withColumn("file_path", F.lit("f"))), registry, mode)


def reasons(judged):
    return {r["line"]: r["stacktrace"] for r in judged.collect()}


BETWEEN = {"partition_depth": [12, 25], "partition_key": "AGE"}


def test_edge_lines(spark):
    expected = {
        "Ann,20": "",
        "Ann,12": "not in queried partition",
        "Ann,25": "not in queried partition",
        "Ann, 20 ": "",
        "Ann,+20": "",
        "Ann,2_0": "",
        "Ann,2__0": "error_cast",
        "Ann,_20": "error_cast",
        "Ann,x20": "error_cast",
        "Ann,20.0": "error_cast",
        "Ann,1e1": "error_cast",
        "Ann,": "error_cast",
        "Ann,99999999999999999999": "error_cast",
        "Ann": "error_line_index",
        "Ann,20,z": "error_line_index",
        "": "error_line_index",
        "Ann,20,": "error_line_index",
        '"a,b",20': "error_line_index",
        "A\rB,20": "",
    }
    assert reasons(judge(spark, list(expected), **BETWEEN)) == expected


def test_no_predicate_unless_both_parts_are_there(spark):
    for part in ({}, {"partition_depth": [12, 25]}, {"partition_key": "AGE"}):
        assert reasons(judge(spark, ["Ann,99"], **part)) == {"Ann,99": ""}


@pytest.mark.parametrize(
    ("bounds", "inside"),
    [
        ([12, 25.5], {13, 25}),
        ([12.5, 25], {13, 24}),
        (["-1e30", 13], {-(2**63), 12}),
        ([25, "1e30"], {26, 2**63 - 1}),
        (["1e30", "2e30"], set()),
        (["nan", 13], {12, -5}),
    ],
)
def test_bounds_of_integer_keys(spark, bounds, inside):
    values = {-(2**63), -5, 12, 13, 24, 25, 26, 2**63 - 1}
    lower, upper = (float(b) for b in bounds)
    expected = {f"a,{v}" for v in values if not (lower >= v or upper <= v)}
    assert {f"a,{v}" for v in inside} <= expected
    got = reasons(judge(spark, [f"a,{v}" for v in values], partition_depth=bounds, partition_key="AGE"))
    assert {line for line, reason in got.items() if reason == ""} == expected


FLOATS = Registry(
    (SourceLayout("m", struct(name="STRING", height="FLOAT")),), {"m": struct(name="STRING", height="FLOAT")}
)


def test_float_keys_and_nan(spark):
    lines = ["a,1.5", "a,nan", "a,1.0", "a,2", "a,inf", "a,1.5d", "a,0x1p0", "a,1_0.5"]
    got = reasons(
        judge(spark, lines, "m", "m.csv", FLOATS, partition_depth=[1, 2], partition_key="height")
    )
    assert {k for k, v in got.items() if v == ""} == {"a,1.5", "a,nan"}
    assert {k for k, v in got.items() if v == "error_cast"} == {"a,1.5d", "a,0x1p0"}


def test_text_keys(spark):
    got = reasons(judge(spark, ["b,1", "a,1", "m,1", "n,1"], partition_depth=["a", "n"], partition_key="NAME"))
    assert {k for k, v in got.items() if v == ""} == {"b,1", "m,1"}


def test_cast_error_can_fail_the_job(spark):
    with pytest.raises(Exception, match="does not cast"):
        judge(spark, ["Ann,x"], mode="fail").collect()
    assert reasons(judge(spark, ["Ann,1", "Ann"], mode="fail")) == {"Ann,1": "", "Ann": "error_line_index"}


def test_typed_columns_by_name(spark):
    judged = judge(spark, ["Ann,20"], destination="telephone")
    rows = typed_columns(judged, DEFAULT_REGISTRY.table_schema("telephone"), DEFAULT_REGISTRY)
    assert [tuple(r) for r in rows.collect()] == [("Ann", None)]
    assert rows.columns == ["name", "number"]


def test_reason_filters_stay_above_the_reason(spark):
    judged = outputs.rejected_lines(judge(spark, ["Ann,20"]))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


NUMBERS = [" 12 ", "+5", "-7", "007", "1_000", "12.0", "1e3", "", " ", "abc", "1__0", "9223372036854775807",
           "9223372036854775808", "0x10", "１２", "1_", "--1", "1 2"]


def python_int(text):
    try:
        value = int(text)
    except ValueError:
        return None
    return value if -(2**63) <= value < 2**63 and text.isascii() else None


def test_integers_like_python(spark):
    frame = spark.createDataFrame([(n,) for n in NUMBERS], "x string").select("x", to_integer(F.col("x")).alias("y"))
    assert {r["x"]: r["y"] for r in frame.collect()} == {n: python_int(n) for n in NUMBERS}


FLOAT_TEXTS = ["1", "1.", ".5", "1.5", "-1e5", "1E-2", "1_0.5", "inf", "-Infinity", "1.5d", "1f", " 2D ", "0x1p3",
               "", ".", "e5", "1e", "abc", "1__0", "1e1_0", " 3.5 "]


def python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def test_floats_like_python(spark):
    frame = spark.createDataFrame([(n,) for n in [*FLOAT_TEXTS, "nan"]], "x string")
    got = {r["x"]: r["y"] for r in frame.select("x", to_float(F.col("x")).alias("y")).collect()}
    assert math.isnan(got.pop("nan"))
    assert got == {n: python_float(n) for n in FLOAT_TEXTS}


LISTS = ["Ann,20", "", "a,,b,", "it's,x", 'say "hi"', "it's \"both\"", "back\\slash", "tab\there", "cr\rx", "nul\x00x",
         "bell\x07", "é,ü", "no break", "zero​width", "😀,x", "sep x", "\x7f"]


def test_list_text_like_python(spark):
    frame = spark.createDataFrame([(n,) for n in LISTS], "x string").select("x", list_text(F.col("x")).alias("y"))
    assert {r["x"]: r["y"] for r in frame.collect()} == {n: str(n.split(",")) for n in LISTS}


def test_split_like_python(spark):
    lines = ["", ",", "a", "a,b,", ",,a"]
    frame = spark.createDataFrame([(n,) for n in lines], "x string").select("x", split_fields(F.col("x")).alias("y"))
    assert {r["x"]: r["y"] for r in frame.collect()} == {n: n.split(",") for n in lines}


def test_url_parts(spark):
    url = F.lit("gs://bucket/a/b/c.csv")
    row = spark.range(1).select(bucket_of(url).alias("b"), object_of(url).alias("o")).first()
    assert (row["b"], row["o"]) == ("bucket", "a/b/c.csv")


def test_utc_text_like_python(spark):
    frame = spark.sql("SELECT timestamp'2024-01-02 03:04:05.12Z' AS a, timestamp'2024-01-02 03:04:05Z' AS b")
    row = frame.select(utc_text(F.col("a")).alias("a"), utc_text(F.col("b")).alias("b")).first()
    assert tuple(row) == ("2024-01-02 03:04:05.120000", "2024-01-02 03:04:05")


def test_named_fields_default_layout(spark):
    by_name = {"tabledata.csv": struct(a="STRING", b="STRING"), "other.csv": struct(c="STRING")}
    lines = spark.createDataFrame([("x.csv", "1"), ("tabledata.csv", "1,2,3"), ("other.csv", "9")], "n string, line string")
    rows = named_fields(lines, F.col("n"), by_name, "tabledata.csv")
    assert sorted(tuple(r) for r in rows.select("n", "a", "b").collect()) == [
        ("tabledata.csv", "1", "2"), ("x.csv", "1", None),
    ]


def test_conform_can_reject_unknown_columns(spark):
    frame = spark.sql("SELECT 1 AS a, 2 AS b")
    assert outputs.conform(frame, struct(A="INTEGER")).columns == ["A"]
    with pytest.raises(ValueError, match="unknown"):
        outputs.conform(frame, struct(A="INTEGER"), unknown="reject")


def many_layouts(count):
    sources = [SourceLayout(f"kind{i}_", struct(name="STRING", age="INTEGER"), max_bad_rows=i % 3) for i in range(count)]
    return Registry(tuple(sources), {"t": struct(name="STRING", age="INTEGER")})


def test_plans_do_not_grow_with_layouts(spark):
    from waybill import messages_frame
    from waybill.operators.lines import attach_messages, judge_lines, typed_columns
    from waybill.operators.messages import prepare_messages

    def planned(count):
        registry = many_layouts(count)
        message = {"fileURL": f"/x/kind{count - 1}_a.csv", "destination": "t", "id": "1", "timestamp": "t"}
        bridge = prepare_messages(messages_frame(spark, [message]), registry).withColumn("file_path", F.lit("f"))
        lines = spark.createDataFrame([("f", "Ann,20"), ("f", "Bob,x"), ("f", "Cid")], "file_path string, line string")
        judged = judge_lines(attach_messages(lines, bridge), registry)
        return bridge, judged, typed_columns(judged.filter("stacktrace = ''"), registry.tables["t"], registry)

    def branches(frame):
        return frame._jdf.queryExecution().analyzed().toString().upper().count("CASE WHEN")

    few, many = planned(3), planned(500)
    assert [branches(f) for f in few] == [branches(f) for f in many]
    assert many[0].first()["layout"] == "kind499_"
    assert [tuple(r) for r in many[2].collect()] == [("Ann", 20)]
    assert sorted(r["stacktrace"] for r in many[1].collect()) == ["", "error_cast", "error_line_index"]


def test_prefixes_are_patterns_or_text(spark):
    from waybill.operators.messages import layout_of

    registry = Registry((SourceLayout("a.c", struct(x="STRING")), SourceLayout("ab", struct(x="STRING")), SourceLayout("(?:x|y)z", struct(x="STRING"))))
    names = {"abc1": "a.c", "abd": "ab", "yz": "(?:x|y)z", "z": None, "": None}
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in frame.select("n", layout_of(F.col("n"), registry)).collect()} == names
