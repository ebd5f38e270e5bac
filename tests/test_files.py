"""Reading files: headers, splits, compression, globs, odd names."""

import bz2
import gzip

import pytest

from waybill.sources import files
from waybill import DEFAULT_REGISTRY, FileLoad, create_load_tables, messages_frame
from waybill.sources.files import file_sizes, match_files, read_lines, read_paths, read_text_file


def lines_of(frame):
    return sorted(r["line"] for r in frame.collect())


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("skip", [0, 1, 2, 3])
def test_header_per_file_over_many_splits(spark, small_splits, tmp_path, skip):
    expected = []
    for name, n in (("a.csv", 400), ("b.csv", 3), ("c.csv", 1), ("d.csv", 0), ("e.csv", 90)):
        rows = [f"{name},{i}" for i in range(n)]
        (tmp_path / name).write_text("".join(r + "\n" for r in rows))
        expected += rows[skip:]
    frame = read_text_file(spark, f"{tmp_path}/*.csv", skip)
    assert frame.rdd.getNumPartitions() > 8
    assert lines_of(frame) == sorted(expected)


def test_header_line_that_comes_again_is_data(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h,h\nx,1\nh,h\nh,h\n")
    assert lines_of(read_text_file(spark, f"{tmp_path}/a.csv")) == ["h,h", "h,h", "x,1"]


def test_caller_settings_are_left_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\nx\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    read_text_file(spark, f"{tmp_path}/a.csv").collect()
    assert before == {k: spark.conf.get(k) for k in before}


def test_scans_have_the_callers_settings(spark):
    spark.conf.set("fs.custom.key", "x")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    # Like a builder that meets a running session: it may leave core settings there.
    spark._jsparkSession.sessionState().conf().setConfString("spark.driver.memory", "3g")
    try:
        conf = files._scan_session(spark, True).conf
        assert conf.get("fs.custom.key") == "x"
        assert conf.get("spark.sql.parquet.compression.codec") == "zstd"
        assert conf.get("spark.sql.files.openCostInBytes") == conf.get("spark.sql.files.maxPartitionBytes")
    finally:
        spark.conf.unset("fs.custom.key")
        spark.conf.unset("spark.sql.parquet.compression.codec")
        spark._jsparkSession.sessionState().conf().unsetConf("spark.driver.memory")


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"h\r\na\r\nb\r\r\nc\rd\n\r\n\ne")
    assert lines_of(read_text_file(spark, f"{tmp_path}/a.csv")) == sorted(["a", "b\r", "c\rd", "", "", "e"])


def test_compressed(spark, small_splits, tmp_path):
    text = "h\n" + "".join(f"line{i}\n" for i in range(200))
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(text)
    with bz2.open(tmp_path / "b.csv.bz2", "wt") as f:
        f.write(text)
    expected = sorted(f"line{i}" for i in range(200))
    assert lines_of(read_text_file(spark, f"{tmp_path}/a.csv.gz")) == expected
    assert lines_of(read_text_file(spark, f"{tmp_path}/b.csv.bz2")) == expected


def test_big_compressed_files_are_spread(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SPREAD_BYTES", 1)
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("h\n" + "".join(f"line{i}\n" for i in range(2000)))
    frame = read_text_file(spark, f"{tmp_path}/a.csv.gz")
    assert frame.rdd.getNumPartitions() > 8
    assert lines_of(frame) == sorted(f"line{i}" for i in range(2000))


@pytest.mark.parametrize("skip", [0, 1, 2])
def test_small_files_share_tasks(spark, tmp_path, skip):
    expected = []
    for i in range(90):
        rows = [f"{i},{j}" for j in range(i % 4)]
        end = "\r\n" if i % 2 else "\n"
        text = end.join(rows) + (end if rows and i % 3 else "")
        (tmp_path / f"f{i}.csv").write_text(text, newline="")
        expected += rows[skip:]
    (tmp_path / "blank.csv").write_text("h\n\n\nx\n\n")
    expected += ["h", "", "", "x", ""][skip:]
    frame = read_text_file(spark, f"{tmp_path}/*.csv", skip)
    assert frame.rdd.getNumPartitions() < 91
    assert lines_of(frame) == sorted(expected)


def test_odd_names_and_overlapping_globs(spark, tmp_path):
    for name in ("a b.csv", "c[1].csv", "d{x}.csv", "p%20q.csv", "é.csv"):
        (tmp_path / name).write_text(f"h\n{name}\n")
    found = match_files(spark, [f"{tmp_path}/*.csv", f"{tmp_path}/a*.csv"])
    assert len(found) == 6
    frame = read_lines(spark, found)
    rows = {r["file_path"]: r["line"] for r in frame.collect()}
    assert frame.count() == 5
    assert all(sum(form in rows for form in m.forms) == 1 for m in found)
    assert sorted(rows.values()) == sorted({m.status.name for m in found})


def test_path_collection_and_sizes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\nx\n")
    (tmp_path / "b.csv").write_text("h\nyy\n")
    urls = spark.createDataFrame([(f"{tmp_path}/a.csv",), (f"{tmp_path}/b.csv",), (f"{tmp_path}/a.csv",)], "u string")
    assert lines_of(read_paths(spark, urls)) == ["x", "yy"]
    sizes = {r["fileURL"].rsplit("/", 1)[-1]: r["length"] for r in file_sizes(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]).collect()}
    assert sizes == {"a.csv": 4, "b.csv": 5}
    with pytest.raises(FileNotFoundError):
        read_text_file(spark, f"{tmp_path}/none.csv")


def messages(spark, *rows):
    return messages_frame(
        spark,
        [{"fileURL": u, "destination": d, "id": str(i), "timestamp": f"t{i}", **p} for i, (u, d, p) in enumerate(rows)],
    )


def monitoring(spark, targets):
    return sorted(tuple(r) for r in spark.table(targets.monitoring).collect() if r["event"] != "START")


def test_two_messages_for_one_file_and_a_glob(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    (tmp_path / "client1.csv").write_text("NAME,AGE\nAnn,20\nBob,30\n")
    (tmp_path / "client2.csv").write_text("NAME,AGE\nCid,40\nDan\n")
    FileLoad(spark, targets).run(
        messages(
            spark,
            (f"{tmp_path}/client1.csv", "age", {}),
            (f"{tmp_path}/client1.csv", "age", {"partition_depth": [25, 99], "partition_key": "AGE"}),
            (f"{tmp_path}/client*.csv", "telephone", {}),
        )
    )
    assert monitoring(spark, targets) == [("t0", "SUCCESS", 2, 0), ("t1", "WARNING", 1, 1), ("t2", "WARNING", 3, 1)]
    assert sorted(r["NAME"] for r in spark.table(targets.result("age")).collect()) == ["Ann", "Bob", "Bob"]
    assert sorted(r["name"] for r in spark.table(targets.result("telephone")).collect()) == ["Ann", "Bob", "Cid"]
    assert {r["source_file"] for r in spark.table(targets.reject("telephone")).collect()} == {"client*.csv"}


def test_empty_files_have_a_start_only(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    (tmp_path / "client1.csv").write_text("")
    (tmp_path / "client2.csv").write_text("NAME,AGE\n")
    rows = [(f"{tmp_path}/client1.csv", "age", {}), (f"{tmp_path}/client2.csv", "age", {})]
    FileLoad(spark, targets).run(messages(spark, *rows))
    assert monitoring(spark, targets) == []
    assert spark.table(targets.monitoring).count() == 2
    FileLoad(spark, targets, emit_empty_end=True).run(messages(spark, *rows))
    assert monitoring(spark, targets) == [("t0", "SUCCESS", 0, 0), ("t1", "SUCCESS", 0, 0)]


def test_slices_change_nothing(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    rows = []
    for i in range(7):
        (tmp_path / f"client{i}.csv").write_text("NAME,AGE\n" + "".join(f"n,{j}\n" for j in range(i)) + "bad\n" * (i % 2))
        rows.append((f"{tmp_path}/client{i}.csv", "age", {}))
    rows.append((f"{tmp_path}/client99.csv", "age", {}))
    FileLoad(spark, targets, urls_per_slice=3).run(messages(spark, *rows))
    expected = [(f"t{i}", "WARNING" if i % 2 else "SUCCESS", i, i % 2) for i in range(1, 7)]
    assert monitoring(spark, targets) == expected
    assert spark.table(targets.result("age")).count() == sum(range(7))
    assert [r["reason"] for r in spark.table(targets.dead_letters).collect()] == ["file_not_found"]


def test_bad_row_limit(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    (tmp_path / "client1.csv").write_text("NAME,AGE\n" + "a,1\n" * 5 + "b\n" * 18)
    (tmp_path / "client2.csv").write_text("NAME,AGE\n" + "a,1\n" * 5 + "b\n" * 19)
    (tmp_path / "address1.csv").write_text("h\n" + "a,1\n" * 5 + "b\n")
    rows = [(f"{tmp_path}/client1.csv", "age", {}), (f"{tmp_path}/client2.csv", "age", {}), (f"{tmp_path}/address1.csv", "address", {})]
    FileLoad(spark, targets, limit_bad_rows=True).run(messages(spark, *rows))
    assert monitoring(spark, targets) == [("t0", "WARNING", 5, 18), ("t1", "WARNING", 0, 24), ("t2", "WARNING", 0, 6)]
    assert spark.table(targets.result("age")).count() == 5
    assert spark.table(targets.result("address")).count() == 0
    reasons = [r["stacktrace"] for r in spark.table(targets.reject("address")).collect()]
    assert sorted(reasons) == ["error_line_index"] + ["too_many_invalid_rows_in_file"] * 5


def test_hidden_files_are_no_match_and_folders_are_read_whole(spark, tmp_path):
    from waybill.sources.files import match_files

    for name in ("_a.csv", "b.csv", "in/c.csv", "in/.d.csv", "in/deep/e.csv", "_skip/f.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("h\n1\n")
    found = {m.status.path.rsplit("/", 1)[-1] for m in match_files(spark, [str(tmp_path)])}
    assert found == {"b.csv", "c.csv", "e.csv"}
    assert not match_files(spark, [f"{tmp_path}/_a.csv"])


def test_a_continued_load_keeps_its_slices(spark, targets, tmp_path, monkeypatch):
    import json

    from waybill import DEFAULT_REGISTRY, FileLoad, parse_messages
    from waybill.operators.tables import create_load_tables

    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    messages = []
    for n in range(6):
        (tmp_path / f"client{n}.csv").write_text(f"NAME,AGE\nn{n},20\n")
        messages.append((json.dumps({"fileURL": f"{tmp_path}/client{n}.csv", "destination": "age"}), f"m{n}"))
    frame = spark.createDataFrame(messages, "value string, message_id string").selectExpr("*", "current_timestamp() AS message_ts")
    load_id = f"continued_{targets.results}"
    with monkeypatch.context() as broken:
        broken.setattr(FileLoad, "_steps", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            FileLoad(spark, targets, urls_per_slice=2).run(parse_messages(frame), load_id)
    FileLoad(spark, targets, urls_per_slice=100).run(parse_messages(frame), load_id)
    assert sorted(r[0] for r in spark.table(targets.result("age")).select("NAME").collect()) == [f"n{n}" for n in range(6)]
