"""Which files URLs stand for, listed by the file system and by Spark."""

import gzip

import pytest
from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, FileLoad, Registry, SourceLayout, create_load_tables, messages_frame, struct
from waybill.sources import files, listing
from waybill.sources.files import list_files, read_lines
from waybill.sources.listing import glob_regex, qualified, url_frame
from waybill.storage import SharedFiles


@pytest.fixture()
def by_spark(monkeypatch):
    """Every listing goes through Spark, however few files there are."""
    monkeypatch.setattr(listing, "FEW_FILES", 0)


def tree(tmp_path):
    names = [
        "a.csv", "b.csv", "c d.csv", "e[1].csv", "f{x}.csv", "g,h.csv", "p%20q.csv", "é.csv", "z.csv.gz", "_hidden.csv", "_SUCCESS",
        ".x.csv.crc", "in/a.csv", "in/deep/b.csv", "in/deep/.dot", "in/x=1/part.csv", "_skip/f.csv",
    ]
    for name in names:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        if name.endswith(".gz"):
            with gzip.open(path, "wt") as f:
                f.write(f"h\n{name}\n")
        else:
            path.write_text(f"h\n{name}\n")
    return str(tmp_path)


def found(spark, urls, root):
    frame = list_files(spark, url_frame(spark, urls))
    pairs = {(r["fileURL"].removeprefix(root), r["file_path"].rsplit(root, 1)[-1]) for r in frame.matches.collect()}
    return frame, pairs, sorted((r["fileURL"].removeprefix(root), r["problem"]) for r in frame.problems.collect())


def urls_of(root):
    return [
        f"{root}/a.csv", f"{root}/nothing.csv", f"{root}/*.csv", f"file://{root}/b.csv", f"{root}//c d.csv", f"{root}/in", f"{root}/in/",
        f"{root}/in/deep/*", f"{root}/{{a,b}}.csv", f"{root}/[ab].csv", f"{root}/?.csv", f"{root}/g,h.csv", f"{root}/_hidden.csv", f"{root}/x*y",
        f"{root}/z.csv.gz", f"{root}/*/deep",
    ]


def test_spark_finds_what_the_file_system_finds(spark, tmp_path, monkeypatch):
    root = tree(tmp_path)
    few, pairs, problems = found(spark, urls_of(root), root)
    monkeypatch.setattr(listing, "FEW_FILES", 0)
    many, spark_pairs, spark_problems = found(spark, urls_of(root), root)
    assert few.few is not None and many.few is None
    assert spark_pairs == pairs and spark_problems == problems
    assert ("/nothing.csv", "file_not_found") in problems and ("/_hidden.csv", "hidden_file: _hidden.csv") in problems
    assert ("/in", "hidden_file: .dot") in problems and ("/*.csv", "hidden_file: _hidden.csv") in problems
    assert not any("_SUCCESS" in p or ".crc" in p for _, p in problems)
    lines = {tuple(r) for r in read_lines(spark, few).collect()}
    assert {(p.replace("file:///", "file:/"), n) for p, n in lines} == {
        (p.replace("file:///", "file:/"), n) for p, n in map(tuple, read_lines(spark, many).collect())
    }
    # Every file once, however often it was matched.
    assert len(lines) == read_lines(spark, many).count() == 12


@pytest.mark.parametrize("count", [listing.FEW_FILES, listing.FEW_FILES + 1])
def test_both_sides_of_the_bound(spark, tmp_path, count):
    for i in range(count):
        (tmp_path / f"f{i}.csv").write_text(f"h\n{i}\n")
    got = list_files(spark, url_frame(spark, [str(tmp_path)]))
    assert (got.few is None) == (count > listing.FEW_FILES)
    assert got.matches.select("fileURL").count() in (count, 2 * count)  # two forms of a local path
    assert sorted(int(r["line"]) for r in read_lines(spark, got).collect()) == list(range(count))


@pytest.mark.parametrize("count", [listing.FEW_URLS, listing.FEW_URLS + 1])
def test_many_urls_of_one_folder_are_a_few_patterns(spark, tmp_path, count):
    urls = []
    for i in range(count):
        (tmp_path / f"f{i}.csv").write_text(f"h\n{i}\n")
        urls.append(f"{tmp_path}/f{i}.csv")
    got = list_files(spark, url_frame(spark, [*urls, f"{tmp_path}/none.csv"]).limit(count))
    assert (got.few is None) == (count > listing.FEW_URLS)
    own = url_frame(spark, urls).withColumn("url", qualified(spark, F.col("fileURL")))
    assert listing.patterns_of(own, count).count() == 1
    assert sorted(int(r["line"]) for r in read_lines(spark, got).collect()) == list(range(count))


def test_qualified_urls(spark):
    rows = {
        "/a//b/": "file:/a/b", "file:///a/b": "file:/a/b", "file:/a": "file:/a", "s3a://bucket/x//y": "s3a://bucket/x/y",
        "s3a://bucket": "s3a://bucket", "/": "file:/",
    }
    got = url_frame(spark, rows).select("fileURL", qualified(spark, F.col("fileURL")).alias("q")).collect()
    assert {r["fileURL"]: r["q"] for r in got} == rows
    relative = url_frame(spark, ["x/y.csv"]).select(qualified(spark, F.col("fileURL"))).first()[0]
    assert relative.startswith("file:/") and relative.endswith("/x/y.csv")


def test_glob_regex():
    import re

    for glob, yes, no in (
        ("/a/*.csv", "/a/x.csv", "/a/b/x.csv"),
        ("/a/{b,c?}/x", "/a/cd/x", "/a/c/x"),
        ("/a/[!b]x", "/a/cx", "/a/bx"),
        ("/a/[a-c].csv", "/a/b.csv", "/a/d.csv"),
        ("/a/\\*(1)+.csv", "/a/*(1)+.csv", "/a/x(1)+.csv"),
    ):
        assert re.fullmatch(glob_regex(glob), yes) and not re.fullmatch(glob_regex(glob), no)


def test_load_listed_by_spark(spark, targets, tmp_path, by_spark):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    for i in range(6):
        (tmp_path / f"client{i}.csv").write_text(f"NAME,AGE\nn{i},{i}\n")
    rows = [(f"{tmp_path}/client{i}.csv", i) for i in range(7)] + [(f"{tmp_path}/client[0-2].csv", 9)]
    messages = [{"fileURL": u, "destination": "age", "id": str(n), "timestamp": "t"} for u, n in rows]
    FileLoad(spark, targets, urls_per_slice=3).run(messages_frame(spark, messages))
    got = sorted(r["NAME"] for r in spark.table(targets.result("age")).collect())
    assert got == sorted([f"n{i}" for i in range(6)] + [f"n{i}" for i in range(3)])
    assert [(r["message_id"], r["reason"]) for r in spark.table(targets.dead_letters).collect()] == [("6", "file_not_found")]


def test_hidden_files_leave_a_dead_letter(spark, targets, tmp_path):
    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    for name in ("client/a.csv", "client/_b.csv", "client/.c.csv", "client/_SUCCESS"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("NAME,AGE\nn,1\n")
    message = {"fileURL": f"{tmp_path}/client", "destination": "age", "id": "m", "timestamp": "t"}
    FileLoad(spark, targets).run(messages_frame(spark, [message]))
    assert spark.table(targets.result("age")).count() == 1
    reasons = sorted(r["reason"] for r in spark.table(targets.dead_letters).collect())
    assert reasons == ["hidden_file: .c.csv", "hidden_file: _b.csv"]


# --- headers and encodings -----------------------------------------------------------------


@pytest.mark.parametrize("suffix", ["", ".bz2"])
@pytest.mark.parametrize("skip", [0, 1, 2, 7, 30])
def test_header_beyond_the_first_split(spark, tmp_path, skip, suffix):
    import bz2

    expected = []
    for name, n in (("a.csv", 60), ("b.csv", 10), ("c.csv", 31)):
        lines = [f"{name} {i} " + "x" * (40 if i % 3 else 300) for i in range(n)]
        text = "".join(line + "\n" for line in lines)
        if suffix:
            (tmp_path / (name + suffix)).write_bytes(bz2.compress(text.encode()))
        else:
            (tmp_path / name).write_text(text)
        expected += lines[skip:]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        got = sorted(r["line"] for r in files.read_text_file(spark, f"{tmp_path}/*{suffix}", skip).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(expected)


LATIN = Registry(
    sources=(
        SourceLayout("alt", struct(name="STRING", n="INTEGER"), encoding="iso-8859-1"),
        SourceLayout("neu", struct(name="STRING", n="INTEGER")),
    ),
    tables={"t": struct(name="STRING", n="INTEGER")},
)


@pytest.mark.parametrize("count", [1, 90])
def test_files_are_decoded_by_their_layout(spark, targets, tmp_path, count):
    create_load_tables(spark, targets, LATIN)
    for i in range(count):
        (tmp_path / f"alt{i}.csv").write_bytes(f"Größe,n\nMüller é,{i}\n".encode("latin-1"))
        (tmp_path / f"neu{i}.csv").write_bytes(f"Größe,n\nJosé,{i}\n".encode())
    messages = [{"fileURL": f"{tmp_path}/{p}*.csv", "destination": "t", "id": p, "timestamp": "t"} for p in ("alt", "neu")]
    FileLoad(spark, targets, LATIN).run(messages_frame(spark, messages))
    got = sorted(tuple(r) for r in spark.table(targets.result("t")).collect())
    assert got == sorted((n, i) for i in range(count) for n in ("Müller é", "José"))


def test_other_layout_settings_are_refused():
    with pytest.raises(ValueError, match="line end"):
        SourceLayout("a", struct(x="STRING"), delimiter=";")
    with pytest.raises(ValueError, match="utf-16"):
        SourceLayout("a", struct(x="STRING"), encoding="utf-16")


def test_driver_sees_no_names_of_files_that_spark_lists(spark, tmp_path, by_spark, monkeypatch):
    for i in range(50):
        (tmp_path / f"f{i}.csv").write_text("h\n")
    monkeypatch.setattr(SharedFiles, "_status", lambda raw: pytest.fail("a file became a Python object"))
    got = list_files(spark, url_frame(spark, [f"{tmp_path}/*.csv"]))
    assert got.matches.count() == 50 and got.scans[0].files == 50


def test_urls_without_a_file_take_no_slices(spark, targets, tmp_path, monkeypatch):
    from waybill.plans import load

    create_load_tables(spark, targets, DEFAULT_REGISTRY)
    listed, list_slice = [], load.list_slice
    monkeypatch.setattr(load, "list_slice", lambda *given: listed.append(given[-1]) or list_slice(*given))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "client0.csv").write_text("NAME,AGE\na,1\n")
    names = ["in/client0.csv", *[f"gone/client{i}.csv" for i in range(600)], *[f"gone{i}/client.csv" for i in range(9)]]
    messages = [{"fileURL": f"{tmp_path}/{n}", "destination": "age", "id": n, "timestamp": "t"} for n in names]
    FileLoad(spark, targets, urls_per_slice=3).run(messages_frame(spark, messages))
    assert listed == [0]
    letters = {(r.message_id, r.reason) for r in spark.table(targets.dead_letters).collect()}
    assert letters == {(n, "file_not_found") for n in names[1:]}
    assert spark.table(targets.result("age")).count() == 1
