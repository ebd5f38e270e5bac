"""Frames, files and messages rendered from the tables.

``customer`` plays the files (its rows as CSV lines with known faults), ``events`` plays
the topics, ``lineitem`` a big file with an uneven share of rows per message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import DEFAULT_REGISTRY, Registry, SourceLayout, Targets, create_load_tables, struct
from waybill.operators.lines import attach_messages, judge_lines
from waybill.operators.messages import messages_frame, prepare_messages
from waybill.storage import fresh_folder

TIMESTAMP = "2024-01-01 00:00:00"

FEED_FILES = {
    "client1.csv": {"id": "m0", "destination": "age", "header": "NAME,AGE",
                    "partition_depth": [3, 20], "partition_key": "AGE"},
    "telephone2.csv": {"id": "m1", "destination": "telephone", "header": "name,number"},
    "address1.csv": {"id": "m2", "destination": "address", "header": "name,address"},
}

LINEITEM_REGISTRY = Registry(
    sources=(
        SourceLayout(
            "lineitem",
            struct(orderkey="INTEGER", partkey="INTEGER", linenumber="INTEGER", flag="STRING", status="STRING"),
            max_bad_rows=1000,
        ),
    ),
    tables={"lineitem": struct(orderkey="INTEGER", partkey="INTEGER", linenumber="INTEGER", flag="STRING")},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_no, id, source_file, line`` from customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS line_no",
        "concat('m', c_custkey % 3) AS id",
        "CASE c_custkey % 3 WHEN 0 THEN 'client1.csv' WHEN 1 THEN 'telephone2.csv' ELSE 'address1.csv' END"
        " AS source_file",
        """CASE WHEN c_custkey % 10 = 7 THEN concat(c_name, ',1,extra')
                WHEN c_custkey % 10 = 8 THEN c_name
                WHEN c_custkey % 3 = 0 AND c_custkey % 10 = 9 THEN concat(c_name, ',x', c_nationkey)
                WHEN c_custkey % 3 = 0 THEN concat(c_name, ',', c_nationkey)
                WHEN c_custkey % 3 = 1 THEN concat(c_name, ',', c_custkey)
                ELSE concat(c_name, ',', c_mktsegment) END AS line""",
    )


def feed_messages(spark: SparkSession, folder: str = "") -> DataFrame:
    """The three control messages of the feed files."""
    return messages_frame(
        spark,
        [
            {"fileURL": f"{folder}/{name}", "timestamp": TIMESTAMP, **{k: v for k, v in m.items() if k != "header"}}
            for name, m in FEED_FILES.items()
        ],
    )


def judged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's lines with their messages, judged."""
    lines = feed(spark, sf_dir).select(F.col("source_file").alias("file_path"), "line")
    bridge = prepare_messages(feed_messages(spark), DEFAULT_REGISTRY)
    return judge_lines(attach_messages(lines, bridge.withColumn("file_path", F.col("source_file"))), DEFAULT_REGISTRY)


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flag, line``: lineitem as CSV lines, a tenth too short and a tenth with a bad number."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS flag",
        """CASE WHEN l_orderkey % 10 = 7 THEN concat_ws(',', l_orderkey, l_partkey, l_linenumber)
                WHEN l_orderkey % 10 = 8 THEN
                     concat_ws(',', l_orderkey, concat('p', l_partkey), l_linenumber, l_returnflag, l_linestatus)
                ELSE concat_ws(',', l_orderkey, l_partkey, l_linenumber, l_returnflag, l_linestatus) END AS line""",
    )


def lineitem_messages(spark: SparkSession, folder: str = "") -> DataFrame:
    """One message per return flag, with a range of line numbers."""
    return messages_frame(
        spark,
        [
            {"fileURL": f"{folder}/lineitem_{flag}.csv", "destination": "lineitem", "id": flag, "timestamp": TIMESTAMP,
             "partition_key": "linenumber", "partition_depth": [1, 5.5]}
            for flag in ("A", "N", "R")
        ],
    )


def judged_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as lines of one file per return flag, judged; one flag has most of the rows."""
    lines = lineitem_lines(spark, sf_dir).select(
        F.concat(F.lit("lineitem_"), "flag", F.lit(".csv")).alias("file_path"), "line"
    )
    bridge = prepare_messages(lineitem_messages(spark), LINEITEM_REGISTRY)
    bridge = bridge.withColumn("file_path", F.col("source_file"))
    return judge_lines(attach_messages(lines, bridge), LINEITEM_REGISTRY)


def write_lineitem_files(spark: SparkSession, sf_dir: str) -> str:
    """The lines as one CSV file (a folder of part files) per return flag."""
    folder = fresh_folder(spark, "lineitem")
    lines = lineitem_lines(spark, sf_dir)
    for flag in ("A", "N", "R"):
        part = lines.filter(F.col("flag") == flag).select(F.col("line").alias("orderkey,partkey,linenumber,flag,status"))
        write_raw(part, f"{folder}/lineitem_{flag}.csv")
    return folder


def write_raw(lines: DataFrame, path: str, header: bool = True, compression: str = "none") -> None:
    """A one-column frame as lines: one column needs no separator, and nothing is quoted.
    The name of the column is the header of each part file."""
    lines.write.options(header=header, sep="\u0001", quote="", escape="", emptyValue="", compression=compression).csv(path)


def write_feed_files(spark: SparkSession, sf_dir: str, header: bool = True, compression: str = "none") -> str:
    """The feed as three CSV files (folders of part files) with a header line in each part."""
    folder = fresh_folder(spark, "feed")
    lines = feed(spark, sf_dir)
    for name, message in FEED_FILES.items():
        part = lines.filter(F.col("source_file") == name).select(F.col("line").alias(message["header"]))
        write_raw(part, f"{folder}/{name}", header, compression)
    return folder


def scratch_targets(spark: SparkSession, registry: Registry | None = None) -> Targets:
    """Two new databases in the shared folder, with the registry's tables if there is one."""
    folder = fresh_folder(spark, "tables")
    tag = folder.rsplit("-", 1)[-1]
    targets = Targets(results=f"results_{tag}", rejects=f"rejects_{tag}", create=registry is None)
    for name in (targets.results, targets.rejects):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    if registry is not None:
        create_load_tables(spark, targets, registry)
    return targets


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as envelopes: JSON ``{"k": n, "target_table": type}``, topic = type."""
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.expr("left(props, length(props) - 1)"), F.lit(', "target_table": "'), "event_type", F.lit('"}')
        ).alias("value"),
        F.col("event_type").alias("topic"),
        F.col("event_id").cast("string").alias("message_id"),
        F.col("ts").cast("timestamp").alias("message_ts"),
    )
