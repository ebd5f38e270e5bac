"""One function ``(spark, sf_dir) -> DataFrame`` per registered query."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.feeds import (
    FEED_FILES,
    LINEITEM_REGISTRY,
    TIMESTAMP,
    event_payloads,
    feed,
    feed_messages,
    judged_feed,
    judged_lineitem,
    lineitem_messages,
    scratch_targets,
    table,
    write_feed_files,
    write_lineitem_files,
    write_raw,
)
from waybill import DEFAULT_REGISTRY, ExactNameLoad, FileLoad, InferredLoad, JsonRouting, parse_messages, struct
from waybill.functions.casts import to_integer
from waybill.functions.payload import json_field, parse_json
from waybill.functions.text import base_name, bucket_of, object_of, split_fields, without_scheme
from waybill.layouts import DEFAULT_EXACT_NAME, EXACT_NAME_LAYOUTS, OUT_OF_RANGE
from waybill.operators import outputs
from waybill.operators.joins import attach, beside_list
from waybill.operators.lines import named_fields, outside, typed_columns
from waybill.operators.messages import layout_of, messages_frame, with_text_time
from waybill.operators.routing import event_messages, route_by_size, rows_by_topic, rows_with_target
from waybill.operators.tables import append, append_compatible, row_count
from waybill.plans.router import dispatch
from waybill.sources.files import read_paths, read_text_file
from waybill.sources.listing import file_sizes
from waybill.sources.topics import ENVELOPE, folder_topics, publish_file_to_folder, publish_to_folder
from waybill.storage import fresh_folder
from waybill.streaming.arrivals import start_loads_on_arrival
from waybill.streaming.loader import start_file_loads, start_json_routing, start_roads
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

K_SCHEMA = struct(k="INTEGER")
ROADS = {"click": "output1", "view": "output2", "purchase": "output3"}


# --- the load over lines ---------------------------------------------------------------


def load_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End records per message: split, check, cast, range, count (the flagship)."""
    return outputs.end_records(outputs.count_lines(judged_feed(spark, sf_dir)))


def load_start_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A START record per event, each event being a message."""
    messages = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"), F.col("ts").alias("message_ts")
    )
    return with_text_time(messages).transform(outputs.start_records)


def _valid(spark: SparkSession, sf_dir: str, destination: str) -> DataFrame:
    lines = outputs.valid_lines(judged_feed(spark, sf_dir)).filter(F.col("destination") == destination)
    return typed_columns(lines, DEFAULT_REGISTRY.table_schema(destination), DEFAULT_REGISTRY)


def load_valid_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir, "age")


def load_valid_telephone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir, "telephone")


def load_valid_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir, "address")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject-table rows of all messages."""
    return outputs.as_rejects(outputs.rejected_lines(judged_feed(spark, sf_dir)))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = outputs.rejected_lines(judged_feed(spark, sf_dir))
    return rejected.groupBy("message_id", "stacktrace").agg(F.count("*").alias("n"))


def line_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = feed(spark, sf_dir).select("id", F.size(split_fields(F.col("line"))).cast("bigint").alias("fields"))
    return sizes.groupBy("id", "fields").agg(F.count("*").alias("n"))


def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second fields as integers, with the ones that do not cast."""
    second = F.get(split_fields(F.col("line")), F.lit(1))
    return feed(spark, sf_dir).filter(second.isNotNull()).select(
        "line_no", second.alias("text"), to_integer(second).alias("number"), to_integer(second).isNull().alias("failed")
    )


def range_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends exclusive."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").filter(~outside(key, F.lit(3), F.lit(20))).select("n_nationkey", "n_name")


def lineitem_load_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End records of a big load with its own layouts and a message with half of all lines."""
    return outputs.end_records(outputs.count_lines(judged_lineitem(spark, sf_dir)))


def lineitem_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_lineitem(spark, sf_dir)
    return judged.groupBy("message_id", "stacktrace").agg(F.count("*").alias("n"))


def bad_file_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons per file after the bad-row limit; 80 customers make a file."""
    layout = F.element_at(F.array(*[F.lit(s.prefix) for s in DEFAULT_REGISTRY.sources]), F.col("no") % 3 + 1)
    judged = (
        table(spark, sf_dir, "customer")
        .withColumn("no", F.floor(F.col("c_custkey") / 80).cast("int"))
        .select(
            F.concat(F.lit("b"), "no").alias("message_id"),
            F.lit(TIMESTAMP).alias("message_ts"),
            F.concat(layout, F.col("no"), F.lit(".csv")).alias("source_file"),
            layout.alias("layout"),
            F.when(F.col("c_custkey") % 10 >= 7 + F.col("no") % 2, "error_line_index")
            .otherwise("")
            .alias("stacktrace"),
        )
    )
    over = outputs.files_over_limit(judged, DEFAULT_REGISTRY)
    path = fresh_folder(spark, "over_limit")
    over.write.parquet(path)
    limited = outputs.apply_bad_row_limit(judged, spark.read.schema(over.schema).parquet(path))
    return limited.groupBy("source_file", "stacktrace").agg(F.count("*").alias("n"))


def cogroup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected lines, whatever the reason, counted apart and brought together."""
    judged = judged_feed(spark, sf_dir)
    rejected = judged.filter(F.col("stacktrace") != "")
    return outputs.cogroup_counts(outputs.valid_lines(judged), rejected, ["message_id"])


def message_broadcast_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with every message that names its file; two messages name client1.csv."""
    rows = [(m["id"], name, m["destination"]) for name, m in FEED_FILES.items()] + [("m3", "client1.csv", "address")]
    messages = spark.createDataFrame(rows, "message_id string, source_file string, destination string")
    lines = feed(spark, sf_dir).select("source_file", "line_no", "line")
    return attach(lines, messages, ["source_file"])


def list_beside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation with the list of all regions beside it."""
    regions = table(spark, sf_dir, "region")
    beside = beside_list(table(spark, sf_dir, "nation"), regions, "regions")
    names = F.array_join(F.transform("regions", lambda r: r["r_name"]), "|")
    return beside.select("n_nationkey", names.alias("region_names"))


def unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By name whatever the case; unknown columns go, missing ones are NULL."""
    target = struct(C_NAME="STRING", C_NATIONKEY="INTEGER", C_PHONE="STRING", C_ACCTBAL="FLOAT")
    conformed = outputs.conform(table(spark, sf_dir, "customer"), target)
    return conformed.select(*[F.col(c).alias(c.lower()) for c in conformed.columns])


def _exact_named_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with client1.csv under a known name and the others under unknown names."""
    name = F.when(F.col("id") == "m0", "tabledata2.csv").otherwise(F.col("source_file"))
    return feed(spark, sf_dir).select("line_no", name.alias("source_file"), "line")


def positional_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by position, as text, in the default layout (name, age, height)."""
    lines = _exact_named_feed(spark, sf_dir)
    return named_fields(lines, F.col("source_file"), EXACT_NAME_LAYOUTS, DEFAULT_EXACT_NAME)


def positional_untyped_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the layout of an exact file name (NAME, AGE, COLOR)."""
    lines = _exact_named_feed(spark, sf_dir)
    rows = named_fields(lines, F.col("source_file"), EXACT_NAME_LAYOUTS, DEFAULT_EXACT_NAME, "tabledata2.csv")
    return rows.select("line_no", "source_file", *[F.col(c).alias(c.lower()) for c in ("NAME", "AGE", "COLOR")])


# --- messages and routing --------------------------------------------------------------


def json_payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field by schema, and by path."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_json(F.col("props"), K_SCHEMA)["k"].alias("k"),
        json_field(F.col("props"), "k").alias("k_text"),
    )


def message_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages good and bad in six ways, strictly checked."""
    url = "'{\"fileURL\": \"s3://in/client', event_id, '.csv\", \"destination\": \"age\"'"
    envelopes = table(spark, sf_dir, "events").selectExpr(
        f"""CASE event_id % 6
              WHEN 0 THEN concat({url}, '}}')
              WHEN 1 THEN concat({url}, ', "extra": 1}}')
              WHEN 2 THEN concat('{{"fileURL": "s3://in/client', event_id, '.csv"}}')
              WHEN 3 THEN concat('{{"fileURL": ', event_id, ', "destination": "age"}}')
              WHEN 4 THEN concat({url})
              ELSE concat({url}, ', "partition_depth": [1, ', event_id, '], "partition_key": "AGE"}}') END AS value""",
        "CAST(event_id AS STRING) AS message_id",
        "ts AS message_ts",
    )
    return parse_messages(envelopes, strict_keys=True).select("message_id", F.col("problem").alias("reason"))


def file_struct_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout by file-name prefix, case-sensitive, of the last part of a URL."""
    names = F.expr(
        """concat('s3://bucket/client/', CASE c_custkey % 6 WHEN 0 THEN 'client' WHEN 1 THEN 'telephone'
           WHEN 2 THEN 'address' WHEN 3 THEN 'Client' WHEN 4 THEN 'my_client' ELSE 'addresses_' END,
           c_custkey, '.csv')"""
    )
    urls = table(spark, sf_dir, "customer").select("c_custkey", base_name(names).alias("source_file"))
    return urls.withColumn("layout", layout_of(F.col("source_file"), DEFAULT_REGISTRY))


def base64_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigger events with a base64 body, back to text and to messages."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("ts").alias("message_ts"),
        F.base64(
            F.concat(
                F.lit('{"fileURL": "gs://in/'), "event_id", F.lit('.csv", "destination": "'), "event_type", F.lit('"}')
            ).cast("binary")
        ).alias("data"),
    )
    url = F.col("fileURL")
    return event_messages(events).select(
        "message_id", "message", bucket_of(url).alias("bucket"), without_scheme(url).alias("path"), "destination"
    )


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", bucket_of(url).alias("bucket"), object_of(url).alias("object"))


def size_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, their length as the size, 1000 as the threshold."""
    name = F.concat(F.lit("s3://docs/"), "doc_id", F.lit(".txt")).alias("fileURL")
    documents = table(spark, sf_dir, "documents")
    sizes = documents.select(name, F.col("n_chars").alias("length"))
    return route_by_size(documents.select("doc_id", name), sizes, 1000).select("doc_id", "length", "route")


def dynamic_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table named inside the message."""
    rows = rows_with_target(event_payloads(spark, sf_dir), K_SCHEMA)
    return rows.filter("problem = ''").groupBy("target").agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"))


def three_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of the topic; other topics are on no road."""
    rows = rows_by_topic(event_payloads(spark, sf_dir), ROADS, K_SCHEMA)
    return rows.filter("problem = ''").groupBy("target").agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"))


def tumbling_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events"), "ts")


def tumbling_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"], "60 seconds")


# --- files and tables ------------------------------------------------------------------


def header_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files written with a header per file and read back without."""
    folder = write_feed_files(spark, sf_dir)
    lines = None
    for name in FEED_FILES:
        part = read_text_file(spark, f"{folder}/{name}", 1).select(F.lit(name).alias("source_file"), "line")
        lines = part if lines is None else lines.unionByName(part)
    return lines


def path_collection_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a collection of paths, without their paths."""
    folder = write_feed_files(spark, sf_dir)
    urls = feed(spark, sf_dir).select(F.concat(F.lit(folder + "/"), "source_file").alias("url")).distinct()
    return read_paths(spark, urls, 1).select("line")


def feed_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per feed file, from file status."""
    folder = write_feed_files(spark, sf_dir, header=False)
    sizes = file_sizes(spark, [f"{folder}/{name}" for name in FEED_FILES])
    return sizes.groupBy(base_name(F.col("fileURL")).alias("source_file")).agg(F.sum("length").alias("length"))


def _load_feed(spark: SparkSession, sf_dir: str, **settings):
    folder = write_feed_files(spark, sf_dir)
    targets = scratch_targets(spark, DEFAULT_REGISTRY)
    FileLoad(spark, targets, **settings).run(feed_messages(spark, folder))
    return targets


def batch_load_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table after a batch load of the feed files: three STARTs and three ends."""
    return spark.table(_load_feed(spark, sf_dir).monitoring)


def batch_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result table ``age`` after the load."""
    return spark.table(_load_feed(spark, sf_dir).result("age"))


def batch_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reject tables after the load."""
    targets = _load_feed(spark, sf_dir)
    tables = [spark.table(targets.reject(name)).withColumn("destination", F.lit(name)) for name in DEFAULT_REGISTRY.tables]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def load_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the seven tables after the load."""
    targets = _load_feed(spark, sf_dir)
    names = {"monitoring": targets.monitoring}
    for name in DEFAULT_REGISTRY.tables:
        names[name] = targets.result(name)
        names[f"{name}_rejects"] = targets.reject(name)
    counts = None
    for name, qualified in names.items():
        one = row_count(spark, qualified).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def lineitem_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table after a load of the biggest table from files, by its own layouts."""
    folder = write_lineitem_files(spark, sf_dir)
    targets = scratch_targets(spark, LINEITEM_REGISTRY)
    FileLoad(spark, targets, LINEITEM_REGISTRY).run(lineitem_messages(spark, folder))
    return spark.table(targets.monitoring)


def batch_load_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table of a load that rejects files with too many bad rows."""
    return spark.table(_load_feed(spark, sf_dir, limit_bad_rows=True).monitoring)


def stream_load_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table after the same load driven by a stream of messages."""
    folder = write_feed_files(spark, sf_dir)
    targets = scratch_targets(spark, DEFAULT_REGISTRY)
    rows = []
    for name, m in FEED_FILES.items():
        fields = {k: v for k, v in m.items() if k.startswith(("destination", "partition"))}
        rows.append((json.dumps({"fileURL": f"{folder}/{name}", **fields}), m["id"], TIMESTAMP))
    messages = spark.createDataFrame(rows, "value string, message_id string, ts string")
    messages = messages.select("value", "message_id", F.to_timestamp(F.concat("ts", F.lit("Z"))).alias("message_ts"))
    publish_to_folder(messages, "files", f"{folder}/topic")
    name = "load_" + targets.results
    query = start_file_loads(
        folder_topics(spark, f"{folder}/topic", ["files"]), FileLoad(spark, targets), name, f"{folder}/checkpoint"
    )
    query.awaitTermination()
    return spark.table(targets.monitoring)


def _routed(spark: SparkSession, targets, names) -> DataFrame:
    counts = None
    for name in names:
        rows = spark.table(targets.result(name))
        one = rows.agg(F.count("*").alias("n"), F.sum("k").alias("sum_k")).withColumn("target", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return counts.select("target", "n", "sum_k")


def dynamic_route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published to a topic and streamed to the tables they name, made on the way."""
    targets = scratch_targets(spark)
    folder = fresh_folder(spark, "topic")
    publish_to_folder(event_payloads(spark, sf_dir), "rows", f"{folder}/topic")
    routing = JsonRouting(spark, targets, K_SCHEMA)
    query = start_json_routing(
        folder_topics(spark, f"{folder}/topic"), routing, "route_" + targets.results, f"{folder}/checkpoint"
    )
    query.awaitTermination()
    return _routed(spark, targets, ["click", "error", "purchase", "signup", "view"])


def three_road_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published to three topics and streamed to three tables."""
    targets = scratch_targets(spark)
    folder = fresh_folder(spark, "topic")
    payloads = event_payloads(spark, sf_dir)
    for topic in ROADS:
        publish_to_folder(payloads.filter(F.col("topic") == topic), topic, f"{folder}/topic")
    query = start_roads(
        folder_topics(spark, f"{folder}/topic", list(ROADS)), JsonRouting(spark, targets, K_SCHEMA), ROADS,
        "roads_" + targets.results, f"{folder}/checkpoint",
    )
    query.awaitTermination()
    return _routed(spark, targets, ROADS.values())


def stream_tumbling_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed count as a stream over the events file."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = stream.select(F.col("ts").cast("timestamp").alias("ts"))
    folder = fresh_folder(spark, "windows")
    query = start_windowed_counts(
        windowed_counts(stream, "ts"), f"{folder}/counts", f"{folder}/checkpoint", "windows_" + folder[-12:]
    )
    query.awaitTermination()
    counts = latest_counts(spark, f"{folder}/counts")
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


def append_create_if_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a table that the first one makes."""
    target = scratch_targets(spark).result("customers")
    schema = struct(c_custkey="INTEGER", c_name="STRING", c_acctbal="FLOAT")
    customers = table(spark, sf_dir, "customer")
    append(customers, target, create_as=schema)
    append(customers, target, create_as=schema)
    return spark.table(target)


def append_create_never(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append to a table that must be there; its own columns decide."""
    target = scratch_targets(spark).result("customers")
    spark.sql(f"CREATE TABLE {target} (c_name STRING, C_CUSTKEY BIGINT, note STRING) USING parquet")
    append(table(spark, sf_dir, "customer"), target)
    return spark.table(target).select("c_name", F.col("C_CUSTKEY").alias("c_custkey"), "note")


def inferred_schema_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a CSV file with a header, loaded twice with the schema found in it: the
    first load makes the table, the second is checked against it."""
    folder = fresh_folder(spark, "inferred")
    table(spark, sf_dir, "customer").write.option("header", True).csv(f"{folder}/customers.csv")
    targets = scratch_targets(spark)
    message = json.dumps({"fileURL": f"{folder}/customers.csv", "destination": "customers"})
    rows = [(message, "1", TIMESTAMP), (message, "2", TIMESTAMP)]
    InferredLoad(spark, targets).run(
        spark.createDataFrame(rows, "value string, message_id string, message_ts string")
    )
    return spark.table(targets.result("customers"))


def schema_checked_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a frame, then an append with more columns and in another order."""
    target = scratch_targets(spark).result("orders")
    orders = table(spark, sf_dir, "orders")
    append_compatible(orders.select("o_orderkey", "o_orderstatus"), target)
    append_compatible(orders.select("o_orderpriority", "o_orderstatus", "o_orderkey"), target)
    return spark.table(target)


def exact_name_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the layout of their exact name or the default, to the table of the message."""
    folder = fresh_folder(spark, "exact")
    customers = table(spark, sf_dir, "customer")
    lines = customers.select(F.concat_ws(",", "c_name", "c_nationkey", "c_custkey", "c_mktsegment").alias("h"))
    for name in ("tabledata2.csv", "other.csv"):
        write_raw(lines, f"{folder}/{name}")
    targets = scratch_targets(spark)
    messages = spark.createDataFrame(
        [("1", f"{folder}/tabledata2.csv", "colors"), ("2", f"{folder}/other.csv", "heights")],
        "message_id string, fileURL string, destination string",
    )
    ExactNameLoad(spark, targets).run(messages)
    return _exact_named_rows(spark, targets)


def _exact_named_rows(spark: SparkSession, targets) -> DataFrame:
    colors = spark.table(targets.result("colors"))
    heights = spark.table(targets.result("heights"))
    return colors.select(
        F.lit("colors").alias("table_name"), F.col("NAME").alias("name"), F.col("AGE").alias("age"),
        F.col("COLOR").alias("color"), F.lit(None).cast("double").alias("height"),
    ).unionByName(
        heights.select(
            F.lit("heights").alias("table_name"), "name", "age", F.lit(None).cast("string").alias("color"), "height"
        )
    )


def inferred_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per nation, loaded by one run into one table: of four nations one has text where the
    others have numbers, one truth values, one nothing but a blank line and one no file."""
    folder = fresh_folder(spark, "nations")
    nation, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    score = F.when(nation == 7, "none yet").when(nation == 8, "true").otherwise(F.concat(key, F.lit(".5")))
    customers = table(spark, sf_dir, "customer").select("c_nationkey", key.alias("custkey"), F.col("c_name").alias("name"), score.alias("score"))
    customers.filter(~nation.isin(9, 10)).repartition("c_nationkey").write.partitionBy("c_nationkey").option("header", True).csv(folder)
    customers.filter(nation == 9).agg(F.lit("").alias("value")).write.text(f"{folder}/c_nationkey=9")
    messages = table(spark, sf_dir, "nation").select(
        F.to_json(
            F.struct(F.concat(F.lit(f"{folder}/c_nationkey="), "n_nationkey").alias("fileURL"), F.lit("people").alias("destination"))
        ).alias("value"),
        F.format_string("m%02d", "n_nationkey").alias("message_id"),
        F.lit(TIMESTAMP).alias("message_ts"),
    )
    targets = scratch_targets(spark)
    InferredLoad(spark, targets).run(messages)
    people, letters = spark.table(targets.result("people")), spark.table(targets.dead_letters)
    none = F.lit(None)
    return people.select(
        none.cast("string").alias("message_id"), none.cast("string").alias("reason"), "custkey", "name", "score"
    ).unionByName(
        letters.select(
            "message_id", "reason", none.cast("bigint").alias("custkey"), none.cast("string").alias("name"), none.cast("double").alias("score")
        )
    )


def stream_exact_name_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and the arrivals of their files as two streams; one file never arrives."""
    folder = fresh_folder(spark, "arrivals")
    customers = table(spark, sf_dir, "customer")
    lines = customers.select(F.concat_ws(",", "c_name", "c_nationkey", "c_custkey", "c_mktsegment").alias("h"))
    for name in ("tabledata2.csv", "other.csv"):
        write_raw(lines, f"{folder}/{name}")

    def envelopes(*rows: tuple) -> DataFrame:
        frame = spark.createDataFrame(rows, "value string, message_id string, at string")
        return frame.select("value", "message_id", F.to_timestamp(F.concat("at", F.lit("Z"))).alias("message_ts"))

    def message(name: str, destination: str) -> str:
        return json.dumps({"address": f"{folder}/{name}", "destination": destination})

    end = "2024-01-02 00:00:00"  # a day later, all that is still alone stays so
    publish_to_folder(
        envelopes(
            (message("tabledata2.csv", "colors"), "1", "2024-01-01 00:00:00"), (message("other.csv", "heights"), "2", "2024-01-01 00:00:05"),
            (message("none.csv", "heights"), "3", "2024-01-01 00:00:06"), ("{", "4", "2024-01-01 00:00:07"), (message("end", "x"), "5", end),
        ), "messages", f"{folder}/messages",
    )
    publish_to_folder(
        envelopes(
            (json.dumps({"file": f"{folder}/tabledata2.csv"}), "a", "2024-01-01 00:01:00"),
            (json.dumps({"file": f"{folder}/other.csv"}), "b", "2023-12-31 23:59:00"), (json.dumps({"file": f"{folder}/last"}), "c", end),
        ), "files", f"{folder}/files",
    )
    targets = scratch_targets(spark)
    start_loads_on_arrival(
        folder_topics(spark, f"{folder}/messages"), folder_topics(spark, f"{folder}/files"), ExactNameLoad(spark, targets),
        "arrive_" + targets.results, f"{folder}/checkpoint",
    ).awaitTermination()
    letters = spark.table(targets.dead_letters).select(
        F.lit("dead_letters").alias("table_name"), F.col("message_id").alias("name"), F.lit(None).cast("bigint").alias("age"),
        F.col("reason").alias("color"), F.lit(None).cast("double").alias("height"),
    )
    return _exact_named_rows(spark, targets).unionByName(letters)


def _event_stream(spark: SparkSession, events: DataFrame, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_cogroup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose number is no multiple of three as valid, the others as rejected: two streams, counted
    per second and type and brought together."""
    folder = fresh_folder(spark, "cogroup")
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", parse_json(F.col("props"), K_SCHEMA)["k"].alias("k")
    )
    rows.write.parquet(f"{folder}/events")
    # A row of a later day on both sides closes all windows before it, and is in none that closes.
    after = rows.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    last = after.select("ts", F.lit("end").alias("event_type"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("k"))
    last.write.mode("append").parquet(f"{folder}/events")
    stream = _event_stream(spark, rows, f"{folder}/events")
    counts = windowed_cogroup(stream.filter("k % 3 <> 0"), stream.filter("k % 3 = 0"), "ts", ["event_type"])
    start_appended(counts, f"{folder}/counts", f"{folder}/checkpoint", "cogroup_" + folder[-12:]).awaitTermination()
    found = spark.read.parquet(f"{folder}/counts/batch=*")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of even ids, then those of odd ids, of which many come too late: per minute the rows counted
    and the late ones, which together are all events."""
    folder = fresh_folder(spark, "late")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    for rest in (0, 1):
        events.filter(F.pmod("event_id", F.lit(2)) == rest).coalesce(1).write.mode("append").parquet(f"{folder}/events")
    stream = _event_stream(spark, events, f"{folder}/events", 1)
    settings = {"window": "60 seconds", "lateness": "10 days"}
    start_counts_with_late_rows(
        stream, "ts", f"{folder}/out", f"{folder}/checkpoint", "late_" + folder[-12:], **settings
    ).awaitTermination()
    late = windowed_counts(late_rows(spark, f"{folder}/out", events.schema), "ts", window="60 seconds", count="n_late")
    counted = counts_in_time(spark, f"{folder}/out", **settings)
    zero = F.lit(0).cast("bigint")
    return counted.join(late, "window_start", "full_outer").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.coalesce("n", zero).alias("n"),
        F.coalesce("n_late", zero).alias("n_late"),
    )


def compressed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table after a load of gzip files."""
    folder = write_feed_files(spark, sf_dir, compression="gzip")
    targets = scratch_targets(spark, DEFAULT_REGISTRY)
    FileLoad(spark, targets).run(feed_messages(spark, folder))
    return spark.table(targets.monitoring)


def glob_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring table after a load of all files of one pattern by one message."""
    folder = write_lineitem_files(spark, sf_dir)
    targets = scratch_targets(spark, LINEITEM_REGISTRY)
    message = {"fileURL": f"{folder}/lineitem_*.csv", "destination": "lineitem", "id": "all", "timestamp": TIMESTAMP}
    FileLoad(spark, targets, LINEITEM_REGISTRY).run(messages_frame(spark, [message]))
    return spark.table(targets.monitoring)


def load_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of messages made from the events, which name no file or are no messages."""
    url = "'{\"fileURL\": \"" + fresh_folder(spark, "nothing") + "/'"
    envelopes = table(spark, sf_dir, "events").selectExpr(
        f"""CASE event_id % 5
              WHEN 0 THEN concat({url}, 'client', event_id, '.csv", "destination": "age"}}')
              WHEN 1 THEN concat({url}, 'unknown', event_id, '.csv", "destination": "age"}}')
              WHEN 2 THEN concat({url}, 'client', event_id, '.csv", "destination": "nowhere"}}')
              WHEN 3 THEN concat({url}, 'client', event_id, '.csv", "destination": "age", "partition_key": "SIZE", "partition_depth": [1, 2]}}')
              ELSE concat({url}, event_id) END AS value""",
        "CAST(event_id AS STRING) AS message_id",
        "CAST(ts AS TIMESTAMP) AS message_ts",
    )
    targets = scratch_targets(spark, DEFAULT_REGISTRY)
    FileLoad(spark, targets).run(parse_messages(envelopes))
    return spark.table(targets.dead_letters).select("timestamp", "reason", "message_id")


def dispatch_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files by their size: of those at or above the size of the file for ``telephone`` the load's
    end records, of the others the messages that went to the topic of small files."""
    folder = write_feed_files(spark, sf_dir, header=False)
    threshold = file_sizes(spark, [f"{folder}/telephone2.csv"]).agg(F.sum("length")).first()[0]
    targets = scratch_targets(spark, DEFAULT_REGISTRY)
    dispatch(
        feed_messages(spark, folder), lambda rows: publish_to_folder(rows, "small", f"{folder}/topic"),
        FileLoad(spark, targets, skip_header_lines=0), threshold,
    )
    loaded = spark.table(targets.monitoring).filter("event <> 'START'")
    published = spark.read.schema(ENVELOPE).json(f"{folder}/topic")
    none = F.lit(None).cast("bigint")
    return loaded.select("event", "number_inserted_rows", "number_rejected_rows").unionByName(
        published.select(F.concat(F.lit("to the stream: "), "message_id").alias("event"), none.alias("number_inserted_rows"), none.alias("number_rejected_rows"))
    )


def publish_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of a text file, each sent to a topic as a message and routed from there."""
    folder = fresh_folder(spark, "publish")
    event_payloads(spark, sf_dir).select("value").write.text(f"{folder}/messages.json")
    publish_file_to_folder(spark, f"{folder}/messages.json", "rows", f"{folder}/topic")
    rows = rows_with_target(spark.read.schema(ENVELOPE).json(f"{folder}/topic"), K_SCHEMA)
    return rows.filter("problem = ''").groupBy("target").agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"))


QUERIES = {
    f.__name__: f
    for f in (
        load_monitoring, load_start_events, load_valid_client, load_valid_telephone, load_valid_address,
        load_rejects, reject_reasons, line_arity, cast_failures, range_predicate, lineitem_load_monitoring,
        lineitem_reject_reasons, bad_file_threshold, cogroup_counts, message_broadcast_join, list_beside,
        unknown_columns, positional_untyped, positional_untyped_exact, json_payload_parse, message_validation,
        file_struct_lookup, base64_event, url_parts, size_router, dynamic_route_counts, three_roads,
        tumbling_1s, tumbling_60s, header_skip, path_collection_lines, feed_file_sizes, batch_load_monitoring,
        batch_load_rows, batch_load_rejects, load_table_counts, lineitem_file_load, batch_load_limited, stream_load_monitoring,
        dynamic_route_tables, three_road_tables, stream_tumbling_1s, append_create_if_needed,
        append_create_never, inferred_schema_load, schema_checked_append, exact_name_load, inferred_many_files,
        stream_exact_name_load, stream_cogroup_counts, stream_late_rows, compressed_load, glob_load, load_dead_letters,
        dispatch_by_size, publish_file,
    )
}
