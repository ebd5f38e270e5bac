"""Loads by message with the schema found in the file.

A table that is not there is made from the schema of its first message; the files of all other
messages must have its columns in the same kinds. Any number of messages is one load: their files are
read once, one aggregate finds the kinds of all columns of all files, a join tells which messages fit
their table, and every table is written by one append. The number of Spark jobs grows with the
tables and the different headers among them, not with the messages.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import layouts
from waybill.functions.text import base_name
from waybill.layouts import DEAD_LETTER_SCHEMA, REJECT_SCHEMA, SPARK_TYPES, kind_of
from waybill.operators.joins import LINE_SALTS, attach
from waybill.operators.messages import located_messages
from waybill.operators.outputs import conform, dead_letters, reject_records
from waybill.operators.tables import LOAD_ID, STEP, LoadFolder, SchemaMismatch, Targets
from waybill.plans.load import kept_slice_size, list_slice, listed_slices, problem_letters
from waybill.sources.files import numbered_lines
from waybill.sources.inferred import LATTICE, column_facts, delimited_fields, header_names, kind_of_facts, value_of
from waybill.sources.listing import PROBLEM_SCHEMA

inferred_messages = located_messages

_LINES = "file_path string, split_start long, row long, line string, fields array<string>, slice int"
_BRIDGE = "file_path string, message_id string, message_ts string, fileURL string, destination string, slice int"
_COLUMN = "struct<name: string, kind: string>"


@dataclass
class InferredLoad:
    """Settings; ``run`` loads one set of envelopes.

    Messages without a file, with an empty one, with a column of truth values (which have no declared
    kind) or with a schema that is not the table's go to the dead letters with the reason, and the
    others are loaded; ``strict`` makes a schema that is not the table's an error before any row of
    the load is written.
    """

    spark: SparkSession
    targets: Targets = field(default_factory=lambda: Targets(create=True))
    exact_schema: bool = False
    """Refuse files with columns that the table does not have."""
    widen: bool = False
    """Accept columns of a lesser kind than the table's (INTEGER < FLOAT < STRING)."""
    strict: bool = False
    parallel_tables: int = 4
    urls_per_slice: int = 20_000

    def run(self, envelopes: DataFrame, load_id: str | None = None) -> str:
        """Loads and gives back the load id. Repeating a load id continues that load."""
        load_id = load_id or uuid.uuid4().hex
        folder = LoadFolder(self.spark, load_id)
        if folder.complete:
            return load_id
        messages = folder.store(
            located_messages(envelopes).withColumn("table", F.lower("destination")).fillna("", ["message_id"]), "messages"
        )
        fine = messages.filter(F.col("problem") == "")
        slices, problems = self._read(folder, fine)
        letters = [messages.filter(F.col("problem") != "")]
        if problems:
            found = self.spark.read.schema(PROBLEM_SCHEMA).parquet(folder.at("problems"))
            letters.append(problem_letters(fine, found))
        if slices:
            lines = self.spark.read.schema(_LINES).parquet(folder.at("lines")).drop("slice")
            bridge = self.spark.read.schema(_BRIDGE).parquet(folder.at("bridge")).drop("slice")
            headers = folder.store(self._headers(lines), "headers")
            judged = folder.store(self._judged(folder, lines, headers, bridge, fine), "judged")
            if self.strict:
                self._raise_mismatch(judged)
            letters.append(judged.filter(F.col("problem") != "").select(*fine.columns))
            self._write(folder, lines, headers, bridge, judged.filter(F.col("problem") == ""), load_id)
        folder.once("dead_letters", lambda: self._write_dead_letters(reduce(DataFrame.unionByName, letters), load_id))
        folder.finish(("messages", "settings", "listing", "problems", "lines", "bridge", "headers", "found", "judged"))
        return load_id

    # --- reading -----------------------------------------------------------------

    def _read(self, folder: LoadFolder, messages: DataFrame) -> tuple[int, bool]:
        """Stores the lines of all files once, and which message names which file."""
        slices = 0
        size = kept_slice_size(folder, self.urls_per_slice)
        found, problems = listed_slices(folder, messages, size)
        for number, part, urls in found:
            listing = list_slice(self.spark, folder, urls, number)
            if listing.has_problems:
                folder.store(listing.problems, f"problems/slice={number}")
                problems = True
            lines = numbered_lines(self.spark, listing).filter(F.col("line") != "")
            lines = lines.withColumn("fields", delimited_fields(F.col("line")))
            # The text of a line is needed again only where it is refused; its fields say the rest.
            folder.store(lines, f"lines/slice={number}")
            bridge, _ = listing.bridge(part.select("message_id", "message_ts", "fileURL", "destination"))
            folder.store(bridge.select("file_path", "message_id", "message_ts", "fileURL", "destination"), f"bridge/slice={number}")
            slices += 1
        return slices, problems

    @staticmethod
    def _headers(lines: DataFrame) -> DataFrame:
        """``file_path, first, header``: place and names of the first line of each file."""
        place = F.struct("split_start", "row")
        first = lines.groupBy("file_path").agg(F.min(place).alias("first"), F.min_by("fields", place).alias("fields"))
        return first.select("file_path", "first", header_names(F.col("fields")).alias("header"))

    @staticmethod
    def _data(lines: DataFrame, headers: DataFrame) -> DataFrame:
        """The lines after the header, with it beside them."""
        rows = attach(lines, headers, ["file_path"], salts=LINE_SALTS)
        return rows.filter(F.struct("split_start", "row") != F.col("first"))

    # --- judging -----------------------------------------------------------------

    def _facts(self, lines: DataFrame, headers: DataFrame) -> DataFrame:
        """``file_path, position, rank, truths`` of every column of every file, by one aggregate."""
        width = headers.agg(F.max(F.size("header"))).first()[0] or 0
        whole = self._data(lines, headers).filter(F.size("fields") == F.size("header"))
        facts = [f for i in range(width) for f in column_facts(F.get("fields", F.lit(i)), i)]
        if not facts:
            return self.spark.createDataFrame([], "file_path string, position int, rank int, truths boolean")
        found = whole.groupBy("file_path").agg(*facts)
        each = F.array(
            *[
                F.struct(F.lit(i).alias("position"), F.col(f"rank{i}").alias("rank"), F.col(f"truths{i}").alias("truths"))
                for i in range(width)
            ]
        )
        return found.select("file_path", F.inline(each))

    def _judged(
        self, folder: LoadFolder, lines: DataFrame, headers: DataFrame, bridge: DataFrame, messages: DataFrame
    ) -> DataFrame:
        """The messages with a file, with ``columns`` (name, kind) and the problem with them, if any."""
        facts = self._facts(lines, headers)
        named = headers.select("file_path", F.posexplode("header").alias("position", "name"))
        columns = named.join(facts, ["file_path", "position"], "left")
        # Files of one URL are one message's: the greater kind holds both, and the first file's order.
        key = ["message_id", "fileURL", "destination"]
        merged = (
            bridge.join(columns, "file_path", "left")
            .groupBy(*key, "name")
            .agg(
                F.max("rank").alias("rank"), F.bool_and("truths").alias("truths"),
                F.min(F.struct("file_path", "position")).alias("place"),
            )
        )
        named = F.struct("place", "name", kind_of_facts(F.col("rank")).alias("kind"))
        in_order = F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), named)))
        schema = merged.groupBy(*key).agg(
            F.transform(in_order, lambda c: F.struct(c["name"].alias("name"), c["kind"].alias("kind"))).alias("columns"),
            F.min(F.when(F.col("truths"), F.col("name"))).alias("truths"),
        )
        problem = F.when(F.size("columns") == 0, layouts.EMPTY_FILE).when(
            F.col("truths").isNotNull(), F.concat(F.lit(layouts.NO_KIND + ": "), "truths")
        )
        found = messages.join(schema, key).withColumn("problem", F.coalesce(problem, F.lit(""))).drop("truths")
        found = folder.store(found.select(*messages.columns, "columns"), "found")
        tables = self._tables(found, messages)
        fits = found.join(tables, "table", "left").withColumn("gaps", self._gaps())
        wrong = (F.col("problem") == "") & (F.col("gaps") != "")
        return fits.withColumn(
            "problem", F.when(wrong, F.concat(F.lit(layouts.SCHEMA_MISMATCH + ": "), "gaps")).otherwise(F.col("problem"))
        ).select(*messages.columns, "columns", "known", "gaps")

    def _tables(self, found: DataFrame, messages: DataFrame) -> DataFrame:
        """``table, known``: the columns of the tables that are there, and of the first good message of
        those that are not."""
        names = [r[0] for r in messages.select("table").distinct().collect()]
        there = []
        for name in names:
            if self.spark.catalog.tableExists(self.targets.result(name)):
                fields = [f for f in self.spark.table(self.targets.result(name)).schema.fields if f.name not in (LOAD_ID, STEP)]
                there.append((name, [(f.name, _kind_name(f.dataType)) for f in fields]))
        existing = self.spark.createDataFrame(there, f"table string, known array<{_COLUMN}>")
        first = F.min_by("columns", F.struct("message_ts", "message_id", "fileURL"))
        fresh = found.filter(F.col("problem") == "").groupBy("table").agg(first.alias("known"))
        return existing.unionByName(fresh.join(existing.select("table"), "table", "left_anti"))

    def _gaps(self) -> Column:
        """Why a file does not fit its table, ``""`` if it does: the order of columns is free, and
        columns the table lacks are no gap unless ``exact_schema``."""
        order = F.array(*[F.lit(k) for k in LATTICE])

        def gap(known: Column) -> Column:
            own = F.get(F.filter("columns", lambda c: c["name"] == known["name"]), F.lit(0))
            same = own["kind"] == known["kind"]
            if self.widen:
                same = F.array_position(order, own["kind"]) <= F.array_position(order, known["kind"])
            return (
                F.when(own.isNull(), F.concat(known["name"], F.lit(": not in the file")))
                .when(~same, F.concat(known["name"], F.lit(": "), own["kind"], F.lit(" in the file, "), known["kind"], F.lit(" in the table")))
                .otherwise("")
            )

        gaps = F.transform("known", gap)
        if self.exact_schema:
            names = F.transform("known", lambda k: k["name"])
            more = F.filter("columns", lambda c: ~F.array_contains(names, c["name"]))
            gaps = F.concat(gaps, F.transform(more, lambda c: F.concat(c["name"], F.lit(": not in the table"))))
        return F.array_join(F.filter(gaps, lambda g: g != ""), "; ")

    def _raise_mismatch(self, judged: DataFrame) -> None:
        wrong = judged.filter(F.startswith("problem", F.lit(layouts.SCHEMA_MISMATCH))).limit(1).collect()
        if wrong:
            raise SchemaMismatch(f"{self.targets.result(wrong[0]['table'])}: {wrong[0]['gaps']}")

    # --- writing -----------------------------------------------------------------

    def _write(
        self, folder: LoadFolder, lines: DataFrame, headers: DataFrame, bridge: DataFrame, good: DataFrame, load_id: str
    ) -> None:
        """One append of rows and one of rejects per table."""
        key = ["message_id", "fileURL", "destination"]
        named = bridge.join(good.select(*key, "table", "known"), key).join(headers, "file_path")
        # As many rows as there are tables and different headers among their files.
        pairs, known = {}, {}
        for row in named.select("table", "known", "header").distinct().collect():
            pairs.setdefault(row["table"], []).append(row["header"])
            known[row["table"]] = row["known"]
        named = named.drop("known")
        data = attach(lines, named, ["file_path"], salts=LINE_SALTS).filter(F.struct("split_start", "row") != F.col("first"))

        def write(name: str) -> None:
            rows = data.filter(F.col("table") == name)
            folder.once(f"rows-{name}", lambda: self._write_rows(rows, name, pairs[name], known[name], load_id))
            folder.once(f"rejects-{name}", lambda: self._write_rejects(rows, name, load_id))

        with ThreadPoolExecutor(self.parallel_tables) as pool:
            list(pool.map(write, known))

    def _write_rows(self, data: DataFrame, name: str, headers: list, known: list, load_id: str) -> None:
        schema = T.StructType([T.StructField(c["name"], SPARK_TYPES[c["kind"]]) for c in known])
        whole = data.filter(F.size("fields") == F.size("header"))
        parts = []
        for header in headers:
            same = F.col("header") == F.array(*[F.lit(h) for h in header])
            values = [
                value_of(F.get("fields", F.lit(header.index(c["name"]))), c["kind"]).alias(c["name"])
                if c["name"] in header
                else F.lit(None).cast(SPARK_TYPES[c["kind"]]).alias(c["name"])
                for c in known
            ]
            parts.append(whole.filter(same).select(*values))
        rows = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)
        self.targets.append(rows, self.targets.result(name), schema, load_id, "rows")

    def _write_rejects(self, data: DataFrame, name: str, load_id: str) -> None:
        refused = data.filter(F.size("fields") != F.size("header")).select(
            "message_ts",
            F.lit(layouts.WRONG_FIELD_COUNT).alias("stacktrace"),
            base_name(F.col("fileURL")).alias("source_file"),
            "line",
            "destination",
        )
        if not refused.isEmpty():
            records = conform(reject_records(refused), REJECT_SCHEMA)
            self.targets.append(records, self.targets.reject(name), REJECT_SCHEMA, load_id, "rejects")

    def _write_dead_letters(self, messages: DataFrame, load_id: str) -> None:
        letters = conform(dead_letters(messages), DEAD_LETTER_SCHEMA)
        if not letters.isEmpty():
            self.targets.append(letters, self.targets.dead_letters, DEAD_LETTER_SCHEMA, load_id, "dead_letters")


def _kind_name(data_type: T.DataType) -> str:
    """The kind of a table's column; other types are named as they are and fit no file."""
    try:
        return kind_of(data_type)
    except ValueError:
        return data_type.simpleString()
