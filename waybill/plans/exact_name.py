"""Loads by message with layouts found by the exact file name.

The lines of a file are joined with the message that names it, by path, and the message
chooses the table. Fields are text until the table's types are known; a value that does
not fit its column fails the load.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.text import base_name
from waybill.layouts import DEAD_LETTER_SCHEMA, DEFAULT_EXACT_NAME, EXACT_NAME_LAYOUTS
from waybill.operators.joins import LINE_SALTS, attach
from waybill.operators.lines import named_fields
from waybill.operators.messages import with_problem, with_text_time
from waybill.operators.outputs import conform, dead_letters
from waybill.operators.tables import LoadFolder, Targets
from waybill.plans.load import kept_slice_size, list_slice, listed_slices, problem_letters
from waybill.sources.files import read_lines
from waybill.sources.listing import PROBLEM_SCHEMA

_STORED = "message_id string, file_name string, line string, slice int, destination string, file_layout string"
_MESSAGE = ("message_id", "message_ts", "message", "fileURL", "destination", "problem")


def complete_messages(messages: DataFrame) -> DataFrame:
    """Messages with all columns that dead letters tell, whatever the caller gave beside URL and
    destination."""
    if "message_ts" not in messages.columns:
        messages = messages.withColumn("message_ts", F.lit(None).cast("string"))
    return with_text_time(with_problem(messages)).select(*_MESSAGE)


@dataclass
class ExactNameLoad:
    """Settings; ``run`` loads one set of messages.

    A message that does not parse, and one whose URL has no file, goes to the dead letters; the
    others are loaded all the same.
    """

    spark: SparkSession
    targets: Targets = field(default_factory=lambda: Targets(create=True))
    by_name: dict[str, T.StructType] = field(default_factory=lambda: dict(EXACT_NAME_LAYOUTS))
    default: str = DEFAULT_EXACT_NAME
    skip_header_lines: int = 1
    urls_per_slice: int = 20_000
    """URLs whose files are listed and scanned in one go; a load keeps the number it began with."""

    def run(self, messages: DataFrame, load_id: str | None = None) -> str:
        """``messages``: ``message_id, fileURL, destination``, or those of ``located_messages``.
        Repeating a load id continues that load."""
        load_id = load_id or uuid.uuid4().hex
        folder = LoadFolder(self.spark, load_id)
        if folder.complete:
            return load_id
        stored = folder.store(complete_messages(messages), "messages")
        size = kept_slice_size(folder, self.urls_per_slice)
        slices = 0
        found, problems = listed_slices(folder, stored.filter(F.col("problem") == ""), size)
        for number, part, urls in found:
            listing = list_slice(self.spark, folder, urls, number)
            if listing.has_problems:
                folder.store(listing.problems, f"problems/slice={number}")
                problems = True
            if not folder.stored(f"lines/slice={number}"):
                folder.store(self._lines(part, listing), f"lines/slice={number}", ("destination", "file_layout"))
            slices += 1
        folder.once("dead_letters", lambda: self._write_dead_letters(folder, stored, load_id, problems))
        if slices:
            self._write_rows(folder, load_id)
        folder.finish(("messages", "settings", "listing", "problems", "lines"))
        return load_id

    def _write_rows(self, folder: LoadFolder, load_id: str) -> None:
        lines = self.spark.read.schema(_STORED).parquet(folder.at("lines"))
        for destination, name in lines.select("destination", "file_layout").distinct().toLocalIterator():
            part = lines.filter((F.col("destination") == destination) & (F.col("file_layout") == name))
            rows = named_fields(part.select("file_name", "line"), F.lit(name), self.by_name, self.default, name)
            table, schema, step = self.targets.result(destination), self.by_name[name], f"rows-{destination}-{name}"
            folder.once(
                step,
                lambda rows=rows, table=table, schema=schema, step=step: self.targets.append(rows, table, schema, load_id, step),
            )

    def _write_dead_letters(self, folder: LoadFolder, messages: DataFrame, load_id: str, problems: bool) -> None:
        letters = messages.filter(F.col("problem") != "")
        if problems:
            found = self.spark.read.schema(PROBLEM_SCHEMA).parquet(folder.at("problems"))
            letters = letters.unionByName(problem_letters(messages.filter(F.col("problem") == ""), found))
        letters = conform(dead_letters(letters), DEAD_LETTER_SCHEMA)
        if problems or not letters.isEmpty():
            self.targets.append(letters, self.targets.dead_letters, DEAD_LETTER_SCHEMA, load_id, "dead_letters")

    def _lines(self, messages: DataFrame, listing) -> DataFrame:
        bridge, size = listing.bridge(messages)
        name, names = base_name(F.col("fileURL")), F.array(*[F.lit(n) for n in self.by_name])
        bridge = bridge.select(
            "file_path",
            "message_id",
            "destination",
            name.alias("file_name"),
            F.when(F.array_contains(names, name), name).otherwise(self.default).alias("file_layout"),
        )
        lines = read_lines(self.spark, listing, self.skip_header_lines)
        return attach(lines, bridge, ["file_path"], size=size, salts=LINE_SALTS).drop("file_path")
