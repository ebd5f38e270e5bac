"""The load: messages name files, their lines end up in result and reject tables.

Batch and stream run the same plan. Each file is scanned once: the judged lines are
stored as parquet in the shared folder, split by destination and outcome, and the valid
rows, the rejects and the counts are read from there (the counts read two columns). That
store is also what a repeated load continues from, and it does not depend on any executor
staying alive.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import layouts
from waybill.layouts import DEAD_LETTER_SCHEMA, DEFAULT_REGISTRY, MONITORING_SCHEMA, REJECT_SCHEMA, Registry
from waybill.operators.joins import attach
from waybill.operators.lines import attach_messages, judge_lines, typed_columns
from waybill.operators.messages import messages_frame, prepare_messages
from waybill.operators.outputs import (
    MESSAGE_KEY,
    apply_bad_row_limit,
    as_monitoring,
    as_rejects,
    conform,
    count_lines,
    dead_letters,
    end_records,
    files_over_limit,
    start_records,
)
from waybill.operators.tables import LoadFolder, Targets
from waybill.sources.files import read_lines
from waybill.sources.listing import FEW_URLS, PROBLEM_SCHEMA, Listing, list_files, missing_urls

VALID, REJECTED = "valid", "rejected"

_STORED_LINES = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("message_id", "message_ts", "source_file", "layout", "line", "stacktrace")
    ]
    + [
        T.StructField("slice", T.IntegerType()),
        T.StructField("destination", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)


def url_slices(messages: DataFrame, urls_per_slice: int) -> Iterator[tuple[int, DataFrame, DataFrame | list[Row]]]:
    """Messages by slices of their URLs, so that a bounded number is listed at a time: slice number,
    its messages, and ``fileURL, rows, bytes`` per URL of the slice (as rows if there are few).

    All messages of a URL are in one slice. ``messages`` should be a stored frame.
    """
    row = F.octet_length(F.to_json(F.struct("*")))
    sized = messages.select("fileURL", row.alias("row"))
    urls = sized.groupBy("fileURL").agg(F.count("*").alias("rows"), F.sum("row").alias("bytes"))
    few = min(FEW_URLS, urls_per_slice)
    some = urls.limit(few + 1).collect()
    if len(some) <= few:
        if some:
            yield 0, messages, some
        return
    slices = math.ceil(urls.count() / urls_per_slice)
    for number in range(slices):
        own = F.pmod(F.xxhash64("fileURL"), F.lit(slices)) == number
        yield number, messages.filter(own), urls.filter(own)


def listed_slices(
    folder: LoadFolder, messages: DataFrame, urls_per_slice: int, part: int = 0
) -> tuple[Iterator[tuple[int, DataFrame, DataFrame | list[Row]]], bool]:
    """``url_slices``, and whether URLs without a file were left out. Each slice costs some jobs, so where there
    would be several, URLs whose folders or neighbours aren't there are found for all slices at once and
    stored as problems; ``part`` tells several sets of messages of a load apart."""
    if messages.select("fileURL").distinct().limit(urls_per_slice + 1).count() <= urls_per_slice:
        return url_slices(messages, urls_per_slice), False
    spark = messages.sparkSession
    name = f"problems/slice={-1 - part}"
    if folder.stored(name):
        missing = spark.read.schema(PROBLEM_SCHEMA).parquet(folder.at(name))
    else:
        found = missing_urls(spark, messages.select("fileURL"), lambda frame, label: folder.store(frame, f"listing/part={part}/{label}"))
        missing = folder.store(found, name)
    if missing.isEmpty():
        return url_slices(messages, urls_per_slice), True
    left = folder.store(messages.join(missing.select("fileURL"), "fileURL", "left_anti").select(*messages.columns), f"listing/part={part}/possible")
    return (iter([(0, left, [])]) if left.isEmpty() else url_slices(left, urls_per_slice)), True


def kept_slice_size(folder: LoadFolder, urls_per_slice: int) -> int:
    """The slice size a load began with, whatever the settings of the run that continues it."""
    path = folder.at("settings")
    if not folder.files.exists(path):
        folder.files.write_text(path, str(urls_per_slice))
    return int(folder.files.text(path) or urls_per_slice)


def list_slice(spark: SparkSession, folder: LoadFolder, urls: DataFrame | list[Row], number: int) -> Listing:
    """The files of a slice's URLs; what Spark has to list for it is stored with the load."""
    return list_files(spark, urls, lambda frame, name: folder.store(frame, f"listing/slice={number}/{name}"))


def problem_letters(messages: DataFrame, problems: DataFrame) -> DataFrame:
    """Messages whose URL has a problem, with that problem instead of theirs."""
    found = problems.select("fileURL", "problem")
    return attach(messages.drop("problem"), found, ["fileURL"]).select(*messages.columns)


def judged_lines(
    spark: SparkSession,
    messages: DataFrame,
    registry: Registry = DEFAULT_REGISTRY,
    skip_header_lines: int = 1,
    on_cast_error: str = "reject",
) -> DataFrame:
    """The lines of all files of a set of messages, judged; nothing is written.

    For looking at data. Messages with a problem and URLs without a file give no lines.
    """
    ready = prepare_messages(messages, registry).filter(F.col("problem") == "")
    listing = list_files(spark, ready.select("fileURL").distinct())
    bridge = attach(ready, listing.matches.select("fileURL", "file_path"), ["fileURL"])
    lines = read_lines(spark, listing, skip_header_lines)
    return judge_lines(attach_messages(lines, bridge), registry, on_cast_error)


@dataclass
class FileLoad:
    """Settings of a load; ``run`` loads one set of messages."""

    spark: SparkSession
    targets: Targets = field(default_factory=Targets)
    registry: Registry = DEFAULT_REGISTRY
    skip_header_lines: int = 1
    on_cast_error: str = "reject"
    limit_bad_rows: bool = False
    """Reject all lines of files with more bad rows than their layout allows."""
    emit_empty_end: bool = False
    """Write an end record for files without data lines as well."""
    urls_per_slice: int = 20_000
    """URLs whose files are listed and scanned in one go; a load keeps the number it began with."""
    parallel_writes: int = 8
    keep_stored_frames: bool = False

    def run(self, messages: DataFrame, load_id: str | None = None) -> str:
        """Loads and gives back the load id. Repeating a load id continues that load."""
        load_id = load_id or uuid.uuid4().hex
        folder = LoadFolder(self.spark, load_id)
        if folder.complete:
            return load_id
        stored = folder.store(prepare_messages(messages, self.registry), "messages")
        with ThreadPoolExecutor(self.parallel_writes) as pool:
            start = pool.submit(folder.once, "start", lambda: self._write_starts(stored, load_id))
            slices, problems = self._store_lines(folder, stored.filter(F.col("problem") == ""))
            start.result()
            steps = self._steps(folder, stored, load_id, slices, problems)
            for done in [pool.submit(folder.once, step, action) for step, action in steps.items()]:
                done.result()
            if slices:
                folder.once("end", lambda: self._write_ends(folder, stored, load_id))
        folder.finish(() if self.keep_stored_frames else ("messages", "settings", "listing", "problems", "lines", "over_limit"))
        return load_id

    # --- reading -----------------------------------------------------------------

    def _store_lines(self, folder: LoadFolder, messages: DataFrame) -> tuple[int, bool]:
        """Reads all files, a bounded number of URLs at a time, into the judged store.
        Gives back the number of slices and whether some URL has a problem."""
        slices, problems = 0, False
        size = kept_slice_size(folder, self.urls_per_slice)
        for number, (encoding, part) in enumerate(self._by_encoding(messages)):
            found, lost = listed_slices(folder, part, size, number)
            problems |= lost
            for _, own, urls in found:
                problems |= self._store_slice(folder, own, urls, slices, encoding)
                slices += 1
        return slices, problems

    def _by_encoding(self, messages: DataFrame) -> Iterator[tuple[str, DataFrame]]:
        """Messages by the encoding of their files."""
        encodings: dict[str, list[str]] = {}
        for layout in self.registry.sources:
            encodings.setdefault(layout.encoding, []).append(layout.prefix)
        for encoding, prefixes in encodings.items():
            yield encoding, messages if len(encodings) == 1 else messages.filter(F.col("layout").isin(prefixes))

    def _store_slice(self, folder: LoadFolder, messages: DataFrame, urls: DataFrame | list[Row], number: int, encoding: str) -> bool:
        listing = list_slice(self.spark, folder, urls, number)
        if listing.has_problems:
            folder.store(listing.problems, f"problems/slice={number}")
        if not folder.stored(f"lines/slice={number}"):
            bridge, size = listing.bridge(messages)
            lines = read_lines(self.spark, listing, self.skip_header_lines, encoding)
            lines = attach_messages(lines, bridge, size)
            judged = judge_lines(lines, self.registry, self.on_cast_error)
            outcome = F.when(F.col("stacktrace") == "", VALID).otherwise(REJECTED)
            folder.store(
                judged.withColumn("outcome", outcome),
                f"lines/slice={number}",
                ("destination", "outcome"),
                # Lines hardly repeat: a dictionary of them would be built in vain.
                {"parquet.enable.dictionary#line": "false"},
            )
        return listing.has_problems

    # --- writing -----------------------------------------------------------------

    def _append(self, df: DataFrame, table: str, schema: T.StructType, load_id: str, step: str) -> None:
        self.targets.append(df, table, schema, load_id, step)

    def _write_starts(self, messages: DataFrame, load_id: str) -> None:
        well_formed = messages.filter(F.col("problem") != layouts.INVALID_MESSAGE)
        records = well_formed.transform(start_records).transform(as_monitoring)
        self._append(records, self.targets.monitoring, MONITORING_SCHEMA, load_id, "start")

    def _steps(
        self, folder: LoadFolder, messages: DataFrame, load_id: str, slices: int, problems: bool
    ) -> dict[str, Callable[[], None]]:
        """The appends that can run side by side, by name."""
        steps = {"dead_letters": lambda: self._write_dead_letters(folder, messages, load_id, problems)}
        if slices:
            lines = self._lines(folder)
            names = messages.filter(F.col("problem") == "").select("destination").distinct()
            # Destinations are names of registry tables, so there are few.
            for name in [row[0] for row in names.collect()]:
                steps[f"results-{name}"] = self._result_step(folder, lines, name, load_id)
                steps[f"rejects-{name}"] = self._reject_step(folder, lines, name, load_id)
        return steps

    def _lines(self, folder: LoadFolder) -> DataFrame:
        lines = self.spark.read.schema(_STORED_LINES).parquet(folder.at("lines"))
        return self._limited(folder, lines) if self.limit_bad_rows else lines

    def _limited(self, folder: LoadFolder, lines: DataFrame) -> DataFrame:
        rejected = lines.filter(F.col("outcome") == REJECTED)
        return apply_bad_row_limit(lines, folder.store(files_over_limit(rejected, self.registry), "over_limit"))

    def _has_stored(self, folder: LoadFolder, destination: str, outcome: str) -> bool:
        return bool(folder.files.glob(folder.at(f"lines/slice=*/destination={destination}/outcome={outcome}")))

    def _result_step(self, folder: LoadFolder, lines: DataFrame, name: str, load_id: str):
        def write() -> None:
            if not self._has_stored(folder, name, VALID):
                return
            valid = lines.filter((F.col("destination") == name) & (F.col("outcome") == VALID))
            schema = self.registry.table_schema(name)
            typed = typed_columns(valid.filter(F.col("stacktrace") == ""), schema, self.registry)
            self._append(typed, self.targets.result(name), schema, load_id, "results")

        return write

    def _reject_step(self, folder: LoadFolder, lines: DataFrame, name: str, load_id: str):
        def write() -> None:
            rejected = lines.filter((F.col("destination") == name) & (F.col("stacktrace") != ""))
            if not self.limit_bad_rows:
                if not self._has_stored(folder, name, REJECTED):
                    return
                rejected = rejected.filter(F.col("outcome") == REJECTED)
            self._append(as_rejects(rejected), self.targets.reject(name), REJECT_SCHEMA, load_id, "rejects")

        return write

    def _write_ends(self, folder: LoadFolder, messages: DataFrame, load_id: str) -> None:
        # Reads the message key and the reason; the text of the lines stays unread.
        counts = count_lines(self._lines(folder))
        if self.emit_empty_end:
            loaded = messages.filter(F.col("problem") == "").select(*MESSAGE_KEY).distinct()
            zero = F.lit(0).cast("bigint")
            same = F.lit(True)
            for name in MESSAGE_KEY:
                same = same & loaded[name].eqNullSafe(counts[name])
            counts = loaded.join(counts, same, "left").select(
                *[loaded[name] for name in MESSAGE_KEY],
                F.coalesce("number_inserted_rows", zero).alias("number_inserted_rows"),
                F.coalesce("number_rejected_rows", zero).alias("number_rejected_rows"),
            )
        self._append(as_monitoring(end_records(counts)), self.targets.monitoring, MONITORING_SCHEMA, load_id, "end")

    def _write_dead_letters(self, folder: LoadFolder, messages: DataFrame, load_id: str, problems: bool) -> None:
        letters = messages.filter(F.col("problem") != "")
        if problems:
            found = self.spark.read.schema(PROBLEM_SCHEMA).parquet(folder.at("problems"))
            lost = problem_letters(messages.filter(F.col("problem") == ""), found)
            letters = letters.unionByName(lost)
        letters = conform(dead_letters(letters), DEAD_LETTER_SCHEMA)
        if problems or not letters.isEmpty():
            self._append(letters, self.targets.dead_letters, DEAD_LETTER_SCHEMA, load_id, "dead_letters")


def load_file(
    spark: SparkSession,
    url: str,
    destination: str,
    timestamp: str,
    message_id: str,
    partition_depth=None,
    partition_key: str | None = None,
    **settings,
) -> str:
    """Batch load of one file, glob or folder; ``settings`` are those of ``FileLoad``."""
    message = {
        "fileURL": url,
        "destination": destination,
        "timestamp": timestamp,
        "id": message_id,
        "partition_depth": partition_depth,
        "partition_key": partition_key,
    }
    return FileLoad(spark, **settings).run(messages_frame(spark, [message]))
