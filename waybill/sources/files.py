"""Reading the lines of listed files.

Files are listed before anything is read (see ``listing``): a single missing path would fail a whole
Spark read, and a path given twice would be read twice.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from waybill.functions.text import identifier, strip_carriage_return
from waybill.layouts import DEFAULT_ENCODING
from waybill.operators.joins import attach
from waybill.sources.listing import Listing, MatchedFile, Scan, file_sizes, list_files, listing_of, listing_session, match_files
from waybill.storage import stored

__all__ = ["Listing", "file_sizes", "list_files", "match_files", "read_lines", "read_paths", "read_text_file"]

# More small files than this are packed into shared tasks.
FEW_FILES = 64
SPREAD_BYTES = 64 * 1024 * 1024
UNPACKED = 4
"""Unpacked bytes per compressed byte, for choosing a number of tasks."""

OPEN_WRITERS = 16

_ROW_BITS = 33  # monotonically_increasing_id(): row number within the task


def _literal(path: str) -> str:
    """The path with glob characters escaped: matching is over."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _scan_session(spark: SparkSession, split_per_task: bool) -> SparkSession:
    """A session for file scans, like the caller's but for the settings made here.

    A scan's settings are those of the session that made its reader, so the caller's
    session is left alone.
    """
    session = listing_session(spark)
    # Writes that split their rows over a few folders need no sort for it.
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_WRITERS))
    if split_per_task:
        # A file counts as a full task before its own length is added: nothing is packed.
        split = session.conf.get("spark.sql.files.maxPartitionBytes")
        session.conf.set("spark.sql.files.openCostInBytes", split)
        session.conf.set("spark.sql.files.maxPartitionNum", str(2**31 - 1))
    return session


def _text(session: SparkSession, scan: Scan, encoding: str, **options) -> DataFrame:
    # Paths that Spark has listed stay in the JVM.
    paths = scan.paths if not isinstance(scan.paths, list) else session.sparkContext._jvm.PythonUtils.toSeq(
        [_literal(p) for p in scan.paths]
    )
    frame = DataFrame(session.read.options(**options)._jreader.text(paths), session)
    # The reader gives the bytes of a line as they are.
    value = F.col("value") if encoding == DEFAULT_ENCODING else F.decode(F.col("value").cast("binary"), encoding.upper())
    return frame.select(F.col("_metadata.file_path").alias("file_path"), value.alias("value"), "_metadata")


def _packed_lines(spark: SparkSession, scan: Scan, skip: int, encoding: str) -> DataFrame:
    """Lines of small files, each read as one value so that many of them share a task."""
    lines = F.split("value", "\n")
    # What follows the last line end is a line only if there is something.
    ends = F.endswith("value", F.lit("\n")) | (F.col("value") == "")
    n = F.size(lines) - ends.cast("int") - skip
    data = F.slice(lines, F.lit(skip + 1), F.greatest(n, F.lit(0)))
    return _text(_scan_session(spark, False), scan, encoding, wholetext=True).select("file_path", F.explode(data).alias("value"))


def _split_bytes(spark: SparkSession) -> int:
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split)


def _line_counts(rows: DataFrame, most: int) -> DataFrame:
    """``file_path, split_start, lines`` of every split, counted up to ``most``: no task reads further
    than it must."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = start = None
        lines = 0
        for batch in batches:
            if batch.num_rows:
                path, start = batch.column("file_path")[0].as_py(), batch.column("split_start")[0].as_py()
                lines += batch.num_rows
            if lines >= most:
                break
        if path is not None:
            yield pa.RecordBatch.from_pydict({"file_path": [path], "split_start": [start], "lines": [min(lines, most)]})

    return rows.select("file_path", "split_start").mapInArrow(count, "file_path string, split_start long, lines long")


def _split_lines(spark: SparkSession, scan: Scan, skip: int, encoding: str) -> DataFrame:
    """Lines of files read in splits."""
    if skip == 0:
        return _text(_scan_session(spark, False), scan, encoding, lineSep="\n").select("file_path", "value")
    session = _scan_session(spark, True)
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = _text(session, scan, encoding, lineSep="\n").select(
        "file_path", "value", F.col("_metadata.file_block_start").alias("split_start"), row_in_task.alias("_row")
    )
    if skip == 1 or scan.kind == "packed" or scan.longest <= _split_bytes(session):
        # The first line belongs to the first split, however long it is.
        return rows.filter((F.col("split_start") > 0) | (F.col("_row") >= skip)).select("file_path", "value")
    # Lines of the splits before this one; only where the header reaches beyond the first split are
    # there splits that begin with some of it left.
    counts = _line_counts(rows, skip)
    earlier = Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    left = counts.withColumn("left", F.lit(skip) - F.coalesce(F.sum("lines").over(earlier), F.lit(0))).filter("left > 0")
    headed = attach(rows, stored(left.select("file_path", "split_start", "left"), "header-splits"), ["file_path", "split_start"], "left")
    return headed.filter(F.col("left").isNull() | (F.col("_row") >= F.col("left"))).select("file_path", "value")


def _spread(spark: SparkSession, lines: DataFrame, scan: Scan) -> DataFrame:
    """Lines of compressed files over as many tasks as their unpacked bytes deserve."""
    return lines.repartition(max(2, math.ceil(scan.bytes * UNPACKED / _split_bytes(spark))))


def read_lines(
    spark: SparkSession,
    files: Listing | Iterable[MatchedFile],
    skip_header_lines: int = 1,
    encoding: str = DEFAULT_ENCODING,
) -> DataFrame:
    """``file_path, line`` of every data line; blank lines are lines.

    Every file is read once, however often it was matched. Lines end at ``\\n`` or
    ``\\r\\n``. Compressed files are recognised by their extension and read as one split;
    the lines of big ones are spread over more tasks afterwards.

    The first ``skip_header_lines`` lines of *each file* are dropped in the same scan, without a
    shuffle: with one split per task, the row number within the task is the line number within the
    split. One header line stands in the first split. Where more of them are to be skipped from files
    of several splits, the splits' lines are counted first, up to the header's length, so that a
    header that goes on in the next split is skipped there too. Small files, of which there may be
    very many, are packed into tasks instead.
    """
    listing = files if isinstance(files, Listing) else listing_of(spark, list(files))
    skip, parts = max(skip_header_lines, 0), []
    for scan in listing.scans:
        if scan.kind == "small" and scan.files > FEW_FILES:
            parts.append(_packed_lines(spark, scan, skip, encoding))
        elif scan.kind == "packed" and scan.longest >= SPREAD_BYTES:
            parts.append(_spread(spark, _split_lines(spark, scan, skip, encoding), scan))
        else:
            parts.append(_split_lines(spark, scan, skip, encoding))
    if not parts:
        return spark.createDataFrame([], "file_path string, line string")
    lines = reduce(DataFrame.unionByName, parts)
    return lines.select("file_path", strip_carriage_return(F.col("value")).alias("line"))


def numbered_lines(spark: SparkSession, listing: Listing) -> DataFrame:
    """``file_path, split_start, row, line``: all lines with their place in the file."""
    parts = []
    for scan in listing.scans:
        if scan.kind == "small" and scan.files > FEW_FILES:
            whole = _text(_scan_session(spark, False), scan, DEFAULT_ENCODING, wholetext=True)
            rows = whole.select("file_path", F.posexplode(F.split("value", "\n")).alias("row", "value"))
            parts.append(rows.select("file_path", F.lit(0).cast("long").alias("split_start"), F.col("row").cast("long").alias("row"), "value"))
        else:
            row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
            lines = _text(_scan_session(spark, True), scan, DEFAULT_ENCODING, lineSep="\n")
            parts.append(lines.select("file_path", F.col("_metadata.file_block_start").alias("split_start"), row.alias("row"), "value"))
    if not parts:
        return spark.createDataFrame([], "file_path string, split_start long, row long, line string")
    lines = reduce(DataFrame.unionByName, parts)
    return lines.select("file_path", "split_start", "row", strip_carriage_return(F.col("value")).alias("line"))


def read_text_file(spark: SparkSession, url: str, skip_header_lines: int = 1) -> DataFrame:
    """``file_path, line`` of one file, glob or folder; no match is an error."""
    listing = list_files(spark, [Row(fileURL=url)])
    if listing.empty:
        raise FileNotFoundError(url)
    return read_lines(spark, listing, skip_header_lines)


def read_paths(spark: SparkSession, urls: DataFrame, skip_header_lines: int = 1) -> DataFrame:
    """``file_path, line`` of every file named in the first column of a frame."""
    named = urls.select(F.col(identifier(urls.columns[0])).alias("fileURL")).distinct()
    return read_lines(spark, list_files(spark, named), skip_header_lines)
