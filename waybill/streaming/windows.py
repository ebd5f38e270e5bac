"""Counts in tumbling event-time windows, on tables and on streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.storage import SharedFiles
from waybill.streaming.counts import CountStore
from waybill.streaming.loader import _trigger

WINDOW = "1 second"


def windowed_counts(
    df: DataFrame,
    time: str,
    keys: Sequence[str] = (),
    window: str = WINDOW,
    lateness: str = "0 seconds",
    count: str = "n",
) -> DataFrame:
    """``window_start, <keys>, n``. On a stream, rows later than ``lateness`` are dropped
    and a window's state goes when it can get no more rows."""
    if df.isStreaming:
        df = df.withWatermark(time, lateness)
    counted = df.groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias(count))
    return counted.select(F.col("w.start").alias("window_start"), *keys, count)


def start_windowed_counts(
    counts: DataFrame,
    folder: str,
    checkpoint: str,
    name: str,
    every: str | None = None,
    window: str = WINDOW,
    lateness: str = "0 seconds",
) -> StreamingQuery:
    """Runs ``windowed_counts`` of a stream in update mode; ``window`` and ``lateness`` are its own.

    Each micro-batch leaves the counts it changed, which a repeated batch overwrites. So the last
    window is there too at the end of the input, where append mode would wait for later rows to close
    it. Windows that are closed are put together (see ``counts``).
    """
    keys = tuple(c for c in counts.columns if c not in ("window_start", "n"))

    def on_batch(batch: DataFrame, number: int) -> None:
        CountStore(batch.sparkSession, folder, keys, window, lateness).write(batch, number)

    writer = counts.writeStream.outputMode("update").queryName(name).option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(on_batch), every).start()


def latest_counts(spark: SparkSession, folder: str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest count of every window written by ``start_windowed_counts``."""
    return CountStore(spark, folder, tuple(keys)).read()


# --- late rows kept ----------------------------------------------------------------------


def start_counts_with_late_rows(
    rows: DataFrame,
    time: str,
    folder: str,
    checkpoint: str,
    name: str,
    keys: Sequence[str] = (),
    window: str = WINDOW,
    lateness: str = "0 seconds",
    every: str | None = None,
) -> StreamingQuery:
    """Counts a stream by window and keeps the rows that come too late for theirs.

    The watermark of a batch is the greatest time of the batches before it less ``lateness``; a row
    whose window ends at or before it is late (Spark's own filter lags one batch behind that). Late rows, with all their
    columns, go to ``folder/late`` instead of being dropped: counted and late rows together are the
    rows of the stream. Each batch is counted for itself, so there is no state but the watermark, which
    is stored with the batch; a repeated batch overwrites what it wrote.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        spark, files = batch.sparkSession, SharedFiles(batch.sparkSession)
        before = _seen(spark, files, folder, number)
        ends = F.window(time, window)["end"]
        late = F.lit(False) if before is None else F.coalesce(ends <= F.lit(before) - F.expr(f"INTERVAL {lateness}"), F.lit(False))
        found = (
            batch.groupBy(F.window(time, window)["start"].alias("window_start"), *keys, late.alias("late"))
            .agg(F.count("*").alias("n"), F.max(time).alias("newest"))
        )
        path = f"{folder}/found/batch={number}"
        found.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(found.schema).parquet(path)
        if before is not None and not stored.filter("late").isEmpty():
            batch.filter(late).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        counts = stored.filter("NOT late").select("window_start", *keys, "n")
        CountStore(spark, f"{folder}/counts", tuple(keys), window, lateness, "sum").write(counts, number)
        # What the next batch needs: the greatest time so far.
        seen = stored.agg(F.max("newest").alias("newest"))
        seen.select(F.greatest("newest", F.lit(before).cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(
            f"{folder}/watermarks/batch={number}"
        )
        if number:
            files.remove(f"{folder}/found/batch={number - 1}")
            files.remove(f"{folder}/watermarks/batch={number - 2}")

    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(on_batch), every).start()


def _seen(spark: SparkSession, files: SharedFiles, folder: str, number: int):
    path = f"{folder}/watermarks/batch={number - 1}"
    return spark.read.parquet(path).first()[0] if files.exists(f"{path}/_SUCCESS") else None


def counts_in_time(
    spark: SparkSession, folder: str, keys: Sequence[str] = (), window: str = WINDOW, lateness: str = "0 seconds"
) -> DataFrame:
    """The counts written by ``start_counts_with_late_rows``."""
    return CountStore(spark, f"{folder}/counts", tuple(keys), window, lateness, "sum").read()


def late_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows that ``start_counts_with_late_rows`` found late; ``schema`` is the stream's."""
    if not SharedFiles(spark).any(f"{folder}/late/batch=*/_SUCCESS"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/late/batch=*")


# --- two streams -------------------------------------------------------------------------


def windowed_cogroup(
    valid: DataFrame,
    rejected: DataFrame,
    time: str,
    keys: Sequence[str] = (),
    window: str = WINDOW,
    lateness: str = "0 seconds",
) -> DataFrame:
    """``window_start, <keys>, number_inserted_rows, number_rejected_rows``: valid and rejected rows
    counted apart and brought together per window; a window that one side lacks counts 0 there.

    On streams both counts are closed by the watermark, and the full outer join of the two frees its
    state with it: a window comes out once, when neither side can get more rows.
    """

    def counted(rows: DataFrame, count: str, prefix: str) -> DataFrame:
        if rows.isStreaming:
            rows = rows.withWatermark(time, lateness)
        named = [F.col(k).alias(prefix + k) for k in keys]
        counts = rows.groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias(count))
        return counts.select(F.col("w").alias(f"{prefix}w"), *named, count)

    inserted, refused = counted(valid, "number_inserted_rows", "v_"), counted(rejected, "number_rejected_rows", "r_")
    same = F.col("v_w") == F.col("r_w")
    for k in keys:
        same &= F.col(f"v_{k}") == F.col(f"r_{k}")
    zero = F.lit(0).cast("bigint")
    return inserted.join(refused, same, "full_outer").select(
        F.coalesce("v_w.start", "r_w.start").alias("window_start"),
        *[F.coalesce(f"v_{k}", f"r_{k}").alias(k) for k in keys],
        F.coalesce("number_inserted_rows", zero).alias("number_inserted_rows"),
        F.coalesce("number_rejected_rows", zero).alias("number_rejected_rows"),
    )


def start_appended(rows: DataFrame, folder: str, checkpoint: str, name: str, every: str | None = None) -> StreamingQuery:
    """Writes a stream in append mode, each batch to a folder of its own that a repeat overwrites."""

    def on_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = rows.writeStream.outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(on_batch), every).start()
