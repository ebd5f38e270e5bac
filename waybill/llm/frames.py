"""What the operators share: named inputs, stored steps and labels."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.storage import SharedFiles, fresh_folder

FOLDS = 5


PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per Spark context."""
    context, name = spark.sparkContext, f"{PACKAGE.name}-shipped.zip"
    if not PACKAGE.is_dir() or name in context._python_includes:
        return
    path = Path(tempfile.mkdtemp(prefix="shipped-")) / name
    with zipfile.ZipFile(path, "w") as archive:
        for source in PACKAGE.rglob("*.py"):
            archive.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` (null becomes empty) alone, whatever else the frame holds."""
    ship(docs.sparkSession)
    return docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written below ``spark.checkpoint.dir`` and read again: lineage ends here,
    and a lost executor costs no more than a new read."""
    return written(frame, fresh_folder(frame.sparkSession, label))


def written(frame: DataFrame, path: str) -> DataFrame:
    """``stored`` in a folder that is known, for steps that are dropped when nothing reads them any more."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    SharedFiles(spark).remove(path)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Frames made within give their shuffle files back when they have run, not when the driver happens to collect
    its garbage. For steps that run once, as those that are ``stored``."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def release() -> None:
    """Gives back what this process has freed. Python workers wait for tasks, and their allocators would
    keep the most that any batch took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def by_batch(
    frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema, rows: int | None = None
) -> DataFrame:
    """``work`` over every Arrow batch of every partition, in slices of ``rows``; ``schema``: the result's.
    A task's memory is given back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                yield from work(batch.slice(begin, rows))
        batch = None
        release()

    return frame.mapInArrow(run, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows of the test fold: crc32 of the id as text, modulo 5, is 0. Never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``text`` and ``label`` of at most ``limit`` labelled rows outside the test fold, the ones whose
    hashed ids come first. One label per id (the largest), labels other than 0 and 1 are left out."""
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    # At most ``limit`` rows of two numbers: small enough to broadcast by its bound.
    return texts_of(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")


def repeated(frame: DataFrame, repeats: str = "repeats", block: int = 100_000) -> DataFrame:
    """Each row as often as its column ``repeats`` says, numbered by ``nth`` from 0. Rows that repeat
    more often than ``block`` are dealt out in blocks, so that no task makes them all."""
    last = F.col(repeats) - 1
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(block).cast("long"))
    few = frame.where(F.col(repeats) <= block).withColumn("block", F.lit(0).cast("long"))
    many = frame.where(F.col(repeats) > block).withColumn("block", F.explode(starts)).repartition("block")
    ends = F.least(F.col("block") + block - 1, last)
    return few.unionByName(many).withColumn("nth", F.explode(F.sequence("block", ends))).drop("block", repeats)
