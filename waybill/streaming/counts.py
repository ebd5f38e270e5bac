"""Where windowed counts of a stream are kept: open batches, and windows that are closed.

Every micro-batch leaves a small frame of its own, which a repeated batch overwrites. After every
``COMPACT_EVERY`` batches the windows that can change no more go to the closed ones and the rest
into one frame of open ones, and the batches' own frames are removed. Closed frames are put together
in tiers: as many as ``COMPACT_EVERY`` of one tier become one of the next. So a reader opens a
bounded number of batches and a number of closed frames that grows with the logarithm of all batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.storage import SharedFiles

COMPACT_EVERY = 8


@dataclass(frozen=True)
class CountStore:
    """``window_start, <keys>, n`` of all batches of a stream.

    ``merge`` says what the rows of several batches for one window are: ``latest`` (running counts,
    the newest holds) or ``sum`` (each batch counts its own rows).
    """

    spark: SparkSession
    folder: str
    keys: tuple[str, ...] = ()
    window: str = "1 second"
    lateness: str = "0 seconds"
    merge: str = "latest"

    @property
    def _files(self) -> SharedFiles:
        return SharedFiles(self.spark)

    def _numbers(self, pattern: str) -> list[int]:
        """Numbers at the ends of the complete folders that a pattern below the store matches."""
        marks = self._files.glob(f"{self.folder}/{pattern}/_SUCCESS")
        return sorted(int(m.path.rsplit("/", 2)[-2].rsplit("=", 1)[-1]) for m in marks)

    def _read(self, paths: Sequence[str]) -> DataFrame | None:
        """Frames of the store, with ``batch``, the last batch they tell of."""
        return self.spark.read.parquet(*paths) if paths else None

    def _merged(self, rows: DataFrame) -> DataFrame:
        n = F.max_by("n", "batch") if self.merge == "latest" else F.sum("n")
        return rows.groupBy("window_start", *self.keys).agg(n.alias("n"), F.max("batch").alias("batch"))

    def _open_paths(self, through: int | None = None) -> list[str]:
        kept = self._numbers("open/through=*")
        last = kept[-1] if kept else -1
        paths = [f"{self.folder}/open/through={last}"] if kept else []
        batches = [b for b in self._numbers("batch=*") if b > last and (through is None or b <= through)]
        return paths + [f"{self.folder}/batch={b}" for b in batches]

    def _closed_paths(self) -> list[str]:
        """Closed frames, without those that a frame of the next tier has taken in."""
        paths, covered = [], -1
        for tier in sorted({int(s.name.split("=")[1]) for s in self._files.glob(f"{self.folder}/closed/tier=*")}, reverse=True):
            own = [n for n in self._numbers(f"closed/tier={tier}/through=*") if n > covered]
            paths += [f"{self.folder}/closed/tier={tier}/through={n}" for n in own]
            covered = max([covered, *own])
        return paths

    def write(self, counts: DataFrame, number: int) -> None:
        """The counts of one batch; every now and then what came before is put together."""
        if number not in self._numbers("open/through=*"):
            counts.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{self.folder}/batch={number}")
        if number % COMPACT_EVERY == COMPACT_EVERY - 1:
            self.compact(number)

    def _is_closed(self, newest: Column) -> Column:
        end = F.col("window_start") + F.expr(f"INTERVAL {self.window}") + F.expr(f"INTERVAL {self.lateness}")
        # The watermark is not behind the start of the newest window, less the lateness.
        return end <= newest

    def compact(self, number: int) -> None:
        """Closes what can change no more through this batch. Repeated after a crash it goes on where
        it was: each frame is complete before what it replaces is removed."""
        files = self._files
        if number not in self._numbers("open/through=*"):
            rows = self._read(self._open_paths(number))
            if rows is None:
                return
            merged = self._merged(rows)
            newest = merged.agg(F.max("window_start").alias("t")).first()["t"]
            if newest is None:
                return
            closed = F.coalesce(self._is_closed(F.lit(newest)), F.lit(False))
            merged.filter(closed).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/closed/tier=0/through={number}")
            merged.filter(~closed).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/open/through={number}")
        for old in self._numbers("open/through=*"):
            if old < number:
                files.remove(f"{self.folder}/open/through={old}")
        for batch in self._numbers("batch=*"):
            if batch <= number:
                files.remove(f"{self.folder}/batch={batch}")
        self._lift(0)

    def _lift(self, tier: int) -> None:
        higher = self._numbers(f"closed/tier={tier + 1}/through=*")
        numbers = self._numbers(f"closed/tier={tier}/through=*")
        done = [n for n in numbers if higher and n <= higher[-1]]
        for n in done:
            self._files.remove(f"{self.folder}/closed/tier={tier}/through={n}")
        fresh = [n for n in numbers if n not in done]
        if len(fresh) < COMPACT_EVERY:
            return
        rows = self._read([f"{self.folder}/closed/tier={tier}/through={n}" for n in fresh])
        rows.repartition(1, "window_start").write.mode("overwrite").parquet(f"{self.folder}/closed/tier={tier + 1}/through={fresh[-1]}")
        for n in fresh:
            self._files.remove(f"{self.folder}/closed/tier={tier}/through={n}")
        self._lift(tier + 1)

    def read(self) -> DataFrame:
        """The count of every window, as far as it is known."""
        paths = self._closed_paths() + self._open_paths()
        if not paths:
            raise FileNotFoundError(self.folder)
        return self._merged(self._read(paths)).drop("batch")
