"""The shared file system, reached through Hadoop's FileSystem like Spark itself does."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where nothing is set, a local session gets a temporary folder of its own, kept for
    the life of the Spark context; a cluster session must say where its folder is.
    """
    setting = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if setting:
        return setting.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="waybill-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path (not yet created) below the shared root."""
    return f"{shared_root(spark)}/waybill/{label}-{uuid.uuid4().hex[:12]}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared root and read again, under its own session."""
    path = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@dataclass(frozen=True)
class FileStatus:
    path: str
    """Plain path, as a reader takes it."""
    uri: str
    """Encoded path, as ``_metadata.file_path`` shows it."""
    length: int
    is_folder: bool

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


class SharedFiles:
    """Existence, markers, listing and removal on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self._conf)

    @staticmethod
    def _status(raw) -> FileStatus:
        path = raw.getPath()
        return FileStatus(path.toString(), path.toUri().toString(), raw.getLen(), raw.isDirectory())

    def exists(self, path: str) -> bool:
        hadoop_path, fs = self._open(path)
        return fs.exists(hadoop_path)

    def text(self, path: str) -> str:
        """The whole of a small text file."""
        hadoop_path, fs = self._open(path)
        stream = fs.open(hadoop_path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Writes a small text file, folders included."""
        hadoop_path, fs = self._open(path)
        stream = fs.create(hadoop_path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def mark(self, path: str) -> None:
        """Creates an empty file, folders included."""
        hadoop_path, fs = self._open(path)
        fs.create(hadoop_path, True).close()

    def remove(self, path: str) -> None:
        hadoop_path, fs = self._open(path)
        fs.delete(hadoop_path, True)

    def _statuses(self, found, limit: int | None) -> list[FileStatus] | None:
        if limit is not None and found is not None and len(found) > limit:
            return None
        return [self._status(s) for s in (found or [])]

    def glob(self, pattern: str, limit: int | None = None, named: str | None = None) -> list[FileStatus] | None:
        """What a pattern matches, of the names that fit ``named`` if given; None if that is more
        than ``limit`` (nothing is converted then)."""
        hadoop_path, fs = self._open(pattern)
        if named is None:
            return self._statuses(fs.globStatus(hadoop_path), limit)
        names = self._jvm.org.apache.hadoop.fs.GlobFilter(named)
        return self._statuses(fs.globStatus(hadoop_path, names), limit)

    def any(self, pattern: str) -> bool:
        """Whether a pattern matches something."""
        hadoop_path, fs = self._open(pattern)
        found = fs.globStatus(hadoop_path)
        return found is not None and len(found) > 0

    def children(self, folder: str, limit: int | None = None) -> list[FileStatus] | None:
        hadoop_path, fs = self._open(folder)
        return self._statuses(fs.listStatus(hadoop_path), limit)
