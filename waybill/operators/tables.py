"""Appending to catalog tables: dispositions, schema checks, writing once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.text import identifier
from waybill.layouts import DEAD_LETTER_SCHEMA, MONITORING_SCHEMA, REJECT_SCHEMA, Registry, kind_of
from waybill.operators.outputs import conform
from waybill.storage import SharedFiles, shared_root

LOAD_ID, STEP = "load_id", "step"
"""Optional partition columns. What a step of a load writes to a table that has them replaces what
the same step wrote before, so that a step repeated after a crash leaves no second copy."""


class SchemaMismatch(ValueError):
    """A file does not fit an existing table."""


def quoted(database: str, table: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in (*database.split("."), table))


@dataclass(frozen=True)
class Targets:
    """Where a load writes: results and rejects are two databases with the same table names."""

    results: str = "results"
    rejects: str = "rejects"
    monitoring_table: str = "monitoring"
    dead_letter_table: str = "dead_letters"
    create: bool = False
    """False: a missing table is an error. True: it is created from its layout."""
    source: str = "parquet"
    by_load: bool = False
    """Tables that are created get the partition columns ``load_id`` and ``step``."""

    def append(self, df: DataFrame, table: str, schema: T.StructType, load_id: str, step: str) -> None:
        """What one step of a load writes to one table."""
        append(df, table, schema if self.create else None, self.source, "drop", load_id, step, self.by_load)

    def result(self, table: str) -> str:
        return quoted(self.results, table)

    def reject(self, table: str) -> str:
        return quoted(self.rejects, table)

    @property
    def monitoring(self) -> str:
        return quoted(self.results, self.monitoring_table)

    @property
    def dead_letters(self) -> str:
        return quoted(self.rejects, self.dead_letter_table)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, source: str = "parquet", by_load: bool = False
) -> None:
    """Creates the table unless it is there. ``by_load`` adds the partitions ``load_id, step``."""
    columns = [f"{identifier(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    if by_load:
        columns += [f"`{name}` string" for name in (LOAD_ID, STEP)]
    partition = f" PARTITIONED BY (`{LOAD_ID}`, `{STEP}`)" if by_load else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {source}{partition}")


def create_load_tables(spark: SparkSession, targets: Targets, registry: Registry, by_load: bool = False) -> None:
    """All tables of a registry: results, rejects, monitoring and dead letters."""
    for database in (targets.results, targets.rejects):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in registry.tables.items():
        create_table(spark, targets.result(name), schema, targets.source, by_load)
        create_table(spark, targets.reject(name), REJECT_SCHEMA, targets.source, by_load)
    create_table(spark, targets.monitoring, MONITORING_SCHEMA, targets.source, by_load)
    create_table(spark, targets.dead_letters, DEAD_LETTER_SCHEMA, targets.source, by_load)


def append(
    df: DataFrame,
    table: str,
    create_as: T.StructType | None = None,
    source: str = "parquet",
    unknown: str = "drop",
    load_id: str | None = None,
    step: str = "rows",
    by_load: bool = False,
) -> None:
    """Appends a frame to a table, by column name.

    Without ``create_as`` a missing table is an error; with it the table is created. In a table
    partitioned by ``load_id`` (and ``step``) that part is replaced, so that a repeated step leaves
    no second copy.
    """
    spark = df.sparkSession
    if create_as is not None:
        create_table(spark, table, create_as, source, by_load)
    schema = spark.table(table).schema
    own = {name: value for name, value in ((LOAD_ID, load_id), (STEP, step)) if name in schema.names}
    if LOAD_ID in own and load_id is not None and LOAD_ID not in df.columns:
        data = T.StructType([f for f in schema.fields if f.name not in own])
        part = ", ".join(f"`{name}` = {_text_literal(value)}" for name, value in own.items())
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) SELECT * FROM {{rows}}", rows=conform(df, data, unknown))
    else:
        conform(df, schema, unknown).write.insertInto(table)


def _text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def row_count(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).agg(F.count("*").alias("n"))


def schema_gaps(table: T.StructType, file: T.StructType, exact: bool = False) -> list[str]:
    """Why a file does not fit a table: table columns the file lacks or has in another type.

    The order is free, and columns the table lacks are no gap unless ``exact``.
    """
    kinds = {f.name: kind_of(f.dataType) for f in file.fields}
    gaps = []
    for f in table.fields:
        if f.name in (LOAD_ID, STEP):
            continue
        if f.name not in kinds:
            gaps.append(f"{f.name}: not in the file")
        elif kinds[f.name] != kind_of(f.dataType):
            gaps.append(f"{f.name}: {kinds[f.name]} in the file, {kind_of(f.dataType)} in the table")
    if exact:
        gaps += [f"{n}: not in the table" for n in kinds if n not in table.names]
    return gaps


def append_compatible(
    df: DataFrame, table: str, source: str = "parquet", exact: bool = False, load_id: str | None = None, step: str = "rows"
) -> None:
    """Appends to a table made from the frame's schema, or checked against it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        gaps = schema_gaps(spark.table(table).schema, df.schema, exact)
        if gaps:
            raise SchemaMismatch(f"{table}: " + "; ".join(gaps))
    append(df, table, create_as=df.schema, source=source, load_id=load_id, step=step)


class LoadFolder:
    """The shared folder of one load: stored frames, and markers of the steps done.

    A step that has its marker is not run again when the load is repeated with the same
    id. A crash between a step's commit and its marker would repeat that one step; tables
    partitioned by ``load_id`` and ``step`` are safe from that too.
    """

    def __init__(self, spark: SparkSession, load_id: str):
        self.path = f"{shared_root(spark)}/waybill/loads/{load_id}"
        self.files = SharedFiles(spark)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def once(self, step: str, action: Callable[[], None]) -> None:
        marker = self.at(f"done/{step}")
        if not self.files.exists(marker):
            action()
            self.files.mark(marker)

    def stored(self, name: str) -> bool:
        return self.files.exists(self.at(f"{name}/_SUCCESS"))

    def store(
        self,
        df: DataFrame,
        name: str,
        partition_by: tuple[str, ...] = (),
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Writes a frame unless it has been written completely before, and reads it back."""
        if not self.stored(name):
            writer = df.write.mode("overwrite").options(**(options or {}))
            writer.partitionBy(*partition_by).parquet(self.at(name))
        return df.sparkSession.read.schema(df.schema).parquet(self.at(name))

    @property
    def complete(self) -> bool:
        return self.files.exists(self.at("done/load"))

    def finish(self, frames: tuple[str, ...]) -> None:
        """Marks the load complete and frees its stored frames; the markers stay."""
        self.files.mark(self.at("done/load"))
        for name in frames:
            self.files.remove(self.at(name))
