"""Declared layouts: what a source file looks like and what a table holds.

A *source layout* is found by the prefix of a file name, a *table layout* by the
table name; the two are independent keys (a ``client`` file may load table ``age``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The three declared primitive kinds and their Spark types (fixed values).
SPARK_TYPES = {
    "INTEGER": T.LongType(),
    "STRING": T.StringType(),
    "FLOAT": T.DoubleType(),
}

# Reasons written into the reject tables (fixed values).
WRONG_FIELD_COUNT = "error_line_index"
OUT_OF_RANGE = "not in queried partition"
TOO_MANY_BAD_ROWS = "too_many_invalid_rows_in_file"
INVALID_MESSAGE = "invalid_message_format"

# Reasons of our own, for cases where the declared behaviour is to crash.
BAD_CAST = "error_cast"
NO_LAYOUT = "no_structure"
UNKNOWN_DESTINATION = "unknown_destination"
UNKNOWN_KEY = "unknown_partition_key"
INVALID_BOUNDS = "invalid_partition_bounds"
FILE_NOT_FOUND = "file_not_found"
HIDDEN_FILE = "hidden_file"
EMPTY_FILE = "empty_file"
NO_KIND = "no_declared_kind"
SCHEMA_MISMATCH = "schema_mismatch"
INVALID_TABLE_NAME = "invalid_table_name"

# A file of this many bytes or more goes to the batch load (fixed value).
BATCH_SIZE_THRESHOLD = 1_000_000_000


def struct(**kinds: str) -> T.StructType:
    """A nullable struct from ``name="KIND"`` pairs."""
    return T.StructType([T.StructField(n, SPARK_TYPES[k], True) for n, k in kinds.items()])


def kind_of(data_type: T.DataType) -> str:
    """The declared kind of a Spark type; raises for any other type."""
    for kind, spark_type in SPARK_TYPES.items():
        if data_type == spark_type:
            return kind
    raise ValueError(f"no declared kind for type {data_type.simpleString()}")


DEFAULT_ENCODING = "utf-8"
# Encodings in which a line end is the one byte that lines are split at.
ENCODINGS = (DEFAULT_ENCODING, "us-ascii", "iso-8859-1")
LINE_END = "\r\n"
"""Lines end at ``\\n``; a ``\\r`` before it belongs to the line end."""


@dataclass(frozen=True)
class SourceLayout:
    """Fields of a source file, found by file-name prefix (a regular expression).

    ``encoding`` is one of ``ENCODINGS``; ``delimiter``, the line end, can only be ``LINE_END``.
    """

    prefix: str
    schema: T.StructType
    max_bad_rows: int = 0
    delimiter: str = LINE_END
    encoding: str = DEFAULT_ENCODING

    def __post_init__(self) -> None:
        if self.delimiter != LINE_END:
            raise ValueError(f"line end {self.delimiter!r}: only {LINE_END!r} is read")
        if self.encoding not in ENCODINGS:
            raise ValueError(f"encoding {self.encoding!r}: not one of {ENCODINGS}")

    def position(self, column: str) -> int | None:
        names = self.schema.names
        return names.index(column) if column in names else None


@dataclass(frozen=True)
class Registry:
    """Ordered source layouts (first prefix match wins) and table layouts by name."""

    sources: tuple[SourceLayout, ...]
    tables: dict[str, T.StructType] = field(default_factory=dict)

    def source(self, prefix: str) -> SourceLayout:
        for layout in self.sources:
            if layout.prefix == prefix:
                return layout
        raise KeyError(prefix)

    def table_schema(self, table: str) -> T.StructType:
        """Layout of a table given by its bare or qualified name."""
        return self.tables[table.split(".")[-1]]


# --- fixed values: the built-in layouts --------------------------------------------
DEFAULT_REGISTRY = Registry(
    sources=(
        SourceLayout("client", struct(NAME="STRING", AGE="INTEGER"), max_bad_rows=18),
        SourceLayout("telephone", struct(name="STRING", number="STRING"), max_bad_rows=18),
        SourceLayout("address", struct(name="STRING", address="STRING"), max_bad_rows=0),
    ),
    tables={
        "age": struct(NAME="STRING", AGE="INTEGER"),
        "telephone": struct(name="STRING", number="STRING"),
        "address": struct(name="STRING", address="STRING"),
    },
)

REJECT_SCHEMA = struct(
    timestamp="STRING", stacktrace="STRING", source_file="STRING", raw_data="STRING"
)
MONITORING_SCHEMA = struct(
    timestamp="STRING",
    event="STRING",
    number_inserted_rows="INTEGER",
    number_rejected_rows="INTEGER",
)
JSON_LOG_SCHEMA = struct(name="STRING", age="INTEGER", height="FLOAT")

# Layouts found by the exact file name, with a default for every other name.
EXACT_NAME_LAYOUTS = {
    "tabledata.csv": struct(name="STRING", age="INTEGER", height="FLOAT"),
    "tabledata2.csv": struct(NAME="STRING", AGE="INTEGER", COLOR="STRING"),
}
DEFAULT_EXACT_NAME = "tabledata.csv"
# ------------------------------------------------------------------------------------

# Invalid messages and messages whose file cannot be loaded.
DEAD_LETTER_SCHEMA = struct(
    timestamp="STRING", reason="STRING", message_id="STRING", message="STRING"
)

# A control message as it stands in the topic. Bounds are read as text and compared in
# the type of the key: a numeric array type would lose mixed integer/fraction bounds.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("fileURL", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("partition_depth", T.ArrayType(T.StringType())),
        T.StructField("partition_key", T.StringType()),
    ]
)
