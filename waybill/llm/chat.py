"""Chat formatting whose output is parsed again until it gives back its source.

The grammar of a formatted conversation::

    conversation = turn*
    turn         = "### " name ": " body "\\n</turn>\\n"

``### `` begins a turn and ``</turn>`` ends one wherever no backslash stands before it. A backslash
before either of them belongs to the escape and is taken away on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, AFTER_NAME, END_MARK = "### ", ": ", "</turn>"
END = f"\n{END_MARK}\n"
# Names of the usual roles; any other role is written as "=" and its percent-encoded form.
ROLE_NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
LEARNT = "assistant"

_CONTROL = f"({BEGIN}|{END_MARK})"
_NEXT_TURN = rf"(?<!\\)(?={BEGIN})"
_OPEN_END = rf"(?<!\\){END_MARK}"


def plain(text: Column) -> Column:
    return text


def escaped(text: Column) -> Column:
    """One more backslash before every control string, however many stand there already."""
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, rf"\\{_CONTROL}", "$1")


ENCODINGS = (plain, escaped)
"""Ways to write a text, the plainest first; the first that is read back unchanged is taken."""


def role_name(role: Column) -> Column:
    name = F.concat(F.lit("="), F.url_encode(role))
    for known, written in ROLE_NAMES.items():
        name = F.when(role == known, F.lit(written)).otherwise(name)
    return name


def role_of(name: Column) -> Column:
    """The role that a name stands for, NULL for a name that no role has."""
    role = F.when(F.startswith(name, F.lit("=")), F.try_url_decode(F.substr(name, F.lit(2))))
    for known, written in ROLE_NAMES.items():
        role = F.when(name == written, F.lit(known)).otherwise(role)
    return role


def head_of(role: Column) -> Column:
    return F.concat(F.lit(BEGIN), role_name(role), F.lit(AFTER_NAME))


def pieces_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, still formatted."""
    return F.split(formatted, _NEXT_TURN)


def read_turn(piece: Column) -> Column:
    """``role, text`` of one formatted turn; what the grammar does not allow gives a NULL text."""
    name = F.substring_index(F.substr(piece, F.lit(len(BEGIN) + 1)), AFTER_NAME, 1)
    head = F.char_length(name) + len(BEGIN) + len(AFTER_NAME)
    body = F.substr(piece, head + 1, F.char_length(piece) - head - len(END))
    valid = F.startswith(piece, F.lit(BEGIN)) & F.endswith(piece, F.lit(END)) & ~body.rlike(_OPEN_END)
    return F.struct(role_of(name).alias("role"), F.when(valid, unescaped(body)).alias("text"))


def read_back(formatted: Column) -> Column:
    """The parser: ``role, text`` of every turn of a formatted conversation."""
    return F.transform(pieces_of(formatted), read_turn)


def body_of(role: Column, text: Column) -> Column:
    """The text as it stands in the output: written in one way after the other until the turn
    parses to exactly its role and text. A text that no way preserves stops the job."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    body = F.raise_error(F.concat(F.lit("no encoding is read back: "), F.left(text, F.lit(200)))).cast("string")
    for encode in reversed(ENCODINGS):
        written = encode(text)
        same = read_back(F.concat(head_of(role), written, F.lit(END))) == source
        body = F.when(same, written).otherwise(body)
    return body


def formatted_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, formatted, mask``: each conversation as one text, rows by turn.

    ``mask`` has an entry per turn, in order: ``head`` code points of marks, then ``body`` code points
    of (escaped) text, under the loss where ``loss`` is true, which is the assistants' text; the end
    mark follows. Turns are made and checked row by row before they meet, then the whole
    conversation is parsed again and compared with its source turn by turn.

    A null text or role is an empty one; rows without a turn come first, rows of the same turn in the
    order of their formatted text, repeated rows are turns of their own. Rows without an id are one
    conversation. An empty table gives no rows; other columns don't matter. All patterns take time in
    proportion to the text. A conversation becomes one value, so it must fit in a task's memory.
    """
    own = rows.select(
        rows[conversation].cast("long").alias("conv_id"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit("")).alias("text"),
    )
    source = F.xxhash64("role", "text")
    written = own.select(
        "conv_id",
        "turn",
        head_of(F.col("role")).alias("head"),
        body_of(F.col("role"), F.col("text")).alias("body"),
        (F.col("role") == LEARNT).alias("loss"),
        source.alias("source"),
    ).select(
        "conv_id",
        F.struct(
            "turn",
            F.concat("head", "body", F.lit(END)).alias("piece"),
            F.char_length("head").alias("head"),
            F.char_length("body").alias("body"),
            "loss",
            "source",
        ).alias("turn"),
    )
    joined = (
        written.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", "turns", F.array_join("turns.piece", "").alias("formatted"))
    )
    recovered = F.transform(read_back(F.col("formatted")), lambda t: F.xxhash64(t["role"], t["text"]))
    wrong = F.raise_error(F.concat(F.lit("not read back: conversation "), F.col("conv_id").cast("string")))
    return joined.select(
        "conv_id",
        F.when(recovered == F.col("turns.source"), F.col("formatted")).otherwise(wrong.cast("string")).alias("formatted"),
        F.arrays_zip(
            F.col("turns.head").alias("head"), F.col("turns.body").alias("body"), F.col("turns.loss").alias("loss")
        ).alias("mask"),
    )


def learnt_texts(formatted: Column, mask: Column) -> Column:
    """What stands under the loss mask, unescaped, one entry per turn (empty where nothing is learnt)."""

    def learnt(piece: Column, entry: Column) -> Column:
        return F.when(entry["loss"], unescaped(F.substr(piece, entry["head"] + 1, entry["body"]))).otherwise("")

    return F.zip_with(pieces_of(formatted), mask, learnt)
