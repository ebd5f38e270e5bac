"""Neighbours in a sorted table, across the borders of partitions too."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import stored

PAIR, FIRST, LAST = range(3)


def _side_by_side(left: pa.Table, right: pa.Table, kind: int, part: int) -> pa.RecordBatch:
    columns = [pa.array(np.full(left.num_rows, kind), pa.int32()), pa.array(np.full(left.num_rows, part), pa.int32())]
    names = ["kind", "part"]
    for side, rows in (("a", left), ("b", right)):
        for name in rows.column_names:
            columns.append(rows.column(name).combine_chunks())
            names.append(f"{side}_{name}")
    return pa.RecordBatch.from_arrays(columns, names=names)


def neighbours(rows: DataFrame, order: list[str], label: str, reach: int = 1) -> DataFrame:
    """Pairs of rows at most ``reach`` places apart in the order of all columns ``order`` and equal in
    the first of them, side by side as ``a_...`` and ``b_...``.

    Rows are dealt out by range, so that even one value's rows go to many tasks. Each task compares
    the rows it streams through; the first and last ``reach`` rows of each partition are compared
    with those of the next at the end.
    """
    key = order[0]
    columns = [f"{side}_{f.name} {f.dataType.simpleString()}" for side in "ab" for f in rows.schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, begun = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if begun < reach:
                head = table.slice(0, reach - begun)
                yield _side_by_side(head, head, FIRST, part)
                begun += head.num_rows
            old = last.num_rows if last is not None else 0
            table = pa.concat_tables([last, table]) if old else table
            keys = table.column(key).to_numpy()
            for step in range(1, reach + 1):
                at = np.flatnonzero(keys[step:] == keys[:-step])
                at = at[at + step >= old]  # the others have been compared before
                if len(at):
                    yield _side_by_side(table.take(pa.array(at)), table.take(pa.array(at + step)), PAIR, part)
            last = table.slice(max(0, table.num_rows - reach))
        if last is not None:
            yield _side_by_side(last, last, LAST, part)

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(["kind int", "part int", *columns])
    found = stored(ranged.mapInArrow(work, schema), label)
    width = len(rows.columns)
    ends: dict[tuple[int, int], list] = {}
    for row in found.where(F.col("kind") != PAIR).collect():
        ends.setdefault((row.part, row.kind), []).append(row)
    parts = sorted({part for part, _ in ends})
    across = []
    for part, following in zip(parts, parts[1:]):
        here = sorted(ends[part, LAST], key=lambda r: tuple(r[f"a_{c}"] for c in order))
        there = sorted(ends[following, FIRST], key=lambda r: tuple(r[f"a_{c}"] for c in order))
        across += [
            [PAIR, part, *one[2 : 2 + width], *other[2 + width :]]
            for i, one in enumerate(reversed(here))
            for j, other in enumerate(there)
            if i + j < reach and one[f"a_{key}"] == other[f"a_{key}"]
        ]
    pairs = found.where(F.col("kind") == PAIR)
    if across:
        pairs = pairs.unionByName(rows.sparkSession.createDataFrame(across, found.schema))
    return pairs.drop("kind", "part")
