"""Quality by a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, held_out, texts_of, training_rows
from waybill.llm.words import Words, words_of

SAMPLE = 6000
WORD_BITS = 16
FACTORS = 8
BINS = 10
THRESHOLD = 0.3

# Signs that rarely stand in prose.
SIGNS = b"#$%&*|!~^<>{}=_\\@+"


def _marks(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


_CLASSES = [
    _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _marks(SIGNS),
    _marks(b"0123456789"),
    _marks(b"\n"),
    _marks(b".,;:?"),
    _marks(b"|"),
    _marks(b"!"),
]
STATISTICS = len(_CLASSES) + 6


def structure(words: Words) -> np.ndarray:
    """Numbers between 0 and 1 about every text: shares of kinds of characters, of words that repeat
    the one before, of different words and of different shingles; lengths of words and of the text."""
    size = np.maximum(np.diff(words.offsets), 1)
    columns = []
    for marks in _CLASSES:
        sums = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum(marks[words.data], out=sums[1:], dtype=np.int64)
        columns.append(np.diff(sums[words.offsets]) / size)
    count = np.diff(words.first)
    some = np.maximum(count, 1)
    again = np.zeros(len(words.hashes) + 1, np.int64)
    if len(words.hashes) > 1:
        again[2:] = np.cumsum(words.hashes[1:] == words.hashes[:-1])
    columns.append((again[words.first[1:]] - again[np.minimum(words.first[:-1] + 1, words.first[1:])]) / some)
    columns.append(_distinct(words.hashes, words.first) / some)
    shingles, first = words.shingles(3)
    columns.append(_distinct(shingles, first) / np.maximum(np.diff(first), 1))
    lengths = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    columns.append(np.minimum((lengths[words.first[1:]] - lengths[words.first[:-1]]) / some / 20, 1))
    columns.append(np.minimum(np.log1p(count) / 12, 1))
    columns.append(np.minimum(np.log1p(size) / 14, 1))
    return np.column_stack(columns)


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=len(first) - 1)


def binned(statistics: np.ndarray) -> np.ndarray:
    """Bin of each statistic; small shares get finer bins (square root)."""
    return np.minimum((np.sqrt(np.clip(statistics, 0, 1)) * BINS).astype(np.int64), BINS - 1)


@dataclass
class Rows:
    """Sparse rows: row i has the features ``index[first[i]:first[i + 1]]`` with their ``value``."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray


def features(words: Words, metadata: np.ndarray | None = None) -> Rows:
    """Hashed words (each once, the row's norm 1), bins of the structure and of numeric metadata."""
    documents = len(words)
    owner = np.repeat(np.arange(documents, dtype=np.int64), np.diff(words.first))
    slots = (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key = np.unique(owner << WORD_BITS | slots)
    owner, slots = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    value = 1 / np.sqrt(np.bincount(owner, minlength=documents)[owner])
    statistics = structure(words)
    if metadata is not None:
        statistics = np.column_stack([statistics, metadata])
    bins = binned(statistics) + (1 << WORD_BITS) + BINS * np.arange(statistics.shape[1])
    owner = np.concatenate([owner, np.repeat(np.arange(documents), bins.shape[1])])
    order = np.argsort(owner, kind="stable")
    index = np.concatenate([slots, bins.ravel()])[order]
    value = np.concatenate([value, np.full(bins.size, 1 / np.sqrt(bins.shape[1]))])[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=documents))])
    return Rows(index, value, first)


@dataclass
class Machine:
    """score = bias + sum w x + 1/2 sum over factors ((sum v x)^2 - sum v^2 x^2), then the logistic curve."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def terms(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Sums before the logistic curve, and the sums of v x for each factor."""
        vx = self.factors[rows.index] * rows.value[:, None]
        sums = np.add.reduceat(vx, rows.first[:-1]) if len(vx) else np.zeros((0, self.factors.shape[1]))
        squares = np.add.reduceat((vx * vx).sum(axis=1), rows.first[:-1])
        linear = np.add.reduceat(self.weights[rows.index] * rows.value, rows.first[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.terms(rows)[0], -30, 30)))


def trained(rows: Rows, labels: np.ndarray, size: int, epochs: int = 12, batch: int = 64, rate: float = 0.2) -> Machine:
    """AdaGrad on the log loss. With one class only, or none, the machine is a constant."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    random = np.random.Generator(np.random.PCG64(7))
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, FACTORS))
    )
    if not 0 < labels.sum() < len(labels):
        machine.factors[:] = 0
        return machine
    seen_w, seen_v, seen_bias = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            counts = rows.first[chosen + 1] - rows.first[chosen]
            first = np.concatenate([[0], np.cumsum(counts)])
            at = np.arange(first[-1]) + np.repeat(rows.first[chosen] - first[:-1], counts)
            part = Rows(rows.index[at], rows.value[at], first)
            total, sums = machine.terms(part)
            error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[chosen]
            pull = np.repeat(error, counts) * part.value / len(chosen)
            own = machine.factors[part.index]
            pull_v = pull[:, None] * (np.repeat(sums, counts, axis=0) - own * part.value[:, None])
            slots, place = np.unique(part.index, return_inverse=True)
            grad_w = np.bincount(place, pull) + 1e-5 * machine.weights[slots]
            grad_v = np.column_stack([np.bincount(place, column) for column in pull_v.T]) + 1e-4 * machine.factors[slots]
            seen_w[slots] += grad_w**2
            seen_v[slots] += grad_v**2
            machine.weights[slots] -= rate * grad_w / np.sqrt(seen_w[slots])
            machine.factors[slots] -= rate * grad_v / np.sqrt(seen_v[slots])
            slope = error.mean()
            seen_bias += slope**2
            machine.bias -= rate * slope / np.sqrt(seen_bias)
    return machine


def metadata_share(column: pa.Array) -> np.ndarray:
    """A numeric column on a log scale between 0 and 1; null counts as 0."""
    values = np.nan_to_num(column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
    return np.minimum(np.log1p(np.maximum(values, 0)) / 14, 1)


def _batch_features(batch: pa.RecordBatch, metadata: list[str]) -> Iterator[tuple[int, Rows]]:
    shares = np.column_stack([metadata_share(batch.column(m)) for m in metadata]) if metadata else None
    for begin, words in words_of(batch.column("text")):
        part = None if shares is None else shares[begin : begin + len(words)]
        yield begin, features(words, part)


def learnt_machine(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = (), sample: int = SAMPLE) -> Machine:
    """A machine from labelled rows outside the test fold, at most ``sample`` of them.

    Spark makes their sparse features; the driver gets those of the sample alone.
    """
    names = [f"metadata_{i}" for i in range(len(metadata))]
    training = training_rows(docs, labels, "quality", sample)
    if metadata:
        extra = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *[docs[m].cast("double").alias(n) for m, n in zip(metadata, names)])
        training = training.join(F.broadcast(training.select("doc_id")).join(extra, "doc_id").dropDuplicates(["doc_id"]), "doc_id")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        labels_of = batch.column("label").to_pylist()
        for begin, rows in _batch_features(batch, names):
            spans = list(zip(rows.first[:-1], rows.first[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(begin, len(spans)),
                    pa.array(labels_of[begin : begin + len(spans)], pa.int32()),
                    pa.array([rows.index[a:b].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                    pa.array([rows.value[a:b].astype("<f4").tobytes() for a, b in spans], pa.binary()),
                ],
                names=["doc_id", "label", "slots", "vals"],
            )

    sparse = by_batch(training, work, "doc_id long, label int, slots binary, vals binary").toPandas()
    sparse = sparse.sort_values("doc_id", kind="stable")
    index = np.frombuffer(b"".join(sparse["slots"]), "<i4").astype(np.int64)
    value = np.frombuffer(b"".join(sparse["vals"]), "<f4").astype(float)
    first = np.concatenate([[0], np.cumsum([len(s) // 4 for s in sparse["slots"]])]).astype(np.int64)
    size = (1 << WORD_BITS) + BINS * (STATISTICS + len(metadata))
    return trained(Rows(index, value, first), sparse["label"].to_numpy(float), size)


def quality_scores(
    docs: DataFrame,
    machine: Machine,
    metadata: tuple[str, ...] = (),
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts have no words and are scored by their structure. Null metadata count as 0.
    Rows that repeat are scored each, rows without an id too (not held out). An empty table gives no
    rows.
    """
    names = [f"metadata_{i}" for i in range(len(metadata))]
    rows = docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
        *[docs[m].cast("double").alias(n) for m, n in zip(metadata, names)],
    )
    texts_of(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of a size fixed by WORD_BITS and FACTORS

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, part in _batch_features(batch, names):
            score = shared.value.score(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(begin, len(score)), pa.array(score)], names=["doc_id", "score"]
            )

    return by_batch(rows, work, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
