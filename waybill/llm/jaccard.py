"""Documents whose sets of word shingles are similar: a size-aware heavy-light join.

Similarity 100 * intersection >= 80 * union. Two such sets share at least ``k`` of their first
``n - ceil(0.8 n) + k`` shingles, in any order common to all sets. Small sets are matched by subsets
of two shingles (k = 2), large ones by inverted lists of single shingles (k = 1); where small ends is
chosen by the cost counted in the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.frames import by_batch, ship, stored, texts_of
from waybill.llm.graph import components
from waybill.llm.words import SHINGLE, mix, words_of

PERCENT = 80
MAX_COMMON = 1 << 22
BITS = 26
BLOCK_BITS = 16
LOOKED_THROUGH = 1.5
LARGEST_SMALL = 64
PIVOT_ROUNDS = 2
LONGEST_PAIRED = 128
"""Members of longer lists are compared block by block instead of pair by pair."""
BLOCK_SETS = 512
BLOCK_BYTES = 8 << 20
COLUMNS = 2048  # shingles in one product of matrices
ROWS = 1024  # texts whose sets a task holds at once
BROADCAST_BYTES = 32 << 20


def needed(n: int) -> int:
    """The least intersection of a set of ``n`` with any similar set."""
    return -(-PERCENT * n // 100)


def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of a batch."""
    for begin, words in words_of(batch.column("text")):
        values, first = words.shingles(SHINGLE)
        for i in range(len(words)):
            yield begin + i, np.unique(values[first[i] : first[i + 1]])


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def members(texts: DataFrame) -> DataFrame:
    """``doc_id, digest`` of the whole set, and its size ``n``."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [(digest_of(s), len(s)) for _, s in sets_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([d for d, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
            names=["doc_id", "digest", "n"],
        )

    return by_batch(texts, work, "doc_id long, digest binary, n long", ROWS)


def statistics(texts: DataFrame) -> DataFrame:
    """What the order and the boundary are chosen by: the shingles that are among several sets' first
    ones (``kind`` 0; ``LOOKED_THROUGH`` times as many as are used, as those that come later move up),
    and by size the sets, their list entries and, within a batch, the entries they would be compared
    with (kinds 1 to 3)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, parts = [], []
        for _, shingles in sets_of(batch):
            if len(shingles):
                sizes.append(len(shingles))
                parts.append(shingles[: int(LOOKED_THROUGH * (len(shingles) - needed(len(shingles)) + 1))])
        out = [np.zeros((3, 0), np.int64)]
        if parts:
            entries = np.array([len(p) for p in parts])
            shingles, place, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            out.append(np.stack([np.zeros(len(counts), np.int64), shingles.view(np.int64), counts]))
            others = np.add.reduceat(counts[place] - 1, np.concatenate([[0], np.cumsum(entries)[:-1]]))
            size = np.minimum(sizes, LARGEST_SMALL)
            for kind, weight in ((1, np.ones(len(size))), (2, entries), (3, others)):
                sums = np.bincount(size, weight).astype(np.int64)
                out.append(np.stack([np.full(len(sums), kind), np.arange(len(sums)), sums]))
        kind, value, n = np.concatenate(out, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(value), pa.array(n)], names=["kind", "value", "n"])

    counts = by_batch(texts.select("text"), work, "kind long, value long, n long")
    return counts.groupBy("kind", "value").agg(F.sum("n").alias("n")).where("kind > 0 OR n > 1")


def boundary(sets: np.ndarray, entries: np.ndarray, others: np.ndarray) -> int:
    """The size from which sets count as large: the least sum of subsets written by small sets and of
    entries written and compared by large ones. Arguments by size, the last for all from there on."""
    size = np.arange(len(sets))
    first = size - -(-PERCENT * size // 100) + 2
    subsets = sets * first * (first - 1) // 2
    lists = entries + others
    costs = [subsets[4:b].sum() + lists[needed(b) :].sum() for b in range(4, len(sets))]
    return 4 + int(np.argmin(costs)) if costs else 4


def bit_of(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> np.uint64(64 - BITS)).astype(np.int64)


def common_bits(counted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (``2 ** BITS`` bits) of the shingles that several sets have among their
    first; of more than ``MAX_COMMON`` those that most sets have. It only serves the order: a bit that
    two shingles share, or a shingle without one, changes which come last and no result."""
    left, least = MAX_COMMON, 2
    frequencies = counted.where("kind = 0").groupBy("n").agg(F.count("*").alias("shingles")).orderBy(F.desc("n"))
    for row in frequencies.toLocalIterator():
        left -= row.shingles
        if left < 0:
            least = row.n + 1
            break

    def places(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits = bit_of(batch.column(0).to_numpy().view(np.uint64))
        columns = [pa.array((bits >> BLOCK_BITS).astype(np.int32)), pa.array((bits & ((1 << BLOCK_BITS) - 1)).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "place"])

    def packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for block in batch.column("places"):
            bits = np.zeros(1 << BLOCK_BITS, bool)
            bits[block.values.to_numpy()] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "bits"])

    chosen = by_batch(counted.where((F.col("kind") == 0) & (F.col("n") >= least)).select("value"), places, "block int, place int")
    blocks = chosen.groupBy("block").agg(F.collect_set("place").alias("places"))  # at most 2 ** BLOCK_BITS places
    bitmap = np.zeros((1 << (BITS - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    table = by_batch(blocks, packed, "block int, bits binary").toArrow()
    for block, bits in zip(table.column("block").to_pylist(), table.column("bits").to_pylist()):
        bitmap[block] = np.frombuffer(bits, np.uint8)
    return bitmap.ravel()


def keyed_sets(texts: DataFrame, known: DataFrame, common: np.ndarray, small_below: int) -> DataFrame:
    """One row per distinct set: ``node`` (a number of its own), ``digest, first_id, n, keys``;
    the first ``subsets`` of the keys are those of subsets, the rest shingles in order.

    Of the documents with equal sets (``known``: see ``members``) the one with the smallest id stands
    for all. Shingles in the bitmap ``common`` come last in the order, before and after it goes by hash.
    """
    firsts = known.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    others = known.join(firsts, "digest").where("doc_id > first_id").select("doc_id", "digest").distinct()
    if others.count() * 24 <= BROADCAST_BYTES:
        others = F.broadcast(others)

    shared = texts.sparkSession.sparkContext.broadcast(common)  # of fixed size

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        digests, sizes, keys, subsets = [], [], [], []
        last = shared.value
        for _, shingles in sets_of(batch):
            n = len(shingles)
            digests.append(digest_of(shingles))
            sizes.append(n)
            if n < 4:  # similar to nothing but an equal set
                keys.append(np.zeros(0, np.int64))
                subsets.append(0)
                continue
            bits = bit_of(shingles)
            is_common = (last[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
            shingles = np.concatenate([shingles[~is_common], shingles[is_common]])
            first = n - needed(n) + 1
            found = []
            if n < small_below:
                a, b = np.triu_indices(first + 1, 1)
                found.append(mix(shingles[a] * np.uint64(3) + mix(shingles[b])))
            if n >= needed(small_below):
                found.append(shingles[:first])
            keys.append(np.concatenate(found).view(np.int64))
            subsets.append(len(found[0]) if n < small_below else 0)
        flat = np.concatenate(keys)
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(digests, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(subsets, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            names=["doc_id", "digest", "n", "subsets", "keys"],
        )

    rows = by_batch(texts, work, "doc_id long, digest binary, n long, subsets long, keys array<long>", ROWS)
    distinct = rows.where("doc_id IS NOT NULL").join(others, ["doc_id", "digest"], "left_anti")
    # Numbers are made when the table is written and read from it ever after. A row that repeats id
    # and text gets a number of its own, which is linked like any equal set.
    return stored(
        distinct.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("doc_id").alias("first_id"), "n", "subsets", "keys"),
        "keyed-sets",
    )


def shared_lists(keyed: DataFrame) -> DataFrame:
    """The lists (``key, node, n, place``) of keys that several sets have. ``place``: the shingle's
    number in its set's order, from 1; 1 for keys of subsets.

    Entries are sorted by key, dealt out by range and node, so that long lists go to many tasks, and
    each task drops those that differ from both neighbours. At the ends of a partition, where a
    neighbour may be elsewhere, entries stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, matched = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            keys = rows.column("key").to_numpy()
            same = keys[1:] == keys[:-1]
            keep = np.append(same, False)
            keep[1:] |= same
            keep[0] |= matched
            held, matched = rows.slice(rows.num_rows - 1), bool(keep[-1])
            yield from rows.slice(0, rows.num_rows - 1).filter(pa.array(keep[:-1])).to_batches()
        if held is not None:
            yield from held.to_batches()

    entries = keyed.select(F.posexplode("keys").alias("at", "key"), "node", "n", "subsets")
    place = F.greatest(F.col("at") - F.col("subsets") + 1, F.lit(1)).cast("int").alias("place")
    entries = entries.select("key", "node", "n", place)
    ranged = entries.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return stored(ranged.mapInArrow(work, "key long, node long, n long, place int"), "lists")


def candidate_sets(texts: DataFrame, keyed: DataFrame, lists: DataFrame) -> DataFrame:
    """``node`` and its whole set (sorted 64-bit numbers) for all nodes in ``lists``."""
    wanted = stored(keyed.select("node", "digest", "first_id").join(lists.select("node").distinct(), "node", "left_semi"), "wanted")
    ids = wanted.select(F.col("first_id").alias("doc_id")).distinct()
    if ids.count() * 16 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [(digest_of(s), s.tobytes()) for _, s in sets_of(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], names=["digest", "shingles"])

    sets = by_batch(texts.join(ids, "doc_id", "left_semi").select("text"), work, "digest binary, shingles binary", ROWS)
    # Rows that share an id, but not the text, drop out here.
    return stored(sets.join(wanted.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "shingles"), "sets")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes whose whole sets are similar."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for one, other in zip(batch.column("one"), batch.column("other")):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, other))
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= PERCENT * (len(both) - common))
        kept = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    return by_batch(pairs.join(other, "b").join(one, "a").select("a", "b", "one", "other"), work, "a long, b long")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _fitting(n: str, place: str, m: str, other_place: str):
    """Whether sets of n and m that first meet in this list can be similar: no more than the shingles
    from here on are common. Of the lists that two similar sets share, at least the first says so."""
    common = F.least(F.col(n) - F.col(place), F.col(m) - F.col(other_place)) + 1
    return common * (100 + PERCENT) >= (F.col(n) + F.col(m)) * PERCENT


def _linked_in_cell(low: list[np.ndarray], high: list[np.ndarray] | None) -> np.ndarray:
    """For the sets of a block with each other, or of two blocks: the smallest position that each set
    is connected with by links in this cell. Intersections are counted for all at once, as products
    of 0/1 matrices over slices of the shingles."""
    sets = low + (high or [])
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    first = len(low) if high else 0
    common = np.zeros((len(low), len(sets) - first), np.float32)
    edges = np.searchsorted(column, np.arange(0, column[-1] + COLUMNS + 1, COLUMNS))
    for part, (start, end) in enumerate(zip(edges, edges[1:])):
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[start:end], column[start:end] - part * COLUMNS] = 1
        common += held[: len(low)] @ held[first:].T
    union = size[: len(low), None] + size[None, first:] - common
    near = 100 * common >= PERCENT * union
    linked = np.zeros((len(sets), len(sets)), bool)
    linked[: len(low), first:] = near
    linked |= linked.T
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        nearest = np.where(linked, label[None, :], len(sets)).min(1)
        if (nearest == label).all():
            return label
        label = nearest


def linked_in_cells(hot: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect all similar sets among the members of long lists (``key, node``).

    Lists that share members are one group. Its sets are dealt into blocks of a bounded number and
    size, and each pair of blocks is one cell, where all its sets are compared at once: a set is
    sent once to a cell, not once per pair, and of a cell's links those of a spanning forest come out.
    """
    lowest = hot.groupBy("key").agg(F.min("node").alias("b"))
    stars = hot.select("key", F.col("node").alias("a")).join(lowest, "key").select("a", "b").distinct()
    groups = components(stars).select("node", F.col("component").alias("group"))
    held = stored(groups.join(sets, "node"), "hot-sets")
    weight = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(F.octet_length("shingles")) / BLOCK_BYTES))
    blocks = held.groupBy("group").agg(weight.cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = held.join(blocks, "group").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select(
        "group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "shingles"
    )

    def compare(table: pa.Table) -> pa.Table:
        nodes, blocks = table.column("node").to_numpy(), table.column("own").to_numpy()
        order = np.argsort(blocks, kind="stable")
        shingles = table.column("shingles").combine_chunks()
        found = [np.frombuffer(shingles[int(i)].as_buffer(), np.uint64) for i in order]
        nodes, in_low = nodes[order], int(np.count_nonzero(blocks == blocks.min()))
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        if not same and in_low == len(nodes):  # the other block is empty
            label = np.arange(len(nodes))
        else:
            label = _linked_in_cell(found if same else found[:in_low], None if same else found[in_low:])
        moved = label != np.arange(len(nodes))
        return pa.table({"a": nodes[label[moved]], "b": nodes[moved]})

    return cells.groupBy("group", "low", "high").applyInArrow(compare, "a long, b long")


def node_components(lists: DataFrame, sets: DataFrame, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """``node, component`` by all links between the members of each list (``key, node, n, place``).

    Comparing all members of a list with each other would grow with its square. First, some times
    over, every list is compared with one of its members: the one with the fewest rarer shingles, in a
    group of near copies that which the others were made from. What is connected by then needs no more comparing; the rest (members outside
    the list's largest component against all others) is compared in full, so that no link between
    components is lost: pair by pair where the list is short, in cells of blocks where it is long.
    """
    spark = lists.sparkSession
    links = checked = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "node long, component long")
    for turn in range(pivot_rounds + 1):
        if turn:
            lists = lists.drop("component").join(labels, "node", "left")
            lists = lists.select("key", "node", "n", "place", F.coalesce("component", "node").alias("component"))
        else:
            lists = lists.withColumn("component", F.col("node"))
        mixed = lists.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        lists = stored(lists.join(mixed.select("key"), "key", "left_semi"), "lists")
        if lists.isEmpty():
            break
        if turn < pivot_rounds:
            pivot = F.min(F.struct("place", F.xxhash64("node").alias("rank"), "node", "n", "component"))
            against = lists.groupBy("key").agg(pivot.alias("p")).select(
                "key", F.col("p.node").alias("other"), F.col("p.n").alias("m"), F.col("p.place").alias("other_place"), F.col("p.component").alias("opposite")
            )
            near = lists
        else:
            length = lists.groupBy("key").agg(F.count("*").alias("members"))
            longest = stored(length.where(F.col("members") > LONGEST_PAIRED).select("key"), "long-lists")
            if not longest.isEmpty():
                hot = lists.join(longest, "key", "left_semi").select("key", "node")
                links = stored(links.unionByName(linked_in_cells(hot, sets)), "similar")
                lists = lists.join(longest, "key", "left_anti")
            shares = lists.groupBy("key", "component").agg(F.count("*").alias("share"))
            largest = shares.groupBy("key").agg(F.max(F.struct("share", "component")).alias("top"))
            against = (
                lists.join(largest, "key")
                .where(F.col("component") != F.col("top.component"))
                .select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("place").alias("other_place"), F.col("component").alias("opposite"))
            )
            near = lists
        pairs = near.join(against, "key").where((F.col("component") != F.col("opposite")) & _fitting("n", "place", "m", "other_place"))
        pairs = stored(pairs.select(*_ordered("node", "other")).distinct().join(checked, ["a", "b"], "left_anti"), "pairs")
        links = stored(links.unionByName(similar(pairs, sets)), "similar")
        checked = checked.unionByName(pairs)
        labels = components(links, rounds=None if turn == pivot_rounds else 2)
        if turn < pivot_rounds:
            lists = lists.join(against.select("key", F.col("other").alias("node")), ["key", "node"], "left_anti")
    return components(links)


def grouped_documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``similar_documents`` with the ``digest`` of each row's set."""
    ship(docs.sparkSession)
    texts = texts_of(docs, id_column, text_column)
    known = stored(members(texts), "members")
    counted = stored(statistics(texts), "statistics")
    by_size = np.zeros((4, LARGEST_SMALL + 1), np.int64)
    for row in counted.where("kind > 0").collect():
        by_size[row.kind, row.value] = row.n
    keyed = keyed_sets(texts, known, common_bits(counted), boundary(*by_size[1:]))
    lists = shared_lists(keyed)
    linked = node_components(lists, candidate_sets(texts, keyed, lists))
    ids = keyed.select("digest", "node", "first_id").join(linked, "node", "left")
    ids = ids.select("digest", "first_id", F.coalesce("component", "node").alias("component"))
    lowest = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = ids.join(lowest, "component").select("digest", "component_id").distinct()
    # Without shingles each document stands alone: all share one digest, but no link.
    return known.join(by_digest, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "digest",
    )


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id reachable by links. Equal sets are linked; null and empty
    texts and those without words have no shingles and stand alone. A row without an id gets the
    component of an equal set, if there is one, else null. Rows that repeat are returned each.
    An empty table gives no rows.
    """
    return grouped_documents(docs, id_column, text_column).drop("digest")


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose id is the smallest of their component.

    A row goes by its id and its text: of an id that is used for several texts only those go that
    have a smaller id in their component. Rows without an id stay if they are equal to no document
    that has one; texts without words stay. Rows that repeat id and text stay or go together.
    """
    groups = stored(grouped_documents(docs, id_column, text_column).where("n_shingles > 0"), "components")
    own_id = docs[id_column].cast("long")
    gone = groups.where("doc_id <> component_id").select("doc_id", "digest").distinct()
    # Most ids stand for one text. The texts are looked at again only where that does not settle it.
    texts = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count_distinct("digest").alias("texts"))
    settled = stored(
        gone.join(texts, "doc_id").select(F.col("doc_id").alias("_gone"), (F.col("texts") == 1).alias("_alone")).distinct(), "gone"
    )
    kept = docs.join(settled.select("_gone"), own_id == F.col("_gone"), "left_anti").where(own_id.isNotNull())
    unsettled = docs.join(settled.where("NOT _alone").select("_gone"), own_id == F.col("_gone"), "left_semi")
    nameless = docs.where(own_id.isNull())

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(batch.schema.get_field_index(text_column)).cast(pa.string()).fill_null("")
        found = [s for _, s in sets_of(pa.RecordBatch.from_arrays([texts], names=["text"]))]
        # A text without words has no digest, as it is linked with nothing.
        digests = pa.array([digest_of(s) if len(s) else None for s in found], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, digests], names=[*batch.schema.names, "_digest"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_digest", T.BinaryType())])
    named = groups.where("doc_id IS NOT NULL").select(F.col("digest").alias("_digest")).distinct()
    if not settled.where("NOT _alone").isEmpty():
        marks = gone.select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_own"))
        again = by_batch(unsettled, work, schema)
        same = (again[id_column].cast("long") == marks["_gone"]) & (again["_digest"] == marks["_own"])
        kept = kept.unionByName(again.join(marks, same, "left_anti").select(*docs.columns))
    if not nameless.isEmpty():
        kept = kept.unionByName(by_batch(nameless, work, schema).join(named, "_digest", "left_anti").select(*docs.columns))
    return kept
