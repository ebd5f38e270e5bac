import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import Texts, crowded, frame
from waybill.llm.exact import _by_text, exact_groups, without_copies
from waybill.llm.packing import CAPACITY, Encoder, cuts, encoder, pack, packing_plan, token_pieces
from waybill.llm.shard import place_of, row_at, shard_rows, walk


def test_exact_groups_with_ties_nulls_and_copies(spark):
    rows = [(i, "same") for i in range(60)] + [(100, None), (101, ""), (102, "Same"), (103, "same "), (None, "same")]
    rows += [(200, "twice"), (200, "twice"), (None, "no id"), (None, "no id"), (300, "x" * 300_000)]
    got = exact_groups(crowded(spark, rows)).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(list)
    for i, text in rows:
        by_text[text or ""].append(i)
    for text, ids in by_text.items():
        mine = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in mine) == sorted((i is None, i or 0) for i in ids)
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [keep]


def test_texts_with_one_digest_are_told_apart(spark):
    rows = frame(spark, [(1, "a"), (2, "b"), (3, "a")]).withColumn("digest", F.lit(b"d")).withColumn("salt", F.lit(0))
    got = {(r.doc_id, r.keep_id, r.group_size) for r in _by_text(rows).collect()}
    assert got == {(1, 3, 2), (3, 3, 2), (2, 2, 1)}


def test_without_copies_keeps_columns_and_one_row_each(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "c"), (None, "c"), (None, "a")]
    kept = without_copies(crowded(spark, rows))
    assert kept.columns == crowded(spark, rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "c"), (2, "a"), (4, ""), (5, "b")]


@pytest.mark.parametrize("count", [1, 2, 3, 16, 17, 1000])
def test_walk_is_a_permutation_that_can_be_undone(count):
    places = walk(np.arange(count), count, 3)
    assert sorted(places) == list(range(count))
    for row in range(0, count, 7):
        shard, slot = place_of(row, count, 4, 3)
        assert row_at(shard, slot, count, 4, 3) == row


def test_shards_are_even_and_gapless(spark):
    rows = [(i, f"text {i}") for i in range(500)] + [(7, "again")] * 40 + [(None, None), (None, "")]
    got = shard_rows(crowded(spark, rows), 16).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == len(rows) and sizes.max() - sizes.min() <= 1 and len(sizes) == 16
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    again = shard_rows(frame(spark, rows).repartition(5), 16).toPandas()
    order = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert got[order].sort_values(order).to_numpy(na_value=-1).tolist() == again[order].sort_values(order).to_numpy(na_value=-1).tolist()
    row = got[got.doc_id == 3].iloc[0]
    assert (row["size"], row.text_crc32) == (7, zlib.crc32(b"text 3"))


def test_shuffle_mixes_neighbours(spark):
    got = shard_rows(frame(spark, [(i, "t") for i in range(4000)]), 4).toPandas().sort_values("doc_id")
    assert got.shard.diff().eq(0).mean() < 0.4


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TRICKY = [
    "", " ", "  two  blanks ", "end ", "it's we'll 'tis", "tabs\tand\nlines\n\n\nmore", "<|endoftext|> a <|endoftext|>",
    "日本語 текст ñ é 🙂🙂", "a b 　c", "x" * 5000, "12 345,67 ... !!! ?", "\u0000 null", "don' t I'm", " lead", "\r\n mixed \r",
]


def test_encoder_gives_the_ids_of_tokenizers(reference):
    encode = encoder("byte_bpe_50k").encode
    texts = TRICKY + [" ".join(Texts(4).make(50)) for _ in range(20)]
    for text in texts + texts:  # the second time from memory
        ids = reference.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == ids, text
    assert isinstance(encoder("byte_bpe_50k"), Encoder)


def test_cuts():
    assert cuts(5, 10) == [(0, 5)] and cuts(10, 10) == [(0, 10)] and cuts(21, 10) == [(0, 1), (1, 10), (11, 10)]


def test_packing_places_every_piece_once(spark, reference):
    texts = Texts(5)
    rows = [(i, " ".join(texts.make(texts.random.choice([1, 5, 60, 300, 900, 3000])))) for i in range(150)]
    rows += [(900 + i, t) for i, t in enumerate(TRICKY)] + [(1, None), (1, None), (None, "no id"), (950, "hot")] + [(951, "hot")] * 9
    got = pack(crowded(spark, rows)).toPandas()
    expected = defaultdict(int)
    for i, text in rows:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, (start, length) in enumerate(cuts(len(ids), CAPACITY)):
            expected[i, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    found = defaultdict(int)
    for r in got.itertuples():
        found[None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32] += 1
    assert found == expected
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum()[:-1]] and part.length.sum() <= CAPACITY
    # No packing needs fewer: pieces of over half a sequence never share one.
    least = max(-(-got.length.sum() // CAPACITY), (got.length > CAPACITY // 2).sum())
    assert got.sequence_id.nunique() <= least + 1
    with_ids = token_pieces(frame(spark, rows[:3]), with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length for r in with_ids)


def test_two_documents_replace_the_smallest():
    # Greedy fills 10 with 6 + 3; of the unpacked 2s two fit the place of 3 and the gap exactly.
    plan = packing_plan({6: 1, 3: 1, 2: 2}, 10)
    first = {(r.length, r.rows) for r in plan.runs if r.sequence == 0}
    assert first in ({(6, 1), (2, 2)}, {(6, 1), (3, 1)}) and plan.sequences == 2
    counts = {n: 40 for n in range(1, 200)}
    plan = packing_plan(counts, 256)
    assert sum(r.rows for r in plan.runs) == sum(counts.values())
    assert plan.sequences <= 1.01 * sum(n * c for n, c in counts.items()) / 256 + 1


@pytest.mark.parametrize("operator", [exact_groups, shard_rows, pack, without_copies])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0
