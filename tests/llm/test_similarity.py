import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import Texts, components, crowded, frame, repeated, shingles, words_of
from waybill.llm import contamination
from waybill.llm.contamination import blocks_of, contained_items, without_items
from waybill.llm.frames import by_batch
from waybill.llm.graph import components as linked
from waybill.llm.jaccard import boundary, keyed_sets, members, node_components, one_of_each_group, shared_lists, similar_documents
from waybill.llm.neighbours import neighbours
from waybill.llm.passages import compact_windows, dense_runs, joined_windows, near_repeated_passages, shared_windows, similar_runs, sliding, tree_nodes
from waybill.llm.suffixes import minimisers, repeated_passages
from waybill.llm.words import Words, utf8, words_of as batch_words

ODD = [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "few words"), (9005, "Few  words"), (9006, None)]


def near_copies(seed: int) -> list[tuple]:
    """Groups of near copies (small and large sets), one of them big, and texts sharing a common passage."""
    texts, rows = Texts(seed), list(ODD)
    common = texts.make(60)
    for size in (6, 9, 12, 20, 40, 64, 90, 300):
        for _ in range(4):
            base = texts.make(size)
            for copy in range(texts.random.randint(1, 5)):
                rows.append((len(rows), " ".join(texts.edited(base, copy // 2 * max(1, size // 60)))))
    base = texts.make(200)
    rows += [(1000 + i, " ".join(texts.edited(base, 3))) for i in range(60)] + [(1100 + i, " ".join(base)) for i in range(30)]
    rows += [(2000 + i, " ".join(texts.make(120) + common)) for i in range(40)]
    rows += [(3000, "a b c d"), (3001, "A b c d"), (3002, "z " * 400), (3003, "z " * 300), (3004, "É é x y z w"), (3005, "é é x y z w")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_documents_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    got = {r.doc_id: r for r in similar_documents(crowded(spark, rows)).collect()}
    expected = components(rows)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}
    kept = one_of_each_group(crowded(spark, rows))
    assert kept.columns == crowded(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


@pytest.mark.parametrize("small_below", [4, 20, 64])
def test_no_boundary_and_no_order_loses_links(spark, small_below):
    rows = near_copies(3)
    texts = frame(spark, rows).fillna("", ["text"])
    known = members(texts)
    first = {r.digest: r.doc_id for r in sorted(known.collect(), key=lambda r: -r.doc_id)}
    for common in (np.zeros(1 << 23, np.uint8), np.random.Generator(np.random.PCG64(1)).integers(0, 256, 1 << 23, dtype=np.uint8)):
        keyed = keyed_sets(texts, known, common, small_below)
        from waybill.llm.jaccard import candidate_sets

        lists = shared_lists(keyed)
        found = node_components(lists, candidate_sets(texts, keyed, lists), pivot_rounds=1)
        number = {r.node: r.first_id for r in keyed.collect()}
        groups = {}
        for r in found.collect():
            groups.setdefault(r.component, []).append(number[r.node])
        expected = components([(i, t) for i, t in rows if i in first.values()])
        want = {}
        for i, c in expected.items():
            want.setdefault(c, []).append(i)
        assert sorted(sorted(g) for g in groups.values() if len(g) > 1) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def near_threshold(count, seed=9):
    """Edited versions of one text, most pairs of which are a little less similar than it takes."""
    texts = Texts(seed)
    base = texts.make(90)
    return [(i, " ".join(texts.edited(base, texts.random.randint(0, 5)))) for i in range(count)]


@pytest.mark.parametrize("longest", [8, 10_000])
def test_long_lists_are_compared_in_cells(spark, monkeypatch, longest):
    from waybill.llm import jaccard

    monkeypatch.setattr(jaccard, "LONGEST_PAIRED", longest)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 30)
    rows = near_threshold(160) + [(1000 + i, " ".join(Texts(50 + i).make(40))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in similar_documents(frame(spark, rows)).collect()}
    assert got == components(rows)
    assert 1 < len(set(got.values())) < 180


def test_a_cell_of_two_blocks(monkeypatch):
    from waybill.llm import jaccard

    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[draw.random(60) < 0.93], draw.integers(0, 2**63, draw.integers(0, 8), dtype=np.uint64)])) for _ in range(40)]

    def expected(pairs):
        label = list(range(40))
        for i, j in pairs:
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
        return label

    every = [(i, j) for i in range(40) for j in range(i)]
    assert jaccard._linked_in_cell(sets, None).tolist() == expected(every)
    across = [(i, j) for i in range(15) for j in range(15, 40)]
    assert jaccard._linked_in_cell(sets[:15], sets[15:]).tolist() == expected(across)
    assert len(set(expected(every))) > 1


def test_an_id_used_for_two_texts_loses_the_copy_alone(spark):
    a, u, z = (" ".join(Texts(60 + i).make(30)) for i in range(3))
    rows = [(3, a), (5, a), (5, u), (9, z), (9, z), (None, z), (None, "of its own words here now"), (10, ""), (5, None)]
    kept = sorted(((r.doc_id or 0, r.text or "") for r in one_of_each_group(crowded(spark, rows)).collect()))
    assert kept == sorted([(3, a), (5, u), (9, z), (9, z), (0, "of its own words here now"), (10, ""), (5, "")])


def test_boundary_follows_the_cost():
    sets = np.full(65, 10)
    assert boundary(sets, np.zeros(65), np.zeros(65)) == 4
    assert boundary(sets, np.full(65, 10), np.full(65, 10**6)) == 64


def test_rows_without_id_and_repeated_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (5, text), (5, "quite another text of seven words here"), (None, "alone in the world with no id"), (5, text)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(frame(spark, rows)).collect()}
    assert {(5, 3, 5), (None, 3, 5), (None, 3, None)} == got
    assert sorted((r.doc_id or 0) for r in one_of_each_group(frame(spark, rows)).collect()) == [0, 5, 5, 5]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in linked(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    early = {r.node: r.component for r in linked(links, rounds=1).collect()}
    assert all((early[a] < 50) == (a < 50) for a in early)


def leaks(seed: int):
    texts = Texts(seed)
    items = [(i, " ".join(texts.make(texts.random.randint(5, 60)))) for i in range(30)] + [(90, None), (91, ""), (92, "short one"), (None, "no id but with six words")]
    rows = list(ODD) + [(i, " ".join(texts.make(300))) for i in range(100)]
    for i in range(60):
        words = texts.make(texts.random.choice([0, 20, 2000]))
        at = texts.random.randint(0, len(words))
        item = items[i % 30][1].split()
        item = item[texts.random.choice([0, 0, len(item) // 4]) :]
        rows.append((500 + i, " ".join(words[:at] + item + words[at:])))
    return rows + [(800, items[3][1].upper() + " " + items[4][1]), (801, "Short one"), (802, "a short one b c")], items


def expected_leaks(rows, items):
    out = set()
    for i, text in rows:
        own = shingles(text)
        for n, item in items:
            mine = shingles(item)
            if mine and 100 * len(mine & own) >= 80 * len(mine):
                out.add((i, n, len(mine & own)))
    return out


def test_contained_items_equal_brute_force(spark, monkeypatch):
    rows, items = leaks(7)
    docs, bench = crowded(spark, rows), frame(spark, items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    expected = expected_leaks(rows, items)
    assert len(expected) > 40
    assert {(r.doc_id, r.item_id, r.shared) for r in contained_items(docs, bench).collect()} == expected
    monkeypatch.setattr(contamination.blocks_of, "__defaults__", (400,))
    assert len(list(blocks_of(bench, "item_id", "text"))) > 3
    assert {(r.doc_id, r.item_id, r.shared) for r in contained_items(docs, bench).collect()} == expected
    clean = without_items(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _, _ in expected}


def test_no_items(spark):
    docs, none = frame(spark, [(1, "a b c d e f")]), frame(spark, [], "item_id long, text string")
    assert contained_items(docs, none).isEmpty() and without_items(docs, none).count() == 1
    assert contained_items(frame(spark, []), none).isEmpty()


def passages(seed: int):
    """Texts that share passages of 20 to 200 words, whole copies, and clean ones."""
    texts, rows = Texts(seed), list(ODD)
    shared = [texts.make(n) for n in (20, 45, 50, 51, 60, 61, 80, 120, 200)]
    for i in range(120):
        words = texts.make(texts.random.choice([0, 30, 400]))
        if i % 3 == 0:
            at = texts.random.randint(0, len(words))
            words[at:at] = texts.random.choice(shared)
        rows.append((i, " ".join(words)))
    copy = " ".join(texts.make(700))
    rows += [(500 + i, " ".join(texts.make(30) + shared[6] + texts.make(20))) for i in range(80)] + [(700, copy), (701, copy)]
    return rows + [(800, "echo " * 5000), (801, " ".join(texts.make(100) * 4))]


def covered(rows):
    out = {}
    for r in rows:
        assert r.end - r.start == r.words >= 50
        out.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages_equal_brute_force(spark, seed):
    rows = passages(seed)
    spans = repeated_passages(crowded(spark, rows)).collect()
    got, expected = covered(spans), repeated(rows)
    assert set(got) == set(expected)
    # A word more that two texts share by chance, beside a passage that others share too, may be missed.
    assert all(got[i] <= expected[i] and len(expected[i] - got[i]) <= 2 for i in got)
    firsts = [r.doc_id for r in spans if r.first]
    assert 700 in firsts and 701 not in firsts


@pytest.mark.parametrize("size", [50, 55, 60])
def test_one_first_in_a_large_group(spark, size):
    texts = Texts(size)
    shared = texts.make(size)
    rows = [(i, " ".join(texts.make(20) + shared + texts.make(80))) for i in range(1000)]
    spans = repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in spans} == set(range(1000))
    assert [r.doc_id for r in spans if r.first] == [0]


def test_all_places_of_a_passage_are_found(spark):
    texts = Texts(31)
    shared, longer = texts.make(52), texts.make(45)
    rows = [
        (1, " ".join(texts.make(30) + shared + texts.make(20) + shared + longer + texts.make(10) + shared)),
        (2, " ".join(texts.make(7) + shared + longer + texts.make(9))),
    ]
    assert covered(repeated_passages(frame(spark, rows)).collect()) == repeated(rows)


def test_minimisers_depend_on_content_alone():
    texts = Texts(3)
    passage = texts.make(80)
    found = []
    for before in (0, 7, 100):
        text = " ".join(texts.make(before) + passage + texts.make(5)).encode()
        data = np.frombuffer(text, np.uint8)
        at = minimisers(Words(data, np.array([0, len(data)]))) - before
        found.append([p for p in at.tolist() if 15 <= p < 60])
        assert np.diff(at).max() <= 11
    assert found[0] == found[1] == found[2] and found[0]


@pytest.mark.parametrize("reach", [1, 3])
def test_neighbours_across_partitions(spark, reach):
    rows = [(k, i) for i, k in enumerate([1] * 40 + [2] * 3 + [3] + [4] * 20)]
    table = spark.createDataFrame(rows, "key long, id long").repartition(4)
    got = {(r.a_id, r.b_id) for r in neighbours(table, ["key", "id"], "pairs", reach).collect()}
    assert got == {(a, b) for k, a in rows for m, b in rows if k == m and 0 < b - a <= reach}


def test_tree_nodes_equal_the_definition():
    random = np.random.Generator(np.random.PCG64(5))
    for upper in (5, 10**6):
        hashes = random.integers(1, upper, 90, dtype=np.uint64)
        first = np.array([0, 50, 52, 90])
        got = set(zip(*(x.tolist() for x in tree_nodes(hashes, first, 8))))
        expected = set()

        def divide(low, high):
            if high - low + 1 >= 8:
                centre = low + int(hashes[low : high + 1].argmin())
                expected.add((low, centre, high))
                divide(low, centre - 1)
                divide(centre + 1, high)

        for a, b in zip(first, first[1:]):
            divide(int(a), int(b) - 1)
        assert got == expected
    values = random.integers(0, 99, 40, dtype=np.uint64)
    assert sliding(values, 7, np.minimum).tolist() == [values[i : i + 7].min() for i in range(34)]


def test_runs():
    marked = np.array([0] * 5 + [1] * 60 + [0] * 30 + [1] * 20 + [0] + [1] * 30, bool)
    assert sorted(dense_runs(marked, 46, 4)) == [(5, 65), (95, 146)]
    x = np.arange(300, dtype=np.uint64)
    y = np.concatenate([np.arange(1000, 1040), np.arange(100, 180), [7777], np.arange(181, 200)]).astype(np.uint64)
    assert list(similar_runs(x, y, 46)) == [(100, 200, 40, 140)]


def test_near_repeated_passages(spark):
    texts, rows = Texts(21), list(ODD)
    expected, clean = set(), set()
    for i in range(0, 60, 2):
        passage = texts.make(120)
        for doc, edits in ((i, 0), (i + 1, i % 3)):
            rows.append((doc, " ".join(texts.make(50) + texts.edited(passage, edits) + texts.make(200))))
            expected.add(doc)
    for i in range(100, 140):
        rows.append((i, " ".join(texts.make(200))))
        clean.add(i)
    shared = texts.make(70)
    rows += [(300 + i, " ".join(texts.make(10) + shared + texts.make(10))) for i in range(50)]
    got = covered(near_repeated_passages(crowded(spark, rows)).collect())
    assert not set(got) & clean and set(range(300, 350)) <= set(got)
    assert len(expected & set(got)) >= 0.95 * len(expected)
    exact = {i for i in range(0, 60, 2) if i % 3 == 0}
    assert all(set(range(50, 170)) <= got[i] for i in exact)


def test_partners_far_apart_in_a_large_group(spark):
    texts = Texts(51)
    base, rows = texts.make(80), []
    families = [texts.edited(base, 6) for _ in range(100)]
    for copy in range(2):
        for i, family in enumerate(families):
            rows.append((100 * copy + i, " ".join(texts.make(30) + texts.edited(family, copy) + texts.make(30))))
    runs = {i: shingles(" ".join(t.split()[30:110])) for i, t in rows}
    near = {i: [k for k in runs if k != i and 100 * len(runs[i] & runs[k]) >= 80 * len(runs[i] | runs[k])] for i in runs}
    expected = {i for i in runs if near[i]}
    spans = near_repeated_passages(frame(spark, rows)).collect()
    assert len(expected) > 150 and len(expected - {r.doc_id for r in spans}) <= 0.03 * len(expected)
    later = {i for i in expected if min(near[i]) < i}
    assert len(later & {r.doc_id for r in spans if r.first}) <= 0.03 * len(later)


def near_words(rows: list[tuple], least: int = 46) -> dict:
    """Words in windows of ``least`` shingles similar to one of another document, by brute force."""
    found = {}
    runs = {i: [tuple(words_of(t)[k : k + 5]) for k in range(len(words_of(t)) - 4)] for i, t in rows}
    for a, x in runs.items():
        for b, y in runs.items():
            for i in range(len(x) - least + 1) if a != b else ():
                one = set(x[i : i + least])
                for k in range(len(y) - least + 1):
                    both = len(one & set(y[k : k + least]))
                    if 100 * both >= 80 * (len(one) + len(set(y[k : k + least])) - both):
                        found.setdefault(a, set()).update(range(i, i + least + 4))
                        break
    return found


@pytest.mark.parametrize("paired", [64, 1])
def test_near_repeated_spans_equal_brute_force(spark, monkeypatch, paired):
    """A passage that stands twice in a text, first with few and then with more of the common words, repeated
    lines, an inserted word; in pairs and in cells."""
    monkeypatch.setattr("waybill.llm.passages.PAIRED", paired)
    texts = Texts(77)
    passage, line, other = texts.make(60), texts.make(7), texts.make(55)
    rows = [
        (1, texts.make(9) + passage + texts.make(9)),
        (2, passage[:52] + texts.make(8) + passage + texts.make(5)),
        (3, texts.make(3) + passage[:30] + ["inserted"] + passage[30:] + texts.make(4)),
        (4, line * 12 + texts.make(6)),
        (5, texts.make(8) + line * 9),
        (6, texts.make(4) + other[:20] + ["changed"] + other[21:] + texts.make(4)),
        (7, other),
        (8, other),
        (9, texts.make(90)),
    ]
    rows = [(i, " ".join(w)) for i, w in rows]
    spans = near_repeated_passages(frame(spark, rows)).collect()
    got, expected = covered(spans), near_words(rows)
    # Longer runs may hold some words more.
    assert got.keys() == expected.keys() and all(expected[i] <= set(got[i]) for i in got)
    assert all(len(set(got[i]) - expected[i]) <= 10 for i in got)
    assert {r.doc_id for r in spans if r.first} <= {1, 4, 6}


def test_large_groups_are_dealt_out_without_what_has_no_partner(spark, monkeypatch):
    """A line in many texts with nothing in common around it, a passage nearly repeated in some: the same spans as
    from one cell a group, whatever the number of blocks and rounds."""
    from waybill.llm import passages

    texts = Texts(83)
    line, passage = texts.make(14), texts.make(55)
    rows = [texts.make(50) + line + texts.make(50) for _ in range(60)]
    rows += [texts.make(30) + texts.edited(passage, i % 3) + line + texts.make(30) for i in range(30)]
    docs = frame(spark, [(i, " ".join(words)) for i, words in enumerate(rows)])
    monkeypatch.setattr(passages, "PAIRED", 1)
    expected = sorted(near_repeated_passages(docs).collect())
    near = {r.doc_id for r in expected}
    assert near <= set(range(60, 90)) and len(near) > 20
    counts, stored = {}, passages.stored

    def counting(table, label):
        out = stored(table, label)
        counts.setdefault(label, []).append((out.count(), out))
        return out

    monkeypatch.setattr(passages, "stored", counting)
    monkeypatch.setattr(passages, "BLOCK", 4)
    monkeypatch.setattr(passages, "SENT_BYTES", 1)
    assert sorted(near_repeated_passages(docs).collect()) == expected
    ((_, left),), ((chosen, _),) = counts["partnered"], counts["compared-classes"]
    assert {r.doc_id for r in left.collect()} <= set(range(60, 90))
    assert 0 < left.count() < chosen and len(counts["similar-in-cells"]) > 1


def test_near_repeated_spans_of_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("waybill.llm.passages.PAIRED", 1)
    monkeypatch.setattr("waybill.llm.passages.BLOCK", 1)
    monkeypatch.setattr("waybill.llm.passages.SENT_BYTES", 1)
    texts = Texts(78)
    passage, line = texts.make(56), texts.make(7)
    rows = [
        (1, texts.make(9) + passage + texts.make(9)),
        (2, passage[:30] + ["inserted"] + passage[30:] + texts.make(4)),
        (3, line * 12 + texts.make(6)),
        (4, texts.make(8) + line * 9),
        (5, passage[:20] + texts.make(40)),
        (6, line + texts.make(60)),
    ]
    rows = [(i, " ".join(w)) for i, w in rows]
    got, expected = covered(near_repeated_passages(frame(spark, rows)).collect()), near_words(rows)
    assert got.keys() == expected.keys() == {1, 2, 3, 4} and all(expected[i] <= set(got[i]) for i in got)


def test_passages_give_their_shuffle_files_back(spark):
    """Once the steps are stored, the disk holds neither their shuffle files nor the stretches' shingles."""
    import time

    from waybill.llm.frames import FREED
    from waybill.storage import SharedFiles, shared_root

    texts = Texts(91)
    passage = texts.make(80)
    docs = frame(spark, [(i, " ".join(texts.make(20) + texts.edited(passage, i % 2) + texts.make(20))) for i in range(90)])

    def on_disk():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    def folders():
        return {f.name for f in SharedFiles(spark).children(f"{shared_root(spark)}/waybill")}

    before, stored_before, setting = on_disk(), folders(), spark.conf.get(FREED, None)
    found = near_repeated_passages(docs)
    until = time.time() + 20
    while (left := on_disk() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(FREED, None) == setting
    assert not [f for f in folders() - stored_before if f.startswith(("stretches-", "compared-stretches-"))]
    assert found.count() == found.count() == 90


def test_words_of_batches_and_null(spark):
    import pyarrow as pa

    texts = [None, "", "A b\x0bc", " é  É ", "x" * 100]
    out = [len(w.hashes[w.first[i] : w.first[i + 1]]) for _, w in batch_words(pa.array(texts), 8) for i in range(len(w))]
    assert out == [len(words_of(t)) for t in texts]
    sliced = pa.array(["skipped", None, "kept"]).slice(1)
    data, offsets = utf8(sliced)
    assert bytes(data) == b"kept" and offsets.tolist() == [0, 0, 4]


@pytest.mark.parametrize("operator", [similar_documents, repeated_passages, near_repeated_passages, one_of_each_group])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_words_of_a_large_batch_take_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    from waybill.llm import words

    draw = np.random.Generator(np.random.PCG64(5))
    texts = pa.array([" ".join(map(str, draw.integers(0, 10**6, 300).tolist())) for _ in range(3000)], pa.string())
    words._powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    tracemalloc.start()
    for _ in batch_words(texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20


def test_pairs_compared_together_equal_one_by_one(monkeypatch):
    from waybill.llm import passages

    texts, pairs = Texts(91), []
    line = texts.make(7)
    for i in range(60):
        base = texts.make(40 + 3 * i)
        one = texts.make(i) + texts.edited(base, i % 7) + texts.make(5)
        other = texts.make(9) + texts.edited(base[: 30 + i], i % 4) + texts.make(3) + base[10 + i :]
        if i % 5 == 0:
            one, other = one + line * 9, line * 4 + other + line * 8
        pairs.append((one, other))
    numbers = {}
    xs, ys = ([np.array([numbers.setdefault(tuple(w[k : k + 5]), len(numbers)) for k in range(len(w) - 4)], np.uint64) for w in side] for side in zip(*pairs))
    alone = []
    slowly = passages.similar_places
    monkeypatch.setattr(passages, "similar_places", lambda x, y, least: alone.append(1) or slowly(x, y, least))
    for (x, y), got in zip(zip(xs, ys), passages.places_of_pairs(xs, ys, 46)):
        expected = slowly(x, y, 46)
        assert np.array_equal(got[0], expected[0]) and np.array_equal(got[1], expected[1])
    assert len(alone) < 6


def test_few_shingles_over_and_over_are_compared_as_sets(monkeypatch):
    from waybill.llm import passages

    texts = Texts(92)
    line, other = texts.make(7), texts.make(11)
    rows = [(1, line * 120 + texts.make(50)), (2, texts.make(9) + (line[:5] + ["x"]) * 3 + line * 40 + other * 5), (3, other * 30 + line * 3)]
    runs = [[hash(tuple(w[k : k + 5])) % 2**63 for k in range(len(w) - 4)] for _, w in rows]
    found = near_words([(i, " ".join(w)) for i, w in rows[:2]])
    monkeypatch.setattr(passages, "_matches", None)  # places are not paired
    got = passages.similar_windows(*[np.array(r, np.uint64) for r in runs[:2]], 46)
    for (doc, words), held in zip(rows, got):
        places = {i + k for i in np.flatnonzero(held).tolist() for k in range(5)}
        assert places == found[doc]


def test_a_task_gives_its_memory_back():
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

    above = []

    def work(batch):
        held = [np.ones(1 << 13) for _ in range(4000)]  # 262 MB in small pieces
        above.append(held[-1])  # stays above the others
        yield pa.RecordBatch.from_arrays([pa.array([len(held)])], names=["n"])

    before = resident()
    rows = list(by_batch(Frame(), work, "n long")(iter([pa.RecordBatch.from_arrays([pa.array([1])], names=["n"])])))
    assert rows[0].column("n").to_pylist() == [4000]
    assert resident() - before < 100


def test_windows_of_a_run_are_one_stretch(spark):
    texts = Texts(31)
    rows = [(i, " ".join([*texts.make(30), *["to"] * (60 + i), *texts.make(60)])) for i in range(1, 6)]
    windows = shared_windows(compact_windows(frame(spark, rows), 46, 6))
    joined = [tuple(r) for r in joined_windows(windows, 46).select("key", "doc_id", "low", "high").collect()]
    single = [tuple(r) for r in windows.select("key", "doc_id", "low", "high").collect()]
    assert len(single) > 2 * len(joined), (len(single), len(joined))
    assert all(any(k == key and d == doc and low <= a and b <= high for k, d, low, high in joined) for key, doc, a, b in single)
    assert max(high - low for *_, low, high in joined) < 3 * 46
