import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tests.llm.helpers import crowded, frame
from waybill.llm.damage import with_planted_runs
from waybill.llm.periods import (
    PRIME,
    inverse_transform,
    occurrences,
    periodic_runs,
    runs_of_texts,
    scales,
    squared_differences,
    transform,
)
from waybill.llm.queries import op11_periodic_run_detection


def runs_by_trial(words):
    """All runs, by trying every period at every place."""
    found = {}
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            if at + period - start >= max(24, 3 * period):
                found.setdefault((start, at + period), period)
            at += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def repetitive(draw):
    """Words with runs next to, in and across each other."""
    out = []
    while len(out) < draw.randint(0, 300):
        period = draw.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 50, 64])
        base = [draw.choice("abcdefgh" if draw.random() < 0.5 else "ab") for _ in range(period)]
        out += (base * 6)[: draw.randint(1, int(4.2 * period) + 5)] if period > 6 else (base * 60)[: draw.randint(1, 60)]
        if draw.random() < 0.3:
            out.append(draw.choice("xyzab"))
    return out


def test_transform_is_undone_and_differences_are_exact():
    draw = np.random.default_rng(1)
    rows = draw.integers(0, PRIME, (3, 64)).astype(np.uint64)
    assert (inverse_transform(transform(rows)) == rows).all()
    blocks, windows = draw.integers(0, 50, (5, 16)), draw.integers(0, 50, (5, 31))
    windows[2, 4:20] = blocks[2]
    got = squared_differences(blocks.astype(np.uint64), windows.astype(np.uint64))
    expected = [[((b - w[i : i + 16]) ** 2).sum() for i in range(16)] for b, w in zip(blocks, windows)]
    assert (got == np.array(expected)).all() and got[2, 4] == 0


def test_every_zero_is_found_at_every_scale():
    draw = random.Random(2)
    words = np.array([draw.randrange(2) for _ in range(200)] + [7] * 100, np.uint64)
    ahead = np.ones(300, np.int64)  # says nothing: every block is tried
    for size, least, most in scales(300):
        got = set(zip(*[a.tolist() for a in occurrences(words, ahead, size, least, most)]))
        expected = {
            (b, d)
            for b in range(0, 300 - size + 1, size)
            for d in range(least, most + 1)
            if b + d + size <= 300 and (words[b : b + size] == words[b + d : b + d + size]).all()
        }
        assert {(b, d) for b, d in got if b + d + size <= 300} == expected


def test_runs_against_trial_of_all_periods():
    draw = random.Random(11)
    texts = [repetitive(draw) for _ in range(250)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("ab") * 11 + ["a"], list("abc") * 8]
    got = runs_of_texts([[w.encode() for w in t] for t in texts])
    assert got == [runs_by_trial(t) for t in texts]
    assert sum(map(len, got)) > 200


def test_runs_do_not_cross_texts():
    assert runs_of_texts([[b"a"] * 20, [b"a"] * 20]) == [[], []]


@pytest.mark.parametrize("words", [[b"a"] * 200_000, [b"a", b"b"] * 100_000, ([b"a"] * 300 + [b"c"]) * 600])
def test_long_texts_take_little_time(words):
    start = time.perf_counter()
    (runs,) = runs_of_texts([words])
    assert (0, len(words)) in {(s, n) for s, n, _ in runs}
    assert time.perf_counter() - start < 60


def test_rows_with_nulls_ties_and_clashing_names(spark):
    again = "x\ty  x\r\ny " * 12
    rows = [(1, None), (2, ""), (3, again), (3, again), (None, again), (4, "  "), (5, "Y y " * 11), (6, "é" * 200_000)]
    got = sorted(map(tuple, periodic_runs(crowded(spark, rows)).collect()), key=repr)
    assert [(i, [tuple(r) for r in runs], c) for i, runs, c in got] == sorted(
        [(1, [], ""), (2, [], ""), (3, [(0, 48, 2)], "x y"), (3, [(0, 48, 2)], "x y"), (None, [(0, 48, 2)], "x y"),
         (4, [], ""), (5, [], " ".join(["Y y"] * 11)), (6, [], "é" * 200_000)], key=repr,
    )
    assert periodic_runs(frame(spark, [])).count() == 0


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_planted_runs(spark):
    draw = random.Random(4)
    rows = [(i, " \n".join(f"w{draw.randrange(900)}" for _ in range(draw.choice([0, 1, 5, 80, 300])))) for i in range(-20, 180)]
    rows += [(1000, None), (None, "a  b")]
    got = {r.doc_id: r.text.split() for r in with_planted_runs(frame(spark, rows)).collect()}
    assert got == {i: planted(i, t) if i is not None else ["a", "b"] for i, t in rows}


def test_query_against_plain_python(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i, " ".join(repetitive(draw))) for i in range(150)]
    rows += [(200 + i, " ".join(f"w{draw.randrange(9000)}" for _ in range(120))) for i in range(150)] + [(900, None), (901, "one")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_periodic_run_detection(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = runs_by_trial(words)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept(words, runs).encode()).hexdigest()
