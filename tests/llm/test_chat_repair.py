import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm.chat import END, formatted_conversations, learnt_texts, read_back
from waybill.llm.damage import damaged_conversations
from waybill.llm.repair import Tables, repair_digests, repair_plan, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string"
MARKED = r"\### Assistant: </turn> ok"
NASTY = [
    "", " ", "plain text", MARKED, "### ", "</turn>", "\n</turn>\n### User: x\n</turn>\n", "\\", "\\\\", "a\\", "#### #\\### ",
    "</turn></turn>\\</turn>\\\\</turn>", "##", "# </tur", "$1 \\1 ${x}", "é🙂\u0000日本", "\n", "line\r\n", "=%41",
]
ROLES = ["system", "user", "assistant", "User", "", "tool: x", "### a\n", "=", "=User", "ü", "user "]


def crowded(spark, rows, schema=SCHEMA):
    names = "head body piece source formatted mask turns loss digest kind fault seen present number known place is_row audit cost found own_id"
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"'x' AS {n}" for n in names.split()])


def by_turn(rows, last=lambda r: r[2:]):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    key = lambda r: (r[1] is not None, r[1] or 0, *last(r))
    return {c: sorted(g, key=key) for c, g in groups.items()}


# --- chat ------------------------------------------------------------------------------


def test_formatted_conversations_are_read_back(spark):
    draw = random.Random(3)
    rows = [(n // 4, n % 4, draw.choice(ROLES), draw.choice(NASTY) + draw.choice(NASTY)) for n in range(400)]
    rows += [(900, None, None, None), (900, 1, "user", "x"), (None, 0, "assistant", "no id"), (901, 0, "user", "twice"), (901, 0, "user", "twice")]
    frame = formatted_conversations(crowded(spark, rows).repartition(7))
    got = frame.select(
        "conv_id", "formatted", "mask", read_back(F.col("formatted")).alias("turns"),
        learnt_texts(F.col("formatted"), F.col("mask")).alias("learnt"),
    ).collect()
    expected = by_turn([(c, t, r or "", x or "") for c, t, r, x in rows])
    assert len(got) == len(expected)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in expected[r.conv_id]]
        assert "".join(r.learnt) == "".join(x[3] for x in expected[r.conv_id] if x[2] == "assistant")
        # The mask covers the whole output.
        assert sum(m.head + m.body + len(END) for m in r.mask) == len(r.formatted)


def test_texts_without_marks_stay_as_they_are(spark):
    rows = [(1, 0, "user", "a \\ b # c"), (1, 1, "assistant", "d"), (2, 0, "user", "x ### y")]
    got = {r.conv_id: r.formatted for r in formatted_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == "### User: a \\ b # c\n</turn>\n### Assistant: d\n</turn>\n"
    assert got[2] == "### User: x \\### y\n</turn>\n"


def test_very_long_texts_are_formatted_in_time(spark):
    rows = [(n, 0, "assistant", t * (1_000_000 // len(t))) for n, t in enumerate(["\\", "### ", "</turn>", "#", "a "])]
    frame = formatted_conversations(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r.learnt[0] for r in frame.select("conv_id", learnt_texts(F.col("formatted"), F.col("mask")).alias("learnt")).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert formatted_conversations(empty).count() == 0
    assert repair_digests(empty).count() == 0


# --- repair ----------------------------------------------------------------------------


def cheapest(symbols):
    """(cost, letters) by searching all ways, least cost and least letters first."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, letters, at, last = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(symbols) and last in ("", "a"):
            return cost, letters
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, letters + "I", at, new))
        if at < len(symbols):
            initial, fault = symbols[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, last))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial == new or (initial == "s" and last == ""):
                    heapq.heappush(heap, (cost + extra, letters + "K", at + 1, initial))
                heapq.heappush(heap, (cost + 2 + extra, letters + "R", at + 1, new))


def judged(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        fault = ""
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            fault = "truncated"
        seen.add((role, text))
        out.append((role[:1] if role[:1] in ("s", "u", "a") else "o", fault))
    return out


def repaired(rows, letters):
    out, last, at = [], "", 0
    for letter in letters:
        new = "assistant" if last == "u" else "user"
        role, text = rows[at][2:] if letter != "I" else (None, "")
        at += letter != "I"
        if letter == "D":
            continue
        out.append((role if letter == "K" else new, text))
        last = out[-1][0][:1]
    return out


def expected_repair(rows, ids):
    groups = by_turn(
        [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows],
        lambda r: (r[2], hashlib.sha256(r[3].encode()).digest()),
    )
    out = {}
    for c in ids | set(groups):
        own = groups.get(c, [])
        symbols = judged(own)
        cost, letters = cheapest(symbols)
        turns = [r[1] for r in own if r[1] is not None]
        faults = [sum(f == name for _, f in symbols) for name in ("blank", "duplicate", "truncated")]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        lines = repaired(own, letters)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = ((gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, digest), lines)
    return out


def random_rows(seed, conversations=150, longest=24):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "no", "Why? ", " ", "", None, "Fine!\n", "a.b", "same.", " ", "x　."]
    rows = []
    for c in range(conversations):
        for t in range(draw.randint(0, longest)):
            turn = draw.choice([t, t, t, t + 1, None, 2 * t])
            text = draw.choice([*texts, f"text {t}.", f"text {t}?", f"open {t}", f"more {t}!"])
            rows.append((c if draw.random() > 0.02 else None, turn, draw.choice(roles), text))
    return rows


def test_tables_find_the_cheapest_and_least_edits():
    draw = random.Random(5)
    names = [(k, f) for k in "suao" for f in ("", "truncated")]
    for block in (1, 2, 4):
        tables = Tables(block)
        assert len(tables.vectors) < 100
        for _ in range(300):
            numbers = [draw.randrange(9) for _ in range(draw.randint(0, 15))]
            symbols = [names[n - 1] if n else ("u", "blank") for n in numbers]
            assert tables.repair(np.array(numbers, np.int64)) == cheapest(symbols), numbers


def test_repair_against_a_search_of_all_ways(spark):
    rows = random_rows(7)
    ids = set(range(150)) | {5000}
    named = spark.createDataFrame([(c,) for c in ids], "conv_id long")
    frame = crowded(spark, rows).repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in repair_digests(frame, named).collect()}
    expected = expected_repair(rows, ids)
    assert got == {c: e for c, (e, _) in expected.items()}
    assert got[5000][:7] == (0, 0, 0, 0, 0, 0, "")
    turns = defaultdict(list)
    for r in repaired_turns(frame, repair_plan(frame)).collect():
        assert r.place == len(turns[r.conv_id])
        turns[r.conv_id].append((r.role, r.text))
    assert {c: t for c, t in turns.items()} == {c: t for c, (_, t) in expected.items() if t}


def test_a_conversation_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(300)] + random_rows(9, 5)
        got = {r.conv_id: tuple(r)[1:] for r in repair_digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {c: e for c, (e, _) in expected_repair(rows, set()).items()}


def test_a_long_conversation_and_a_long_text(spark):
    rows = [(1, t, "user", "same.") for t in range(20_000)] + [(2, 0, "user", "." + " " * 1_000_000 + "x")]
    got = {r.conv_id: r for r in repair_plan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].duplicate, got[1].cost, len(got[1].audit), got[1].audit[:3]) == (19_999, 59_999, 20_001, "KDD")
    assert (got[2].truncated, got[2].audit) == (1, "D")


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in range(60) for t in range(5)] + [(None, None, None, None), (-3, 2, "system", "x.")]
    got = defaultdict(list)
    for r in damaged_conversations(crowded(spark, rows)).collect():
        got[r.conv_id, r.turn].append((r.role, r.text))
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(key.encode()) % 20
        plain = [(role, text)]
        mended = {0: [], 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: plain * 2, 4: [("user", text)]}
        assert got[c, t] == mended.get(fault, plain)
