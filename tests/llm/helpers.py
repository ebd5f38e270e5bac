"""Fixtures drawn from a seed, and plain Python versions to compare with."""

import random
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({k: k + 32 for k in range(65, 91)})
SCHEMA = "doc_id long, text string"


def vocabulary(seed: int, size: int = 4000) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzéñß") for _ in range(draw.randint(2, 9))) for _ in range(size)]


class Texts:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.words = vocabulary(seed + 1)

    def make(self, count: int) -> list[str]:
        return [self.random.choice(self.words) for _ in range(count)]

    def edited(self, words: list[str], edits: int) -> list[str]:
        words = list(words)
        for _ in range(edits):
            words[self.random.randrange(len(words))] = self.random.choice(self.words)
        return words


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text) -> frozenset:
    words = words_of(text)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows: list[tuple]) -> dict:
    """Smallest id linked with each id, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in ids}


def repeated(rows: list[tuple], length: int = 50) -> dict:
    """Word numbers of every text that lie in a run of ``length`` words that another text has."""
    owners = defaultdict(set)
    for i, text in rows:
        words = words_of(text)
        for at in range(len(words) - length + 1):
            owners[tuple(words[at : at + length])].add(i)
    out = defaultdict(set)
    for i, text in rows:
        words = words_of(text)
        for at in range(len(words) - length + 1):
            if len(owners[tuple(words[at : at + length])]) > 1:
                out[i].update(range(at, at + length))
    return dict(out)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def crowded(spark, rows):
    """The rows beside columns whose names the operators use themselves."""
    names = "digest salt n key keys node low high length piece start row place score held_out bucket repeats"
    sql = [f"'x' AS {name}" for name in names.split()]
    return frame(spark, rows).selectExpr("*", *sql)
