"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded texts."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, held_out, ship, texts_of, training_rows

SAMPLE = 6000
MIN_SUPPORT = 5
MIN_WEIGHT = 3.0
STEM_LENGTHS = range(4, 13)

# Letters of other scripts that look like Latin ones, and characters put for letters.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁԛԝһгпкмнвтзєі" + "αβεικνοπρτυχγηω" + "ıɡɑɩʋ",
        "aeopcyxijsdqwhrnkmhbtzei" + "abeiknoprtuxynw" + "igaiu",
    )
)
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}


def _fold_table(limit: int = 0x3000) -> dict[int, str]:
    """Character by character: lower case, Latin lookalikes, one space for what is no letter, mark or digit."""
    table = {}
    for code in [*range(limit), *range(0xFF00, 0xFFF0)]:
        char = unicodedata.normalize("NFKC", chr(code)).lower()
        char = "".join(LOOKALIKES.get(c, c) for c in char)
        if len(char) != 1:
            char = char if char.isalpha() else " "
        elif unicodedata.category(char)[0] not in "LMN":
            char = " "
        if unicodedata.category(chr(code)) == "Cf":
            char = ""  # zero-width characters inside words
        if char != chr(code):
            table[code] = char
    return table


FOLD = _fold_table()
_MIXED = re.compile(r"(?:[^\W\d_][013457 8@$!|](?=[^\W\d_]))|(?:[013457 8@$|][^\W\d_])".replace(" ", ""))
_MIXED_WORD = re.compile(r"[^\W_](?:[^\W_]|[@$!|](?=\w))*|[@$](?:[^\W_]|[@$!|](?=\w))+")
_SWAP = str.maketrans(DIGITS)


def _letters(match: re.Match) -> str:
    word = match[0]
    return word.translate(_SWAP) if sum(c.isalpha() for c in word) * 5 >= 2 * len(word) else word


def fold(text: str) -> str:
    """Words in lower case between single characters of space; digits and signs that stand for letters
    inside a word of two fifths letters or more become those letters. Spaces at both ends."""
    if _MIXED.search(text):
        text = _MIXED_WORD.sub(_letters, text)
    return f" {text.translate(FOLD)} "


@dataclass
class Lexicon:
    """``weights`` of folded entries: ``" stem"`` matches words that begin so, ``" word "`` whole words,
    entries may have several words. A match inside a match of one of ``exceptions`` doesn't count.
    ``bias``, ``total`` and ``rate`` turn the sums into a score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    bias: float = -2.0
    total: float = 1.0
    rate: float = 1.0

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        if len(machine):
            machine.make_automaton()
        return machine

    def score(self, weight: float, words: int) -> float:
        x = self.bias + self.total * math.log1p(weight) + self.rate * math.log1p(100 * weight / max(words, 1))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def matched(machine, folded: str) -> float:
    """Sum of the weights of the matches, without those inside an exception. Of matches that begin
    at one place only the heaviest counts."""
    if not len(machine):
        return 0.0
    best: dict[int, tuple[int, float]] = {}
    spared = []
    for end, (size, weight) in machine.iter(folded):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > best.get(start, (0, 0.0))[1]:
            best[start] = (end, weight)
    if spared:
        # Of the exceptions that begin at or before a match the one that reaches furthest decides.
        spared.sort()
        begins, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        best = {s: v for s, v in best.items() if (i := bisect_right(begins, s)) == 0 or reach[i - 1] < v[0]}
    return sum(weight for _, weight in best.values())


def word_after(text: str, at: int) -> str:
    """The first word from a place on, empty if there is none."""
    size = len(text)
    while at < size and text[at].isspace():
        at += 1
    end = at
    while end < size and not text[end].isspace():
        end += 1
    return text[at:end]


def word_before(text: str, at: int) -> str:
    """The last word before a place, empty if there is none."""
    while at and text[at - 1].isspace():
        at -= 1
    start = at
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:at]


def entries_of(words: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(entry, word before) of all stems and whole words."""
    before = ""
    for word in words:
        for length in STEM_LENGTHS:
            if length > len(word):
                break
            yield f" {word[:length]}", before
        if len(word) > 2:
            yield f" {word} ", before
        before = word


def words_seen(training: DataFrame) -> DataFrame:
    """``word`` and ``n``, the texts that have it, over the texts that aren't toxic."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = Counter(w for text in batch.column("text") for w in set(fold(text.as_py()).split()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    return by_batch(training.where("label = 0").select("text"), work, "word string, n long")


def candidates(training: DataFrame, min_support: int, min_weight: float) -> dict[str, int]:
    """Entries of toxic texts by the number of texts, told apart by the word before the entry.

    Copies of one text show an entry after the same word, so that they count once. Entries that are
    about as frequent in other texts are left out. Of entries with the same support the longest
    stands for its own beginnings.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # One word before per text and entry, so that a long text counts once as well.
        pairs = {p for text in batch.column("text") for p in dict(entries_of(fold(text.as_py()).split())).items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([e for e, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())],
            names=["entry", "before"],
        )

    texts = training.agg(F.sum("label"), F.count("*")).first()
    toxic, other = texts[0] or 0, texts[1] - (texts[0] or 0)
    pairs = by_batch(training.where("label = 1").select("text"), work, "entry string, before string")
    support = pairs.distinct().groupBy("entry").agg(F.count("*").alias("support")).where(F.col("support") >= min_support)
    longest_stem = F.least(F.length("word"), F.lit(STEM_LENGTHS[-1]))
    stems = F.when(
        F.length("word") >= STEM_LENGTHS[0],
        F.transform(F.sequence(F.lit(STEM_LENGTHS[0]), longest_stem), lambda i: F.concat(F.lit(" "), F.col("word").substr(F.lit(1), i))),
    ).otherwise(F.array().cast("array<string>"))
    entries = F.concat(stems, F.array(F.concat(F.lit(" "), F.col("word"), F.lit(" "))))
    elsewhere = words_seen(training).select(F.explode(entries).alias("entry"), "n").groupBy("entry").agg(F.sum("n").alias("n"))
    weight = F.log((F.col("support") + 0.5) / (toxic + 1)) - F.log((F.coalesce("n", F.lit(0)) + 0.5) / (other + 1))
    found = (
        support.join(elsewhere, "entry", "left")
        .where(weight >= min_weight)
        .collect()  # as many as the sample of labelled rows has
    )
    support_of = {r.entry: r.support for r in found}
    longest = dict(support_of)
    for entry in sorted(support_of, key=len, reverse=True):
        for end in range(STEM_LENGTHS[0] + 1, len(entry)):
            if longest.get(entry[:end]) == support_of[entry]:
                del longest[entry[:end]]
    return longest


def counted(training: DataFrame, entries: list[str]) -> tuple[dict[str, list[int]], list[int], Counter]:
    """For each entry the texts that have it, by label; the texts by label; and for entries with their
    next or previous word that no toxic text has the other texts that have them, if 3 at least.
    Copies of one text count once for these."""
    plain = Lexicon({e: 1.0 for e in entries})

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry in plain.weights:
            machine.add_word(entry, entry)
        machine.make_automaton()
        counts: Counter = Counter()
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            folded = fold(text.as_py())
            counts["texts", "", label, ""] += 1
            seen = set()
            content = hashlib.sha256(" ".join(folded.split()).encode()).hexdigest()
            for end, entry in machine.iter(folded):
                seen.add(("entry", entry, ""))
                start = end - len(entry) + 1
                word_end = folded.find(" ", start + 1)
                if after := word_after(folded, word_end):
                    seen.add(("phrase", f"{folded[start:word_end]} {after} ", content))
                if before := word_before(folded, start):
                    seen.add(("phrase", f" {before}{folded[start:word_end]} ", content))
            counts.update((kind, value, label, content) for kind, value, content in seen)
        kinds, values, labels, contents = zip(*counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kinds), pa.array(values), pa.array(labels, pa.int32()), pa.array(contents),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["kind", "value", "label", "content", "n"],
        )

    found = by_batch(training.select("text", "label"), work, "kind string, value string, label int, content string, n long")
    phrases_of_others = (
        found.where("kind = 'phrase'")
        .groupBy("kind", "value")
        .agg(F.max("label").alias("label"), F.count_distinct("content").alias("n"))
        .where("label = 0 AND n >= 3")
    )
    sums = (
        found.where("kind <> 'phrase'")
        .groupBy("kind", "value", "label")
        .agg(F.sum("n").alias("n"))
        .unionByName(phrases_of_others)
        .collect()
    )
    by_entry: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    texts, phrases = [0, 0], Counter()
    for row in sums:
        if row.kind == "entry":
            by_entry[row.value][row.label] = row.n
        elif row.kind == "texts":
            texts[row.label] = row.n
        else:
            phrases[row.value] = row.n
    return by_entry, texts, phrases


def fitted(features: np.ndarray, labels: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights (bias first) of a logistic regression, by Newton steps with a little shrinkage."""
    x = np.column_stack([np.ones(len(labels)), features])
    w, shrink = np.zeros(x.shape[1]), np.diag([0.0] + [0.1] * features.shape[1])
    for _ in range(min(steps, 30)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - shrink @ w
        bend = x.T @ (x * (p * (1 - p))[:, None]) + shrink + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learnt_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    min_support: int = MIN_SUPPORT,
    min_weight: float = MIN_WEIGHT,
) -> Lexicon:
    """A lexicon from labelled rows outside the test fold, at most ``sample`` of them.

    An entry's weight is its log odds ratio between toxic and other texts. A phrase of other texts
    that would be a false match (in 3 different ones at least, and none that is toxic) becomes an exception.
    Without any toxic text the lexicon is empty and all scores are equal.
    """
    training = training_rows(docs, labels, "toxic", sample)
    found = candidates(training, min_support, min_weight)
    if not found:
        return Lexicon()
    by_entry, texts, phrases = counted(training, list(found))
    weights = {}
    for entry, (other, toxic) in by_entry.items():
        weight = math.log((toxic + 0.5) / (texts[1] + 1)) - math.log((other + 0.5) / (texts[0] + 1))
        if weight >= min_weight:
            weights[entry] = weight
    lexicon = Lexicon(weights, tuple(p for p in phrases if any(p.startswith(e) or e in p for e in weights)))
    rows = weighed(training, lexicon, "label").collect()
    weight = np.array([r.weight for r in rows])
    features = np.column_stack([np.log1p(weight), np.log1p(100 * weight / np.maximum([r.words for r in rows], 1))])
    y = np.array([r.label for r in rows], float)
    if 0 < y.sum() < len(y):
        lexicon.bias, lexicon.total, lexicon.rate = map(float, fitted(features, y))
    return lexicon


def weighed(rows: DataFrame, lexicon: Lexicon, carried: str) -> DataFrame:
    """``weight`` and ``words`` of every text, beside the integer column ``carried``."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        weights, words = [], []
        for text in batch.column("text"):
            folded = fold(text.as_py())
            weights.append(matched(machine, folded))
            words.append(len(folded.split()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(carried).cast(pa.int64()), pa.array(weights, pa.float64()), pa.array(words, pa.int64())],
            names=[carried, "weight", "words"],
        )

    return by_batch(rows.select(carried, "text"), work, f"{carried} long, weight double, words long")


def toxicity_scores(
    docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    The weight of all matches, as a sum and per 100 words, gives the score between 0 and 1; predicted
    is 1 from 0.5 on. Null and empty texts match nothing and get the score of texts without a match.
    Rows that repeat are scored each, rows without an id too (not held out). An empty table gives no
    rows.
    """
    bias, total, rate = (F.lit(v) for v in (lexicon.bias, lexicon.total, lexicon.rate))
    per_100 = F.log1p(100 * F.col("weight") / F.greatest("words", F.lit(1)))
    x = bias + total * F.log1p("weight") + rate * per_100
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))
    return (
        weighed(texts_of(docs, id_column, text_column), lexicon, "doc_id")
        .withColumn("score", score)
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def without_toxic(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not predicted to be toxic."""
    ship(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine, clean = lexicon.automaton(), []
        for text in batch.column(batch.schema.get_field_index(text_column)):
            folded = fold(str(text.as_py() or ""))
            clean.append(lexicon.score(matched(machine, folded), len(folded.split())) < 0.5)
        yield batch.filter(pa.array(clean))

    return by_batch(docs, work, docs.schema)
