import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import Texts, crowded, frame
from waybill.llm.frames import held_out, training_rows
from waybill.llm.quality import Machine, Rows, learnt_machine, quality_scores
from waybill.llm.toxicity import Lexicon, counted, fold, learnt_lexicon, matched, toxicity_scores, without_toxic, word_after, word_before

LABELS = "doc_id long, quality int, toxic int"
ODD = [(9001, None), (9002, ""), (9003, " \n"), (None, "idle words"), (9004, "word " * 60_000), (9004, "again")]


def test_fold():
    assert fold("Tr4sh! 1d10t").split() == ["trash", "idiot"]
    assert fold("іdіоt ｓｃｕｍ cl​own").split() == ["idiot", "scum", "clown"]
    assert fold("in 2024 for 30$ a@b").split()[:3] == ["in", "2024", "for"]
    assert fold("") == "  "


def test_matches_weights_and_exceptions():
    lexicon = Lexicon({" trash ": 2.0, " low": 1.0, " lowest": 3.0}, (" trash can ",))
    machine = lexicon.automaton()
    assert matched(machine, fold("Trash, trash!")) == 4.0
    assert matched(machine, fold("the trash can and trash")) == 2.0
    assert matched(machine, fold("lowest below")) == 3.0
    assert matched(Lexicon().automaton(), fold("trash")) == 0.0
    assert lexicon.score(4, 10) > lexicon.score(4, 1000) > lexicon.score(0, 10)


@pytest.fixture(scope="module")
def toxic_table(spark):
    texts, bad = Texts(11), ["grumox", "plivert", "snorbag"]
    rows, labels = [], []
    for i in range(900):
        words, toxic = texts.make(texts.random.randint(10, 80)), int(i % 5 == 0)
        for _ in range(3 if toxic else 0):
            word = texts.random.choice(bad) + texts.random.choice(["", "s", "er", "ing"])
            words.insert(texts.random.randrange(len(words)), word.replace("o", texts.random.choice("o0")))
        if not toxic and i % 80 == 1:
            words[3:3] = ["grumox", "valley"]  # a harmless phrase
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return frame(spark, rows + ODD).cache(), frame(spark, labels + [(None, 1, 1), (9001, None, None)], LABELS).cache()


def test_toxicity_on_the_test_fold(spark, toxic_table):
    docs, labels = toxic_table
    lexicon = learnt_lexicon(docs, labels)
    assert any("valley" in e for e in lexicon.exceptions)
    scores = toxicity_scores(docs, lexicon)
    assert scores.count() == docs.count()
    test = scores.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    assert len(test) > 100 and (test.predicted == test.toxic).mean() > 0.98
    assert scores.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    clean = without_toxic(docs.withColumn("score", F.lit("x")), lexicon)
    assert clean.columns == ["doc_id", "text", "score"]
    assert clean.count() == scores.where("predicted = 0").count()


def test_exceptions_need_texts_that_differ_and_none_that_is_toxic(spark):
    texts, rows = Texts(41), []
    for i in range(900):
        before = "you" if i % 2 else texts.make(1)[0]
        rows.append((" ".join(texts.make(8) + [before, "zorgish"] + texts.make(8)), 1) if i < 300 else (" ".join(texts.make(17)), 0))
    rows += [(" ".join(texts.make(8) + [word, "zorgish"] + texts.make(8)), 0) for word in ("you", "quoted") for _ in range(3)]
    rows += [(" ".join(texts.make(8) + ["mild", "zorgish"] + texts.make(8)), 0)] * 3
    _, _, phrases = counted(spark.createDataFrame(rows, "text string, label int"), [" zorgish "])
    assert phrases[" quoted zorgish "] == 3
    assert " you zorgish " not in phrases and " mild zorgish " not in phrases


def test_training_never_sees_the_test_fold(toxic_table):
    docs, labels = toxic_table
    assert training_rows(docs, labels, "toxic", 10_000).where(held_out()).isEmpty()
    assert training_rows(docs, labels, "toxic", 50).count() == 50


def test_factorisation_identity():
    random = np.random.Generator(np.random.PCG64(1))
    machine = Machine(0.3, random.normal(size=30), random.normal(size=(30, 4)))
    rows = Rows(np.array([1, 5, 9, 2, 3]), random.normal(size=5), np.array([0, 3, 5]))
    got = machine.terms(rows)[0]
    for i in range(2):
        at = range(rows.first[i], rows.first[i + 1])
        pairs = sum(
            machine.factors[rows.index[a]] @ machine.factors[rows.index[b]] * rows.value[a] * rows.value[b] for a in at for b in at if a < b
        )
        assert got[i] == pytest.approx(0.3 + sum(machine.weights[rows.index[a]] * rows.value[a] for a in at) + pairs)


def test_quality_on_the_test_fold(spark):
    texts = Texts(13)
    rows, labels = [], []
    for i in range(900):
        words, good = texts.make(texts.random.randint(20, 120)), int(i % 4 != 0)
        if not good:
            kind = i % 3
            words = [w + "###" for w in words] if kind == 0 else [w.upper() for w in words] if kind == 1 else [w for w in words[:6] for _ in range(9)]
        rows.append((i, " ".join(words)))
        labels.append((i, good, 0))
    docs = frame(spark, rows + ODD).withColumn("n_chars", F.length("text").cast("long"))
    known = frame(spark, labels, LABELS)
    scores = quality_scores(docs, learnt_machine(docs, known, ("n_chars",)), ("n_chars",))
    assert scores.count() == docs.count() and scores.where("score < 0 OR score > 1 OR isnan(score)").isEmpty()
    test = scores.join(known, "doc_id").where("held_out").toPandas()
    assert len(test) > 100 and (test.predicted == test.quality).mean() > 0.97
    assert scores.where("predicted <> cast(score >= 0.3 AS int)").isEmpty()


@pytest.mark.parametrize("one", [True, False])
def test_without_labels_or_rows(spark, one):
    docs = crowded(spark, [(1, "some text"), (2, None)] if one else [])
    none = frame(spark, [], LABELS)
    assert toxicity_scores(docs, learnt_lexicon(docs, none)).count() == docs.count()
    assert quality_scores(docs, learnt_machine(docs, none)).count() == docs.count()


def test_many_matches_and_exceptions_take_little_time():
    lexicon = Lexicon({" bad": 1.0, " worse ": 2.0}, (" not bad ", " bad bad "))
    start = time.perf_counter()
    assert matched(lexicon.automaton(), fold("not bad worse bad " * 60_000)) == 60_000 * 3
    assert time.perf_counter() - start < 5


def test_words_beside_a_place():
    for text in (" a bc  d ", "", "   ", "x"):
        for at in range(len(text) + 1):
            assert word_after(text, at) == (text[at:].split(None, 1) or [""])[0]
            assert word_before(text, at) == (text[:at].rsplit(None, 1) or [""])[-1]
