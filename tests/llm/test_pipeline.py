from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm.helpers import Texts, components, frame, shingles
from waybill.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables in which it is known what each stage has to take out."""
    texts, bad = Texts(31), ["grumox", "plivert"]
    rows, labels = [], []
    for i in range(400):
        words = texts.make(texts.random.randint(20, 120))
        if i % 5 == 0:
            for at in (1, 5, 9):
                words.insert(at, texts.random.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    items = [(n, " ".join(texts.make(20))) for n in range(5)]
    rows += [(400 + i, rows[3 + 5 * (i % 3)][1]) for i in range(20)]
    rows += [(500 + i, " ".join(texts.edited(rows[401][1].split(), 0) + texts.make(1))) for i in range(10)]
    rows += [(600 + i, " ".join(texts.make(200)) + " " + items[i % 5][1]) for i in range(15)]
    rows += [(700, None), (701, ""), (702, "long " * 9000)]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = frame(spark, [(i, t, None, "s", None) for i, t in rows], DOCS)
    docs.write.parquet(f"{folder}/documents.parquet")
    frame(spark, labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame(spark, items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages_against_plain_python(spark, tables):
    folder, rows, items = tables
    left = {i: t for i, t in rows if not (t and {"grumox", "plivert"} & set(t.split()))}
    by_text = {}
    for i, t in sorted(left.items()):
        by_text[t or ""] = i
    left = {i: t for t, i in by_text.items()}
    group = components(list(left.items()))
    left = {i: t for i, t in left.items() if group[i] == i}
    left = {i: t for i, t in left.items() if not any(len(shingles(t) & shingles(x)) >= 0.8 * len(shingles(x)) for _, x in items)}
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert set(packed.doc_id) == set(left)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_return_the_columns_of_documents(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        path = Path(SF_DIR, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(result.fetchall())


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_its_table(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert not frame.isEmpty()
