import corpus_pipeline as P
from oracle import connect, differences
from spokewise.llm import quality
from spokewise.llm.queries import QUERIES, SQL
from test_decontaminate import by_hand as hits
from test_near_dup import by_hand as components

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_return_a_row_for_each_input_row(spark, name):
    table = {"op6": "pages", "op9": "pages"}.get(name.split("_")[0], "documents")
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_equals_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), use=~quality.held_out())
    good = {r.doc_id for r in quality.score(docs, model, keep=["doc_id"]).collect() if r.predicted}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    newest = {}
    for i, text, _ in rows:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        newest[key] = max(i, newest.get(key, i))
    rows = [r for r in rows if r[0] in set(newest.values())]
    top, _ = components([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if top[r[0]] == r[0]]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = []
    for r in rows:
        n_words, n_hit, _ = hits(r[1], bench)
        if not (n_hit and 20 * n_hit >= n_words):
            clean.append(r)
    found = P.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.source) for r in found) == sorted((r[0], r[2]) for r in clean)
    assert len(clean) < len(good) and sum(r.taken for r in found) > 0


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, step in P.STAGES[:-1]:
        assert step(spark, docs, SMALL).columns == docs.columns, name
