"""Registered queries of the subpackage against their SQL over the smallest tables, and shapes of the rest."""

import pytest

from newsloom.llm import catalog
from oracle import differences

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
FOUND = {
    "p1_found": ["first_id", "article_id"], "p2_found": ["id_a", "id_b"], "p4_found": ["first_id", "article_id"],
    "p5_found": ["first_id", "best_id"], "p6_found": ["id_a", "id_b"], "p9_found": ["doc_a", "doc_b"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables, name):
    assert differences(spark, tables, QUERIES[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, tables, name):
    df = QUERIES[name](spark, tables)
    rows = df.collect()
    if name in FOUND:
        assert df.columns == FOUND[name] and {t for _, t in df.dtypes} == {"bigint"} and len(rows) == len(set(rows))
    assert rows


def test_spans_are_delivered(spark, tables):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").where("text is not null").collect()}
    rows = QUERIES["p9_spans"](spark, tables).collect()
    assert rows and all(0 <= r["lo"] and r["lo"] + 200 <= r["hi"] <= len(text[r["doc_id"]]) for r in rows)
    for r in rows:  # each end of a stretch lies in a window that another document holds
        mine = text[r["doc_id"]]
        for part in (mine[r["lo"] : r["lo"] + 200], mine[r["hi"] - 200 : r["hi"]]):
            assert any(part in t for d, t in text.items() if d != r["doc_id"])
