"""Registered queries against their SQL over the smallest tables, and the entry point."""

import pytest

import __spark_entry__ as entry
from newsloom.plans import catalog
from oracle import differences

CORE, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables, name):
    assert differences(spark, tables, CORE[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(CORE) - set(SQL) - {"p3_found", "top_stories"}))
def test_runs(spark, tables, name):
    df = CORE[name](spark, tables)
    assert df.columns and df.count() >= 0


def test_entry(spark, tables):
    rows = entry.entry(spark).collect()
    per = {}
    for r in rows:
        per.setdefault(r["topic"], []).append(r["rank"])
    assert rows and all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 5 for v in per.values())


@pytest.mark.parametrize("name", ["norm_title", "norm_url", "noise_signals", "word_tokens", "bigram_sets", "fetch_rank", "grouped_ranking", "recency", "final_score"])
def test_rows_of_all_tables(spark, tables, name):
    ids = lambda q: sorted(r[0] for r in CORE[q](spark, tables).select("article_ix").collect())
    assert ids(name) == ids("union_registry")


def test_pairs_reach_twitter(spark, tables):
    kind = lambda ix: ix // 10**13
    for name in ("candidate_pairs", "pair_jaccard", "comparable_pairs", "fuzzy_pairs"):
        kinds = {(kind(r[0]), kind(r[1])) for r in CORE[name](spark, tables).select("i", "j").collect()}
        assert (2, 2) in kinds and (1, 2) in kinds, name
    parts = {}
    for r in CORE["exact_components"](spark, tables).collect():
        parts.setdefault(r["component"], set()).add(r["vertex"])
    by = {}
    for r in CORE["norm_title"](spark, tables).where("norm_title <> ''").collect():
        by.setdefault(r["norm_title"], set()).add(r["article_ix"])
    assert any({kind(x) for x in p} >= {1, 2} for p in parts.values())
    assert all(any(same <= p for p in parts.values()) for same in by.values() if len(same) > 1)


@pytest.mark.parametrize("name", ["canonical_pick", "all_canonical_pick"])
def test_scores_cover_twitter(spark, tables, name):
    canon = CORE[name](spark, tables).collect()
    assert any(r["article_ix"] // 10**13 == 2 for r in canon) and any(r["multi_source"] for r in canon)
    assert all(r["first_ix"] <= r["article_ix"] for r in canon) and len({r["article_ix"] for r in canon}) == len(canon)
