"""The registered queries over the smallest tables: contracts, and SQL where there is some."""

import os

import duckdb
import pytest

from ampliscope.llm import near_copies, queries, quality
from ampliscope.llm.common import read

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    got = queries.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, found.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = read(spark, SF, "documents")
    found, scored = quality.fit(docs, read(spark, SF, "labels"))
    assert scored.count() == docs.count()
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and {r.length for r in out} <= set(range(1, 2049))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "near_dedup", "source_mixing", "best_fit_packing"]


def test_near_copies_against_all_pairs(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text")
    got = {r.doc_id: r.component_id for r in near_copies.components(docs).collect()}
    sets = {r.doc_id: set(near_copies._features(r.text.encode(), 5).tolist()) for r in docs.collect()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in sets}
