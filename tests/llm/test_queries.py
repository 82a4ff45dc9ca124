"""Registered corpus queries against their SQL, and the pipeline against its parts."""

import os
from collections import Counter

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


def names():
    from cartograph.llm.queries import ORACLE

    return sorted(ORACLE)


@pytest.mark.parametrize("name", names())
def test_matches_sql(spark, name):
    from cartograph.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got.columns, map(tuple, got.collect())) == canon(want.columns, want.fetchall())


def test_operators_registered():
    from cartograph.llm.queries import QUERIES

    assert Counter(n.split("_")[0] for n in QUERIES) == {f"op{i}": 1 for i in range(1, 14)}


def test_pipeline_stage_by_stage(spark):
    """Each stage's decisions against a plain recomputation on its own input."""
    import corpus_pipeline as P
    from cartograph.llm import mixing, toxicity
    from tests.llm.test_joins import jaccard_brute
    from tests.llm.test_native import spans

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [k for k, _ in P.STAGES] == ["toxicity", "near duplicates", "secrets", "mixture", "tokens"]
    at = docs
    for name, stage in P.STAGES:
        rows = {r["doc_id"]: r for r in at.collect()}
        out = stage(spark, at, SF)
        got = out.collect()
        if name == "tokens":
            assert {r["doc_id"] for r in got} == set(rows) and len(got) == len(rows)
            continue
        assert out.columns == docs.columns
        if name == "toxicity":
            model = toxicity.train(at, labels)
            auto = toxicity.Automaton(model["terms"])
            a, b = model["curve"]
            want = {d for d, r in rows.items() if a + b * toxicity.total(toxicity.hits_of(r["text"], auto, set()), model["weights"]) < 0}
            assert {r["doc_id"] for r in got} == want  # this folder has too few labels to learn terms
        elif name == "near duplicates":
            assert {r["doc_id"] for r in got} == {c for _, c, _ in jaccard_brute([(r["doc_id"], r["text"]) for r in rows.values()])}
        elif name == "secrets":
            assert {r["doc_id"] for r in got} == set(rows)
            for r in got:
                assert not spans(r["text"]) and r["n_chars"] == len(r["text"])
                if not spans(rows[r["doc_id"]]["text"]):
                    assert r == rows[r["doc_id"]]
        else:
            want = {r["doc_id"] for r in mixing.mix(at).where("__sampled").collect()}
            assert {r["doc_id"] for r in got} == want and 0 < len(want) < len(rows)
        at = spark.createDataFrame(got, docs.schema)
    assert P.run(spark, SF).count() == at.count()
