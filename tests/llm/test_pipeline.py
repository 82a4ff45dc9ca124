"""The pipeline on odd rows, empty tables and columns under names that operators use."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import COLUMNS, rows_of

LABELS = "doc_id long, quality int, toxic int"
CLASH = ("__score", "__text", "__row", "__blob", "__spans", "__topic", "__prob", "__tokens", "__sampled", "__h0", "__group", "__doc",
         "__first", "path", "leaf", "cls", "score")


@pytest.fixture(scope="module")
def folder(spark, odd_rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd_rows, COLUMNS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(None, 1, 1), (5, None, None), (7, 1, 0)], LABELS).write.parquet(f"{at}/labels.parquet")
    return at


def test_run_on_odd_rows(spark, folder, odd_rows):
    import corpus_pipeline as P

    at = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, at, folder)
        before, after = Counter(r["doc_id"] for r in at.collect()), Counter(r["doc_id"] for r in out.collect())
        assert out.columns == at.columns and not after - before, name
        if name in ("toxicity", "secrets"):  # nothing here is toxic, masked documents stay
            assert after == before
        at = spark.createDataFrame(out.collect(), out.schema)
    got = P.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in at.collect())
    # of all null and empty texts one stays, and the very long one went through whole
    texts = {r[0]: r[1] for r in odd_rows}
    assert sum(not texts[r["doc_id"]] for r in got if r["doc_id"] in (0, 1, 2)) <= 1


def test_columns_under_operator_names(spark, folder):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.select(*[F.concat(F.lit(f"{n}:"), F.coalesce("text", F.lit(""))).alias(n) for n in CLASH], *docs.columns)
    for name, stage in P.STAGES[:-1]:
        plain, got = stage(spark, docs, folder), stage(spark, wide, folder)
        assert got.columns == wide.columns, name
        assert Counter(r["doc_id"] for r in got.collect()) == Counter(r["doc_id"] for r in plain.collect()), name
        if name != "secrets":
            assert rows_of(got.select(*docs.columns)) == rows_of(plain)
            assert all(r[n] == f"{n}:{r['text'] or ''}" for r in got.collect() for n in CLASH), name


def test_run_on_nothing(spark, tmp_path):
    import corpus_pipeline as P

    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
