import pytest

import corpus_pipeline
from weftline.llm import queries


def test_stages_keep_columns_and_take_effect(docs, table, spark, tmp_path):
    labels = spark.createDataFrame([(r[0], int("###" not in (r[1] or "") and "Und Und" not in (r[1] or "") and "!!" not in (r[1] or ""))) for r in table if r[0] is not None], "doc_id bigint, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns, name
        path = f"{tmp_path}/{len(counts)}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        counts.append(now.count())
    assert counts[0] > counts[2] > counts[3] > 0
    coded = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
    assert coded.count() == counts[-1]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[-1]


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run(spark, name):
    assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS FROM '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        want = con.sql(sql)
        got = queries.queries()[name](spark, "/root/testdata/sf0.001").select(*want.columns).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall())), name
