"""Every operator with SQL against it, value for value; and tables that belong to their owners."""

import os

import duckdb
import pytest

from anchorline.llm import _common, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(queries.ORACLE[name])
    assert sorted(want.columns) == cols
    tidy = lambda rows: sorted((tuple(rows_) for rows_ in rows), key=repr)
    got = tidy(tuple(r[c] for c in cols) for r in got.collect())
    assert got and got == tidy(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_a_frame_outlives_what_other_queries_drop(spark):
    first = queries.QUERIES["op9_quality_rules"](spark, SF)
    import corpus_pipeline

    folder = _common.shared_dir(spark).removeprefix("file:")
    out = corpus_pipeline.run(spark, SF)
    assert first.count() == 200 and out.count() > 100 and out.count() > 100
    mine = _common.Tables()
    before = set(os.listdir(folder))
    kept = mine.stored(spark.range(3))
    assert kept.count() == 3 and len(set(os.listdir(folder)) - before) == 1
    mine.drop()
    assert set(os.listdir(folder)) == before
