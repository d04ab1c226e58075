import os

import check
import corpus_pipeline
import duckdb
import pytest
from brute import contamination, empty, frame, keep_lines, near, rows

import __spark_entry__ as entry
from velotrail.llm.packing import pack
from velotrail.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "decontamination", "packing"]
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


def test_stages_equal_plain_versions(spark):
    """Each stage on what the one before kept; the language stage keeps all given documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stage = dict(corpus_pipeline.STAGES)
    rows_of = lambda df: sorted(tuple(r) for r in df.collect())

    kept = stage["language"](spark, docs, SF)
    assert rows_of(kept) == sorted(data)
    kept = stage["lines"](spark, kept, SF)
    data = [(r[0], t, r[2], r[3], len(t)) for r, (t, _) in zip(data, keep_lines(data, 20, 3), strict=True)]
    assert rows_of(kept) == sorted(data)
    kept = stage["near_copies"](spark, kept, SF)
    group = near(data, 5, 80)
    data = [r for k, r in enumerate(data) if group[k] == r[0]]
    assert rows_of(kept) == sorted(data)
    kept = stage["decontamination"](spark, kept, SF)
    data = [r for r in data if not contamination(r[1], items)[1]]
    assert rows_of(kept) == sorted(data)
    want = sorted((p.doc_id, p.doc_tokens) for p in pack(kept).filter("start = 0").collect())
    got = sorted((p.doc_id, p.doc_tokens) for p in corpus_pipeline.run(spark, SF).filter("start = 0").collect())
    assert got == want and [g[0] for g in got] == sorted(r[0] for r in data)


def test_stages_take_odd_tables(spark):
    for docs in (frame(spark, rows()), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs_after = stage(spark, docs, SF)
            assert docs_after.schema == docs.schema, name
            docs_after.collect()
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert pieces.filter("start = 0").count() == docs.count()
