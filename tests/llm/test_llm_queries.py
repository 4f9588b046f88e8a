"""The registered queries against SQL, and the pipeline against its parts."""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES, documents


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cells(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in order) for row in rows])


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sql, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    sql.execute(ORACLES[name])
    names = [c[0] for c in sql.description]
    assert cells(df.columns, got) == cells(names, sql.fetchall()) and got


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(names)


def test_stages(spark, sf_dir, tmp_path):
    docs = documents(spark, sf_dir)
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        steps[name] = docs = spark.read.parquet(str(tmp_path / name))
    assert [x for x, _ in corpus_pipeline.STAGES] == list(steps)
    ids = {n: [r.doc_id for r in steps[n].select("doc_id").collect()] for n in steps if n != "packing"}
    before = [r.doc_id for r in documents(spark, sf_dir).select("doc_id").collect()]
    for name, now in ids.items():
        assert steps[name].columns == columns and set(now) <= set(before) and len(set(now)) == len(now)
        before = now
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert good <= set(ids["language"]) | (good - {r.doc_id for r in documents(spark, sf_dir).collect()})
    texts = {r.doc_id: r.text for r in steps["passages"].collect()}
    total = defaultdict(int)
    for r in steps["packing"].collect():
        total[r.doc_id] += r.length
    assert set(total) == set(texts)
    assert [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "doc_tokens").distinct().groupBy("doc_id").sum("length").orderBy("doc_id").collect()] == sorted(total.items())


def test_pipeline_over_nulls_and_an_empty_table(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (None, "the words of a text", None, None, None), (2, "", None, None, 0), (3, "the words of another text", "en", "b", 25)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "some" / "documents.parquet"))
    table.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert {r.doc_id for r in packed} == {None, 3}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
