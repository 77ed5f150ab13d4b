import pytest

import __spark_entry__
import corpus_pipeline
from checks.compare import difference, duck
from plantmetrics.llm.oracle import ORACLE_SQL
from plantmetrics.llm.queries import QUERIES
from plantmetrics.sources import stage
from plantmetrics.sources.scratch import scratch_base, written

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name]) is None


def test_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(function(spark, docs, SF), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before), name
        if name in ("toxicity", "near_copies", "decontamination"):
            assert all(after[k] == before[k] for k in after), name
        assert len(after) >= 0.85 * len(before), name
    assert not any(item in text for item in benchmark for text in after.values())
    assert len(set(after.values()) - {""}) == sum(1 for t in after.values() if t)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(rows) == len(after) < len(texts)


def test_stages_keep_columns_of_any_name_and_one_row_per_id(spark, documents):
    from pyspark.sql import functions as F

    names = ["_score", "_toxic", "_least", "_rank", "_n_removed", "_x", "_name", "_leaked_items"]
    docs = documents([(1, "a few words"), (1, "other words here"), (2, "something else"), (None, "no id")])
    docs = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    for name, function in corpus_pipeline.STAGES[:-1]:
        results = []
        for rows in (docs, docs.orderBy(F.desc("text")).repartition(3)):
            out = function(spark, rows, SF)
            assert out.columns == docs.columns, name
            results.append(sorted(map(str, out.collect())))
        assert results[0] == results[1] and all(f"own {n}" in row for row in results[0] for n in names), name
        assert len(results[0]) == (3 if name == "near_copies" else 4), name


def test_stages_take_odd_rows(spark, documents):
    odd = documents([(1, None), (1, None), (None, ""), (3, ""), (None, "word " * 30), (5, "word " * 30), (5, "word " * 30)])
    for rows in (odd, odd.limit(0)):
        docs = rows
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, SF)
        assert docs.count() <= rows.count()


def test_stages_leave_only_the_scratch_tables_that_their_result_reads(spark, documents):
    """What fitting and the join of near copies write is gone before the next stage writes."""
    from pathlib import Path

    folder = Path(scratch_base(spark).removeprefix("file:"), "plantmetrics")
    docs = documents([(k, f"some {k % 7} words that near copies share in any document and number {k % 3}") for k in range(40)])
    for function, left in zip((corpus_pipeline.drop_toxic, corpus_pipeline.keep_one_of_near_copies), ([], ["kept"]), strict=True):
        count, before = written(spark), set(folder.iterdir()) if folder.exists() else set()
        result = function(spark, docs, SF)
        new = set(folder.iterdir()) - before if folder.exists() else set()
        assert sorted(path.name.rsplit("-", 1)[0] for path in new) == left
        assert written(spark) == count + len(left) and 0 < result.count() <= 40
