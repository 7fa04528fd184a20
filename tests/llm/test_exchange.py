"""What keeps the memory of executors low, beside the steps' results."""

import pyarrow as pa
import pytest
from pyspark.sql import Row

from scanweave.llm import anchors, langid, packing, suffix
from scanweave.llm.exchange import local_table, stored

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("most, expected", [(None, 10), (4, 4), (50, 10)])
def test_batches_for_python_are_bounded_for_a_step_alone(spark, most, expected):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, "10")
    try:
        out = stored(spark.range(0, 20, 1, 1).mapInArrow(sizes, "n long"), "sizes", batch_rows=most)
        assert max(r.n for r in out.collect()) == expected
        assert sum(r.n for r in out.collect()) == 20
        assert spark.conf.get(ROWS) == "10"
        with pytest.raises(Exception):
            stored(spark.range(3).selectExpr("raise_error('no') AS x"), "fails", batch_rows=most)
        assert spark.conf.get(ROWS) == "10"
    finally:
        spark.conf.set(ROWS, before)


def test_local_tables_need_no_workers(spark):
    schema = "leaf struct<a string, b string>, n long, k int"
    rows = [({"a": "x", "b": None}, 1, 2), ({"a": "y", "b": "z"}, 2**40, -1)]
    table = local_table(spark, rows, schema)
    assert "LocalRelation" in table._jdf.queryExecution().analyzed().toString()
    assert table.collect() == [Row(leaf=Row(a="x", b=None), n=1, k=2), Row(leaf=Row(a="y", b="z"), n=2**40, k=-1)]
    assert table.schema.simpleString() == "struct<leaf:struct<a:string,b:string>,n:bigint,k:int>"
    assert local_table(spark, [], schema).collect() == []


def test_texts_go_to_python_once(spark):
    docs = spark.createDataFrame([(1, "ein Text", "de"), (2, None, "de"), (3, "42", "en")], "doc_id long, text string, lang string")
    model = langid.train(docs.withColumn("doc_id", docs.doc_id + 6), per_language=3, least=1)
    found = langid.with_language(docs, model)
    assert "_text" not in found._jdf.queryExecution().analyzed().toString()
    assert found.columns == [*docs.columns, "lang_pred", "score", "bits_per_byte"]
    binary = langid.with_language(docs.withColumn("text", docs.text.cast("binary")), model)
    names = [c for c in found.columns if c != "text"]
    assert sorted(binary.select(names).collect()) == sorted(found.select(names).collect())


def test_steps_give_memory_back(monkeypatch):
    steps = [anchors._scan, anchors._meet, suffix._rank, suffix._rerank, suffix._remove, langid._train, langid._predict, packing._cut]
    ended = []
    monkeypatch.setattr("scanweave.llm.exchange.tidy", lambda: ended.append(1))
    scheme = anchors.Scheme(words=False, window=100, gram=24, everywhere=False)
    assert list(anchors._meet(iter([]), scheme, 1)) == [] and len(ended) == 1
    assert all(hasattr(s, "__wrapped__") for s in steps)
