from __spark_entry__ import entry


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["v_date", "source", "order_no", "task_no", "keyword", "text"]
    assert entry(spark).schema == df.schema
