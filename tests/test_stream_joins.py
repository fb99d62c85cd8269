from chronoframe.plans import queries_stream


def test_labels_are_joined_without_broadcast(spark):
    """a fold's rows look tiny to Spark in a batch without new files."""
    few, many = spark.createDataFrame([(1, 2.0)], "event_id long, x double"), spark.range(10**6).withColumnRenamed("id", "event_id")
    plan = queries_stream._labelled(few, many)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
