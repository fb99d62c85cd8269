import pytest

from __spark_entry__ import queries
from chronoframe.operators.joins import LookupError_
from chronoframe.sources.bindings import lineitem_log


def test_item_log_joins_its_orders_for_the_check_only(spark, tmp_path):
    """a left join on a checked, unique key adds nothing where its value is not read."""
    li = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string"
    rows = [(i % 4, i, i % 3, 1, None, "R" if i % 2 else "N", "O") for i in range(12)]
    spark.createDataFrame(rows, li).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(k, 10 * k) for k in range(4)], "o_orderkey long, o_custkey long")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    log = lineitem_log(spark, str(tmp_path), user=False)
    assert "Join" not in log.select("l_linenumber", "video_id", "ts_us", "is_returned")._jdf.queryExecution().optimizedPlan().toString()
    full = lineitem_log(spark, str(tmp_path))
    assert sorted(map(str, log.collect())) == sorted(map(str, full.collect())) and log.columns == full.columns
    orders.filter("o_orderkey < 3").write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    with pytest.raises(LookupError_, match="no o_custkey for 3 rows"):
        lineitem_log(spark, str(tmp_path), user=False)


def test_asof_of_items_joins_no_orders(spark):
    """the lookup of orders is checked, not joined again for every pass."""
    out = queries()["asof_item_li"](spark, "/root/testdata/sf0.001")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_asof_training_table_joins_orders_once(spark):
    """the log is stored, and the table reads that."""
    out = queries()["training_table_li_asof"](spark, "/root/testdata/sf0.001")
    assert not [f for f in out.inputFiles() if "orders.parquet" in f]


def test_largest_key_is_counted_by_groups_first(spark, monkeypatch):
    """keys one by one only where their group has too many rows."""
    from chronoframe.operators import skew

    rows = [(k, None if k % 5 == 0 else k % 3) for k in range(100) for _ in range(4)] + [(7, 1)] * 9
    df = spark.createDataFrame(rows, "a int, b int")
    monkeypatch.setattr(skew, "GROUPS", 2)
    assert 13 <= skew.largest_key(df, ["a", "b"], 1000) <= 409  # as a group it fits
    assert skew.largest_key(df, ["a", "b"], 20) == 13 and skew.largest_key(df, ["a"], 12) == 13
    assert skew.largest_key(df, ["b"], 10) == max(sum(1 for r in rows if r[1] == b) for b in (None, 0, 1, 2))
    assert skew.largest_key(df.limit(0), ["a"]) == 0


def test_asof_rows_keep_keys_and_times_that_travel_beside_them(spark):
    """a left row of keys and time only, null keys and times, repeated rows."""
    from chronoframe.operators.joins import asof_features, asof_join

    left = spark.createDataFrame([(1, 5), (1, 5), (None, 6), (2, None), (2, 9)], "k int, ts_us long")
    right = spark.createDataFrame([(1, 4, 0.5), (2, 9, 1.5), (None, 1, 9.0)], "k int, ts_us long, v double")
    for strategy in ("direct", "sliced"):
        got = asof_join(left, right, ["k"], ["v"], strategy=strategy)
        assert got.columns == ["k", "ts_us", "v"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 5, 0.5), (1, 5, 0.5), (None, 6, None), (2, None, None), (2, 9, 1.5)]))
    rows = left.selectExpr("'x' AS n", "k", "timestamp_micros(ts_us) AS ts", "ts_us")
    got = asof_features(rows, right, ["k"], ["v"])
    assert got.columns == ["k", "ts", "ts_us", "n", "v"] and got.count() == 5
    assert sorted(map(str, (tuple(r) for r in got.select("k", "ts_us", "v").collect()))) == sorted(map(str, [(1, 5, 0.5), (1, 5, 0.5), (None, 6, None), (2, None, None), (2, 9, 1.5)]))
