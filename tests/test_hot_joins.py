"""Joins with tables that grow don't broadcast them by their files' size."""

from chunkloom.operators import joins as J


def test_many_keys_are_shuffled(spark, tmp_path):
    total = J.MANY + 1
    spark.range(total).selectExpr("id as k", "1L as n", "id % 7 as v").write.parquet(f"{tmp_path}/keyed")
    keyed = spark.read.parquet(f"{tmp_path}/keyed")
    found = J.hot_left_join(spark.range(50).selectExpr("id * 3 as k", "id as by"), keyed, "k", "by", total)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the hot keys
    assert sorted((r["k"], r["v"]) for r in found.collect()) == [(3 * i, 3 * i % 7) for i in range(50)]
