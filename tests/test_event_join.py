"""Hypotheses of given events: partitions of the join and its rows."""


def test_event_join_is_not_merged_into_few_tasks(spark, tmp_path):
    """Merged at run time, the lines of all events were sorted in a handful of tasks."""
    from vialflow.sources.tables import EventSource
    spark.createDataFrame([(i, i % 3) for i in range(50)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(0, "x"), (1, "y")], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    within = spark.createDataFrame([(i,) for i in [*range(0, 40, 2), 7, 7, None]], "codigo_accidente long")
    s = EventSource(spark, str(tmp_path))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # as with tables of many rows
    try:
        assert s._lines(within).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    keep = {*range(0, 40, 2), 7}
    assert sorted(map(tuple, s.hypotheses(within=within).collect())) == sorted((i, "xy"[i % 3]) for i in keep if i % 3 < 2)
