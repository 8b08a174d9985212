from riskbook import session


def test_shuffles_start_with_a_partition_for_each_share_of_the_input(spark):
    n, before = int(spark.conf.get("spark.sql.shuffle.partitions")), [(k, spark.conf.get(k, None)) for k in (session.INITIAL, session.OURS)]
    try:
        for k, _ in before:
            spark.conf.unset(k)
        session.spread(spark, n * session.INPUT_BYTES)
        assert spark.conf.get(session.INITIAL, None) is None
        session.spread(spark, 3 * n * session.INPUT_BYTES)
        assert f", {3 * n})" in spark.createDataFrame([(1,)], "a int").groupBy("a").count()._jdf.queryExecution().executedPlan().toString()
        session.spread(spark, 2 * n * session.INPUT_BYTES)
        assert spark.conf.get(session.INITIAL) == str(3 * n)
        session.spread(spark, 5 * n * session.INPUT_BYTES)
        assert spark.conf.get(session.INITIAL) == str(5 * n)
        spark.conf.set(session.INITIAL, "4")  # a cluster's own number
        session.spread(spark, 9 * n * session.INPUT_BYTES)
        assert spark.conf.get(session.INITIAL) == "4"
    finally:
        for k, v in before:
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partitions_are_joined_up_to_sixteen_megabytes(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert session.configure(spark).conf.get(key) == "16m"
        spark.conf.set(key, "8m")  # a cluster's own size
        assert session.configure(spark).conf.get(key) == "8m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
