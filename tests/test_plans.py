"""Physical plan properties the scale design relies on."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_text_job_has_no_shuffle_and_pruned_scan(spark):
    plan = _plan(spark, "clean_frame")
    assert "hashpartitioning" not in plan            # small input: not even a spread
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_newest_per_channel_limits_before_exchange(spark):
    plan = _plan(spark, "newest_per_channel")
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_keep_latest_is_partial_aggregate(spark):
    plan = _plan(spark, "remove_duplicates")
    assert "partial_max_by" in plan


def _exchanges(plan):
    import re
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_sessions_shuffle_by_bucket_then_key(spark):
    exchanges = _exchanges(_plan(spark, "session_fold"))
    # outermost first: partial sessions by key, events by (key, day bucket)
    assert len(exchanges) == 2
    assert exchanges[0].startswith("user_id") and exchanges[0].count(",") == 1
    assert "_groupingexpression" in exchanges[1]


def test_dense_sessions_are_pre_aggregated_by_slot(spark):
    from chanlake.streaming.sessions import fold_sessions
    ev = spark.range(100).selectExpr("id AS event_id", "id % 3 AS user_id", "timestamp_seconds(id * 60) AS ts")
    plan = fold_sessions(ev, ["user_id"], "ts", "event_id", "5 minutes", pre_aggregate=True)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert len(_exchanges(plan)) == 3 and "partial_collect_list" in plan


def test_marks_do_not_shuffle_messages_on_channel(spark):
    from chanlake.sources import store
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = spark.range(1000).selectExpr("id", "concat('c', id % 3) AS channel")
        state = spark.createDataFrame([("c1", 500)], "channel string, last_id bigint")
        new = store.new_since(m, state)
        # ids above 0, and of c1 above 500
        assert new.count() == sum(1 for i in range(1, 1000) if i % 3 != 1 or i > 500)
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan


def test_spread_is_bounded_and_needs_a_gain(spark, workdir):
    from chanlake.session import spread
    n = spark.sparkContext.defaultParallelism
    spark.range(200_000).selectExpr("id", "repeat('x', 30) AS t").coalesce(1).write.parquet(workdir + "/coarse")
    coarse = spark.read.parquet(workdir + "/coarse")
    few = {"min_bytes": 1}
    assert spread(coarse, **few).rdd.getNumPartitions() == n            # one task on n cores
    assert spread(coarse, min_bytes=1, max_bytes=10).rdd.getNumPartitions() == 1
    split = spark.range(1000).repartition(max(1, n // 2))
    assert spread(split, **few).rdd.getNumPartitions() == max(1, n // 2)     # left alone


def test_cluster_needs_a_shared_folder():
    import pytest
    from chanlake.session import _local_folder
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _local_folder(master)


def test_album_fold_partial(spark):
    plan = _plan(spark, "album_group")
    assert "partial_min_by" in plan and "partial_collect_list" in plan


def test_eq_filter_pushed_to_scan(spark):
    plan = _plan(spark, "eq_filter")
    assert "PushedFilters: [IsNotNull(c_mktsegment), IsNotNull(c_nationkey), EqualTo(c_mktsegment,BUILDING)" in plan


def test_shuffle_sizing(spark):
    from chanlake.session import size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        floor = 2 * spark.sparkContext.defaultParallelism
        assert size_shuffle_partitions(spark, 10) == floor
        assert size_shuffle_partitions(spark, 10 * 1024 ** 4) == 10 * 1024 ** 4 // (256 * 1024 ** 2)
        assert size_shuffle_partitions(spark, 100 * 1024 ** 4) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_unknown_size_leaves_partitions(spark):
    from chanlake.session import estimated_bytes, size_shuffle_partitions
    df = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")   # no statistics
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert estimated_bytes(df) is None
    assert size_shuffle_partitions(spark, estimated_bytes(df)) == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def _shuffle_records(df) -> list[int]:
    """Records written by each shuffle of an executed adaptive plan."""
    out = []

    def walk(p):
        recs = p.metrics().get("shuffleRecordsWritten")
        if recs.isDefined():
            out.append(int(recs.get().value()))
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(p.plan())
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))
    walk(df._jdf.queryExecution().executedPlan().finalPhysicalPlan())
    return out


def test_hot_key_is_reduced_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    from chanlake.operators.dedupe import keep_latest
    # key 0 holds a third of all rows, spread over 8 map tasks
    df = spark.range(30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("d"))
    out = keep_latest(df, "k", "d")
    out.write.format("noop").mode("overwrite").save()
    # 20000 other keys + at most one row of the hot key per map task
    assert _shuffle_records(out) == [20000 + 8]
    assert out.where("k = 0").first()["d"] == "9999"         # max string among ids % 3 == 0


def test_hot_user_session_pre_aggregated_and_spread(spark):
    from pyspark.sql import functions as F
    from chanlake.streaming.sessions import fold_sessions
    # one user active every minute for 3 days: a single session of 4320 events
    n = 3 * 24 * 60
    ev = spark.range(0, n, numPartitions=8).select(
        F.lit(1).alias("user_id"), F.col("id").alias("event_id"),
        (F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp").alias("ts"))
    out = fold_sessions(ev, ["user_id"], "ts", "event_id", "5 minutes", pre_aggregate=True)
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["n_messages"] == n and rows[0]["message_ids"] == list(range(n))
    final_merge, per_day, slots = _shuffle_records(out)
    # events one minute apart pre-aggregate into 5-minute slots before the first
    # shuffle (about n / 5 rows, plus one partial per map task at slot edges);
    # the per-day merge sees slot summaries; the final merge one part per day
    assert slots <= n // 5 + 8 * 4 and per_day <= slots and final_merge <= 8 * 4


def test_hot_channel_and_album_reduced_map_side(spark):
    from pyspark.sql import functions as F
    from chanlake.operators import albums
    # channel 'hot' and album 7 hold a third of all rows, spread over 8 map tasks
    msgs = spark.range(1, 30001, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")))
        .alias("channel"),
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.lit(None)).cast("long").alias("grouped_id"),
        F.col("id").cast("string").alias("text"), F.lit("m").alias("message"), F.lit("d").alias("date"),
        F.lit(1).cast("long").alias("sender_id"))
    newest = albums.newest_per_channel(msgs, 10)
    newest.write.format("noop").mode("overwrite").save()
    # at most n rows per channel and map task reach the window: 51 channels x 8 tasks x 10
    assert _shuffle_records(newest)[0] <= 51 * 8 * 10
    folded = albums.fold_albums(msgs)
    folded.write.format("noop").mode("overwrite").save()
    # the hot album's 10,000 messages cross as one partial buffer per map task
    assert _shuffle_records(folded)[0] == 20000 + 8
    hot = folded.where("channel = 'hot'").first()
    assert hot["group_id"] == 7 and len(hot["message_ids"]) == 10000 and hot["message_ids"][0] == 30000
