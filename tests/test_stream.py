"""Inactivity folding: gap edges in batch, and stream = batch once a far
future event closes every session."""

from pyspark.sql import functions as F

from chanlake.streaming.sessions import fold_sessions, run_session_stream


def test_gap_edges(spark):
    df = spark.createDataFrame([
        ("c", 1, 10, "2024-01-01 00:00:00", "a"), ("c", 1, 11, "2024-01-01 00:00:05", "b"),
        ("c", 1, 12, "2024-01-01 00:00:10.000001", "c"),
        ("d", 1, 13, "2024-01-01 00:00:01", "x")],
        "channel string, group_id long, id long, ts string, message string"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    out = fold_sessions(df, ["channel", "group_id"], "ts", "id", "5 seconds", texts=["message"])
    got = sorted((r["channel"], r["message_ids"], r["message"]) for r in out.collect())
    assert got == [("c", [10, 11], "a\nb"), ("c", [12], "c"), ("d", [13], "x")]


def test_stream_equals_batch(spark, workdir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = workdir + "/landing"
    ev.write.parquet(src + "/part=0")
    sentinel = spark.createDataFrame([(-1, "2099-01-01 00:00:00", -1, "flush", 0.0, "{}")],
                                     "event_id long, ts string, user_id long, event_type string, "
                                     "value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*ev.columns)
    sentinel.write.parquet(src + "/part=1")
    q = run_session_stream(spark, src + "/part=*", ev.schema, workdir + "/sink", workdir + "/ckpt",
                           ["user_id"], "ts", "event_id", "6 hours", "1 hour",
                           texts=["event_type"], firsts=["value"], max_files=1)
    q.awaitTermination()
    streamed = spark.read.parquet(workdir + "/sink").where("user_id >= 0")
    batch = fold_sessions(ev.withColumn("ts", F.col("ts").cast("timestamp")), ["user_id"], "ts",
                          "event_id", "6 hours", texts=["event_type"], firsts=["value"])
    cols = ["user_id", "session_start", "session_end", "n_messages", "message_ids", "event_type", "value"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert len(a) == len(b) > 0 and a == b


def test_bucketed_fold_equals_one_step(spark):
    # one hot key whose sessions straddle many small buckets
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .withColumn("ts", F.col("ts").cast("timestamp")).withColumn("user_id", F.col("user_id") % 3)
    args = (["user_id"], "ts", "event_id", "20 minutes")
    cols = ["user_id", "session_start", "session_end", "n_messages", "message_ids", "event_type", "value"]
    two = fold_sessions(ev, *args, texts=["event_type"], firsts=["value"], bucket_seconds=600)
    one = fold_sessions(ev, *args, texts=["event_type"], firsts=["value"], bucket_seconds=None)
    a = sorted(tuple(r) for r in two.select(*cols).collect())
    b = sorted(tuple(r) for r in one.select(*cols).collect())
    assert a == b and any(r[3] > 3 for r in a)


def test_stream_resumes_from_checkpoint(spark, workdir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cut = ev.selectExpr("percentile_approx(ts, 0.5) AS m").first()["m"]
    src, sink, ckpt = workdir + "/landing", workdir + "/sink", workdir + "/ckpt"
    args = (["user_id"], "ts", "event_id", "6 hours", "1 hour")
    kw = dict(texts=["event_type"], firsts=["value"])
    ev.where(F.col("ts") < F.lit(cut)).write.parquet(src + "/part=0")
    run_session_stream(spark, src + "/part=*", ev.schema, sink, ckpt, *args, **kw).awaitTermination()
    first = spark.read.parquet(sink).count()
    # restart: more data and a far-future event arrive; open sessions resume from state
    ev.where(F.col("ts") >= F.lit(cut)).write.parquet(src + "/part=1")
    spark.createDataFrame([(-1, "2099-01-01 00:00:00", -1, "flush", 0.0, "{}")],
                          "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*ev.columns).write.parquet(src + "/part=2")
    run_session_stream(spark, src + "/part=*", ev.schema, sink, ckpt, *args, **kw).awaitTermination()
    streamed = spark.read.parquet(sink).where("user_id >= 0")
    batch = fold_sessions(ev.withColumn("ts", F.col("ts").cast("timestamp")), *args[:4], **kw)
    cols = ["user_id", "session_start", "session_end", "n_messages", "message_ids"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert 0 < first < len(b) and a == b


def test_live_album_fold(spark):
    from chanlake.streaming.sessions import fold_live_albums
    df = spark.createDataFrame([
        ("c", 11, 900, "2024-01-01 00:00:00", "first", "", 5),
        ("c", 12, 900, "2024-01-01 00:00:05", "", "t2", 6),        # exactly 5 s later: same album
        ("c", 13, 900, "2024-01-01 00:00:10.5", "late", None, 6),   # 5.5 s later: new record, same id
        ("d", 7, None, "2024-01-01 00:00:01", "other channel", "x", 1),
        ("c", 7, 0, "2024-01-01 00:00:02", "id 7 in c", "y", 2)],   # fallback key 7, own channel
        "channel string, id long, grouped_id long, date string, message string, text string, sender_id long"
    ).withColumn("date", F.col("date").cast("timestamp"))
    got = sorted((r["channel"], r["group_id"], r["message_ids"], r["message"], r["text"], r["sender_id"])
                 for r in fold_live_albums(df).collect())
    assert got == [("c", 7, [7], "id 7 in c", "y", 2), ("c", 900, [11, 12], "first", "t2", 5),
                   ("c", 900, [13], "late", "", 6), ("d", 7, [7], "other channel", "x", 1)]


def test_live_album_media_paths(spark):
    from chanlake.streaming.sessions import fold_live_albums
    df = spark.createDataFrame([
        ("c", 11, 900, "2024-01-01 00:00:00", "a", "a", 5, "m/11.jpg"),
        ("c", 12, 900, "2024-01-01 00:00:01", "", "", 5, None),            # no media / failed download
        ("c", 13, 900, "2024-01-01 00:00:02", "", "", 5, "m/13.jpg")],
        "channel string, id long, grouped_id long, date string, message string, text string, "
        "sender_id long, path string").withColumn("date", F.col("date").cast("timestamp"))
    for bucket in (86400, None):
        r = fold_live_albums(df, media_path="path", bucket_seconds=bucket).first()
        assert r["message_ids"] == [11, 12, 13] and r["path"] == ["m/11.jpg", "m/13.jpg"]


def test_session_fold_variants_agree(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .withColumn("ts", F.col("ts").cast("timestamp")).withColumn("user_id", F.col("user_id") % 4)
    args = (["user_id"], "ts", "event_id", "30 minutes")
    kw = dict(texts=["event_type"], firsts=["value"])
    cols = ["user_id", "session_start", "session_end", "n_messages", "message_ids", "event_type", "value"]
    runs = [fold_sessions(ev, *args, **kw, bucket_seconds=3600, pre_aggregate=True),
            fold_sessions(ev, *args, **kw, bucket_seconds=3600, pre_aggregate=False),
            fold_sessions(ev, *args, **kw, bucket_seconds=None)]
    got = [sorted(tuple(r) for r in df.select(*cols).collect()) for df in runs]
    assert got[0] == got[1] == got[2] and len(got[0]) > 0


def test_late_members_are_found(spark):
    from chanlake.streaming.sessions import late_members
    landed = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("b", 5)], "k string, id long")
    folded = spark.createDataFrame([("a", [1, 2])], "k string, message_ids array<long>")
    assert [tuple(r) for r in late_members(landed, folded, ["k"], "id").collect()] == [("a", 9)]
