"""Edge rows for the model chain, albums, stores and data tests (FIXTURES.md section 5)."""

import pytest
from pyspark.sql import functions as F

from chanlake.functions.arrays import unnest_lockstep
from chanlake.operators import albums, quality
from chanlake.operators.dedupe import keep_latest
from chanlake.plans import warehouse
from chanlake.sources import store


def test_keep_latest_null_first_and_ties(spark):
    df = spark.createDataFrame([
        (1, "a", "2024-01-02 00:00:00"), (1, "b", "2024-01-03 00:00:00"), (1, "c", None),
        (2, "x", "2024-01-01 00:00:00"), (2, "y", "2024-01-01 00:00:00"),
        (3, "p", "2024-01-01 00:00:00"), (3, "q", "2023-01-01 00:00:00"),
    ], "message_id int, message_text string, message_date string")
    got = {r[0]: r[1] for r in keep_latest(df, "message_id", "message_date").collect()}
    assert got == {1: "c", 2: "y", 3: "p"}


def test_keep_latest_plan_aggregates_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("d"))
    plan = keep_latest(df, "k", "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") + plan.count("ObjectHashAggregate") >= 2


def test_lockstep_unnest(spark):
    df = spark.createDataFrame([
        (1, [1, 2, 3], ["a"], []), (2, None, [], None), (3, [], [], []), (4, [7], None, ["l"])],
        "g int, ids array<int>, media array<string>, links array<string>")
    rows = sorted(tuple(r) for r in unnest_lockstep(
        df, {"ids": "id", "media": "m", "links": "l"}, keep=["g"]).collect())
    assert rows == [(1, 1, "a", None), (1, 2, None, None), (1, 3, None, None), (4, 7, None, "l")]


def test_fold_albums_first_truthy(spark):
    df = spark.createDataFrame([
        ("c", 5, 10, "", "m5", None, 0), ("c", 4, 10, "t4", "", "2024-01-02", 7),
        ("c", 3, 10, "t3", "m3", "2024-01-01", 8),
        ("c", 2, 0, None, None, None, None), ("c", 1, None, "", "", None, 0),
        ("d", 1, None, "x", "y", "2024", 1)],
        "channel string, id int, grouped_id int, text string, message string, date string, sender_id int")
    out = {(r["channel"], r["group_id"]): r for r in albums.fold_albums(df).collect()}
    a = out[("c", 10)]
    assert a["message_ids"] == [5, 4, 3] and a["text"] == "t4" and a["message"] == "m5"
    assert a["date"] == "2024-01-02" and a["sender_id"] == 7
    assert out[("c", 2)]["text"] is None and out[("c", 1)]["text"] == ""
    assert ("d", 1) in out and len(out) == 4


def test_attach_media_order_and_failures(spark):
    msgs = spark.createDataFrame([("c", 3, 9), ("c", 2, 9), ("c", 1, 9), ("c", 4, None)],
                                 "channel string, id int, grouped_id int")
    media = spark.createDataFrame([("c", 1, "p1"), ("c", 3, "p3"), ("c", 2, None)],
                                  "channel string, id int, path string")
    out = {r["group_id"]: r["media_paths"] for r in albums.attach_media(msgs, media).collect()}
    assert out == {9: ["p3", "p1"], 4: []}


def test_unique_append_rolls_back(spark, workdir):
    path = workdir + "/messages"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "group_id int, message string")
    store.append_unique(spark, first, path, "group_id")
    with pytest.raises(store.UniqueViolation):
        store.append_unique(spark, spark.createDataFrame([(3, "c"), (3, "d")], first.schema), path, "group_id")
    with pytest.raises(store.UniqueViolation):
        store.append_unique(spark, spark.createDataFrame([(2, "x")], first.schema), path, "group_id")
    assert spark.read.parquet(path).count() == 2
    store.append_unique(spark, spark.createDataFrame([(5, "e")], first.schema), path, "group_id")
    assert spark.read.parquet(path).count() == 3


def test_eq_filter_null_semantics(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, v string")
    assert store.eq_filter(df, {"v": None}).count() == 0
    assert store.eq_filter(df, {"v": None}, null_safe=True).count() == 1
    assert store.eq_filter(df, {}).count() == 2
    assert store.eq_filter(df, {"absent": None}, null_safe=True, missing_as_null=True).count() == 2
    assert store.eq_filter(df, {"absent": "x"}, null_safe=True, missing_as_null=True).count() == 0
    with pytest.raises(KeyError):
        store.eq_filter(df, {"absent": None})


def test_marks_advance(spark):
    state = spark.createDataFrame([("a", 5), ("b", 9)], "channel string, last_id long")
    msgs = spark.createDataFrame([("a", 4), ("a", 7), ("c", 2), ("b", 9)], "channel string, id long")
    loaded = store.new_since(msgs, state)
    assert sorted(tuple(r) for r in loaded.collect()) == [("a", 7), ("c", 2)]
    marks = {r[0]: (r[1], r[2]) for r in store.advance_marks(state, loaded).collect()}
    assert marks == {"a": (7, 1), "b": (9, 0), "c": (2, 1)}


def _tiny_warehouse(spark, dup_group=False, unknown_sender=False):
    raw = spark.createDataFrame([
        ("r1", 1, [1, 2], "see https://a.b/x ok", "u", "2024-01-01", ["m1"], "Shop", "+251", "Addis"),
        ("r2", 1 if dup_group else 2, [3], "no link", "u", "2024-01-02", [], "Shop2", "+252", None),
    ], "_id string, group_id long, message_ids array<long>, message_text string, sender string, "
       "scraped_date string, media_paths array<string>, business_name string, phone_number string, "
       "address string")
    msgs = spark.createDataFrame([
        (1, None if unknown_sender else "u", " Hi ", "2024-01-01 10:00:00", None, "c"),
        (1, "u", "old", "2023-01-01 10:00:00", "p", "c")],
        "message_id long, sender_id string, message_text string, message_date string, "
        "media_path string, channel string")
    return warehouse.build({"raw_data": raw, "stg_telegram_messages": msgs})


def test_gate_passes_and_fails(spark):
    # the link-less group pads extracted_link with NULL: that test fails by design
    tests = [t for t in quality.DECLARED_TESTS if t.column != "extracted_link"]
    ok = quality.gate(quality.run_tests(_tiny_warehouse(spark), tests))
    assert ok.where("failures > 0").count() == 0
    with pytest.raises(quality.DataTestFailure) as e:
        quality.gate(quality.run_tests(_tiny_warehouse(spark, dup_group=True, unknown_sender=True), tests))
    failing = {(f["model"], f["column"], f["test"]) for f in e.value.failing}
    assert ("stg_telegram", "group_id", "unique") in failing
    assert ("standardized", "sender_id", "test_sender_id") in failing


def test_standardized_chain(spark):
    got = _tiny_warehouse(spark)["standardized"].collect()
    assert len(got) == 1 and got[0]["message_text"] == "hi"
    assert str(got[0]["formatted_date"]) == "2024-01-01 10:00:00"


def test_example_models(spark):
    first = warehouse.my_first_dbt_model(spark)
    assert sorted([r[0] for r in first.collect()], key=lambda x: (x is None, x)) == [1, None]
    assert [r[0] for r in warehouse.my_second_dbt_model(first).collect()] == [1]


def test_media_path_rules(spark):
    df = spark.createDataFrame([("c", 1, "photo", None), ("c", 2, "document", "video/mp4"),
                                ("c", 3, "document", None), ("c", 4, "other", None)],
                               "channel string, id int, media_kind string, mime_type string")
    only_photo = [r[0] for r in df.select(albums.media_file_path("m", ["photo"])).orderBy("id").collect()]
    both = [r[0] for r in df.select(albums.media_file_path("m", ["photo", "document"])).collect()]
    assert only_photo == ["m/c/1.jpg", None, None, None]
    assert sorted(x for x in both if x) == ["m/c/1.jpg", "m/c/2.mp4", "m/c/3.bin"]


def test_run_gate(spark, workdir):
    tests = [t for t in quality.DECLARED_TESTS if t.column != "extracted_link"]
    raw = _tiny_warehouse(spark)   # sources come from the helper's inputs
    report = warehouse.run(spark, {"raw_data": raw["stg_telegram"].withColumnRenamed("raw_id", "_id").drop("links"),
                                   "stg_telegram_messages": raw["clean_messages"]},
                           workdir + "/wh", tests=tests)
    assert report.where("failures > 0").count() == 0


def test_plain_append(spark, workdir):
    path = workdir + "/docs"
    empty = spark.createDataFrame([], "id int, t string")
    store.append(empty, path)
    import os
    assert not os.path.exists(path.replace("file:", ""))
    store.append(spark.createDataFrame([(1, "a")], empty.schema), path)
    store.append(spark.createDataFrame([(1, "a")], empty.schema), path)
    assert spark.read.parquet(path).count() == 2


def test_append_unique_to_any_target(spark, workdir):
    written = []
    existing = spark.createDataFrame([(1,)], "group_id int")
    ok = spark.createDataFrame([(2,), (3,)], "group_id int")
    store.append_unique_to(ok, existing, "group_id", written.append)
    assert len(written) == 1
    with pytest.raises(store.UniqueViolation):
        store.append_unique_to(spark.createDataFrame([(1,)], "group_id int"), existing, "group_id",
                               written.append)
    assert len(written) == 1


def test_materialize_kinds(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    out = warehouse.materialize(spark, {"m_view": df, "m_table": df, "m_catalog": df},
                                how={"m_table": "table", "m_catalog": "catalog"}, location=workdir + "/wh")
    assert spark.table("m_view").count() == 2 and spark.table("m_table").count() == 2
    assert spark.table("m_catalog").count() == 2 and out["m_catalog"].count() == 2
    spark.sql("DROP TABLE IF EXISTS m_catalog")          # external: files stay in the shared folder
    with pytest.raises(ValueError):
        warehouse.materialize(spark, {"x": df}, how={"x": "table"})


def test_children_read_stored_parents(spark, workdir, monkeypatch):
    raw = _tiny_warehouse(spark)
    raw["clean_messages"].write.parquet(workdir + "/messages")
    files, keep = {}, warehouse.store_model

    def watch(s, name, df, kind, location):
        files[name] = df.inputFiles()
        return keep(s, name, df, kind, location)
    monkeypatch.setattr(warehouse, "store_model", watch)
    stored = warehouse.build_stored(spark, {"stg_telegram_messages": spark.read.parquet(workdir + "/messages")},
                                    workdir + "/wh")
    chain = ["clean_messages", "remove_duplicates", "handle_missing", "standardized"]
    assert list(stored) == chain
    for parent, child in zip(chain, chain[1:]):
        assert files[child] and all(f"/wh/{parent}/" in f for f in files[child])


def test_failed_gate_leaves_its_report(spark, workdir):
    raw = _tiny_warehouse(spark, unknown_sender=True)
    with pytest.raises(quality.DataTestFailure):
        warehouse.run(spark, {"stg_telegram_messages": raw["clean_messages"].withColumn(
            "sender_id", F.lit(None).cast("string"))}, workdir + "/wh")
    assert spark.read.parquet(workdir + "/wh/" + warehouse.REPORT).where("failures > 0").count() > 0


def test_null_keys_never_collide(spark, workdir):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k long, t string")
    store.append_unique(spark, rows, workdir + "/u", "k")
    store.append_unique(spark, rows.where("k IS NULL"), workdir + "/u", "k")
    with pytest.raises(store.UniqueViolation, match="1 keys"):
        store.append_unique(spark, rows, workdir + "/u", "k")
    assert spark.read.parquet(workdir + "/u").count() == 5
    assert [r["k"] for r in spark.read.parquet(workdir + "/u_violations").collect()] == [1]


def test_regex_folds_unicode_case(spark):
    from chanlake.operators import reads
    df = spark.createDataFrame([(1, "CAFÉ Аптека"), (2, "other")], "id long, n string")
    assert [reads.regex_filter(df, "n", p).count() for p in ("café", "АПТЕКА", "x+y")] == [1, 1, 0]
