"""File sources and sinks: lossless CSV, CoNLL edges, dispatch, channel merge."""

import pytest
from pyspark.sql import functions as F

from chanlake.sources import files


def test_csv_lossless(spark, workdir):
    rows = [(1, 'say "hi", ok'), (2, "line1\nline2"), (3, "  padded  "), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    files.save_csv(df, workdir + "/x.csv")
    back = sorted(tuple(r) for r in files.load_csv(spark, workdir + "/x.csv", schema=df.schema,
                                                    lossless=True).collect())
    assert back == rows


def test_conll_edges(spark, workdir):
    path = workdir + "/raw.conll"
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(path.replace("file:", "") + "/a.conll", "w") as f:
        f.write("a\tO\nb\tB-X\n   \n\nc\tO\n \t \nd\tO")          # spaces-only lines, no final newline
    got = sorted((r["tokens"], r["labels"]) for r in files.load_conll(spark, path).collect())
    assert got == [(["a", "b"], ["O", "B-X"]), (["c"], ["O"]), (["d"], ["O"])]


def test_conll_roundtrip_truncates(spark, workdir):
    df = spark.createDataFrame([(["a", "b", "c"], ["O", "X"]), ([], []), (["z"], ["O"])],
                               "tokens array<string>, labels array<string>")
    files.save_conll(df, workdir + "/s.conll")
    got = sorted((r["tokens"], r["labels"]) for r in files.load_conll(spark, workdir + "/s.conll").collect())
    assert got == [(["a", "b"], ["O", "X"]), (["z"], ["O"])]


def test_dispatch_errors(spark, workdir):
    with pytest.raises(FileNotFoundError):
        files.load(spark, workdir + "/missing.json")
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        files.save(df, workdir + "/x.xlsx")


def test_merge_channels(spark, workdir):
    df = spark.createDataFrame([("c1", 1, [1, 2]), ("c2", 2, [3]), ("c3", 3, None)],
                               "channel string, group_id long, ids array<long>")
    files.save_by_channel(df.where("channel != 'c3'"), workdir + "/j", fmt="json")
    files.save_by_channel(df.where("channel = 'c3'"), workdir + "/c", fmt="csv")
    merged = files.merge_channels(spark, df.drop("channel").schema, json_glob=workdir + "/j/*/*.json",
                                  csv_glob=workdir + "/c/*/*.csv")
    assert sorted((r["channel"], r["group_id"], r["ids"]) for r in merged.collect()) == \
        [("c1", 1, [1, 2]), ("c2", 2, [3]), ("c3", 3, None)]


def test_json_array_form(spark, workdir):
    df = spark.range(50).select(F.col("id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    files.save_json_array(df.repartition(3), workdir + "/a.json")
    assert files.load_json(spark, workdir + "/a.json", array_form=True).count() == 50


def test_merge_channels_tolerant(spark, workdir):
    import os
    df = spark.createDataFrame([("c1", 1, [1, 2])], "channel string, group_id long, ids array<long>")
    files.save_by_channel(df, workdir + "/j", fmt="json")
    bad_dir = (workdir + "/j/channel=broken").replace("file:", "")
    os.makedirs(bad_dir, exist_ok=True)
    with open(bad_dir + "/part-0.json", "w") as f:
        f.write('{"group_id": 7, "ids": [1,\n')
    merged = files.merge_channels(spark, df.drop("channel").schema, json_glob=workdir + "/j/*/*.json",
                                  tolerant=True)
    assert [(r["channel"], r["group_id"]) for r in merged.collect()] == [("c1", 1)]


def test_conll_split_file(spark, workdir):
    import os
    path = (workdir + "/big.conll").replace("file:", "")
    os.makedirs(path, exist_ok=True)
    sentences = [[f"w{i}_{j}" for j in range(1 + i % 7)] for i in range(3000)]
    with open(path + "/one.conll", "w") as f:
        for k, s in enumerate(sentences):
            f.write("".join(f"{t}\tO\n" for t in s))
            f.write("\n" if k % 3 else "  \n\n")                # some separators carry spaces
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.load_conll(spark, path)
        assert df.rdd.getNumPartitions() > 1
        got = sorted(tuple(r["tokens"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(tuple(s) for s in sentences)


def test_csv_infer_or_all_strings(spark, workdir):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, 3.0, "b")], "i int, d double, s string")
    files.save_csv(df, workdir + "/t.csv", lossless=False)
    inferred = files.load_csv(spark, workdir + "/t.csv", infer=True)
    as_text = files.load_csv(spark, workdir + "/t.csv", infer=False)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double", "string"]
    assert {f.dataType.simpleString() for f in as_text.schema} == {"string"}
    assert sorted(r["i"] for r in as_text.collect()) == ["1", "2"]


def test_json_array_with_empty_partitions(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, t string").repartition(8)
    files.save_json_array(df, workdir + "/sparse.json")
    back = files.load_json(spark, workdir + "/sparse.json", array_form=True, schema=df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def _write(workdir, name, text):
    import os
    path = os.path.join(workdir.replace("file:", ""), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_load_reads_what_save_writes(spark, workdir):
    rows = [(i, None if i % 7 == 0 else ["", "\\N x", 'q"', "a\nb", "  p "][i % 5]) for i in range(1000)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    for name in ("x.json", "x.csv", "x.parquet"):
        files.save(df, f"{workdir}/{name}")
        back = files.load(spark, f"{workdir}/{name}")
        assert sorted(((int(r["i"]), r["t"]) for r in back.collect())) == sorted(rows), name


def test_json_forms_in_one_folder(spark, workdir):
    import json
    _write(workdir, "in/lines.json", '{"a": 1, "s": "x, y]"}\n\n{"a": 2, "s": null}\n')
    _write(workdir, "in/array.json", '[\n{"a": 3, "s": "[z"},\n{"a": 4}\n]\n')
    _write(workdir, "in/indented.json", json.dumps([{"a": 5, "s": "é"}, {"a": 6, "s": "w"}], indent=2))
    _write(workdir, "in/one.json", '[{"a": 7, "s": "only"}]')
    got = files.load_json(spark, workdir + "/in", schema="a int, s string")
    assert sorted((r["a"], r["s"]) for r in got.collect()) == [
        (1, "x, y]"), (2, None), (3, "[z"), (4, None), (5, "é"), (6, "w"), (7, "only")]
    inferred = files.load_json(spark, workdir + "/in")
    assert sorted(r["a"] for r in inferred.collect()) == list(range(1, 8))


def test_all_null_column_survives_json(spark, workdir):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    files.save_json(df, workdir + "/n.json")
    assert files.load(spark, workdir + "/n.json").columns == ["a", "b"]


def test_channel_names_and_headers(spark, workdir):
    names = ["a+b", "a:b", "a/b", "a=b", "a%b", "shop one", None]
    df = spark.createDataFrame([(n, i, [f"p{i}", None]) for i, n in enumerate(names)],
                               "channel string, group_id long, media array<string>")
    for fmt in ("json", "csv"):
        files.save_by_channel(df, f"{workdir}/{fmt}", fmt=fmt)
        merged = files.merge_channels(spark, df.drop("channel").schema, **{f"{fmt}_glob": f"{workdir}/{fmt}/*/*.{fmt}"})
        assert sorted(((str(r["channel"]), r["group_id"], r["media"]) for r in merged.collect())) == sorted(
            (str(n), i, [f"p{i}", None]) for i, n in enumerate(names))


def test_merge_arrays_swapped_headers_and_python_lists(spark, workdir):
    schema = spark.createDataFrame([], "message string, note long, media array<string>").schema
    _write(workdir, "j/shop one.json", '[\n  {"message": "hi", "note": 1, "media": ["m", null]},\n  {"note": 2}\n]')
    _write(workdir, "j/two+.json", '[\n{"message": "x"},\n{"message": "y", "note": 3}\n]')
    _write(workdir, "c/three.csv", "note,message,media\n7,hello,\"['a.jpg', None]\"\n")
    _write(workdir, "c/four.csv", "message,note\nbad,not a number\n")
    got = files.merge_channels(spark, schema, workdir + "/j/*.json", workdir + "/c/*.csv", tolerant=True)
    assert sorted((r["channel"], str(r["message"]), str(r["note"]), str(r["media"])) for r in got.collect()) == [
        ("four", "bad", "None", "None"), ("shop one", "None", "2", "None"), ("shop one", "hi", "1", "['m', None]"),
        ("three", "hello", "7", "['a.jpg', None]"), ("two+", "x", "None", "None"), ("two+", "y", "3", "None")]


def test_large_files_split(spark, workdir):
    body = "".join(f"{i},text {i}\n" for i in range(5000))
    csv = _write(workdir, "s/a.csv", "i,t\n" + body)
    conll = _write(workdir, "s/a.conll", "".join(f"w{i}\tO\r\nv\tB\r\n\r\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        c, k = files.load_csv(spark, csv), files.load_conll(spark, conll)
        assert c.rdd.getNumPartitions() > 1 and k.rdd.getNumPartitions() > 1
        assert c.count() == 5000 and sorted(r["tokens"][0] for r in k.collect()) == sorted(f"w{i}" for i in range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_conll_third_field_fails(spark, workdir):
    path = _write(workdir, "bad.conll", "a\tO\tx\n")
    with pytest.raises(Exception, match="not a token and a label"):
        files.load_conll(spark, path).collect()
