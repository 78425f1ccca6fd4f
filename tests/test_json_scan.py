"""Structural JSON scan: any layout, any split, nothing lost."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chanlake.sources import files, json_scan

HOSTILE = ['plain', 'a "quoted" word', 'brace } in { text', '[1, {"x": 2}]', 'back\\slash\\\\', '\\"', 'tail\\', 'ሰላም', '',
           "o'k.jpg", 'line\nbreak', '},{']


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind < 2:
        return rng.choice(HOSTILE)
    if kind == 2:
        return rng.choice([None, True, 7, -1.5])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(HOSTILE) + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}


def record(rng, n):
    return {"id": n, "a": value(rng), "b": value(rng), "text": rng.choice(HOSTILE) * rng.randrange(1, 4)}


LAYOUTS = {
    "compact array": lambda rs: json.dumps(rs, separators=(",", ":")),
    "plain array": lambda rs: json.dumps(rs, ensure_ascii=False),
    "indented array": lambda rs: json.dumps(rs, indent=4),
    "array by lines": lambda rs: "[\n" + ",\n".join(map(json.dumps, rs)) + "\n]\n",
    "lines": lambda rs: "\n".join(map(json.dumps, rs)) + "\n",
    "lines without end": lambda rs: "\n".join(map(json.dumps, rs)),
    "two on a line": lambda rs: "".join(json.dumps(r) + (" " if i % 2 else "\n") for i, r in enumerate(rs)),
    "touching": lambda rs: "".join(map(json.dumps, rs)),
    "indented records": lambda rs: "\n".join(json.dumps(r, indent=2) for r in rs),
    "with a mark": lambda rs: "﻿" + json.dumps(rs),
}


def read_all(spark, path, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        paths = [str(path)]
        states = json_scan.entries(spark, paths).collect()
        found = json_scan.records(spark, paths, states).collect()
        return states, found
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("layout", list(LAYOUTS))
@pytest.mark.parametrize("seed", [1, 2])
def test_every_layout_and_split(spark, tmp_path, layout, seed):
    rng = random.Random(f"{layout}-{seed}")
    rows = [record(rng, i) for i in range(60)]
    path = tmp_path / "x.json"
    path.write_text(LAYOUTS[layout](rows), encoding="utf-8")
    states, found = read_all(spark, path, **{"spark.sql.files.maxPartitionBytes": str(rng.choice([211, 800, 3000])),
                                             "spark.sql.files.openCostInBytes": "1"})
    assert len(states) > 2 and all(r["clean"] for r in states)
    assert not [r for r in found if r["stray"]]
    assert sorted((json.loads(r["line"]) for r in found), key=lambda r: r["id"]) == rows


def test_record_longer_than_many_splits(spark, tmp_path):
    rows = [{"id": 0, "t": "x" * 50}, {"id": 1, "t": "} \\\" {" * 3000, "n": [{"k": i} for i in range(500)]}, {"id": 2}]
    (tmp_path / "x.json").write_text(json.dumps(rows))
    states, found = read_all(spark, tmp_path / "x.json", **{"spark.sql.files.maxPartitionBytes": "1000",
                                                            "spark.sql.files.openCostInBytes": "1"})
    assert len(states) > 20
    assert sorted((json.loads(r["line"]) for r in found), key=lambda r: r["id"]) == rows


@pytest.mark.parametrize("text, clean, records, stray", [
    ('[{"a":1},{"a":2}', False, None, None),                 # the array does not end
    ('{"a":1', False, None, None),
    ('[{"a":"x},{"a":2}]', False, None, None),               # a string does not end
    ('{"a":1}}{"a":2}', False, None, None),
    ('[1, "two", {"a":3}, null]', True, 1, 2),               # elements that are no records
    ('[[{"a":1}], {"a":2}]', True, 1, 1),
    ('word {"a":1}', True, 1, 1),
    ('[]', True, 0, 0),
    (' \n', True, 0, 0),
])
def test_what_is_no_record_shows(spark, tmp_path, text, clean, records, stray):
    (tmp_path / "x.json").write_text(text)
    states, found = read_all(spark, tmp_path / "x.json")
    assert all(r["clean"] == clean for r in states)
    if clean:
        assert sum(not r["stray"] for r in found) == records
        assert sum(r["stray"] for r in found) == stray


def test_compressed_file(spark, tmp_path):
    import gzip
    rows = [{"id": i, "n": {"k": "}"}} for i in range(20)]
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        json.dump(rows, f)
    _, found = read_all(spark, tmp_path / "x.json.gz")
    assert sorted((json.loads(r["line"]) for r in found), key=lambda r: r["id"]) == rows


def test_load_json_keeps_every_record(spark, tmp_path):
    """The counterexamples: a compact array, two records on a line, an indented record among one-line objects."""
    rows = [{"id": i, "tags": [{"n": j} for j in range(8)]} for i in range(5)]
    (tmp_path / "a.json").write_text(json.dumps(rows, separators=(",", ":")))
    (tmp_path / "b.json").write_text('{"id":10}{"id":11}\n{"id":12}')
    one = '{\n "id": 20,\n "tags": [\n' + ",\n".join('  {"n":%d}' % j for j in range(8)) + '\n ]\n}'
    (tmp_path / "c.json").write_text(one)
    (tmp_path / "d.json").write_text('{"id":30,"tags":[]}\n{"id":31,"tags":[{"n":1}]}\n')
    df = files.load_json(spark, str(tmp_path))
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 20, 30, 31]
    assert df.where("id = 20").select(F.size("tags")).first()[0] == 8
    with_schema = files.load_json(spark, str(tmp_path), schema="id long")
    assert with_schema.count() == 11


def test_lines_and_structure_are_told_apart(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a":{"b":[{"c":"}{"}]}}\n\n{"a":null}\n')
    (tmp_path / "two.json").write_text('{"a":1},{"a":2}\n')
    lines, others = files.json_forms(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in lines] == ["lines.json"]
    assert [p.rsplit("/", 1)[1] for p in others] == ["two.json"]


def test_broken_file_is_loud(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"a":1,\n"b":')
    with pytest.raises(ValueError, match="brackets do not close"):
        files.load_json(spark, str(tmp_path))
    (tmp_path / "x.json").write_text('{"a":1}\n{"a":\n{"a":3}\n')
    rows = [r["a"] for r in files.load_json(spark, str(tmp_path), schema="a long").collect()]
    assert sorted(rows, key=str) == [1, 3, None]


@pytest.mark.parametrize("shown", [["o'k.jpg", None], ['say "hi"', "o'k", None], [], ["None", "True"], ["a\\b", "tab\t"],
                                   ["x\x1by", "é"], ['both \' and "']])
def test_python_literals(spark, shown):
    df = spark.createDataFrame([(repr(shown),)], "x string")
    got = df.select(F.from_json(files.python_literals(F.col("x")), "array<string>").alias("y")).first()["y"]
    assert got == shown


def test_merge_reads_compact_arrays(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("media", T.ArrayType(T.StringType()))])
    rows = [{"id": i, "media": ["o'k.jpg", None]} for i in range(5)]
    (tmp_path / "one.json").write_text(json.dumps(rows, separators=(",", ":")))
    (tmp_path / "two.csv").write_text("id,media\n7,\"" + repr(["o'k.jpg", None]).replace('"', '""') + "\"\n")
    for tolerant in (False, True):
        got = files.merge_channels(spark, schema, json_glob=str(tmp_path / "*.json"), csv_glob=str(tmp_path / "*.csv"),
                                   tolerant=tolerant).collect()
        assert sorted((r["id"], tuple(r["media"]), r["channel"]) for r in got) == [
            *[(i, ("o'k.jpg", None), "one") for i in range(5)], (7, ("o'k.jpg", None), "two")]


def test_large_file_in_one_line_is_not_read_by_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LARGE", 1000)
    monkeypatch.setattr(files, "MEAN_LINE", 500)
    rows = [{"id": i, "t": "x" * 20} for i in range(200)]
    (tmp_path / "one.json").write_text("".join(map(json.dumps, rows)))
    (tmp_path / "many.json").write_text("\n".join(map(json.dumps, rows)))
    real, read = files.one_record, []
    monkeypatch.setattr(files, "one_record", lambda c: read.append(1) or real(c))
    lines, others = files.json_forms(spark, str(tmp_path / "one.json"))
    assert (len(lines), len(others), read) == (0, 1, [])
    lines, others = files.json_forms(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in lines + others] == ["many.json", "one.json"]
    assert files.load_json(spark, str(tmp_path)).count() == 400
    (tmp_path / "one.json").write_text(json.dumps(rows)[:-30])
    with pytest.raises(ValueError, match="brackets do not close"):
        files.load_json(spark, str(tmp_path))


def test_names_with_odd_characters(spark, tmp_path):
    folder = tmp_path / "a b%20{c}[d]"
    folder.mkdir()
    (folder / "x+y z.json").write_text('[{"id":1},{"id":2}]')
    (folder / "l.json").write_text('{"id":3}\n')
    (folder / "empty.json").write_text("")
    assert sorted(r["id"] for r in files.load_json(spark, str(tmp_path)).collect()) == [1, 2, 3]
