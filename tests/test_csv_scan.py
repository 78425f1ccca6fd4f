"""CSV records that span lines: any split, equal to Python's reader and to Spark's whole-file reader."""

import csv
import io
import random

import pytest

from chanlake.sources import csv_scan, files

CELLS = ["plain", "two\nlines", 'say "hi"', "", "a,b", "\n", '"', '""', "tail\n", "x\r\ny", '5" nail', "ሰላም", '",\n"', "end,"]


def write(path, rows, header=("id", "a", "b")):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    w.writerows(rows)
    path.write_bytes(buf.getvalue().encode())


@pytest.mark.parametrize("seed", range(4))
def test_records_at_any_split(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [[str(i), rng.choice(CELLS) * rng.randrange(1, 5), rng.choice(CELLS)] for i in range(150)]
    rows[70][1] = 'long "\n' * 400                       # over many splits
    write(tmp_path / "x.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.choice([150, 700])))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        states = csv_scan.entries(spark, str(tmp_path), ",").collect()
        assert len(states) > 5 and all(r["spans"] for r in states)
        got = files.load_csv(spark, str(tmp_path), schema="id string, a string, b string")
        assert sorted(([x or "" for x in r] for r in got.collect()), key=lambda r: int(r[0])) == rows
        whole = files.load_csv(spark, str(tmp_path), schema="id string, a string, b string", multi_line=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_state_behind_a_line_equals_python(spark):
    """``after_line`` against a reader that takes characters one by one."""
    def plain(line, inside):
        start, i = not inside, 0
        closed = False
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"':
                    if line[i + 1:i + 2] == '"':
                        i += 1
                    else:
                        inside, closed = False, True
            elif c == ",":
                start, closed = True, False
                i += 1
                continue
            elif c == '"' and start and not closed:
                inside = True
            start = False
            i += 1
        return inside

    rng = random.Random(3)
    for _ in range(20_000):
        line = "".join(rng.choice('",ab') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            assert csv_scan.after_line(line, inside, ",") == plain(line, inside), (line, inside)


def test_inch_marks_do_not_span(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,a\n1,5" nail\n2,"x ""y"""\n3,6"\n')
    assert files.odd_quotes(spark, str(tmp_path))
    assert files.csv_records(spark, str(tmp_path)) is None
    assert [r["a"] for r in files.load_csv(spark, str(tmp_path)).orderBy("id").collect()] == ['5" nail', 'x "y"', '6"']


def test_headers_types_and_files(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "x\ny", "2.5"], ["2", "", "3"]])
    write(tmp_path / "b.csv", [["3", "z", "4"]])
    df = files.load_csv(spark, str(tmp_path))
    assert df.dtypes == [("id", "int"), ("a", "string"), ("b", "double")]
    assert sorted(map(tuple, df.collect())) == [(1, "x\ny", 2.5), (2, None, 3.0), (3, "z", 4.0)]
    assert files.load_csv(spark, str(tmp_path), infer=False).dtypes == [("id", "string"), ("a", "string"), ("b", "string")]


def test_carriage_returns(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'id,a\r\n1,"x\r\ny"\r\n2,z\r\n')
    rows = files.load_csv(spark, str(tmp_path), schema="id int, a string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x\r\ny"), (2, "z")]


def test_open_quote_at_the_end(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,a\n1,"x\n2,y\n')
    rows = files.load_csv(spark, str(tmp_path), schema="id int, a string").collect()
    assert [r["id"] for r in rows] == [1] and "2,y" in rows[0]["a"]


def test_channel_files_with_spanning_records(spark, tmp_path):
    write(tmp_path / "c1.csv", [["1", "x\ny", "p"]])
    write(tmp_path / "c2.csv", [["q", "2", "u\n\nv"]], header=("b", "id", "a"))
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()),
                           T.StructField("b", T.StringType())])
    for tolerant in (False, True):
        got = files.merge_channels(spark, schema, csv_glob=str(tmp_path / "*.csv"), tolerant=tolerant).collect()
        assert sorted(map(tuple, got)) == [(1, "x\ny", "p", "c1"), (2, "u\n\nv", "q", "c2")]
