"""Commits: unique appends under a race, rows and marks together, the target left unread."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from chanlake.sources import commits, store


def frame(spark, a, b, step=1):
    return spark.range(a, b, step).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))


def ids(spark, path):
    return sorted(r["id"] for r in commits.read(spark, path).collect() if r["id"] is not None)


def test_append_reject_and_report(spark, workdir):
    path, told = workdir + "/t", []
    assert commits.append_unique(spark, frame(spark, 0, 5000), path, "id") == 1
    assert commits.append_unique(spark, frame(spark, 5000, 9000), path, "id") == 2
    with pytest.raises(store.UniqueViolation):
        commits.append_unique(spark, frame(spark, 8990, 9010), path, "id", report=lambda d: told.extend(d.collect()))
    assert sorted(r["id"] for r in told) == list(range(8990, 9000)) and all(r["in_target"] for r in told)
    twice = frame(spark, 20000, 20003).union(frame(spark, 20002, 20004))
    with pytest.raises(store.UniqueViolation, match="20002"):
        commits.append_unique(spark, twice, path, "id")
    none = frame(spark, 0, 3).withColumn("id", F.lit(None).cast("long"))
    commits.append_unique(spark, none, path, "id")
    commits.append_unique(spark, none, path, "id")                  # NULL keys never collide
    commits.append_unique(spark, frame(spark, 0, 0), path, "id")     # nor does an empty batch
    assert ids(spark, path) == list(range(9000)) and commits.read(spark, path).count() == 9006


def test_target_is_not_read(spark, workdir):
    """With its data files gone, the table still tells new keys from old ones."""
    path = workdir + "/t"
    for a in range(0, 40_000, 10_000):
        commits.append_unique(spark, frame(spark, a, a + 10_000), path, "id")
    for name in commits.snapshot(spark, path)["data"]:
        folder = f"{path}/{name}".replace("file:", "")
        for f in os.listdir(folder):
            os.truncate(os.path.join(folder, f), 0)
    with pytest.raises(store.UniqueViolation):
        commits.append_unique(spark, frame(spark, 39_999, 40_001), path, "id")
    commits.append_unique(spark, frame(spark, 40_000, 40_010), path, "id")


def test_index_entries_stay_few(spark, workdir):
    path = workdir + "/t"
    for a in range(12):
        commits.append_unique(spark, frame(spark, a * 10, a * 10 + 10), path, "id")
    entries = commits.snapshot(spark, path)["index"]
    assert sum(e["n"] for e in entries) == 120 and len(entries) <= 4
    assert commits.in_index(spark, spark.range(100, 140).select(F.col("id").alias("key")), path, entries).count() == 20


def test_bitmaps_name_few_suspects(spark, workdir):
    path = workdir + "/t"
    commits.append_unique(spark, frame(spark, 0, 50_000), path, "id")
    e = commits.snapshot(spark, path)["index"][0]
    keys = spark.range(1_000_000, 1_050_000).select(F.col("id").alias("key"))
    bits = spark.read.parquet(f"{path}/{e['bits']}")
    hit = commits._hashed(keys, e["buckets"]).join(bits, "bucket").filter(commits._hit(F.col("bits"), F.col("bit"))).count()
    assert 0 < hit < 50_000 / 12
    own = commits._hashed(spark.range(50_000).select(F.col("id").alias("key")), e["buckets"]).join(bits, "bucket")
    assert own.filter(commits._hit(F.col("bits"), F.col("bit"))).count() == 50_000


def race(*jobs):
    out, gate = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(i, job):
        gate.wait()
        try:
            out[i] = job()
        except Exception as e:  # noqa: BLE001
            out[i] = e
    threads = [threading.Thread(target=run, args=x) for x in enumerate(jobs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_racing_appenders(spark, workdir):
    """Of two with a common key exactly one wins; two without one both do."""
    path = workdir + "/t"
    commits.append_unique(spark, frame(spark, 0, 10), path, "id")
    out = race(lambda: commits.append_unique(spark, frame(spark, 10, 30), path, "id"),
               lambda: commits.append_unique(spark, frame(spark, 29, 50), path, "id"))
    assert sum(isinstance(x, int) for x in out) == 1 and sum(isinstance(x, store.UniqueViolation) for x in out) == 1, out
    assert ids(spark, path) in (list(range(30)), [*range(10), *range(29, 50)])
    out = race(lambda: commits.append_unique(spark, frame(spark, 100, 110), path, "id"),
               lambda: commits.append_unique(spark, frame(spark, 110, 120), path, "id"),
               lambda: commits.append_unique(spark, frame(spark, 120, 130), path, "id"))
    assert sorted(out) == [3, 4, 5]
    assert [i for i in ids(spark, path) if i >= 100] == list(range(100, 130))


def test_next_manifest_is_put_once(spark, workdir):
    path = workdir + "/t"
    state = commits.snapshot(spark, path)
    commits.commit(spark, path, state)
    with pytest.raises(commits.Conflict):
        commits.commit(spark, path, state)
    assert commits.snapshot(spark, path)["version"] == 1
    assert not [n for n in os.listdir(f"{path}/_commits".replace("file:", "")) if n.startswith(".") and "crc" not in n]


def messages(spark, top):
    return spark.createDataFrame([(c, i, f"{c}{i}") for c in "ab" for i in range(1, top + 1)],
                                 "channel string, id long, text string")


def test_rows_and_marks_are_one_commit(spark, workdir):
    path = workdir + "/t"
    commits.load_new(spark, messages(spark, 3), path)

    def die():
        raise InterruptedError
    with pytest.raises(InterruptedError):                            # rows and marks written, not committed
        commits.load_new(spark, messages(spark, 5), path, before_commit=die)
    assert commits.read(spark, path).count() == 6
    new = commits.load_new(spark, messages(spark, 5), path)
    assert sorted(map(tuple, new.collect())) == [("a", 5, 2), ("b", 5, 2)]
    assert commits.read(spark, path).count() == 10 and commits.read(spark, path).distinct().count() == 10
    commits.load_new(spark, messages(spark, 5), path)
    assert commits.read(spark, path).count() == 10


def test_growing_source(spark, workdir):
    """Rows that appear between the writing and the marks are neither lost nor marked."""
    path, source = workdir + "/t", workdir + "/source"
    messages(spark, 3).write.parquet(source)
    live = spark.read.parquet(source)

    def grow():
        messages(spark, 6).where("id > 3").write.mode("append").parquet(source)
    new = commits.load_new(spark, live, path, before_commit=grow)
    assert {r["last_id"] for r in new.collect()} == {3}
    commits.load_new(spark, spark.read.parquet(source), path)
    assert commits.read(spark, path).count() == 12


def test_racing_loaders(spark, workdir):
    path = workdir + "/t"
    commits.load_new(spark, messages(spark, 2), path)
    out = race(lambda: commits.load_new(spark, messages(spark, 4), path).count(),
               lambda: commits.load_new(spark, messages(spark, 5), path).count())
    assert out == [2, 2]
    rows = commits.read(spark, path)
    assert rows.count() == rows.distinct().count() == 10
    assert {r["last_id"] for r in commits.marks(spark, path).collect()} == {5}


def test_any_sink_gets_the_rows_of_the_marks(spark, workdir):
    """``store.load_new``: the source grows while the sink writes; the marks stay with the written rows."""
    source, sink, marks = (workdir + x for x in ("/s", "/k", "/m"))
    messages(spark, 3).write.parquet(source)

    def write(df):
        df.write.mode("append").parquet(sink)
        if spark.read.parquet(source).count() == 6:
            messages(spark, 6).where("id > 3").write.mode("append").parquet(source)
    for _ in range(2):
        store.load_new(spark, spark.read.parquet(source), marks, write)
    rows = spark.read.parquet(sink)
    assert rows.count() == rows.distinct().count() == 12
