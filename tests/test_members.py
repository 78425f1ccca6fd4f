"""Long-format sessions: any partitioning, hot keys over many tasks, late members of a live run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chanlake.streaming import members, sessions

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, id long, part string, session long"


def rows_of(spark, rows, parts=5):
    full = [(k, None if s is None else START + dt.timedelta(seconds=s), i, "x", 9) for k, s, i in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def plain(rows, gap):
    out, seen = [], {}
    for k, s, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        at = s if s is not None else -10 ** 9
        last, session, place = seen.get(k, (None, 0, -1))
        if last is not None and at - last > gap:
            session, place = session + 1, -1
        seen[k] = (at, session, place + 1)
        out.append((i, session, place + 1))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_members_as_counted_one_by_one(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "hot", "hot", "hot", "b", None]), rng.choice([None, rng.randrange(3000), rng.randrange(3000),
             rng.randrange(3000)]) if rng.random() < 0.3 else rng.randrange(3000), i) for i in range(700)]
    df = rows_of(spark, rows).drop("session")
    got = members.session_members(df, ["k"], "ts", "id", 7)
    assert sorted((r["id"], r["session"], r["place"]) for r in got.collect()) == plain(rows, 7)


def test_one_key_is_spread(spark):
    """A key that is active all the time goes through many tasks, and its one session is numbered through."""
    rows = [("hot", i, i) for i in range(4000)]
    got = members.session_members(rows_of(spark, rows).drop("session"), ["k"], "ts", "id", 5)
    parts = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
    assert sorted((r["id"], r["session"], r["place"]) for r in got.collect()) == [(i, 0, i) for i in range(4000)]
    one = members.summaries(got, ["k"], "ts", "id").first()
    assert one["n_messages"] == 4000 and one["session_start"] == START


def test_summaries_equal_the_list_fold(spark):
    rng = random.Random(9)
    rows = [(rng.choice("abc"), rng.randrange(2000), i) for i in range(300)]
    df = rows_of(spark, rows).drop("session")
    long = members.summaries(members.session_members(df, ["k"], "ts", "id", 6), ["k"], "ts", "id", firsts=["id"])
    fold = sessions.fold_sessions(df, ["k"], "ts", "id", "6 seconds")
    want = sorted((r["k"], r["session_start"], r["n_messages"], r["message_ids"][0]) for r in fold.collect())
    assert sorted((r["k"], r["session_start"], r["n_messages"], r["id"]) for r in long.collect()) == want


def test_no_rows(spark):
    df = rows_of(spark, []).drop("session")
    assert members.session_members(df, ["k"], "ts", "id", 5).collect() == []


class Live:
    def __init__(self, spark, workdir):
        self.spark, self.base = spark, workdir

    def land(self, rows):
        rows_of(self.spark, rows, 1).drop("session").write.mode("append").parquet(self.base + "/in")
        stream = sessions.read_landed(self.spark, self.base + "/in", rows_of(self.spark, []).drop("session").schema)
        live = members.live_members(stream, ["k"], "ts", "id", 5, "2 seconds")
        sessions.write_append(live, self.base + "/out", self.base + "/ck").awaitTermination()
        return {r["id"]: (r["record"], r["place"]) for r in self.spark.read.parquet(self.base + "/out").collect()}


def test_late_member_opens_a_second_record(spark, workdir):
    live = Live(spark, workdir)
    got = live.land([("a", 0, 1), ("a", 3, 2), ("b", 1, 3), ("a", 20, 4)])
    assert got == {1: (0, 0), 2: (0, 1), 3: (0, 0), 4: (1, 0)}
    got = live.land([("c", 100, 5)])                       # the watermark passes every record so far
    assert got[5] == (0, 0)
    got = live.land([("a", 4, 6), ("a", 5, 7), ("b", 2, 8)])
    assert (got[6], got[7], got[8]) == ((2, 0), (2, 1), (1, 0))
    assert len(got) == 8                                   # each member once


def test_member_joins_what_is_open(spark, workdir):
    live = Live(spark, workdir)
    live.land([("a", 50, 1)])
    got = live.land([("a", 47, 2), ("a", 54, 3), ("a", 70, 4)])   # older, within the gap, beyond it
    assert got == {1: (0, 0), 2: (0, 1), 3: (0, 2), 4: (1, 0)}


def test_live_members_in_a_session_without_our_defaults(spark, workdir):
    """Spark's default state store refuses state with timers; the operator sets the one it needs itself."""
    plain_session = spark.newSession()
    plain_session.conf.set("spark.sql.streaming.stateStore.providerClass",
                           "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    live = Live(plain_session, workdir)
    live.land([("a", 0, 1), ("a", 3, 2), ("b", 100, 3)])
    assert live.land([("a", 1, 4)]) == {1: (0, 0), 2: (0, 1), 3: (0, 0), 4: (1, 0)}


def test_live_members_with_null_keys(spark, workdir):
    """A NULL among integer keys neither mixes groups nor changes a value; NULL keys are a key."""
    schema, far = "id long, k long, ts timestamp, small short", 2 ** 60

    def land(rows):
        full = [(i, k, START + dt.timedelta(seconds=s), small) for i, k, s, small in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(workdir + "/in")
        stream = sessions.read_landed(spark, workdir + "/in", spark.createDataFrame([], schema).schema)
        live = members.live_members(stream, ["k"], "ts", "id", 5, "2 seconds")
        assert live.dtypes == [("id", "bigint"), ("k", "bigint"), ("ts", "timestamp"), ("small", "smallint"),
                               ("record", "bigint"), ("place", "bigint")]
        sessions.write_append(live, workdir + "/out", workdir + "/ck").awaitTermination()
        return {(r["id"], r["k"], r["small"]): (r["record"], r["place"])
                for r in spark.read.parquet(workdir + "/out").collect()}

    got = land([(far + i, k, 10 * r, None if i % 2 else i) for r in range(3) for i, k in
                [(10 * r, None), (10 * r + 1, far + 1), (10 * r + 2, far + 2), (10 * r + 3, 7)]] + [(None, 7, 21, 1)])
    want = {(far + 10 * r + i, k, None if i % 2 else 10 * r + i): (r, 0)
            for r in range(3) for i, k in enumerate([None, far + 1, far + 2, 7])}
    assert got == want | {(None, 7, 1): (2, 1)}
    land([(1, 100, 100, 0)])                                # the watermark passes every record so far
    got = land([(2, None, 1, 0), (3, far + 1, 1, 0), (4, 7, 1, 0)])
    assert (got[2, None, 0], got[3, far + 1, 0], got[4, 7, 0]) == ((3, 0), (3, 0), (3, 0))
