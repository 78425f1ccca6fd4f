"""Sessions in long format: one row for each member, with the number of its session and its place there.

A session that holds a third of all events is then as many rows, not one row with a list, and no step holds a key's
events together (ST2, A5). A live run keeps only the open edge of each group, and a member that comes after its
group's record has closed opens a second record (ST3).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chanlake.session import estimated_bytes, keep_state_in_rocksdb, shared_path

TASK_BYTES = 64 * 1024 * 1024


# --- batch: numbers carried over the edges of a range partitioning -------------------------

def _numbered(gap_us: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a sorted partition: session and place of each row, counted from 0 at the partition's start or at its
    key's first row; ``run`` numbers the partition's sessions, ``keys`` its keys."""
    part = TaskContext.get().partitionId()
    last_key, last_us, session, place, run, keys = None, 0, 0, 0, 0, 0
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        coded = b.column("_key").dictionary_encode()
        names, code = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64)
        us = np.asarray(b.column("_us"), np.int64)
        same = np.zeros(n, bool)
        same[1:] = code[1:] == code[:-1]
        same[0] = last_key is None or names[code[0]] == last_key
        before = np.concatenate([[us[0] if last_key is None else last_us], us[:-1]])
        new_key = ~same                                    # the partition's first row goes on, for all we know here
        starts = new_key | (us - before > gap_us)          # of a session
        runs = run + np.cumsum(starts)
        at_key = np.maximum.accumulate(np.where(new_key, np.arange(n), -1))
        base = np.where(at_key >= 0, runs[np.maximum(at_key, 0)], run - session)
        at_start = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
        places = np.where(at_start >= 0, np.arange(n) - at_start, np.arange(n) + place)
        key_no = keys + np.cumsum(new_key)
        sessions = runs - base
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(sessions), pa.array(places), pa.array(runs),
             pa.array(key_no)], [*b.schema.names, "_part", "_session", "_place", "_run", "_keys"])
        last_key, last_us = names[code[-1]], int(us[-1])
        session, place, run, keys = int(sessions[-1]), int(places[-1]) + 1, int(runs[-1]), int(key_no[-1])


def carried(edges: list, gap_us: int) -> list[tuple[int, int, int]]:
    """(partition, sessions, places) that the first key, and the first session, of each partition go on from; one
    row a partition in, one out."""
    out, key, last, session, place = [], None, 0, 0, 0
    for e in sorted(edges, key=lambda e: e["part"]):
        begins = key is None or e["first_key"] != key
        new = begins or e["first_us"] - last > gap_us
        ahead = 0 if begins else session + 1 if new else session
        along = 0 if new else place
        out.append((e["part"], ahead, along))
        one_run = e["runs"] == 0                           # the partition holds one session only
        session = e["last_session"] + (ahead if e["keys"] == 0 else 0)
        place = e["last_place"] + 1 + (along if one_run else 0)
        key, last = e["last_key"], e["last_us"]
    return out


def session_members(df: DataFrame, keys: Sequence[str], ts: str, msg_id: str, gap_seconds: float) -> DataFrame:
    """Every row with ``session`` (number within its key, from 0) and ``place`` (within its session, from 0), by
    time and id; members more than ``gap_seconds`` apart are in different sessions. NULL keys are a key; rows without a
    time come first, as one session.

    Rows are range-partitioned by key, time and id, so an always-active key spreads over many tasks; the carry is one row
    a partition. The sorted rows are written once."""
    spark, gap_us = df.sparkSession, int(gap_seconds * 1_000_000)
    order = [*keys, ts, msg_id]
    size = estimated_bytes(df) or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES) if size < 1 << 56 else 0)
    us = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(1 << 62)))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns(
        {"_key": F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), "_us": us})
    more = [("_part", T.IntegerType()), *[(c, T.LongType()) for c in ("_session", "_place", "_run", "_keys")]]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, t) for c, t in more]])

    def number(batches):
        return _numbered(gap_us, batches)

    path = shared_path(spark, "sessions", "numbered")
    rows.mapInArrow(number, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    head, tail = F.struct("_keys", "_run", "_place"), F.struct("_keys", "_run", "_place")
    edges = found.groupBy("_part").agg(
        F.min_by("_key", head).alias("first_key"), F.min_by("_us", head).alias("first_us"),
        F.max_by("_key", tail).alias("last_key"), F.max_by("_us", tail).alias("last_us"),
        F.max_by("_session", tail).alias("last_session"), F.max_by("_place", tail).alias("last_place"),
        F.max("_run").alias("runs"), F.max("_keys").alias("keys")).withColumnRenamed("_part", "part").collect()
    ahead = spark.createDataFrame(carried(edges, gap_us), "_part int, _ahead long, _along long")
    both = found.join(F.broadcast(ahead), "_part")        # one row of 20 bytes for each partition
    session = F.col("_session") + F.when(F.col("_keys") == 0, F.col("_ahead")).otherwise(0)
    place = F.col("_place") + F.when(F.col("_run") == 0, F.col("_along")).otherwise(0)
    return both.select(*df.columns, session.alias("session"), place.alias("place"))


def summaries(members: DataFrame, keys: Sequence[str], ts: str, msg_id: str, firsts: Sequence[str] = ()) -> DataFrame:
    """One row a session without lists: start, last arrival, number of members, and ``firsts`` of the first member; all
    partial aggregates."""
    return members.groupBy(*keys, "session").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("last_arrival"), F.count(F.lit(1)).alias("n_messages"),
        *[F.min_by(c, F.col("place")).alias(c) for c in firsts])


# --- live: state keeps the open edge, late members open the next record ---------------------

EDGE = T.StructType([T.StructField("record", T.LongType()), T.StructField("place", T.LongType()),
                     T.StructField("last", T.LongType()), T.StructField("open", T.BooleanType())])


class OpenEdge(StatefulProcessor):
    """Passes each member on with its record's number and its place; keeps, for a group, the number and size of its
    newest record, its last arrival and whether it is open. A timer closes it once the watermark has passed the gap."""

    def __init__(self, gap_us: int, names: Sequence[str], order: Sequence[str]):
        self.gap_us, self.names, self.order = gap_us, list(names), list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.edge = handle.getValueState("edge", EDGE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        record, place, last, open_ = self.edge.get() if self.edge.exists() else (-1, 0, 0, False)
        for part in rows:
            part = part.sort_values(self.order, kind="stable")
            records, places = [], []
            for us in part["us"].tolist():
                if not open_ or us - last > self.gap_us:
                    record, place, last, open_ = record + 1, 0, us, True
                records.append(record)
                places.append(place)
                place, last = place + 1, max(last, us)
            yield part[self.names].assign(record=records, place=places)
        self.edge.update((int(record), int(place), int(last), bool(open_)))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int((last + self.gap_us) // 1000 + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        record, place, last, _ = self.edge.get()
        self.edge.update((int(record), int(place), int(last), False))
        return iter([])

    def close(self) -> None:
        pass


def live_members(stream: DataFrame, keys: Sequence[str], ts: str, msg_id: str, gap_seconds: float, lateness: str) -> DataFrame:
    """ST2 + ST3 on a stream: every member once, with ``record`` (number of its group's record, from 0) and ``place``.

    A member joins its group's open record if it is at most the gap after the record's last arrival (an older one always
    does, as the listener's cache takes it); else it opens the next. A record closes when the watermark (the
    latest time less ``lateness``) passes its last arrival plus the gap; a member that comes after that, however
    old, opens a second record of the group and is not dropped: the watermark's column does not reach the operator. NULL
    keys are a key.
    A micro-batch is taken in order of time within each Arrow batch of a group; state is one slim row a group.

    State with timers needs the RocksDB store, so the stream's session is set to it for the streams it starts from here."""
    keep_state_in_rocksdb(stream.sparkSession)
    names = [msg_id, *[c for c in stream.columns if c != msg_id]]
    timed = stream.withColumn("_at", F.col(ts).try_cast("timestamp")).filter("_at is not null").withWatermark(
        "_at", lateness)
    # columns travel under plain names: the workers see rows as named tuples. There an integer column with NULLs
    # turns into floats, which find no key's state and lose digits: integers travel filled, with a mark; the key as text
    kinds = [stream.schema[c].dataType for c in names]
    whole = [i for i, kind in enumerate(kinds) if isinstance(kind, T.IntegralType)]
    filled = [F.coalesce(c, F.lit(0).cast(kind)) if i in whole else F.col(c) for i, (c, kind) in enumerate(zip(names, kinds))]
    rows = timed.select(
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"), F.unix_micros("_at").alias("us"),
        *[c.alias(f"c{i}") for i, c in enumerate(filled)], *[F.col(names[i]).isNull().alias(f"n{i}") for i in whole])
    schema = T.StructType([*[T.StructField(f"c{i}", kind) for i, kind in enumerate(kinds)],
                           *[T.StructField(f"n{i}", T.BooleanType()) for i in whole],
                           T.StructField("record", T.LongType()), T.StructField("place", T.LongType())])
    order = ["us", "n0", "c0"] if 0 in whole else ["us", "c0"]
    out = rows.groupBy("key").transformWithStateInPandas(
        OpenEdge(int(gap_seconds * 1_000_000), schema.names[:-2], order), outputStructType=schema, outputMode="Append",
        timeMode="EventTime")
    return out.select(*[(F.when(~F.col(f"n{i}"), F.col(f"c{i}")) if i in whole else F.col(f"c{i}")).alias(c)
                        for i, c in enumerate(names)], "record", "place")
