"""Tables whose changes are one commit: unique appends and incremental loads (S9, J3/ST4).

A table is a folder of data folders and of numbered manifests, each the whole state: its data folders, its key
index and its marks. A writer stages files that no manifest names, then puts the next manifest; that succeeds for one
writer only, and readers see all of a commit or nothing. A writer that lost looks again at what the other one committed.
What a crashed writer staged is never seen.

Unique keys: every commit adds an entry to the key index, buckets of about BUCKET_KEYS keys with a bitmap of 32,768
hashed positions each (a Bloom filter with one hash, at most a sixteenth full). A batch meets the bitmaps first; only keys
that hit one are looked up among the keys of those buckets, so an append reads neither the target nor, for new
keys, most of the index. Entries are merged as they add up, so there are about log2 of the appends of them, and a key is
rewritten as often.

Put-if-absent is a hard link on a local file system and a rename that refuses to replace (FileContext) elsewhere; an
object store has to offer either, or conditional writes, through its Hadoop connector.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlake.schemas import LAST_ID
from chanlake.sources import store

BUCKET_KEYS = 2048
BITS = 32768
BUCKETS_PUSHED = 10_000         # so many bucket numbers are pushed into the index scan; beyond, the join alone decides


class Conflict(RuntimeError):
    """Another writer put the next manifest first."""


# --- manifests --------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/_commits/{version:012d}.json"


def snapshot(spark: SparkSession, path: str) -> dict:
    """The newest manifest; an empty one for a table without commits."""
    folder, fs = _fs(spark, f"{path.rstrip('/')}/_commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    versions = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
    if not versions:
        return {"version": 0, "data": [], "schema": None, "index": [], "marks": None}
    file, fs = _fs(spark, _name(path, versions[-1]))
    stream = fs.open(file)
    try:
        size = fs.getFileStatus(file).getLen()
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(size))
    finally:
        stream.close()
    return json.loads(bytes(data))


def commit(spark: SparkSession, path: str, state: dict) -> dict:
    """Put the manifest that follows ``state["version"]``; Conflict if there is one."""
    state = state | {"version": state["version"] + 1}
    folder, fs = _fs(spark, f"{path.rstrip('/')}/_commits")
    fs.mkdirs(folder)
    staged, fs = _fs(spark, f"{path.rstrip('/')}/_commits/.{uuid.uuid4().hex}")
    final, _ = _fs(spark, _name(path, state["version"]))
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            os.link(staged.toUri().getPath(), final.toUri().getPath())
        else:
            jvm = spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(staged, final, none)
    except Exception as e:  # noqa: BLE001 - a link that exists, or the JVM's exception for it
        if fs.exists(final):
            raise Conflict(f"{path}: version {state['version']} exists") from e
        raise
    finally:
        if fs.exists(staged):
            fs.delete(staged, False)
    return state


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The committed rows."""
    state = snapshot(spark, path)
    if not state["data"]:
        if schema is None:
            raise FileNotFoundError(f"{path} has no commit")
        return spark.createDataFrame([], schema)
    declared = schema or T.StructType.fromJson(state["schema"])
    return spark.read.schema(declared).parquet(*[f"{path.rstrip('/')}/{d}" for d in state["data"]])


def _stage(df: DataFrame, path: str, kind: str) -> str:
    """Write a frame into the table's folder; nobody sees it until a manifest names it."""
    name = f"{kind}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{name}")
    return name


def _staged(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}")


# --- the key index ----------------------------------------------------------------------

def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    """(key, bucket, bit): two hashes of the key."""
    return keys.withColumns({"bucket": F.pmod(F.xxhash64("key"), F.lit(buckets)),
                             "bit": F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(BITS))})


def _index(keys: DataFrame, n: int, path: str) -> dict:
    """Stage an entry: its keys in the order of their buckets, and a bitmap for each bucket."""
    buckets = max(1, -(-n // BUCKET_KEYS))
    rows = _hashed(keys, buckets)
    tasks = max(1, -(-n // 5_000_000))
    kept = _stage(rows.select("bucket", "key").repartitionByRange(tasks, "bucket").sortWithinPartitions("bucket", "key"),
                  path, "index")
    bits = _stage(rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), path, "bits")
    return {"keys": kept, "bits": bits, "buckets": buckets, "n": n}


def _hit(bits, bit):
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0


def in_index(spark: SparkSession, keys: DataFrame, path: str, entries: list[dict]) -> DataFrame:
    """The keys (column ``key``) that an entry holds. Each entry's bitmaps name the suspects, its buckets decide."""
    kind = keys.schema["key"].dataType
    found = None
    for e in entries:
        bits = spark.read.schema("bucket long, bits binary").parquet(f"{path.rstrip('/')}/{e['bits']}")
        suspects = _hashed(keys, e["buckets"]).join(bits, "bucket").filter(_hit(F.col("bits"), F.col("bit"))).select(
            "key", "bucket")
        index = spark.read.schema(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("key", kind)])
                                  ).parquet(f"{path.rstrip('/')}/{e['keys']}")
        some = [r["bucket"] for r in suspects.select("bucket").distinct().limit(BUCKETS_PUSHED + 1).collect()]
        if not some:
            continue
        if len(some) <= BUCKETS_PUSHED:                    # sorted by bucket: the scan skips the pages of others
            index = index.filter(F.col("bucket").isin(some))
        hit = index.join(suspects, ["bucket", "key"], "left_semi").select("key")
        found = hit if found is None else found.union(hit)
    return found.distinct() if found is not None else spark.createDataFrame([], T.StructType([T.StructField("key", kind)]))


def _with_entry(spark: SparkSession, path: str, entries: list[dict], keys: DataFrame, n: int) -> list[dict]:
    """Entries after an append: the new one takes in the entries before it that are not twice its size, so sizes
    fall by half from entry to entry."""
    entries, merged = list(entries), []
    while entries and entries[-1]["n"] <= 2 * n:
        merged.append(entries.pop())
        n += merged[-1]["n"]
    for e in merged:
        keys = keys.union(spark.read.schema(T.StructType([T.StructField("bucket", T.LongType()), keys.schema["key"]]))
                          .parquet(f"{path.rstrip('/')}/{e['keys']}").select("key"))
    return [*entries, _index(keys, n, path)]


# --- S9: unique append --------------------------------------------------------------------

def append_unique(spark: SparkSession, batch: DataFrame, path: str, key: str,
                  report: Callable[[DataFrame], None] | None = None, tries: int = 20) -> int:
    """Append the batch as one commit if ``key`` stays unique, else raise UniqueViolation and change nothing; returns the
    version. Of writers with a common key one wins whatever their timing; writers without one all succeed (the
    loser of a race checks the winner's keys and commits behind it). NULL keys never collide. The batch is evaluated once."""
    name = _stage(batch, path, "data")
    rows = _staged(spark, path, name, batch.schema)
    keys = rows.select(F.col(key).alias("key")).filter("key is not null")
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    seen: list[dict] = []
    for _ in range(tries):
        state = snapshot(spark, path)
        fresh = [e for e in state["index"] if e not in seen]
        old = in_index(spark, keys, path, fresh)
        clash = counted.join(old.withColumn("in_target", F.lit(True)), "key", "left").filter(
            "n > 1 or in_target").select(F.col("key").alias(key), F.col("n").alias("n_in_batch"),
                                         F.coalesce("in_target", F.lit(False)).alias("in_target"))
        some = clash.orderBy(key).limit(5).collect() if fresh or sizes["most"] > 1 else []
        if some:
            if report is not None:
                report(clash)
            raise store.UniqueViolation(f"{key} not unique, first " + ", ".join(str(r[key]) for r in some))
        seen = state["index"]
        index = _with_entry(spark, path, state["index"], keys, sizes["keys"]) if sizes["keys"] else state["index"]
        try:
            return commit(spark, path, state | {"data": [*state["data"], name], "index": index,
                                                "schema": state["schema"] or batch.schema.jsonValue()})["version"]
        except Conflict:
            continue
    raise Conflict(f"{path}: {tries} other commits came first")


# --- J3 / ST4: rows and marks --------------------------------------------------------------

def marks(spark: SparkSession, path: str, channel: str = "channel", state: dict | None = None) -> DataFrame:
    """The committed marks, one row a channel; none before the first commit."""
    state = state or snapshot(spark, path)
    schema = T.StructType([T.StructField(channel, T.StringType()), T.StructField("last_id", T.LongType()),
                           T.StructField("n_new", T.LongType())])
    if state["marks"] is None:
        return spark.createDataFrame([], LAST_ID).withColumnRenamed("channel", channel).withColumn(
            "n_new", F.lit(0).cast("long"))
    return _staged(spark, path, state["marks"], schema)


def load_new(spark: SparkSession, messages: DataFrame, path: str, channel: str = "channel", msg_id: str = "id",
             before_commit: Callable[[], None] | None = None, tries: int = 20) -> DataFrame:
    """J3 + ST4 in one commit: rows above the committed marks are written once, the new marks are taken from the
    rows written, and one manifest names both. A crash leaves neither; a source that grows meanwhile only gives more to
    the next run; of two loaders the second drops what the first has committed. Returns the new marks."""
    name = None
    for _ in range(tries):
        state = snapshot(spark, path)
        old = marks(spark, path, channel, state).drop("n_new")
        source = messages if name is None else _staged(spark, path, name, messages.schema)
        name = _stage(store.new_since(source, old, channel, msg_id).select(*messages.columns), path, "data")
        rows = _staged(spark, path, name, messages.schema)
        ahead = store.advance_marks(old, rows, channel, msg_id)
        new_marks = _stage(ahead.coalesce(1), path, "marks")
        if before_commit is not None:
            before_commit()
        try:
            state = commit(spark, path, state | {"data": [*state["data"], name], "marks": new_marks,
                                                 "schema": state["schema"] or messages.schema.jsonValue()})
            return marks(spark, path, channel, state)
        except Conflict:
            continue
    raise Conflict(f"{path}: {tries} other commits came first")
