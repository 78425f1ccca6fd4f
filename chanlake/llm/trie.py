"""Operator 13: prefix trie of conversations, as balanced parentheses.

Conversations become sequences of turn hashes (128 bits a turn) with the byte length of each text. Sequences are sorted
(a sequence before those that extend it, equal ones by conversation) over a range partitioning; each partition is a
shard of the trie. A shard is encoded as balanced parentheses, one pair for each node in preorder, with range min-max
blocks over the excess: ``findclose`` skips blocks whose least excess is too high and delimits subtrees; rank over
``()`` counts the leaf pairs of a subtree; cumulative arrays over rows and nodes give members and savings by
differences.

Neighbouring shards share a spine: the nodes on the path of a shard's last row that also lie on the path of the next
shard's first row. Two numbers a shard (how much of its first and last path is shared) make everything additive: a
shared node, its bytes and its place among the children are counted where it begins, leaves where they end. So shared
nodes merge by sums and a minimum; all others are complete in their shard. A hot first turn, or a hot conversation with a
third of all rows, is just a spine over many shards. The member lists of shared nodes are hashed from pieces, in order,
as a stream.

Long conversations are cut into bands of ``band`` turns (at most BANDS bands: the band widens with the deepest
conversation), each a trie of its own below the nodes where the band above ends; bands are built from the
deepest up, and what a subtree below holds is added where it hangs. Turns are numbered by counts carried over the edges
of a range partitioning, so a conversation with a third of all turns spreads over many tasks.

Defined results: NULL role or text is empty; turns are ordered by number (NULL first), then role, then text; repeated
rows are repeated turns; rows without a conversation id belong to none and are ignored; the remainder of
a negative id counts upwards (floor); an empty table has no nodes; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm.common import blocks_for, stored

BAND, BANDS = 1024, 16
SHARD_BYTES = 8 << 20      # of hashes and lengths, for each shard
BLOCK = 64                 # parentheses in a block of the excess index
PIECE = 1 << 16            # bytes of a piece of a member list
EMPTY = hashlib.sha256(b"").hexdigest()


# --- turns in order, rebuilt conversations ------------------------------------------------

NUMBERED = "part int, conv long, idx long, h1 long, h2 long, bytes long"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation within a sorted partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for b in batches:
        conv = np.asarray(b.column("conv"))
        if not len(conv):
            continue
        begins = np.flatnonzero(np.diff(conv, prepend=conv[0]) != 0)
        at = np.arange(len(conv))
        begin = np.zeros(len(conv), np.int64)
        begin[begins] = begins
        begin = np.maximum.accumulate(begin)
        idx = at - begin
        head = len(conv) if not len(begins) else begins[0]
        if last is not None and conv[0] == last:
            idx[:head] += seen
        last, seen = conv[-1], int(idx[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), part, np.int32)), b.column("conv"), pa.array(idx), b.column("h1"),
             b.column("h2"), b.column("bytes")], ["part", "conv", "idx", "h1", "h2", "bytes"])


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv, idx from 0, h1, h2, bytes) of every turn; texts move once and go no further than this."""
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    n = blocks_for(rows, 32 << 20)
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "conv", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"),
        F.octet_length("text").cast("long").alias("bytes"))
    runs = stored(rows.mapInArrow(_number, NUMBERED), "numbered")
    counts = runs.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.withColumn("before", F.sum("n").over(w)).filter("before > 0").select("conv", "part", "before")
    # a partition edge cuts at most one conversation: at most one row per partition, so it may be broadcast
    both = runs.join(F.broadcast(carried), ["conv", "part"], "left")
    return both.select("conv", (F.col("idx") + F.coalesce("before", F.lit(0))).alias("idx"), "h1", "h2", "bytes")


def rebuilt(rows: DataFrame, taken: Column, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversation c as the first ``taken`` turns (a column over ``conv``, at most ``most``) of conversation
    c - c % group, then its own turns after its first ``taken``: (conv, pos from 0, h1, h2, bytes), and (conv,
    length) of every conversation, those without turns too."""
    sizes = rows.groupBy("conv").agg((F.max("idx") + 1).alias("n")).withColumn("taken", taken.cast("long"))
    base = F.col("conv") - F.pmod("conv", F.lit(group))
    firsts = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    sizes = stored(sizes.withColumn("base", base).join(firsts, "base", "left").select(
        "conv", "n", "taken", F.least("taken", F.coalesce("base_n", F.lit(0))).alias("lead")), "sizes")
    own = rows.join(sizes, "conv").filter("idx >= taken").select(
        "conv", (F.col("lead") + F.col("idx") - F.col("taken")).alias("pos"), "h1", "h2", "bytes")
    lead = rows.filter((F.col("idx") < most) & (F.pmod("conv", F.lit(group)) == 0)).withColumn(
        "conv", F.explode(F.sequence(F.col("conv"), F.col("conv") + group - 1)))
    lead = lead.join(sizes.select("conv", "lead"), "conv").filter("idx < lead").select(
        "conv", F.col("idx").alias("pos"), "h1", "h2", "bytes")
    lengths = sizes.select("conv", (F.col("lead") + F.greatest(F.lit(0), F.col("n") - F.col("taken"))).alias("length"))
    return own.unionByName(lead), lengths


def segments(rows: DataFrame, lengths: DataFrame, band: int) -> DataFrame:
    """One row for each conversation and band: key (two longs a turn), sizes, whether the conversation ends here, and
    the root (hash of all turns before the band) the segment hangs from, as well as the next band's."""
    cut = rows.groupBy("conv", F.floor(F.col("pos") / band).alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "bytes"))).alias("turns"))
    cut = cut.select("conv", "band", F.flatten(F.transform("turns", lambda t: F.array(t["h1"], t["h2"]))).alias("key"),
                     F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    whole = lengths.withColumn("last", F.greatest(F.lit(0), F.floor((F.col("length") - 1) / band)))
    none = whole.filter("length = 0").select("conv", F.lit(0).cast("long").alias("band"),
                                             F.array().cast("array<long>").alias("key"),
                                             F.array().cast("array<long>").alias("sizes"))
    cut = cut.unionByName(none).join(whole.select("conv", "last"), "conv")
    exact = lambda seed: F.xxhash64(F.lit(seed), "band", "key").cast("decimal(38,0)")
    w = Window.partitionBy("conv").orderBy("band")
    upto = lambda seed, end: F.coalesce(
        F.sum(exact(seed)).over(w.rowsBetween(Window.unboundedPreceding, end)), F.lit(0).cast("decimal(38,0)"))
    name = lambda end: F.concat_ws(",", upto(3, end), upto(5, end))
    cut = cut.withColumn("ends", F.col("band") == F.col("last"))
    return cut.withColumns({"root": F.when(F.col("band") > 0, name(-1)).otherwise(""),
                            "next_root": F.when(~F.col("ends"), name(0))}).drop("last")


# --- a shard ---------------------------------------------------------------------------

SHARD = ("part int, bits binary, n_nodes long, sizes binary, node binary, conv binary, ends binary, leaves binary, "
         "saved binary, children binary, next_root array<string>, roots array<string>, first array<string>, "
         "last array<string>")


def path_of(root: str, key: list[int]) -> list[str]:
    """Names of the nodes from the segment's root down its key."""
    state = hashlib.blake2b(root.encode(), digest_size=16)
    out = [state.hexdigest()]
    for i in range(0, len(key), 2):
        state.update(np.array(key[i:i + 2], "<i8").tobytes())
        out.append(state.copy().hexdigest())
    return out


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of a sorted partition as balanced parentheses: one row."""
    bits, sizes = bytearray(), []
    node, conv, ends, extra, follow, roots = [], [], [], [[], [], []], [], []
    path: list[int] = []                       # open nodes
    seen: tuple[str, list[int]] | None = None
    first = None
    for b in batches:
        for r in b.to_pylist():
            root, key = r["root"], r["key"]
            if seen is None or seen[0] != root:
                same = 0
                roots.append(root)
            else:
                k, most = 0, min(len(key), len(seen[1]))
                while k < most and key[k] == seen[1][k]:
                    k += 1
                same = 1 + k // 2
            bits += b"\0" * (len(path) - same)
            del path[same:]
            for at in range(same, 1 + len(key) // 2):
                path.append(len(sizes))
                sizes.append(r["sizes"][at - 1] if at else 0)
                bits.append(1)
            node.append(path[-1])
            conv.append(r["conv"])
            ends.append(r["ends"])
            follow.append(r["next_root"])
            for xs, name in zip(extra, ("leaves", "saved", "children")):
                xs.append(r[name])
            seen = (root, key)
            first = first or path_of(root, key)
    if seen is None:
        return
    bits += b"\0" * len(path)
    pack = lambda xs: np.array(xs, "<i8").tobytes()
    values = [TaskContext.get().partitionId(), np.packbits(np.frombuffer(bits, np.uint8)).tobytes(), len(sizes),
              pack(sizes), pack(node), pack(conv), np.array(ends, np.uint8).tobytes(), *map(pack, extra), follow, roots, first,
              path_of(*seen)]
    types = [pa.int32(), pa.binary(), pa.int64(), *[pa.binary()] * 7, *[pa.list_(pa.string())] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                     [f.split()[0] for f in SHARD.split(", ")])


class Parentheses:
    """Balanced parentheses (1 opens) with range min-max blocks over the excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1)
        whole = np.full(-(-max(1, len(bits)) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        whole[:len(bits)] = self.excess
        self.blocks = whole.reshape(-1, BLOCK).min(axis=1)
        n = -(-len(self.blocks) // BLOCK) * BLOCK
        wide = np.full(n, np.iinfo(np.int32).max, np.int32)
        wide[:len(self.blocks)] = self.blocks
        self.groups = wide.reshape(-1, BLOCK).min(axis=1)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing partner of each opening position: the next place where the excess falls below its own. All
        queries step together; those in a block (or group of blocks) that stays too high skip it."""
        found, target = at + 1, self.excess[at] - 1
        left = np.flatnonzero(self.excess[found] != target)
        while len(left):
            j = found[left] + 1
            low = target[left]
            start = j % BLOCK == 0
            block = j // BLOCK
            skip = start & (self.blocks[np.minimum(block, len(self.blocks) - 1)] > low)
            far = skip & (block % BLOCK == 0) & (self.groups[np.minimum(block // BLOCK, len(self.groups) - 1)] > low)
            j = np.where(far, j + BLOCK * BLOCK - 1, np.where(skip, j + BLOCK - 1, j))
            found[left] = j
            left = left[np.where(skip, True, self.excess[np.minimum(j, len(self.excess) - 1)] != low)]
        return found

    def leaf_ranks(self) -> np.ndarray:
        """Number of leaf pairs ``()`` that open before each position."""
        leaf = np.zeros(len(self.bits) + 1, np.int64)
        leaf[1:-1] = np.cumsum((self.bits[:-1] == 1) & (self.bits[1:] == 0))
        if len(self.bits):
            leaf[-1] = leaf[-2]
        return leaf


NODES = ("sid string, parent_sid string, open boolean, root string, hang string, follow string, conv long, depth long, "
         "parent_conv long, n_convs long, n_children long, n_leaves long, saved long, ends string, seq long, "
         "piece binary")


def _decode(band_start: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard's nodes: complete ones, parts of shared ones (``open``, named by ``sid``), and pieces of the
    member lists of shared ones."""
    for b in batches:
        for i in range(b.num_rows):
            r = {name: b.column(name)[i].as_py() for name in b.schema.names}
            yield from _shard_rows(r, band_start)


def _shard_rows(r: dict, band_start: int) -> Iterator[pa.RecordBatch]:
    n, longs = r["n_nodes"], lambda name: np.frombuffer(r[name], "<i8")
    tree = Parentheses(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=2 * n))
    sizes, node, conv = longs("sizes"), longs("node"), longs("conv")
    ends = np.frombuffer(r["ends"], np.uint8).astype(bool)
    opens = tree.opens
    close = tree.findclose(opens)
    after = np.arange(n) + (close - opens + 1) // 2              # first node behind the subtree
    depth = (tree.excess[opens] - 1).astype(np.int64)
    parent, path = np.full(n, -1, np.int64), []
    for i, d in enumerate(depth.tolist()):
        del path[d:]
        if path:
            parent[i] = path[-1]
        path.append(i)
    before = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=n))])
    n_convs = before[after] - before[np.arange(n)]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, node, conv)
    levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])
    for level in levels[:0:-1]:                                  # minima go up level by level
        np.minimum.at(least, parent[level], least[level])
    up, down = r["up"], r["down"]
    new = np.ones(n, bool)
    new[:up] = False                                             # the first path is the first nodes
    last = np.array(path[:down], np.int64)
    here = np.ones(n, bool)
    here[last] = False                                           # goes on in the next shard
    shared = ~(new & here)
    portal = np.unique(node[~ends])
    hangs = {k: np.zeros(n, np.int64) for k in ("leaves", "saved", "children")}
    at = np.flatnonzero(~ends)
    for k, v in hangs.items():
        v[node[at]] = longs(k)[at]
        v[~here] = 0
    leaf = (close - opens == 1) & here
    leaf[portal] = False
    ranks = tree.leaf_ranks()
    pairs = ranks[close + 1] - ranks[opens]                      # leaf pairs of the shard ...
    off = (close - opens == 1) & ~leaf                           # ... but for those that end or go on elsewhere
    add = lambda x: (lambda c: c[after] - c[np.arange(n)])(np.concatenate([[0], np.cumsum(x)]))
    n_leaves = pairs - add(off.astype(np.int64)) + add(hangs["leaves"])
    saved = add(n_convs * sizes - np.where(new, sizes, 0) + hangs["saved"])
    child = new & (parent >= 0)
    n_children = np.bincount(parent[child], minlength=n) + hangs["children"]
    names = {i: s for i, s in zip(range(up), r["first"])} | dict(zip(path[:down], r["last"]))
    lists: dict[int, str] = {}
    pieces: list[tuple[str, int, bytes]] = []
    edges = np.flatnonzero(np.diff(node, prepend=-1))
    for a, e in zip(edges, [*edges[1:], len(node)]):
        ids = conv[a:e][ends[a:e]]
        i = int(node[a])
        if not len(ids):
            continue
        if not shared[i]:
            lists[i] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
            continue
        for k in range(0, len(ids), PIECE // 16):
            pieces.append((names[i], (r["part"] << 32) + k, ",".join(map(str, ids[k:k + PIECE // 16].tolist())).encode()))
    follow: dict[int, str] = {}
    for k in at:
        follow.setdefault(int(node[k]), r["next_root"][k])
    fields = [f.split()[0] for f in NODES.split(", ")]
    kinds = [pa.string(), pa.string(), pa.bool_(), *[pa.string()] * 3, *[pa.int64()] * 7, pa.string(), pa.int64(),
             pa.binary()]
    root = dict(zip(levels[0].tolist(), r["roots"]))             # by node: the fragment's name
    some = 20_000
    for a in range(0, n, some):
        e = min(n, a + some)
        span = range(a, e)
        open_parent = [parent[i] >= 0 and shared[parent[i]] for i in span]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([
            [names.get(i) for i in span],
            [names[int(parent[i])] if p else None for i, p in zip(span, open_parent)],
            shared[a:e], [root.get(i) for i in span], [root.get(int(parent[i])) for i in span],
            [follow.get(i) for i in span], least[a:e], depth[a:e] + band_start,
            [None if parent[i] < 0 or p else int(least[parent[i]]) for i, p in zip(span, open_parent)],
            n_convs[a:e], n_children[a:e], n_leaves[a:e], saved[a:e],
            [None if shared[i] else lists.get(i, EMPTY) for i in span], [None] * (e - a), [None] * (e - a)], kinds)],
            fields)
    if pieces:
        cols = [None] * len(fields)
        cols[0], cols[-2], cols[-1] = [list(c) for c in zip(*pieces)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) if c is not None else pa.nulls(len(pieces), k)
                                          for c, k in zip(cols, kinds)], fields)


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each shared node's member list, streamed from its sorted pieces."""
    sid, state = None, None
    for b in batches:
        out = []
        for name, piece in zip(b.column("sid").to_pylist(), b.column("piece").to_pylist()):
            if name != sid:
                if sid is not None:
                    out.append((sid, state.hexdigest()))
                sid, state = name, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["sid", "hashed"])
    if sid is not None:
        yield pa.RecordBatch.from_arrays([pa.array([sid]), pa.array([state.hexdigest()])], ["sid", "hashed"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many nodes each shard's first path shares with the shard before, its last path with the one behind."""
    def common(a, b):
        k, most = 0, min(len(a or ()), len(b or ()))
        while k < most and a[k] == b[k]:
            k += 1
        return k

    for b in batches:
        rows = b.to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["part"] for r in rows], pa.int32()),
             pa.array([common(r["first"], r["prev"]) for r in rows], pa.int32()),
             pa.array([common(r["last"], r["next"]) for r in rows], pa.int32())], ["part", "up", "down"])


NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def band_nodes(rows: DataFrame, start: int) -> DataFrame:
    """Complete nodes of one band (with its roots), from segments that carry what hangs below them: NODE_COLUMNS, root
    (the fragment it is the root of), hang (the fragment whose root is its parent), follow (the fragment below it)."""
    n = blocks_for(rows, SHARD_BYTES)
    # of the rows at one node those that go on come last, so the last shard that holds the node knows of the band below
    order = ["root", "key", F.desc("ends"), "conv"]
    shards = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_encode, SHARD), "shards")
    # paths of the edges: two a shard; only two numbers a shard go back to the shards
    w = Window.orderBy("part")
    edges = shards.select("part", "first", "last", F.lag("last").over(w).alias("prev"), F.lead("first").over(w).alias("next"))
    edges = edges.mapInArrow(_shared, "part int, up int, down int")
    found = stored(shards.join(F.broadcast(edges), "part").mapInArrow(functools.partial(_decode, start), NODES), "nodes")
    parts = found.filter("open").groupBy("sid").agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.max("parent_sid").alias("parent_sid"),
        F.max("root").alias("root"), F.max("hang").alias("hang"), F.max("follow").alias("follow"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parts = stored(parts, "spines")
    k = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = found.filter("piece is not null").select("sid", "seq", "piece").repartition(k, "sid").sortWithinPartitions(
        "sid", "seq").mapInArrow(_hash_lists, "sid string, hashed string")
    merged = parts.join(lists, "sid", "left").select(
        *parts.columns, F.lit(None).cast("long").alias("parent_conv_id"),
        F.coalesce("hashed", F.lit(EMPTY)).alias("ends_sha256")).drop("sid")
    closed = found.filter("not open").select(
        F.col("conv").alias("conv_id"), "depth", "parent_sid", "root", "hang", "follow", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("parent_conv").alias("parent_conv_id"), F.col("ends").alias("ends_sha256"))
    names = parts.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("above"))
    both = closed.unionByName(merged).join(names, "parent_sid", "left")
    return both.select(*[F.coalesce("parent_conv_id", "above").alias(c) if c == "parent_conv_id" else c
                         for c in NODE_COLUMNS], "root", "hang", "follow")


def build(turns: DataFrame, taken: Column, group: int = 5, most: int = 8, band: int = BAND, conv_id: str = "conv_id",
          turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (NODE_COLUMNS)."""
    rows, lengths = rebuilt(numbered(turns, conv_id, turn, role, text), taken, group, most)
    lengths = stored(lengths, "lengths")
    deepest = lengths.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    band = max(band, -(-deepest // BANDS))
    cut = stored(segments(rows, lengths, band), "segments")
    bands = max(1, -(-deepest // band))
    done, waiting, below = [], None, None
    for k in reversed(range(bands)):
        part = cut.filter(F.col("band") == k)
        if below is None:
            part = part.withColumns({c: F.lit(0).cast("long") for c in ("leaves", "saved", "children")})
        else:
            part = part.join(below, "next_root", "left").fillna(0, ["leaves", "saved", "children"])
        nodes = band_nodes(part.select("root", "key", "sizes", "conv", "ends", "next_root", "leaves", "saved", "children"),
                           k * band)
        if bands > 1:
            nodes = stored(nodes, "band")
        if waiting is not None:                # the first nodes of the band below hang from this band's last ones
            above = nodes.filter("follow is not null").select(F.col("follow").alias("hang"), F.col("conv_id").alias("c"))
            done.append(waiting.join(above, "hang", "left").withColumn("parent_conv_id", F.coalesce("c", "parent_conv_id")))
        if k:
            below = nodes.filter("root is not null").select(
                F.col("root").alias("next_root"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
                F.col("n_children").alias("children"))
            waiting = nodes.filter("root is null")
        else:
            done.append(nodes)
    out = done[0].select(*NODE_COLUMNS)
    for more in done[1:]:
        out = out.unionByName(more.select(*NODE_COLUMNS))
    return out


SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS idx
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT,
      0::UBIGINT, 0::UBIGINT, 0::UBIGINT]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT)
      ELSE x // 2 END)), 4294967295::UBIGINT) % 9 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
turns AS (
  SELECT h.conv_id, 0 AS part, b.idx, b.role, b.text
  FROM h JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 5 AND b.idx < h.h
  UNION ALL
  SELECT h.conv_id, 1, t.idx, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.idx >= h.h),
built AS (
  SELECT h.conv_id, coalesce(any_value(x.seq), []) AS seq FROM h LEFT JOIN (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY part, idx) AS seq FROM turns GROUP BY conv_id) x
  ON x.conv_id = h.conv_id GROUP BY h.conv_id),
walk AS (
  SELECT conv_id, seq, unnest(range(0, CAST(len(seq) + 1 AS BIGINT))) AS depth FROM built),
nodes AS (
  SELECT seq[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CASE WHEN len(seq) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM walk GROUP BY seq[1:depth], depth),
kids AS (
  SELECT p.key, p.depth, count(c.depth) AS n_children FROM nodes p
  LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.key[1:p.depth] = p.key GROUP BY p.key, p.depth),
below AS (
  SELECT p.key, p.depth, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((d.n_convs - 1) * CASE WHEN d.depth = 0 THEN 0 ELSE strlen(d.key[d.depth].t) END) AS saved_tokens
  FROM nodes p JOIN nodes d ON d.depth >= p.depth AND d.key[1:p.depth] = p.key
  JOIN kids k ON k.key = d.key AND k.depth = d.depth GROUP BY p.key, p.depth)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, k.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN kids k ON k.key = n.key AND k.depth = n.depth JOIN below b ON b.key = n.key AND b.depth = n.depth
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.key = n.key[1:n.depth - 1]
"""
