"""Operator 2: mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources each belongs
to). A small network routes token capacity: every pattern can be used once per
epoch, each further epoch costs more (convex repetition cost), patterns feed
the sources they belong to, and each source takes its quota. The min-cost flow
says how many tokens each pattern gives; whole epochs take every document
of the pattern, the rest takes documents in seeded order up to a threshold found
by two rounds of bucket sums (no group is sorted whole), plus up to CLOSING closing
documents, each the one whose size comes nearest to what is still missing.
So a pattern misses less than the size of the document at its threshold, and
nothing if documents of the missing sizes are left.

The seeded order goes by id, then by a hash of the row, so reruns and other file
orders take the same documents; equal rows are interchangeable.

Only per-pattern rows reach the driver; more than ``max_patterns`` patterns
raise an error. Defined results: NULL text has size 0; documents of size 0 are never
taken; a NULL source is a source of its own, last in order; repeated rows count
as separate documents; an empty table gives no rows; other columns are kept
only on request.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlake.llm.common import stored

MAX_PATTERNS = 20_000
CLOSING = 4                     # closing documents per pattern at most


def capped_targets(sizes: dict, weights: dict, total: float, max_repeats: int) -> dict:
    """Share ``total`` by weight; a target stops at max_repeats * size and its excess is shared again by
    weight among the rest until none is above."""
    targets, open_, left = {}, list(sizes), float(total)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if unit * weights[s] > max_repeats * sizes[s]]
        if not full:
            targets |= {s: unit * weights[s] for s in open_}
            break
        targets |= {s: float(max_repeats * sizes[s]) for s in full}
        left -= sum(targets[s] for s in full)
        open_ = [s for s in open_ if s not in targets]
    return targets


def min_cost_flow(capacity: dict[tuple, int], quota: dict, max_repeats: int) -> dict[tuple, int]:
    """Tokens per pattern: route quotas through patterns at least total repetition cost.

    Successive shortest paths with potentials. Nodes: 0 start, 1 end, then
    patterns and sources; start->pattern once per epoch e at cost e."""
    nodes = {("p", p): i + 2 for i, p in enumerate(capacity)}
    nodes |= {("s", s): len(nodes) + 2 + i for i, s in enumerate(quota)}
    to, room, cost, out = [], [], [], defaultdict(list)

    def arc(a, b, c, w):
        for x, y, cc, ww in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            room.append(cc)
            cost.append(ww)

    for p, c in capacity.items():
        for epoch in range(1, max_repeats + 1):
            arc(0, nodes["p", p], c, epoch)
        for s in p:
            arc(nodes["p", p], nodes["s", s], sum(capacity.values()) * max_repeats + 1, 0)
    for s, q in quota.items():
        arc(nodes["s", s], 1, q, 0)
    potential = defaultdict(int)
    while True:
        dist, via, heap = {0: 0}, {}, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in out[u]:
                if room[e] > 0:
                    nd = d + cost[e] + potential[u] - potential[to[e]]
                    if nd < dist.get(to[e], 1 << 60):
                        dist[to[e]], via[to[e]] = nd, e
                        heapq.heappush(heap, (nd, to[e]))
        if 1 not in dist:
            break
        reach = dist[1]
        for v in nodes.values():
            potential[v] += min(dist.get(v, reach), reach)
        potential[1] += reach
        path, v = [], 1
        while v != 0:
            path.append(via[v])
            v = to[via[v] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    used = defaultdict(int)
    for u_key, u in nodes.items():
        if u_key[0] == "p":
            used[u_key[1]] = sum(room[e] for e in out[u] if to[e] == 0)
    return dict(used)


def components(patterns: list[tuple]) -> list[list[tuple]]:
    """Patterns grouped by shared sources (independent networks)."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for p in patterns:
        for s in p:
            parent[find(s)] = find(p[0])
    groups = defaultdict(list)
    for p in patterns:
        groups[find(p[0])].append(p)
    return list(groups.values())


def _order(s):
    return (s is None, "" if s is None else s)


def _bounded_rows(df: DataFrame, most: int, what: str) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def _cut_bucket(rows: DataFrame, bucket: Column) -> DataFrame:
    """Per pattern, the first bucket whose running sum exceeds the rest: (_key, _b, _rest within it)."""
    sums = rows.groupBy("_key", bucket.alias("_b")).agg(F.sum("_size").alias("t"), F.first("_rest").alias("_rest"))
    w = Window.partitionBy("_key").orderBy("_b")
    run = sums.withColumn("cum", F.sum("t").over(w)).withColumn("before", F.col("cum") - F.col("t"))
    return (run.filter((F.col("before") <= F.col("_rest")) & (F.col("_rest") < F.col("cum")) & (F.col("t") > 0))
            .select("_key", "_b", (F.col("_rest") - F.col("before")).alias("_left")))


def mix(docs: DataFrame, members: Column, size: Column, weight_of, doc_id: str = "doc_id", max_repeats: int = 3,
        seed: int = 11, keep: list[str] | None = None, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """Return ``keep`` columns plus doc_id, size, members, taken, repeats, source_size and target (maps by source).

    ``members``: array<string> of each document's sources (NULL elements allowed); ``weight_of(i, source)``
    gives the weight of the i-th source in code-point order, NULL last."""
    spark = docs.sparkSession
    keep = [c for c in (keep or []) if c != doc_id]
    hashed = [f.name for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(*hashed).alias("_c"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
                       F.coalesce(size, F.lit(0)).cast("long").alias("_size"),
                       F.sort_array(F.array_distinct(members)).alias("_members"))
    rows = rows.withColumn("_key", F.to_json(F.struct(F.col("_members").alias("m")), {"ignoreNullFields": "false"}))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "_id")).withColumn("_uid", F.monotonically_increasing_id())
    rows = stored(rows, "sizes")

    found = _bounded_rows(rows.groupBy("_key").agg(F.sum("_size").alias("t"), F.first("_members").alias("m")),
                          max_patterns, "membership patterns")
    key_of = {tuple(r["m"] or ()): r["_key"] for r in found}
    capacity = {tuple(r["m"] or ()): int(r["t"]) for r in found}
    sources = sorted({s for p in capacity for s in p}, key=_order)
    source_size = {s: sum(c for p, c in capacity.items() if s in p) for s in sources}
    weights = {s: weight_of(i, s) for i, s in enumerate(sources)}
    targets = capped_targets(source_size, weights, sum(capacity.values()), max_repeats) if sources else {}
    used: dict[tuple, int] = {p: 0 for p in capacity}
    for group in components([p for p in capacity if p]):
        inside = {s for p in group for s in p}
        used |= min_cost_flow({p: capacity[p] for p in group}, {s: round(targets[s]) for s in inside}, max_repeats)

    plan = [(key_of[p], used[p] // capacity[p] if capacity[p] else 0, used[p] % capacity[p] if capacity[p] else 0,
             [float(source_size[s]) for s in p], [targets[s] for s in p]) for p in capacity]
    plan_schema = "_key string, _base long, _rest long, _source_sizes array<double>, _targets array<double>"
    # one row per pattern, at most max_patterns of them: bounded, so it may be broadcast
    rows = rows.join(F.broadcast(spark.createDataFrame(plan, plan_schema)), "_key", "left")

    # threshold of the seeded order: two rounds of 4096 buckets, then the rows of one bucket in order
    b1, b2 = F.shiftright("_h", 52), F.shiftright("_h", 40)
    part = rows.filter("_rest > 0").select("_key", "_h", "_c", "_uid", "_size", "_rest")
    cut1 = part.join(F.broadcast(_cut_bucket(part, b1)), "_key").filter(b1 == F.col("_b")).drop("_b", "_rest")
    cut1 = cut1.withColumnRenamed("_left", "_rest")
    cut2 = cut1.join(F.broadcast(_cut_bucket(cut1, b2)), "_key").filter(b2 == F.col("_b")).drop("_rest")
    w = Window.partitionBy("_key").orderBy("_h", "_c", "_uid")
    cut2 = cut2.withColumn("cum", F.sum("_size").over(w))
    over = F.col("cum") > F.col("_left")
    edge = cut2.groupBy("_key").agg(
        F.min(F.when(over, F.struct("_h", "_c", "_uid"))).alias("e"),
        F.first("_left").alias("left"), F.coalesce(F.sum(F.when(~over, F.col("_size"))), F.lit(0)).alias("got"))
    edges = {r["_key"]: (*r["e"], int(r["left"] - r["got"])) for r in edge.collect()}
    edge_df = spark.createDataFrame([(k, h, c, u) for k, (h, c, u, _) in edges.items()],
                                    "_key string, _eh long, _ec long, _eu long")
    rows = rows.join(F.broadcast(edge_df), "_key", "left")
    chosen = F.col("_eh").isNotNull() & (F.struct("_h", "_c", "_uid") < F.struct("_eh", "_ec", "_eu"))
    rows = rows.withColumn("_chosen", chosen)
    # closing documents: of those not yet used max_repeats times, the size nearest to what is missing, a few times over
    missing, closing = {k: m for k, (*_, m) in edges.items()}, {k: [] for k in edges}
    for _ in range(CLOSING):
        want = [(k, m, closing[k]) for k, m in missing.items() if m > 0]
        if not want:
            break
        open_df = F.broadcast(spark.createDataFrame(want, "_key string, _missing long, _closed array<long>"))
        gap = F.abs(F.col("_size") - F.col("_missing"))
        near = (rows.filter((F.col("_base") + F.col("_chosen").cast("long") < max_repeats) & (F.col("_size") > 0)).join(open_df, "_key")
                .filter((gap < F.col("_missing")) & ~F.array_contains("_closed", F.col("_uid")))
                .groupBy("_key").agg(F.min(F.struct(gap.alias("g"), F.col("_h"), F.col("_c"), F.col("_uid"),
                                                             F.col("_size")))
                                     .alias("c")))
        best = {r["_key"]: r["c"] for r in near.collect()}
        for k in [k for k, _, _ in want]:
            missing[k] = missing[k] - best[k]["_size"] if k in best else 0
            closing[k] += [best[k]["_uid"]] if k in best else []
    closing_df = F.broadcast(spark.createDataFrame(list(closing.items()), "_key string, _closing array<long>"))
    rows = rows.join(closing_df, "_key", "left")
    closes = F.coalesce(F.array_contains("_closing", F.col("_uid")), F.lit(False))
    extra = F.col("_chosen").cast("long") + closes.cast("long")
    repeats = F.when(F.col("_size") > 0, F.col("_base") + extra).otherwise(F.lit(0)).cast("long")
    return rows.select(
        F.col("_id").alias(doc_id), *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_size").alias("size"), F.col("_members").alias("members"), F.col("_source_sizes").alias("source_sizes"),
        F.col("_targets").alias("targets"), repeats.alias("repeats"), (repeats * F.col("_size")).alias("taken"))
