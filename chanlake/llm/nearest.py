"""Operator 9: nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a unit vector; its
nearest signed axis is its bucket. Every vector is indexed in ``tables`` tables; a query
probes, per table, the ``probes`` axes its rotated vector points to most. Candidates are ranked by
their exact Euclidean distance on the original vectors, in double precision.

Equal vectors form a class that is indexed once with its smallest k + 1 ids, so a very common
vector costs one entry. Buckets of more than ``split`` classes are salted into parts (sizes are counted
first; there are tables * 2 * dimension of them), and a query visits all parts: nothing is capped.

Buckets know directions only, so what a query met is checked against its distances. With the distance R of its k-th
row found, a vector of norm L can be nearer only at a cosine of at least (|q|^2 + L^2 - R^2) / (2 |q| L). ``reach``
gives the cosine from which on a pair shares a probed bucket nine times in ten; norms that leave smaller cosines open
are a range, and the query is compared with all vectors of that range. A query that met fewer than k rows is compared
with all vectors of its length. These queries go out in blocks of ``BLOCK`` bytes, each task keeps the k + 1 best.

Defined results: vectors that are NULL, empty or zero, or hold NULL or non-finite components, take no part;
vectors are compared with those of the same length; rows with one id and one vector count once; ties go to
the smaller id; fewer candidates than k give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm.common import stored

TABLES, PROBES, SPLIT, SEED = 24, 4, 8192, 41
REACHED, BLOCK = 0.9, 8 << 20


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row (length a power of two)."""
    n, h = rows.shape[1], 1
    while h < n:
        rows = rows.reshape(-1, n // (2 * h), 2, h)
        rows = np.stack([rows[:, :, 0] + rows[:, :, 1], rows[:, :, 0] - rows[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return rows / np.sqrt(n)


def axes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each vector in one table, nearest first (axis i: 2i, -axis i: 2i+1)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    width = 1 << max(0, (unit.shape[1] - 1).bit_length())
    turned = np.zeros((len(unit), width))
    turned[:, :unit.shape[1]] = unit
    rng = np.random.default_rng([SEED, table])
    for _ in range(3):
        turned = hadamard(turned * rng.choice([-1.0, 1.0], width))
    score = np.stack([turned, -turned], axis=2).reshape(len(unit), 2 * width)
    return np.argsort(-score, axis=1, kind="stable")[:, :probes]


@functools.cache
def reach(width: int, tables: int, probes: int) -> float:
    """Least cosine at which two vectors share a probed bucket with probability ``REACHED`` (on seeded random pairs)."""
    if probes >= 2 * width:
        return -1.0                                     # every bucket is probed
    if width == 1:
        return 1.0
    x, z = np.random.default_rng(SEED).normal(size=(2, 256, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    probed = [axes(x, t, probes) for t in range(tables)]
    low, high = 0.0, 1.0
    for _ in range(7):
        c = (low + high) / 2
        y = c * x + np.sqrt(1 - c * c) * z
        met = np.any([(p == axes(y, t, 1)).any(axis=1) for t, p in enumerate(probed)], axis=0)
        low, high = (low, c) if met.mean() >= REACHED else (c, high)
    return high


def open_norms(norm: float, bound: float | None, least: float) -> tuple[float, float] | None:
    """Range of norms at which a vector within ``bound`` can lie at a cosine below ``least``; all without a bound."""
    if bound is None:
        return 0.0, float("inf")
    room = bound * bound - norm * norm * (1 - least * least)
    if least <= -1 or room <= 0:
        return None
    return norm * least - room ** 0.5, norm * least + room ** 0.5


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the batch's vectors, per vector length."""
    column = b.column("vec")
    ids, offsets = np.asarray(b.column("cid"), dtype=np.int64), np.asarray(column.offsets, dtype=np.int64)
    flat = np.asarray(column.values).astype(np.float64)
    lens = np.diff(offsets)
    for n in np.unique(lens):
        at = np.flatnonzero(lens == n)
        yield ids[at], flat[offsets[at][:, None] + np.arange(n)]


def _sizes(tables: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()
    for b in batches:
        for _, m in _by_length(b):
            for t in range(tables):
                for axis, n in zip(*np.unique(axes(m, t, 1)[:, 0], return_counts=True)):
                    count[f"{m.shape[1]} {t} {axis}"] += int(n)
    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                     ["bucket", "n"])


ENTRY = "bucket string, asks boolean, cid long, vec binary"


def _entries(tables: int, probes: int, asks: bool, parts: dict[str, int],
             batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index entries (one per table, in one part of its bucket) or query entries (all parts of each probe)."""
    for b in batches:
        for ids, m in _by_length(b):
            half = m.astype("<f4")                       # vectors of floats travel as floats: exact, half the bytes
            small = (half == m).all(axis=1)
            cells = [(h if s else row).tobytes() for row, h, s in zip(m, half, small)]
            for t in range(tables):
                chosen = axes(m, t, probes if asks else 1)
                out = []
                for cid, cell, row in zip(ids.tolist(), cells, chosen.tolist()):
                    for axis in row:
                        name = f"{m.shape[1]} {t} {axis}"
                        n = parts.get(name, 1)
                        for part in (range(n) if asks else (cid % n,)):
                            out.append((f"{name} {part}", asks, cid, cell))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.bool_(), pa.int64(), pa.binary()))],
                    ["bucket", "asks", "cid", "vec"])


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed row by row: equal vectors get equal distances wherever they are."""
    gap = vectors - query
    return np.sqrt((gap * gap).sum(axis=1))


def nearest_of(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and distances of the k nearest, ties to the smaller id."""
    if len(ids) > 8 * k:                                # a cheap bound first, exact distances only inside it
        rough = (vectors * vectors).sum(axis=1) - 2 * (vectors @ query)
        scale = 1e-9 * (1 + np.abs(rough).max() + float(query @ query))
        at = np.flatnonzero(rough <= np.partition(rough, k - 1)[k - 1] + scale)
    else:
        at = np.arange(len(ids))
    d = distances(vectors[at], query)
    order = np.lexsort((ids[at], d))[:k]
    return at[order], d[order]


def _vector(cell: bytes, length: int) -> np.ndarray:
    return np.frombuffer(cell, "<f4" if len(cell) == 4 * length else "<f8").astype(np.float64)


def _search(k: int, table: pa.Table) -> pa.Table:
    length = int(table.column("bucket")[0].as_py().split(" ")[0])
    asks = np.asarray(table.column("asks").combine_chunks())
    out = []
    if asks.any() and not asks.all():
        ids = np.asarray(table.column("cid").combine_chunks(), dtype=np.int64)
        cells = table.column("vec")
        stored_ids = ids[~asks]
        vectors = np.stack([_vector(cells[int(i)].as_py(), length) for i in np.flatnonzero(~asks)])
        for i in np.flatnonzero(asks):
            at, d = nearest_of(vectors, stored_ids, _vector(cells[int(i)].as_py(), length), k)
            out += [(int(ids[i]), int(c), float(x)) for c, x in zip(stored_ids[at], d)]
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({"qid": pa.array(cols[0], pa.int64()), "cid": pa.array(cols[1], pa.int64()),
                     "score": pa.array(cols[2], pa.float64())})


OPEN = "cid long, vec binary, length int, low double, high double, bound double"


def _open(tables: int, probes: int, norms: dict[int, list[tuple[float, float]]],
          batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries that are to be compared with all vectors of a range of norms that holds any."""
    for b in batches:
        bound = dict(zip(b.column("cid").to_pylist(), b.column("bound").to_pylist()))
        out = []
        for ids, m in _by_length(b):
            width = 1 << max(0, (m.shape[1] - 1).bit_length())
            for cid, row, norm in zip(ids.tolist(), m, np.linalg.norm(m, axis=1).tolist()):
                span = open_norms(norm, bound[cid], reach(width, tables, probes))
                if span and any(lo <= span[1] and hi >= span[0] for lo, hi in norms[m.shape[1]]):
                    out.append((cid, row.astype("<f8").tobytes(), m.shape[1], *span, bound[cid]))
        if out:
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             [f.split()[0] for f in OPEN.split(", ")])


def _scan(k: int, asked: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per query the k nearest of the task's vectors whose norm is in its range and that lie within its bound."""
    held = {}
    for length in {a[2] for a in asked}:
        rows = [a for a in asked if a[2] == length]
        low, high, bound = (np.array([float("inf") if a[i] is None else a[i] for a in rows]) for i in (3, 4, 5))
        held[length] = (np.array([a[0] for a in rows]), np.stack([np.frombuffer(a[1], "<f8") for a in rows]), low, high,
                        bound * (1 + 1e-12), np.full((len(rows), k), np.inf), np.zeros((len(rows), k), np.int64))
    for b in batches:
        for ids, m in _by_length(b):
            if m.shape[1] not in held:
                continue
            _, queries, low, high, bound, best, who = held[m.shape[1]]
            norm, square = np.linalg.norm(m, axis=1), (m * m).sum(axis=1)
            for s in range(0, len(queries), 64):
                part = slice(s, s + 64)
                q = queries[part]
                total = (q * q).sum(axis=1)[:, None] + square
                rough = total - 2 * (q @ m.T)
                off = (norm < low[part, None]) | (norm > high[part, None])
                most = np.minimum(bound[part], best[part, -1]) ** 2 * (1 + 1e-9)
                upper = np.where(off, np.inf, rough + 1e-9 * total)
                if len(ids) > k:
                    most = np.minimum(most, np.partition(upper, k - 1, axis=1)[:, k - 1])
                i, j = np.nonzero(~off & (rough - 1e-9 * total <= most[:, None]))
                gap = m[j] - q[i]
                d = np.sqrt((gap * gap).sum(axis=1))
                near = d <= bound[part][i]
                if not near.any():
                    continue
                old, at = np.nonzero(np.isfinite(best[part]))
                row = np.concatenate([i[near], old])
                d = np.concatenate([d[near], best[part][old, at]])
                c = np.concatenate([ids[j[near]], who[part][old, at]])
                order = np.lexsort((c, d, row))
                row, d, c = row[order], d[order], c[order]
                head = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                rank = np.arange(len(row)) - np.repeat(head, np.diff(np.append(head, len(row))))
                top = rank < k
                best[part][row[top], rank[top]] = d[top]
                who[part][row[top], rank[top]] = c[top]
    for cid, _, _, _, _, best, who in held.values():
        row, at = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(cid[row]), pa.array(who[row, at]), pa.array(best[row, at])],
                                         ["qid", "cid", "score"])


def usable(vec: Column) -> Column:
    """True for vectors that are not NULL, have only finite components, and are not zero."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & sound & F.exists(vec, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec: str = "embedding", k: int = 10,
           tables: int = TABLES, probes: int = PROBES, split: int = SPLIT) -> DataFrame:
    """For each row where ``queries`` holds, its k nearest other rows found: query, rank, vec_id, score."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("vec"), queries.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    order = Window.partitionBy("vec").orderBy("id")
    least = rows.select("id", "vec").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    classes = least.groupBy("vec").agg(F.min("id").alias("cid"), F.array_distinct(F.array_sort(F.collect_list("id")))
                                       .alias("ids"))
    classes = stored(classes, "vector-classes")
    asked = stored(rows.filter("asks").select(F.col("id").alias("query"), "vec").distinct()
                   .join(classes.select("vec", F.col("cid").alias("qid")), "vec").select("query", "qid"), "queries")
    asking = classes.join(asked.select(F.col("qid").alias("cid")).distinct(), "cid").select("cid", "vec")

    sizes = classes.select("cid", "vec").mapInArrow(functools.partial(_sizes, tables), "bucket string, n long")
    parts = {r["bucket"]: -(-r["n"] // split) for r in sizes.groupBy("bucket").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > split).collect()}     # at most tables * 2 * dimension rows per vector length
    index = classes.select("cid", "vec").mapInArrow(functools.partial(_entries, tables, probes, False, parts), ENTRY)
    probe = asking.mapInArrow(functools.partial(_entries, tables, probes, True, parts), ENTRY)

    def one_bucket(entries: pa.Table) -> pa.Table:
        return _search(k + 1, entries)

    found = index.union(probe).groupBy("bucket").applyInArrow(one_bucket, "qid long, cid long, score double")
    found = stored(_least(found, k + 1), "found")

    # the distance of each query's k-th row bounds what it can have missed; without k rows nothing does
    first = Window.partitionBy("query", "qid").orderBy("score", "vec_id")
    kth = _pairs(asked, found, classes).withColumn("r", F.row_number().over(first)).filter(F.col("r") == k)
    bound = asked.join(kth.select("query", "qid", "score"), ["query", "qid"], "left").groupBy("qid").agg(
        F.when(F.count("score") == F.count(F.lit(1)), F.max("score")).alias("bound"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    norms: dict[int, list[tuple[float, float]]] = {}
    bands = classes.select(F.size("vec").alias("length"), norm.alias("norm"))
    for r in bands.groupBy("length", F.floor(8 * F.log2("norm")).alias("band")).agg(
            F.min("norm").alias("low"), F.max("norm").alias("high")).collect():      # 8 bands per doubling of the norm
        norms.setdefault(r["length"], []).append((r["low"] * (1 - 1e-9), r["high"] * (1 + 1e-9)))
    missed = classes.select("cid", "vec").join(bound.withColumnRenamed("qid", "cid"), "cid").mapInArrow(
        functools.partial(_open, tables, probes, norms), OPEN)
    missed = stored(missed, "open-queries")
    blocks = -(-(missed.agg(F.sum(F.length("vec"))).first()[0] or 0) // BLOCK)
    for n in range(blocks):
        some = [tuple(r) for r in missed.filter(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == n).collect()]
        scanned = classes.select("cid", "vec").mapInArrow(functools.partial(_scan, k + 1, some),
                                                          "qid long, cid long, score double")
        found = found.union(stored(_least(scanned, k + 1), "scanned"))
    if blocks:
        found = _least(found, k + 1)
    last = Window.partitionBy("query").orderBy("score", "vec_id")
    ranked = _pairs(asked, found, classes).withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return ranked.select("query", "rank", "vec_id", "score")


def _least(found: DataFrame, k: int) -> DataFrame:
    """The k nearest classes of each query class."""
    best = Window.partitionBy("qid").orderBy("score", "cid")
    found = found.groupBy("qid", "cid").agg(F.min("score").alias("score"))
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")


def _pairs(asked: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """query, qid, score, vec_id: the other rows that stand for the classes found."""
    found = found.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    return asked.join(found, "qid").filter(F.col("vec_id") != F.col("query"))
