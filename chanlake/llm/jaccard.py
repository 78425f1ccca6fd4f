"""Operator 7: n-gram Jaccard join by MinHash banding.

Sets of five-word shingles (hashed). Documents with equal sets form a class, so copies are
joined once. ``banding`` picks the number of bands for ``rows`` hashes per band so that a
pair at the threshold collides with at least the target probability. Band hashes are
shuffled to buckets, which emit star edges (member, smallest member), never all pairs; a task's own
members of a band meet in one entry per batch, so a hot band costs an entry per batch.
Candidate clusters are the components of these edges. Every pair inside a cluster is verified on
the full shingle sets; clusters above ``TILE`` members are cut into tiles, and each pair of tiles is
a task of its own. Verification emits counts and spanning edges, not pairs.

Result: one row per document with class_id (smallest id linked to it directly or through others), copy_of
(smallest id with the same shingle set) and n_links (documents at or above the threshold, copies included).

Defined results: texts of one to four words have one shingle, all their words; NULL or blank texts
have none and link to nothing; a NULL id gets NULL class and no links; repeated rows are copies of each other; rows
with one id and different texts count as one document that holds each of the texts; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm import substring as S
from chanlake.llm.common import blocks_for, stored
from chanlake.llm.components import components

NGRAM, THRESHOLD, RECALL, ROWS = 5, (4, 5), 0.999999, 4
TILE, SPARSE = 512, 24
U = np.uint64


def banding(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes so that a pair at ``threshold`` shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of the distinct shingles of each text, sorted by row then shingle."""
    lists = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    names = S.word_names([w for ws in lists for w in ws])
    row = np.repeat(np.arange(len(lists)), lens)
    ends = np.cumsum(lens)
    span = S.spans(names, NGRAM)
    at = np.arange(len(span))
    at = at[at + NGRAM <= ends[row[at]]]
    rows, grams = [row[at]], [span[at]]
    for r in np.flatnonzero((lens > 0) & (lens < NGRAM)):
        rows.append(np.array([r]))
        grams.append(S.spans(names[ends[r] - lens[r]:ends[r]], int(lens[r])))
    rows, grams = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1]))[: len(rows)]
    return rows[new], grams[new]


def _slices(ids: list, texts: list, most: int = 2 << 20) -> Iterator[tuple[list, list]]:
    a, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= most:
            yield ids[a:i + 1], texts[a:i + 1]
            a, n = i + 1, 0
    if a < len(ids):
        yield ids[a:], texts[a:]


def set_keys(rows: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, key, second key) per row: order-free 128-bit keys of the sets."""
    count = np.bincount(rows, minlength=n)
    k1, k2 = np.zeros(n, U), np.zeros(n, U)
    if len(rows):
        have = np.flatnonzero(count)
        starts = np.searchsorted(rows, have)
        k1[have] = np.add.reduceat(S.mixed(grams ^ U(0x51ED270B)), starts)
        k2[have] = np.add.reduceat(S.mixed(grams * U(0x2545F4914F6CDD1D)), starts)
    return count, k1, k2


SIGNED = "doc_id long, n int, k1 long, k2 long, bands binary"


def _sign(bands: int, rows_per_band: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(20240229)
    factors = rng.integers(1, 1 << 63, bands * rows_per_band, dtype=U) * U(2) + U(1)
    for b in batches:
        for ids, texts in _slices(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            rows, grams = shingle_sets(texts)
            n, k1, k2 = set_keys(rows, grams, len(ids))
            have = np.flatnonzero(n)
            out = np.zeros((len(ids), bands), U)
            if len(have):
                starts = np.searchsorted(rows, have)
                for band in range(bands):
                    key = np.full(len(have), band + 1, U)
                    for r in range(rows_per_band):
                        low = np.minimum.reduceat(grams * factors[band * rows_per_band + r], starts)
                        key = S.mixed(key * U(0x9E3779B97F4A7C15) + low)
                    out[have, band] = key
            cells = [out[i].tobytes() if n[i] else None for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int32()), pa.array(k1.view(np.int64)),
                 pa.array(k2.view(np.int64)), pa.array(cells, pa.binary())], ["doc_id", "n", "k1", "k2", "bands"])


def _stars(keys: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by key: first index of each key, and (smallest member, other member) edges inside the keys."""
    order = np.lexsort((reps, keys))
    k, r = keys[order], reps[order]
    head = np.append(True, k[1:] != k[:-1])[: len(k)]
    least = np.repeat(r[head], np.diff(np.append(np.flatnonzero(head), len(k))))
    other = least != r
    return order[head], least[other], r[other]


def _send_bands(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = S.first_turn()
    for b in batches:
        cells = [np.frombuffer(x.as_py(), U) for x in b.column("bands")]
        if not cells:
            continue
        keys = np.concatenate(cells)
        reps = np.repeat(np.asarray(b.column("rep"), dtype=np.int64), [len(c) for c in cells])
        first, u, v = _stars(keys, reps)
        rows = list(S._by_bucket(buckets, keys[first], reps[first]))
        if len(u):
            turn += 1
            pairs = np.unique(np.stack([u, v]), axis=1)
            rows.append((buckets + turn % buckets, pairs[0].tobytes(), pairs[1].tobytes(), None, None, True, None))
        yield S._flush(rows)


def _meet(table: pa.Table) -> pa.Table:
    """One bucket: star edges of the bands that two or more classes share."""
    own = np.asarray(table.column("own").combine_chunks())
    us, vs = [], []
    keys, reps = [], []
    for n, d, counts, o in zip(table.column("names"), table.column("docs"), table.column("counts"), own):
        if o:
            us.append(np.frombuffer(n.as_py(), np.int64))
            vs.append(np.frombuffer(d.as_py(), np.int64))
        else:
            keys.append(np.frombuffer(n.as_py(), U))
            reps.append(S._docs_of(d, counts))
    if keys:
        _, u, v = _stars(np.concatenate(keys), np.concatenate(reps))
        us.append(u)
        vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    pairs = np.unique(np.stack([u, v]), axis=1) if len(u) else np.zeros((2, 0), np.int64)
    return pa.table({"u": pairs[0], "v": pairs[1]})


# Sides of a member: 0 and 1 in a pair of two tiles, where only pairs across count; WITHIN where all pairs do.
WITHIN = 2
MEMBER = "tile string, c long, rep long, copies long, side int, n int, grams binary"


def _send_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in MEMBER.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for b in batches:
        meta = b.select(["k1", "k2", "c", "copies", "tiles", "slot", "block"]).to_pylist()
        done = 0
        for ids, texts in _slices(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            rows, grams = shingle_sets(texts)
            n, k1, k2 = set_keys(rows, grams, len(ids))
            ends = np.cumsum(n)
            out = []
            for i, doc in enumerate(ids):
                m = meta[done + i]
                if (int(k1.view(np.int64)[i]), int(k2.view(np.int64)[i])) != (m["k1"], m["k2"]):
                    continue                                    # another text under the same id
                cell = grams[ends[i] - n[i]:ends[i]].tobytes()
                if m["tiles"] == 1:
                    out.append((f"block {m['block']}", m["c"], doc, m["copies"], WITHIN, int(n[i]), cell))
                else:
                    for t in range(m["tiles"]):
                        lo, hi = min(t, m["slot"]), max(t, m["slot"])
                        side = WITHIN if lo == hi else int(m["slot"] == hi)
                        out.append((f"{m['c']} {lo} {hi}", m["c"], doc, m["copies"], side, int(n[i]), cell))
            done += len(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def _near_times(member: np.ndarray, gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members that hold the same gram, for grams of at most SPARSE members (sorted by gram)."""
    for d in range(1, SPARSE):
        same = np.flatnonzero(gram[d:] == gram[:-d])
        if not len(same):
            return
        yield member[same], member[same + d]


def _links_small(cluster, gram, member, n):
    """Linked pairs of many clusters of at most SPARSE members each: (i, j), i < j."""
    order = np.lexsort((member, gram, cluster))
    key, m = S.mixed(gram[order] + S.mixed(cluster[order].astype(U))), member[order]
    total = len(n)
    codes = [np.minimum(i, j) * total + np.maximum(i, j) for i, j in _near_times(m, key)]
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, inter = np.unique(np.concatenate(codes), return_counts=True)
    i, j = code // total, code % total
    num, den = THRESHOLD
    ok = inter * den >= num * (n[i] + n[j] - inter)
    return i[ok], j[ok]


def _links_large(gram, member, n):
    """Linked pairs of one cluster or tile pair, by blocks of a dense membership matrix."""
    m = len(n)
    order = np.lexsort((member, gram))
    gram, member = gram[order], member[order]
    head = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    size = np.diff(np.append(head, len(gram)))
    inter = np.zeros((m, m), np.float32)
    few = np.repeat((size > 1) & (size <= 8), size)
    for i, j in _near_times(member[few], gram[few]):
        inter += np.bincount(np.minimum(i, j) * m + np.maximum(i, j), minlength=m * m).reshape(m, m)
    many = np.flatnonzero(size > 8)
    for a in range(0, len(many), 2048):
        part = many[a:a + 2048]
        matrix = np.zeros((m, len(part)), np.float32)
        cols = np.repeat(np.arange(len(part)), size[part])
        at = np.repeat(head[part], size[part]) + (np.arange(int(size[part].sum()))
                                                  - np.repeat(np.cumsum(size[part]) - size[part], size[part]))
        matrix[member[at], cols] = 1
        inter += np.triu(matrix @ matrix.T, 1)
    num, den = THRESHOLD
    i, j = np.nonzero(inter)
    both = inter[i, j].astype(np.int64)
    ok = both * den >= num * (n[i] + n[j] - both)
    return i[ok], j[ok]


def _verify(table: pa.Table) -> pa.Table:
    """One block of clusters or one pair of tiles: per class its linked documents and a spanning edge."""
    reps = np.asarray(table.column("rep").combine_chunks(), dtype=np.int64)
    c = np.asarray(table.column("c").combine_chunks(), dtype=np.int64)
    side = np.asarray(table.column("side").combine_chunks())
    _, first = np.unique(np.stack([c, reps, side]), axis=1, return_index=True)   # repeated rows: one member
    table = table.take(pa.array(first))
    reps, c, side = reps[first], c[first], side[first]
    copies = np.asarray(table.column("copies").combine_chunks(), dtype=np.int64)
    n = np.asarray(table.column("n").combine_chunks(), dtype=np.int64)
    cells = table.column("grams")
    _, cluster, size = np.unique(c, return_inverse=True, return_counts=True)
    found_i, found_j = [], []

    def flat(rows):
        return (np.concatenate([np.frombuffer(cells[int(r)].as_py(), U) for r in rows]), np.repeat(rows, n[rows]))

    order = np.argsort(cluster, kind="stable")
    edges = np.cumsum(size)
    batch: list[np.ndarray] = []
    held = 0

    def small():
        rows = np.concatenate(batch)
        gram, member = flat(rows)
        i, j = _links_small(cluster[member], gram, member, n)
        found_i.append(i)
        found_j.append(j)

    for k, e in enumerate(edges):
        rows = order[e - size[k]:e]
        if len(rows) < 2:
            continue
        if len(rows) <= SPARSE:
            batch.append(rows)
            held += int(n[rows].sum())
            if held > 200_000:
                small()
                batch, held = [], 0
        else:
            gram, member = flat(np.arange(len(rows)) if len(rows) == len(n) else rows)
            local = np.zeros(len(n), np.int64)
            local[rows] = np.arange(len(rows))
            i, j = _links_large(gram, local[member], n[rows])
            found_i.append(rows[i])
            found_j.append(rows[j])
    if batch:
        small()
    i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
    j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
    counted = (side[i] == WITHIN) | (side[i] != side[j])
    i, j = i[counted], j[counted]
    links = (np.bincount(i, copies[j], minlength=len(n)) + np.bincount(j, copies[i], minlength=len(n))).astype(np.int64)
    root = np.arange(len(n))
    while len(i):                                       # spanning edges: smallest reachable member
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    linked = np.flatnonzero(links > 0)
    return pa.table({"u": reps[linked], "v": reps[root[linked]], "links": links[linked]})


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL, rows: int = ROWS,
         bytes_per_bucket: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_links, n_shingles."""
    bands = banding(THRESHOLD[0] / THRESHOLD[1], recall, rows)
    buckets = blocks_for(docs, bytes_per_bucket)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(texts.mapInArrow(functools.partial(_sign, bands, rows), SIGNED), "signatures")
    classes = stored(signed.filter("doc_id IS NOT NULL AND n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "classes")
    sent = classes.select("rep", "bands").mapInArrow(functools.partial(_send_bands, buckets), S.ENTRY)
    stars = sent.groupBy("bucket").applyInArrow(_meet, "u long, v long")
    clusters = components(stars, "candidates")

    # every class of a cluster sends its set to its block of small clusters, or to its pairs of tiles
    size = clusters.groupBy("c").agg(F.count(F.lit(1)).alias("members"))
    members = clusters.join(size, "c").select(F.col("v").alias("rep"), "c",
                                              F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    members = members.join(classes.select("rep", "k1", "k2", "copies"), "rep").select(
        F.col("rep").alias("doc_id"), "k1", "k2", "c", "copies", "tiles",
        F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int").alias("slot"),
        F.pmod(F.xxhash64("c"), F.lit(buckets)).cast("int").alias("block"))
    members = stored(members, "members")
    # always by a shuffle of the texts: the members grow with the input, whatever the size of a test
    sets = texts.join(members.hint("merge"), "doc_id").mapInArrow(_send_sets, MEMBER)
    verified = stored(sets.groupBy("tile").applyInArrow(_verify, "u long, v long, links long"), "links")
    final = components(verified, "classes")

    links = verified.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    out = signed.join(classes.select("k1", "k2", F.col("rep"), "copies"), ["k1", "k2"], "left")
    out = out.select("doc_id", F.when(F.col("n") > 0, F.col("rep")).alias("rep"),
                     F.when(F.col("n") > 0, F.col("copies")).alias("copies"), "n")
    out = out.join(final.withColumnRenamed("v", "rep"), "rep", "left").join(links, "rep", "left")
    known = F.col("doc_id").isNotNull()
    own = F.coalesce(F.col("copies") - 1, F.lit(0))
    return out.select("doc_id", F.when(known, F.coalesce("c", "rep", "doc_id")).alias("class_id"),
                      F.when(known, F.coalesce("rep", "doc_id")).alias("copy_of"),
                      F.when(known, own + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      F.col("n").cast("long").alias("n_shingles"))
