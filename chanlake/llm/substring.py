"""Operator 5: substring dedup by recompression.

Names. Words get global names by hashing, so no dictionary is shared. One round names token runs
(blocks of two equal words) and, four times, adjacent pairs: a pair is merged when the left
name's bit for that round is 0 and the right one's is 1. Whether two symbols merge depends on
nothing but their names, so equal substrings get the same symbols inside and differ
only near their ends: at most 16 words at each end, whatever stands around them. A window of
50 words therefore always holds a symbol start (or a word of a run) at the same
offset, at most 16, in all its occurrences; the 32 words from there are its phrase.

Rounds on Spark. (1) Tasks name their texts and send (phrase, document) once per batch to
buckets; a bucket finds the phrases held by two or more documents and tells the documents.
(2) Documents compare only the 50-word windows that hold a shared phrase: window names go to
buckets with the smallest document id, and the windows that start in a smaller document
come back. (3) Covered words are cut. Exact copies of a text are known by its hash and send no windows:
all their words go. The texts are shuffled once, by id and text hash; both joins read that exchange. All groups are pre-aggregated per batch (one entry for a
phrase or window, however many copies a batch holds), so a hot passage costs one entry
per batch; buckets scale with the input.

Defined results: NULL or empty text has no words; texts shorter than a window lose nothing;
rows with a NULL id are returned unchanged and are no source; rows with the same id
are never sources for each other, and where their texts differ each is cut by itself (phrases, positions and copies
are keyed by id and a hash of the text); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.common import blocks_for, stored

ROUNDS, PHRASE, WINDOW = 4, 32, 50
SLICE_WORDS = 300_000                       # words named at once in a task
PIECE = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
U = np.uint64
# Packed entries: names (64 bits each), the documents they belong to with a count each, positions, text keys.
ENTRY = "bucket int, names binary, docs binary, counts binary, at binary, own boolean, texts binary"


class _Names(dict):
    """Word -> 64-bit name; forgets everything when full (names are hashes, so they come back the same)."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 200_000:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word, seed=5)
        return name


_names = _Names()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_names.__getitem__, words), U, len(words))


def symbol_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of the words where a symbol starts after all rounds, or that belong to a token run.

    ``first`` marks each document's first word: nothing is merged across it."""
    n = len(names)
    keep = np.zeros(n, bool)
    if n == 0:
        return keep
    same = np.zeros(n, bool)
    same[1:] = (names[1:] == names[:-1]) & ~first[1:]
    keep |= same
    keep[:-1] |= same[1:]
    # token runs: blocks of two from the start of the run
    heads = np.flatnonzero(~same)
    rank = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
    at = np.flatnonzero(rank % 2 == 0)
    sym, length = names[at], np.diff(np.append(at, n))
    sym = np.where(length == 2, mixed(sym + U(0x9E3779B97F4A7C15)), sym)
    for r in range(ROUNDS):
        bit = (mixed(sym ^ U(0xA5A5A5A5 + 7919 * r)) >> U(17)) & U(1)
        pair = (bit[:-1] == 0) & (bit[1:] == 1) & ~first[at[1:]] & (length[:-1] + length[1:] <= 2 << r)
        left = np.append(pair, False)
        right = np.append(False, pair)
        sym = np.where(left, mixed(sym * U(3) + np.append(sym[1:], U(0)) * U(0x9E3779B97F4A7C15)), sym)[~right]
        at = at[~right]
        length = np.diff(np.append(at, n))
    keep[at] = True
    return keep


def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, U)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def spans(names: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15 | 1) -> np.ndarray:
    """Name of the ``width`` words from each position (positions too near the end are left out)."""
    n = len(names)
    if n < width:
        return np.zeros(0, U)
    total = np.concatenate([np.zeros(1, U), np.cumsum(names * _powers(n, base), dtype=U)])
    inverse = pow(base, -1, 1 << 64)
    return mixed((total[width:] - total[:-width]) * _powers(n, inverse)[: n - width + 1])


def _slices(ids: list, keys: list, texts: list) -> Iterator[tuple[list, list, list]]:
    """Documents with at least a window of words, in slices of bounded size: (ids, text keys, word lists)."""
    out_ids, out_keys, out_words, n = [], [], [], 0
    for doc, key, text in zip(ids, keys, texts):
        if doc is None or not text:
            continue
        words = text.encode("utf-8", "surrogatepass").split()
        if len(words) < WINDOW:
            continue
        out_ids.append(doc)
        out_keys.append(key)
        out_words.append(words)
        n += len(words)
        if n >= SLICE_WORDS:
            yield out_ids, out_keys, out_words
            out_ids, out_keys, out_words, n = [], [], [], 0
    if out_ids:
        yield out_ids, out_keys, out_words


def _phrases(ids: list, lists: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names of all words, row of each word, positions of phrases, phrase names) of a slice."""
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    names = word_names([w for ws in lists for w in ws])
    ends = np.cumsum(lens)
    first = np.zeros(len(names), bool)
    first[ends - lens] = True
    row = np.repeat(np.arange(len(lists)), lens)
    span = spans(names, PHRASE)
    at = np.flatnonzero(symbol_starts(names, first))
    at = at[at + PHRASE <= ends[row[at]]]
    return names, row, at, span[at]


def _heads(docs: np.ndarray, keys: np.ndarray | None) -> np.ndarray:
    """Where a new document (and text, if keys are given) begins."""
    new = docs[1:] != docs[:-1]
    return np.flatnonzero(np.append(True, new if keys is None else new | (keys[1:] != keys[:-1]))[: len(docs)])


def _pack(bucket: int, names: np.ndarray, docs: np.ndarray, at: np.ndarray | None, own: bool,
          keys: np.ndarray | None = None) -> tuple:
    """A row of ENTRY; entries come sorted by document and text, so ids are stored once with a count."""
    head = _heads(docs, keys)
    counts = np.diff(np.append(head, len(docs))).astype("<u4")
    return (bucket, names.tobytes(), docs[head].tobytes(), counts.tobytes(),
            at.astype("<u4").tobytes() if at is not None else None, own,
            keys[head].tobytes() if keys is not None else None)


def _docs_of(docs, counts) -> np.ndarray:
    return np.repeat(np.frombuffer(docs.as_py(), np.int64), np.frombuffer(counts.as_py(), "<u4"))


def _by_bucket(buckets: int, names: np.ndarray, docs: np.ndarray, at: np.ndarray | None = None,
               keys: np.ndarray | None = None):
    """Rows of ENTRY, one per bucket (the bucket comes from the name's high bits)."""
    b = ((names >> U(40)) % U(buckets)).astype(np.int64)
    order = np.lexsort((docs, b) if keys is None else (keys, docs, b))
    b, names, docs = b[order], names[order], docs[order]
    at = at[order] if at is not None else None
    keys = keys[order] if keys is not None else None
    edges = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
    for s, e in zip(edges, np.append(edges[1:], len(b))):
        yield _pack(int(b[s]), names[s:e], docs[s:e], at[s:e] if at is not None else None, False,
                    keys[s:e] if keys is not None else None)


def _flush(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      ["bucket", "names", "docs", "counts", "at", "own", "texts"])


def _shared_in(names: np.ndarray, docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by (name, doc, text): returns the order and, in that order, whether the name is held by two documents."""
    order = np.lexsort((keys, docs, names))
    n, d = names[order], docs[order]
    head = np.flatnonzero(np.append(True, n[1:] != n[:-1])) if len(n) else np.zeros(0, np.int64)
    tail = np.append(head[1:], len(n)) - 1
    many = d[head] != d[tail] if len(n) else np.zeros(0, bool)
    return order, np.repeat(many, tail - head + 1) if len(n) else many


def first_turn() -> int:
    """Where a task begins to deal its own rows, so that the tasks' first rows do not meet in one group."""
    task = TaskContext.get()
    return int(mixed(np.array([task.partitionId() + 1], U))[0] >> U(33)) if task else 0


def _send_phrases(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = first_turn()
    for b in batches:
        for ids, keys, lists in _slices(*(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
            _, row, at, phrase = _phrases(ids, lists)
            docs, texts = np.array(ids, np.int64)[row[at]], np.array(keys, np.int64)[row[at]]
            order, many = _shared_in(phrase, docs, texts)
            p, d, k = phrase[order], docs[order], texts[order]
            head = np.append(True, p[1:] != p[:-1])[: len(p)]
            each = head | np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))[: len(p)]
            lone = head | each & ~many                                # one entry per phrase of the slice, or per text
            rows = list(_by_bucket(buckets, p[lone], d[lone], None, k[lone]))    # of the one id that holds it
            if many.any():                                            # known to be shared: only to be told
                fresh = many & each
                turn += 1
                by_doc = np.lexsort((k[fresh], d[fresh]))
                rows.append(_pack(buckets + turn % buckets, p[fresh][by_doc], d[fresh][by_doc], None, True,
                                  k[fresh][by_doc]))
            if rows:
                yield _flush(rows)


def _find_shared(table: pa.Table) -> pa.Table:
    """One bucket: (doc_id, text_key, phrase) rows for every phrase that two documents hold."""
    own = np.asarray(table.column("own").combine_chunks())
    names = [np.frombuffer(x.as_py(), U) for x in table.column("names")]
    docs = [_docs_of(d, c) for d, c in zip(table.column("docs"), table.column("counts"))]
    keys = [_docs_of(k, c) for k, c in zip(table.column("texts"), table.column("counts"))]
    out_n = [n for n, o in zip(names, own) if o]
    out_d = [d for d, o in zip(docs, own) if o]
    out_k = [k for k, o in zip(keys, own) if o]
    if not own.all():
        n, d, k = (np.concatenate([x for x, o in zip(xs, own) if not o]) for xs in (names, docs, keys))
        order, many = _shared_in(n, d, k)
        out_n.append(n[order][many])
        out_d.append(d[order][many])
        out_k.append(k[order][many])
    return pa.table({"doc_id": np.concatenate(out_d), "text_key": np.concatenate(out_k),
                     "phrase": np.concatenate(out_n).view(np.int64)})


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _send_windows(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = first_turn()
    for b in batches:
        told, some_ids, some_keys, some_texts = {}, [], [], []
        text_keys = b.column("text_key").to_pylist()
        cells, copy = b.column("phrases"), b.column("copy").to_pylist()
        for i, doc in enumerate(b.column("doc_id").to_pylist()):
            if doc is not None and not copy[i] and cells[i].is_valid and len(cells[i]):
                told[doc, text_keys[i]] = np.asarray(cells[i].values).view(U)
                some_ids.append(doc)
                some_keys.append(text_keys[i])
                some_texts.append(b.column("text")[i].as_py())
        for ids, keys, lists in _slices(some_ids, some_keys, some_texts):
            names, row, at, phrase = _phrases(ids, lists)
            lens = np.fromiter(map(len, lists), np.int64, len(lists))
            ends = np.cumsum(lens)
            hit = np.zeros(len(at), bool)
            for r in range(len(lists)):
                lo, hi = np.searchsorted(at, (ends[r] - lens[r], ends[r]))
                hit[lo:hi] = np.isin(phrase[lo:hi], told[ids[r], keys[r]])
            # windows that hold a shared phrase: they start at most WINDOW - PHRASE words before it
            reach = np.zeros(len(names) + 1, np.int64)
            at = at[hit]
            np.add.at(reach, np.maximum(at - (WINDOW - PHRASE), ends[row[at]] - lens[row[at]]), 1)
            np.add.at(reach, at + 1, -1)
            w = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
            w = w[w + WINDOW <= ends[row[w]]]
            if not len(w):
                continue
            name = spans(names, WINDOW)[w]
            docs, pos = np.array(ids, np.int64)[row[w]], w - (ends[row[w]] - lens[row[w]])
            order = np.lexsort((docs, name))
            n, d, p, k = name[order], docs[order], pos[order], np.array(keys, np.int64)[row[w]][order]
            new = np.append(True, n[1:] != n[:-1])
            least = np.repeat(d[new], np.diff(np.append(np.flatnonzero(new), len(n))))
            lone = d == least                           # of the slice's smallest document: ask the bucket
            rows = list(_by_bucket(buckets, n[lone], d[lone], p[lone], k[lone]))
            if not lone.all():                          # covered for certain: only to be told
                turn += 1
                by_doc = np.lexsort((k[~lone], d[~lone]))
                rows.append(_pack(buckets + turn % buckets, np.zeros(0, U), d[~lone][by_doc], p[~lone][by_doc], True,
                                  k[~lone][by_doc]))
            yield _flush(rows)


def _find_covered(table: pa.Table) -> pa.Table:
    """One bucket: (doc_id, text_key, starts) of the windows that also start in a document with a smaller id."""
    own = np.asarray(table.column("own").combine_chunks())
    d = [_docs_of(x, c) for x, c in zip(table.column("docs"), table.column("counts"))]
    k = [_docs_of(x, c) for x, c in zip(table.column("texts"), table.column("counts"))]
    a = [np.frombuffer(x.as_py(), "<u4") for x in table.column("at")]
    docs, keys, at = ([x for x, o in zip(xs, own) if o] for xs in (d, k, a))
    if not own.all():
        n = np.concatenate([np.frombuffer(x.as_py(), U) for x, o in zip(table.column("names"), own) if not o])
        d, k, a = (np.concatenate([x for x, o in zip(xs, own) if not o]) for xs in (d, k, a))
        order = np.lexsort((d, n))
        n, d, k, a = n[order], d[order], k[order], a[order]
        new = np.append(True, n[1:] != n[:-1])
        least = np.repeat(d[new], np.diff(np.append(np.flatnonzero(new), len(n))))
        docs.append(d[d > least])
        keys.append(k[d > least])
        at.append(a[d > least])
    d, k, a = np.concatenate(docs), np.concatenate(keys), np.concatenate(at)
    order = np.lexsort((k, d))
    d, k, a = d[order], k[order], a[order]
    head = _heads(d, k)
    cells = [a[s:e].tobytes() for s, e in zip(head, np.append(head[1:], len(d)))]
    return pa.table({"doc_id": d[head], "text_key": k[head], "starts": pa.array(cells, pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc, key, text, cells, copy in zip(
                *(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "starts", "copy"))):
            data = (text or "").encode("utf-8", "surrogatepass")
            words = data.split()
            mark = np.zeros(len(words) + 1, np.int64)
            for cell in cells or []:
                at = np.frombuffer(cell, "<u4").astype(np.int64)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + WINDOW, -1)
            gone = np.cumsum(mark[:-1]) > 0
            if copy and len(words) >= WINDOW:
                gone[:] = True
            n = int(gone.sum())
            kept = [w for w, g in zip(words, gone) if not g]
            left = None
            if n:
                pieces = PIECE.findall(data)
                left = b"".join(x for x, g in zip(pieces, gone) if not g).decode("utf-8", "surrogatepass")
            out.append((doc, key, len(words), n, _digest(kept), left))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()] * 2)],
            ["doc_id", "text_key", "n_words", "n_removed", "kept_sha256", "left_text"])


def _copies(rows: DataFrame) -> DataFrame:
    """(doc_id, text_key) of the documents whose whole text is also that of a smaller id (stored: no texts)."""
    keyed = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.col("text_key").alias("a"), F.xxhash64(F.lit(77), "text").alias("b"))
    keyed = stored(keyed, "text-keys")
    first = keyed.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # stored, so that the join is between two scans: small maps are broadcast, large hot groups split
    first = stored(first.filter("first < last").select("a", "b", "first"), "first-copies")
    return stored(keyed.join(first, ["a", "b"]).filter("doc_id > first").select(
        "doc_id", F.col("a").alias("text_key")).distinct(), "copies")


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    bytes_per_bucket: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, text_key (xxhash64 of the text), n_words, n_removed, kept_sha256 (of the kept
    words joined by spaces) and left_text (what is left of the text, white space kept; NULL where nothing was removed)."""
    buckets = blocks_for(docs, bytes_per_bucket)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"),
                       F.col(text).alias("text"))
    copies = _copies(rows)
    sent = rows.mapInArrow(functools.partial(_send_phrases, buckets), ENTRY)
    told = sent.groupBy("bucket").applyInArrow(_find_shared, "doc_id long, text_key long, phrase long")
    told = told.withColumn("copy", F.lit(False)).union(
        copies.select("doc_id", "text_key", F.lit(None).cast("long"), F.lit(True)))
    # joins by shuffle at every size: these tables grow with the input
    key = ["doc_id", "text_key"]
    told = told.groupBy(*key).agg(F.collect_list("phrase").alias("phrases"), F.max("copy").alias("copy"))
    windows = rows.join(told.hint("merge"), key, "left").select(*key, "text", "phrases", "copy").mapInArrow(
        functools.partial(_send_windows, buckets), ENTRY)
    starts = windows.groupBy("bucket").applyInArrow(_find_covered, "doc_id long, text_key long, starts binary")
    starts = starts.withColumn("copy", F.lit(False)).union(
        copies.select(*key, F.lit(None).cast("binary"), F.lit(True)))
    starts = starts.groupBy(*key).agg(F.collect_list("starts").alias("starts"), F.max("copy").alias("copy"))
    return rows.join(starts.hint("merge"), key, "left").select(*key, "text", "starts", "copy").mapInArrow(
        _cut, "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string, left_text string")
