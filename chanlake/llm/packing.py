"""Operator 8: packing by concatenate and cut.

Pass 1 tokenises every text once and writes the ids to the shared folder; each
task keeps a running token total, so a document's row holds its start within
its partition. The partition totals (one row per partition) are prefix-summed
into global offsets. Pass 2 adds the partition's offset to each start
and cuts at the multiples of the window: a document that crosses a window edge
gives one boundary record (piece) per window it touches. Every window is full
but the last, so at most one sequence has padding.

Defined results: NULL or empty text is one end token; repeated rows and ids are
packed once per row; a document may span many windows; an empty table gives no
pieces; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm import pieces as P
from chanlake.llm.common import stored

IDS = "part int, doc_id long, begin long, n long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


@functools.lru_cache(maxsize=2)
def merger(path: str):
    """Byte-pair merger over the .json file's own ranks. Every vocabulary entry is merged both ways once
    per worker in the tests, not here."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    ranks = {P.token_bytes(k): v for k, v in data["model"]["vocab"].items() if k not in special}
    return tiktoken.Encoding("vocabulary", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def piece_cache(path: str) -> P.Bounded:
    return P.Bounded(200_000)


def ids_of(uniq: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the distinct pre-tokens and the length of each."""
    cache, bpe = piece_cache(path), merger(path)
    out = []
    for piece in uniq:
        ids = cache.get(piece)
        if ids is None:
            ids = array("I", bpe.encode_ordinary(piece)).tobytes()
            cache.put(piece, ids)
        out.append(ids)
    lens = np.fromiter(map(len, out), np.int64, len(out)) // 4
    return np.frombuffer(b"".join(out), "<u4"), lens


def gather(flat: np.ndarray, lens: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Concatenate the runs of ``flat`` (run i has lens[i] items) in the order of ``index``."""
    starts = np.cumsum(lens) - lens
    take = lens[index]
    total = int(take.sum())
    at = np.repeat(starts[index] - (np.cumsum(take) - take), take) + np.arange(total)
    return flat[at]


def _tokenise(path: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, begin = TaskContext.get().partitionId(), 0
    for b in P.joined(batches):
        offsets, values = P.list_parts(b.column("pieces"))
        uniq, index = P.distinct(values)
        flat, lens = ids_of(uniq, path)
        ids = gather(flat, lens, index) if len(uniq) else flat
        counts = P.row_sums(lens[index], offsets) if len(uniq) else np.zeros(b.num_rows, np.int64)
        raw = b.column("raw")
        ids, counts = with_whole_texts(ids, counts, raw, path)
        ids = np.insert(ids, np.cumsum(counts), np.uint32(end))        # the end of every document
        counts += 1
        begins = begin + np.cumsum(counts) - counts
        begin += int(counts.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(b.num_rows, part, np.int32)), b.column("doc_id"), pa.array(begins), pa.array(counts),
             cells(ids, counts)], ["part", "doc_id", "begin", "n", "ids"])


def with_whole_texts(ids: np.ndarray, counts: np.ndarray, raw: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows with those of the texts that the library takes whole put in their places."""
    at = np.flatnonzero(np.asarray(raw.is_valid()))
    if not len(at):
        return ids, counts
    ends, parts, a = np.cumsum(counts), [], 0
    counts = counts.copy()
    for i in at:
        own = np.array(P.library(path).encode(raw[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
        parts += [ids[a:ends[i]], own]
        counts[i], a = len(own), ends[i]
    return np.concatenate([*parts, ids[a:]]), counts


def cells(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary cell a row, cut from one buffer: two bytes an id, or a zero byte and four bytes each in a row that
    has a larger one."""
    ends = np.cumsum(counts)
    large = np.flatnonzero(ids > 65535)
    if not len(large):
        offsets = np.concatenate([[0], ends * 2]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets),
                                                                pa.py_buffer(ids.astype("<u2"))])
    wide = np.unique(np.searchsorted(ends, large, side="right"))
    rows = [ids[e - n:e] for e, n in zip(ends, counts)]
    wide = set(wide.tolist())
    return pa.array([b"\0" + r.astype("<u4").tobytes() if i in wide else r.astype("<u2").tobytes()
                     for i, r in enumerate(rows)], pa.binary())


def unpack_ids(cell: bytes) -> np.ndarray:
    """Ids of a stored cell: two bytes each, or a zero byte and four bytes each."""
    if len(cell) % 2:
        return np.frombuffer(cell, "<u4", offset=1)
    return np.frombuffer(cell, "<u2").astype("<u4")


def _cut(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PIECES.split(", ")]
    for b in batches:
        out: list[tuple] = []
        for doc, at, cell in zip(b.column("doc_id").to_pylist(), b.column("at").to_pylist(), b.column("ids")):
            ids = unpack_ids(cell.as_py())
            n, start = len(ids), 0
            while start < n:
                g = at + start
                length = min(n - start, window - g % window)
                out.append((doc, start, length, zlib.crc32(ids[start:start + length].tobytes()), n, g // window,
                            g % window))
                start += length
        cols = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pass 1: stored rows (part, doc_id, begin in the partition, n, ids)."""
    pieces, raw = P.pretokens(F.col(text), P.BYTE_SPLIT, P.UNKNOWN, list(P.specials_of(tokenizer)))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), pieces, raw)
    return stored(rows.mapInArrow(functools.partial(_tokenise, tokenizer, end_id), IDS), "ids")


def with_offsets(ids: DataFrame) -> DataFrame:
    """Global position ``at`` of each row: its partition's offset (prefix sum over one row per partition)
    plus its start there."""
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    # one row of 12 bytes per scan task: small by construction, so the ids need not move to meet it
    return ids.join(F.broadcast(base), "part").select("doc_id", "ids", "n", (F.col("base") + F.col("begin")).alias("at"))


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Pack all documents into sequences of ``window`` tokens; one row per piece (PIECES)."""
    placed = with_offsets(tokenise(docs, tokenizer, end_id, doc_id, text))
    return placed.mapInArrow(functools.partial(_cut, window), PIECES)
