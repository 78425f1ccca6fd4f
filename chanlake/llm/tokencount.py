"""Operator 1: token counts by the whole-token shortcut.

Most pre-tokens of real text are vocabulary entries. For each vocabulary
string it is proved once per worker, offline, that the tokenizer encodes it
alone as exactly one token; a pre-token in that proven set counts 1 without
merging. Only the rest is merged by the library, once per distinct
pre-token of a batch, with a bounded cache across batches. No shuffle.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); repeated rows
and ids are counted row by row; an empty table gives no rows; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm import pieces as P


@functools.lru_cache(maxsize=2)
def proven_whole(path: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer encodes alone as one token."""
    tok = P.library(path)
    found = []
    for entry in tok.get_vocab(with_added_tokens=False):
        if entry.endswith("</w>"):
            try:
                found.append(P.token_bytes(entry[:-4]).decode("utf-8"))
            except (KeyError, UnicodeDecodeError):
                continue
    found = sorted(set(found))
    encoded = tok.encode_batch_fast(found, add_special_tokens=False)
    return frozenset(s for s, e in zip(found, encoded) if len(e.ids) == 1)


@functools.lru_cache(maxsize=2)
def merged_counts(path: str) -> P.Bounded:
    return P.Bounded()


def counts_of(uniq: list[str], path: str) -> np.ndarray:
    """Tokens of each distinct pre-token: 1 by the proven set, else merged."""
    whole, cache, tok = proven_whole(path), merged_counts(path), P.library(path)
    out = np.ones(len(uniq), dtype=np.int64)
    todo: list[int] = []
    for i, piece in enumerate(uniq):
        if (piece.lower() if piece.isascii() else piece) in whole:
            continue
        n = cache.get(piece)
        if n is None:
            todo.append(i)
        else:
            out[i] = n
    for a in range(0, len(todo), 4096):
        part = todo[a:a + 4096]
        for i, e in zip(part, tok.encode_batch_fast([uniq[j] for j in part], add_special_tokens=False)):
            out[i] = len(e.ids)
            cache.put(uniq[i], len(e.ids))
    return out


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in P.small(batches):
        offsets, values = P.list_parts(b.column("pieces"))
        uniq, index = P.distinct(values)
        n = P.row_sums(counts_of(uniq, path)[index], offsets) if len(uniq) else np.zeros(b.num_rows, np.int64)
        raw = b.column("raw")
        redo = np.asarray(raw.is_valid()).nonzero()[0].tolist()
        # a pre-token that normalisation changes may join its neighbours: count such rows whole
        odd = {i for i, p in enumerate(uniq) if not P.joins_nothing(p)}
        if odd:
            rows = np.searchsorted(offsets, np.isin(index, list(odd)).nonzero()[0], side="right") - 1
            back = set(rows.tolist()) - set(redo)
        else:
            back = set()
        for i in redo:
            n[i] = len(P.library(path).encode(raw[i].as_py(), add_special_tokens=False).ids)
        for i in back:
            n[i] = len(P.library(path).encode(b.column("text")[i].as_py(), add_special_tokens=False).ids)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n)],
                                         ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Return doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is the path of a word-level .json vocabulary, readable on
    every executor (it is never copied here)."""
    pieces, raw = P.pretokens(F.col(text), P.WORD_SPLIT, P.JOINING, list(P.specials_of(tokenizer)))
    # the text travels only where some character is not ASCII (it may turn out to need the library)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), pieces, raw,
                       F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
                       F.when(F.length(text) != F.octet_length(text), F.col(text)).alias("text"))
    counted = rows.mapInArrow(functools.partial(_count, tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
