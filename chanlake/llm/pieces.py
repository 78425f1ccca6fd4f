"""Pre-tokens found by the JVM, merged by vocabulary in Python workers.

A text is cut into pre-tokens with one Java regular expression (the
tokenizer's own split pattern, white space spelled out), so Python sees arrays
of pre-tokens that Arrow dictionary-encodes: each distinct pre-token of a batch
is looked up once. Rows where the Java cut could differ from the library's
(special strings, code points unknown to the JVM, text that normalisation would
join across a cut) carry the whole text instead and go through the library.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# White_Space code points, as the tokenizers' \s has them (fixed values).
WS = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

# Split patterns of the two public vocabularies (fixed values), for Java.
BYTE_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}]+|[" + WS + r"]+(?![^"
              + WS + r"])|[" + WS + r"]+")
WORD_SPLIT = r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|\p{L}+|\p{N}|[^" + WS + r"\p{L}\p{N}]+"

# Any of these sends the whole text to the library: code points the JVM's
# Unicode tables do not know (newer libraries may), private use, marks and
# conjoining jamo (normalisation may join them with a neighbour).
UNKNOWN = r"[\p{Cn}\p{Co}]"
JOINING = r"[\p{Cn}\p{Co}\p{M}\x{1100}-\x{11FF}\x{130}]"


def pretokens(text, split: str, whole: str, specials: list[str]):
    """(pieces, raw) columns: the pre-tokens, or the text itself where the
    library must see it whole. NULL text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    odd = text.rlike(whole)
    for s in specials:
        odd = odd | text.contains(s)
    none = F.array().cast("array<string>")
    return (F.when(odd, none).otherwise(F.regexp_extract_all(text, F.lit(split), F.lit(0))).alias("pieces"),
            F.when(odd, text).alias("raw"))


class Bounded(dict):
    """A dict that forgets its older half when full."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def put(self, key, value):
        if len(self) >= self.limit:
            for old in list(self)[: self.limit // 2]:
                del self[old]
        self[key] = value


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer of a .json file, one per worker process."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def specials_of(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


@functools.lru_cache(maxsize=1)
def byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    are numbered from U+0100 in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(token: str) -> bytes:
    table = byte_of()
    return bytes(table[c] for c in token)


def list_parts(column) -> tuple[np.ndarray, pa.Array]:
    """Offsets (from 0) and flat values of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets, dtype=np.int64)      # of this slice, into the shared values
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    return offsets - offsets[0], values


def small(batches, column: str = "pieces", most: int = 400_000):
    """Cut batches so that each holds about ``most`` list items (a single row may hold more)."""
    for b in batches:
        ends = np.asarray(b.column(column).offsets, dtype=np.int64)
        a = 0
        while a < b.num_rows:
            e = max(a + 1, int(np.searchsorted(ends, ends[a] + most, side="right")) - 1)
            yield b.slice(a, e - a)
            a = e


def joined(batches, column: str = "pieces", most: int = 1_000_000):
    """Join batches until they hold about ``most`` list items (a single row may hold more), so that a distinct
    item is looked up once for many."""
    held, n = [], 0
    for b in small(batches, column, most):
        ends = np.asarray(b.column(column).offsets, dtype=np.int64)
        size = int(ends[-1] - ends[0])
        if held and n + size > most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
        held.append(b)
        n += size
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def distinct(values: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct strings of a flat column and each row's index among them."""
    coded = values.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64)


def row_sums(per_item: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(per_item, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def joins_nothing(piece: str) -> bool:
    """True if normalising the piece alone equals normalising it in its text."""
    return piece.isascii() or unicodedata.is_normalized("NFC", piece)
