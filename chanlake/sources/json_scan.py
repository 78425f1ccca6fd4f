"""Structural scan of JSON files: records of any layout, read by many tasks.

A file may hold one array of records, records one after the other, indented or compact, several on a line or one
over many lines. Files are read in fragments that end at ``}``, so a file splits across tasks like any text (a
fragment is never longer than a record). What a byte means depends on all bytes before it, so the scan takes two passes:

1. Each split computes its transition for both states it may be entered in (outside a string, inside one): the state
   it is left in, how many brackets it closes that were open before, which it leaves open. One row a split.
   Composing these rows in the order of the splits (a fold over slim rows, file by file) fixes the entry of every split.
2. With its entry known, each split cuts the objects that stand at the top or right inside a top-level array. A record over
   a split edge leaves pieces, named by the split in which it begins, and is put together by that name.

Nothing is lost without a word: text that belongs to no record (other than commas, brackets and white space), and a
record that the file ends in, come out as rows with ``stray`` set, and a file is ``clean`` if it has none.

Brackets and quotes are found in numpy, a buffer at a time; a quote counts unless an odd run of backslashes
stands before it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, BACKSLASH = ord('"'), ord("\\")
OPEN = np.zeros(256, bool)
OPEN[[ord("{"), ord("[")]] = True
CLOSE = np.zeros(256, bool)
CLOSE[[ord("}"), ord("]")]] = True
# between records: white space, commas, the brackets of the top-level array, a byte order mark
FRAME = np.zeros(256, bool)
FRAME[[*b" \t\r\n,[]\xef\xbb\xbf"]] = True


# --- one buffer ----------------------------------------------------------------------

def quotes(buf: np.ndarray) -> np.ndarray:
    """Positions of the quotes that start or end a string."""
    at = np.flatnonzero(buf == QUOTE)
    slashes = np.flatnonzero(buf == BACKSLASH)
    if not len(slashes) or not len(at):
        return at
    first = np.ones(len(slashes), bool)                    # of a run of backslashes
    first[1:] = np.diff(slashes) > 1
    begin = slashes[np.maximum.accumulate(np.where(first, np.arange(len(slashes)), 0))]
    k = np.searchsorted(slashes, at - 1)
    k = np.minimum(k, len(slashes) - 1)
    before = slashes[k] == at - 1                          # a backslash stands right before the quote
    run = np.where(before, at - begin[k], 0)
    return at[run % 2 == 0]


def brackets(buf: np.ndarray, ends: np.ndarray, inside: bool) -> np.ndarray:
    """Positions of the brackets outside strings; ``inside``: the buffer begins in a string."""
    at = np.flatnonzero(OPEN[buf] | CLOSE[buf])
    return at[(np.searchsorted(ends, at) + inside) % 2 == 0]


def effect(buf: np.ndarray, at: np.ndarray) -> tuple[int, bytes]:
    """(brackets closed that were open before, brackets left open) of a run of brackets."""
    if not len(at):
        return 0, b""
    opens = OPEN[buf[at]]
    depth = np.cumsum(np.where(opens, 1, -1))
    low = min(0, int(depth.min()))
    later = np.minimum.accumulate(depth[::-1])[::-1]       # least depth from here on
    return -low, buf[at[opens & (later >= depth)]].tobytes()


def compose(state: tuple[bytes, int], step: tuple[int, bytes]) -> tuple[bytes, int]:
    """Open brackets (and how often a bracket closed that none had opened) after an effect."""
    stack, wrong = state
    pops, pushed = step
    wrong += max(0, pops - len(stack))
    return stack[:max(0, len(stack) - pops)] + pushed, wrong


# --- pass 1: transitions ------------------------------------------------------------------

TRANSITIONS = ("file string, start long, file_size long, bytes long, out0 boolean, pops0 int, open0 binary, out1 boolean, "
               "pops1 int, open1 binary")


def buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bool, np.ndarray, int]]:
    """(file, split, file size, whether the split begins here, bytes, fragments) of runs of one split. Fragments are
    joined by their ``}``; the last ``}`` of a run is held back until the split goes on."""
    now = None
    for b in batches:
        names, starts = b.column("file").to_pylist(), np.asarray(b.column("start"))
        sizes = np.asarray(b.column("file_size"))
        a = 0
        while a < b.num_rows:
            e = a + 1
            while e < b.num_rows and starts[e] == starts[a] and names[e] == names[a]:
                e += 1
            key = (names[a], int(starts[a]))
            text = b"}".join(x if x is not None else b"" for x in
                             b.column("value").slice(a, e - a).cast(pa.binary()).to_pylist())
            new = key != now
            now = key
            yield key[0], key[1], int(sizes[a]), new, np.frombuffer(text if new else b"}" + text, np.uint8), e - a
            a = e


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f.split()[0] for f in TRANSITIONS.split(", ")]
    now, size, n, states = None, 0, 0, []

    def row():
        cells = [now[0], now[1], size, n]
        for inside, pops, stack in states:
            cells += [inside, pops, stack]
        kinds = [pa.string(), *[pa.int64()] * 3, *[pa.bool_(), pa.int32(), pa.binary()] * 2]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(cells, kinds)], fields)

    for file, start, file_size, new, buf, rows in buffers(batches):
        if new:
            if now is not None:
                yield row()
            now, size, n, states = (file, start), file_size, 0, [(False, 0, b""), (True, 0, b"")]
        n += len(buf) + new                                # with the ``}`` that is held back
        ends = quotes(buf)
        for i, (inside, pops, stack) in enumerate(states):
            more, left = effect(buf, brackets(buf, ends, inside))
            pops += max(0, more - len(stack))
            states[i] = (bool((len(ends) + inside) % 2), pops, stack[:max(0, len(stack) - more)] + left)
    if now is not None:
        yield row()


def record_level(stack: bytes) -> int | None:
    """Index of the bracket that opened the element we are in, or None between elements."""
    if stack[:1] == b"{":
        return 0
    return 1 if len(stack) > 1 else None


def _closed_end(state: tuple[bool, bytes], total: int, size: int) -> bool:
    """Whether the file ends with ``}``: its fragments and their ends then add up to its size (a byte order mark is not
    among them). A compressed file has another size; there the end that leaves nothing open is taken."""
    if total in (size, size - 3):
        return True
    if total in (size + 1, size - 2):
        return False
    return bool(state[0] or state[1])


def fold(splits: list[dict]) -> list[dict]:
    """Entry state of each split of one file, by composing the transitions in order."""
    splits = sorted(splits, key=lambda r: r["start"])
    total = sum(r["bytes"] for r in splits)
    inside, stack, owners, wrong, out = False, b"", [], 0, []
    for k, r in enumerate(splits):
        level = record_level(stack)
        last = k == len(splits) - 1
        out.append({"file": r["file"], "start": r["start"], "inside": inside, "open": stack[:2],
                    "owner": None if level is None else owners[level], "depth": len(stack), "last": last})
        i = "1" if inside else "0"
        before, (stack, wrong) = stack, compose((stack, wrong), (r["pops" + i], r["open" + i]))
        owners = owners[:max(0, len(before) - r["pops" + i])]
        owners += [r["start"]] * (len(stack) - len(owners))
        inside = r["out" + i]
        closed = _closed_end((inside, stack), total, r["file_size"]) if last else True
        out[-1]["closed"] = closed
        if closed and not inside:
            stack, wrong = compose((stack, wrong), (1, b""))
            owners = owners[:len(stack)]
    balanced = not inside and not stack and not wrong
    return [r | {"clean": balanced} for r in out]


FOLDED = ("file string, start long, inside boolean, open binary, owner long, depth int, last boolean, closed boolean, "
          "clean boolean")


def _fold(table: pa.Table) -> pa.Table:
    rows = fold(table.to_pylist())
    names = [f.split()[0] for f in FOLDED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), *[pa.bool_()] * 3]
    return pa.table({n: pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)})


# --- pass 2: records ---------------------------------------------------------------------

class Cutter:
    """Cuts the records of one split, buffer by buffer."""

    def __init__(self, entry: dict):
        self.inside, self.depth = entry["inside"], entry["depth"]
        self.top = entry["open"][:1]                       # kind of the outermost open bracket
        self.held = b"" if entry["owner"] is not None else None      # text of the record we are in
        self.owner = entry["owner"]                        # the split it began in, if not this one
        self.done: list[tuple] = []                        # (text, None, stray) or (piece, owner, stray)

    def feed(self, buf: np.ndarray) -> None:
        ends = quotes(buf)
        at = brackets(buf, ends, self.inside)
        kinds = buf[at]
        opens = OPEN[kinds]
        after = self.depth + np.cumsum(np.where(opens, 1, -1))
        before = after - np.where(opens, 1, -1)
        outer = opens & (before == 0)                      # each bracket lies in the outermost one opened last
        which = np.maximum.accumulate(np.where(outer, np.arange(1, len(at) + 1), 0))
        top = np.where(which > 0, kinds[np.maximum(which - 1, 0)] if len(at) else 0, self.top[0] if self.top else 0)
        level = (top == ord("[")).astype(np.int64)         # records stand at depth 0, or 1 in an array
        begins = at[opens & (before == level)]
        stops = at[~opens & (after == level)] + 1
        a = 0
        if self.held is not None:
            if not len(stops):
                self.held += buf.tobytes()
                a = len(buf)
            else:
                self._record(self.held + buf[:stops[0]].tobytes())
                a, stops = int(stops[0]), stops[1:]
        n = min(len(begins), len(stops))
        text = buf.tobytes()
        for s, e in zip(begins[:n].tolist(), stops[:n].tolist()):
            self._between(text[a:s])
            self.done.append((text[s:e].decode("utf-8", "replace"), None, text[s] != ord("{")))
            a = e
        if len(begins) > n:                                # one more begins here
            self._between(text[a:begins[n]])
            self.held, a = text[begins[n]:], len(text)
        self._between(text[a:])
        self.inside = bool((len(ends) + self.inside) % 2)
        if len(at):
            self.depth = int(after[-1])
            self.top = bytes([int(top[-1])]) if self.depth > 0 else b""

    def _record(self, text: bytes) -> None:
        if self.owner is None:
            self.done.append((text.decode("utf-8", "replace"), None, text[:1] != b"{"))
        else:
            self.done.append((text, self.owner, False))
        self.held, self.owner = None, None

    def _between(self, text: bytes) -> None:
        if text and not FRAME[np.frombuffer(text, np.uint8)].all():
            said = text.strip(b" \t\r\n,[]")
            self.done.append((said.decode("utf-8", "replace"), None, True))

    def finish(self, start: int, last: bool) -> None:
        """The split ends; a record that goes on leaves a piece, one that the file ends in is stray."""
        if self.held is not None:
            mine = self.owner if self.owner is not None else start
            self.done.append((self.held, mine, last))
            self.held, self.owner = None, None


PIECES = "file string, line string, piece binary, owner long, start long, stray boolean"


def _records(entries: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, cutter, entry, fields = None, None, None, [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

    def rows():
        done, cutter.done = cutter.done, []
        for a in range(0, len(done), 10_000):
            some = done[a:a + 10_000]
            whole = [owner is None for _, owner, _ in some]
            cols = [[now[0]] * len(some), [x[0] if w else None for x, w in zip(some, whole)],
                    [None if w else x[0] for x, w in zip(some, whole)], [x[1] for x in some], [now[1]] * len(some),
                    [x[2] for x in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], fields)

    def close():
        if entry["closed"]:
            cutter.feed(np.frombuffer(b"}", np.uint8))
        cutter.finish(now[1], entry["last"])
        yield from rows()

    for file, start, _, new, buf, _ in buffers(batches):
        if new:
            if now is not None:
                yield from close()
            now, entry = (file, start), entries.get((file, start))
            if entry is None:
                raise RuntimeError(f"{file} was split anew while it was read: no state for {start}")
            cutter = Cutter(entry)
        cutter.feed(buf)
        yield from rows()
    if now is not None:
        yield from close()


# --- on Spark ------------------------------------------------------------------------------

def fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files' text cut behind every ``}``, in order within a split."""
    text = spark.read.option("recursiveFileLookup", "true").text(paths, lineSep="}")
    return text.select("value", F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("file_size"))


def entries(spark: SparkSession, paths: list[str]) -> DataFrame:
    """FOLDED: the entry state of every split of the files, one slim row each."""
    moved = fragments(spark, paths).mapInArrow(_transitions, TRANSITIONS)

    def one_file(splits: pa.Table) -> pa.Table:
        return _fold(splits)

    return moved.groupBy("file").applyInArrow(one_file, FOLDED)


def records(spark: SparkSession, paths: list[str], states: list) -> DataFrame:
    """(line, file, stray): every record of the files, and what belongs to none. ``states``: the collected entries,
    one row of some fifty bytes a split, as many as the driver plans tasks."""
    known = {(r["file"], r["start"]): {"inside": r["inside"], "open": bytes(r["open"]), "owner": r["owner"],
                                       "depth": r["depth"], "last": r["last"], "closed": r["closed"]} for r in states}
    cut = fragments(spark, paths).mapInArrow(functools.partial(_records, known), PIECES)
    whole = cut.filter("owner is null").select("line", "file", "stray")
    # at most two pieces a split; the pieces of a record are as long as the record
    pieces = cut.filter("owner is not null").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("p"), F.max("stray").alias("stray"))
    joined = pieces.select(F.decode(F.aggregate("p", F.lit(b""), lambda x, y: F.concat(x, y["piece"])), "UTF-8").alias("line"),
                           "file", "stray")
    return whole.unionByName(joined)
