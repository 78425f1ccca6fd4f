"""Records of CSV files that span lines, read by many tasks.

A quoted field may hold line ends, so where a record ends depends on the quotes before it. Files are read by lines,
which split across tasks. Each split computes, for both states it may be entered in (between records, inside a
quoted field), the state it is left in; composing these slim rows in order fixes the entry of every split. Then each
split joins its own lines to records; a record over a split edge leaves pieces under the name of the split in
which it begins.

A quote opens a field only as its first character (an inch mark inside a field is text), two quotes inside a quoted
field are one, and after a closing quote the field runs to the delimiter, as the CSV reader has it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def closing(line: str, at: int) -> int:
    """Position of the quote that ends the quoted field whose text begins at ``at``; -1 if it goes on."""
    at = line.find('"', at)
    while at >= 0 and line.startswith('"', at + 1):
        at = line.find('"', at + 2)
    return at


def after_line(line: str, inside: bool, delimiter: str) -> bool:
    """Whether a quoted field is open behind the line, given whether one was before it."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        at = closing(line, 0)
        if at < 0:
            return True
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += len(delimiter)
    while True:
        if line.startswith('"', at):
            at = closing(line, at + 1)
            if at < 0:
                return True
        else:
            at = line.find(delimiter + '"', at)            # the next field that begins with a quote
            if at < 0:
                return False
            at += len(delimiter)
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += len(delimiter)


def lines(spark: SparkSession, paths) -> DataFrame:
    """The files' lines as they stand (a carriage return stays), in order within a split."""
    return spark.read.option("recursiveFileLookup", "true").text(paths, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """((file, split), lines) of runs of one split."""
    for b in batches:
        names, starts = b.column("file").to_pylist(), np.asarray(b.column("start"))
        a = 0
        while a < b.num_rows:
            e = a + 1
            while e < b.num_rows and starts[e] == starts[a] and names[e] == names[a]:
                e += 1
            yield (names[a], int(starts[a])), b.column("value").slice(a, e - a).to_pylist()
            a = e


TRANSITIONS = "file string, start long, out0 boolean, spans0 boolean, out1 boolean, whole1 boolean"


def _transitions(delimiter: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split and entry state: the state behind it; spans0: some line but the last ends inside; whole1: entered
    inside, no record begins in it."""
    fields = [f.split()[0] for f in TRANSITIONS.split(", ")]
    now, states, spans, whole = None, [False, True], False, True

    def row():
        cells = [now[0], now[1], states[0], spans or states[0], states[1], whole]
        kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(cells, kinds)], fields)

    for key, some in by_split(batches):
        if key != now:
            if now is not None:
                yield row()
            now, states, spans, whole = key, [False, True], False, True
        for line in some:
            spans = spans or states[0]
            whole = whole and states[1]
            if '"' in line:
                states = [after_line(line, s, delimiter) for s in states]
    if now is not None:
        yield row()


FOLDED = "file string, start long, inside boolean, owner long, last boolean, spans boolean"


def fold(splits: list[dict]) -> list[dict]:
    """Entry state and the split in which the open record began, for each split of one file in order."""
    out, inside, owner = [], False, None
    splits = sorted(splits, key=lambda r: r["start"])
    spans = False
    for k, r in enumerate(splits):
        out.append({"file": r["file"], "start": r["start"], "inside": inside, "owner": owner if inside else None,
                    "last": k == len(splits) - 1})
        spans = spans or inside or r["spans0"]
        left = r["out1"] if inside else r["out0"]
        if left and not (inside and r["whole1"]):
            owner = r["start"]
        inside = left
    return [r | {"spans": spans} for r in out]


def _fold(table: pa.Table) -> pa.Table:
    rows = fold(table.to_pylist())
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.table({n: pa.array([r[n] for r in rows], k)
                     for n, k in zip((f.split()[0] for f in FOLDED.split(", ")), kinds)})


def entries(spark: SparkSession, paths, delimiter: str) -> DataFrame:
    """FOLDED: a slim row for every split of the files."""
    def one_file(splits: pa.Table) -> pa.Table:
        return _fold(splits)

    moved = lines(spark, paths).mapInArrow(functools.partial(_transitions, delimiter), TRANSITIONS)
    return moved.groupBy("file").applyInArrow(one_file, FOLDED)


PIECES = "file string, line string, head boolean, owner long, start long"


def _records(known: dict, delimiter: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
    now, inside, owner, held, out, fresh = None, False, None, None, [], False

    def rows():
        nonlocal out
        done, out = out, []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], fields)

    def close():
        """What is open at the end of a split goes on in the next; at the end of the file it ends there."""
        if held is not None:
            out.append((now[0], "\n".join(held), fresh and owner is None, owner if owner is not None else now[1], now[1]))

    for key, some in by_split(batches):
        if key != now:
            if now is not None:
                close()
                yield from rows()
            entry = known.get(key)
            if entry is None:
                raise RuntimeError(f"{key[0]} was split anew while it was read: no state for {key[1]}")
            now, inside, owner = key, entry["inside"], entry["owner"]
            held, fresh = ([] if inside else None), entry["first"]
        for line in some:
            inside = after_line(line, inside, delimiter)
            if held is None and not inside:                # the common case: a line is a record
                out.append((now[0], line[:-1] if line.endswith("\r") else line, fresh, None, now[1]))
                fresh = False
                continue
            held = [] if held is None else held
            held.append(line)
            if not inside:
                if line.endswith("\r"):
                    held[-1] = line[:-1]
                out.append((now[0], "\n".join(held), fresh and owner is None, owner, now[1]))
                fresh, held, owner = False, None, None
        yield from rows()
    if now is not None:
        close()
        yield from rows()


def records(spark: SparkSession, paths, delimiter: str, states: list) -> DataFrame:
    """(line, file, head) of every record; ``head``: the first of its file. ``states``: the collected entries, one row of
    some fifty bytes a split, as many as the driver plans tasks."""
    first: dict[str, int] = {}
    for r in states:
        first[r["file"]] = min(r["start"], first.get(r["file"], r["start"]))
    known = {(r["file"], r["start"]): {"inside": r["inside"], "owner": r["owner"], "first": first[r["file"]] == r["start"]}
             for r in states}
    cut = lines(spark, paths).mapInArrow(functools.partial(_records, known, delimiter), PIECES)
    whole = cut.filter("owner is null").select("line", "file", "head")
    pieces = cut.filter("owner is not null").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "line"))).alias("p"), F.max("head").alias("head"))
    joined = pieces.select(F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("line"), "file", "head")
    return whole.unionByName(joined).filter((F.col("line") != "") | F.col("head"))
