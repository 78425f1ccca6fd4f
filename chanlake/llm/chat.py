"""Operator 6: chat formatting in budgeted windows.

Turns of a conversation are put in order and counted in tokens of the vocabulary, as formatted. Of the budget,
``history`` tokens and an eighth (for the system turn) are set aside; ``room`` is left for a window's own turns. Prefix
sums choose turn-aligned spans: a turn of at most half the room belongs to the half room in which it starts, so a
span never holds more than the room; a longer turn is a span of its own. Every span becomes a window: the system
turn first, then the end of the span before (at most ``history`` tokens), then the span's own turns. Assistant
texts of own turns are under the loss mask, those of repeated turns are not, so every target is learnt once. A long
turn that leaves no room goes without history, then without the system turn; one above the whole budget is kept whole
in a window of its own and flagged ``over``: no other window exceeds the budget.

Template: ``[INST]role\\ntext[/INST]`` for a turn, ``<s>text</s>`` for an assistant turn, nothing between. A control
string inside a text gets a backslash after its first character (one more if it has some already), which is undone
exactly when reading back.

Prefix sums take two passes over a range partitioning by conversation and turn, so one long conversation spreads
over many tasks; a partition edge cuts at most one conversation, so the carried sums are one row
per partition. Reading back streams the windows of a conversation in
order (its digests are sequential by definition) without holding them.

Defined results: NULL text is empty; a NULL role is the empty role; a NULL conversation id is one conversation; turns
with equal numbers are ordered by role, then text; repeated rows are repeated turns; a system turn above an eighth of
the budget is not repeated; an empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm import packing
from chanlake.llm import pieces as P
from chanlake.llm.common import stored

BUDGET, HISTORY, OVERHEAD = 1024, 256, 4
CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
TURN = re.compile(r"\[INST\](.*?)\n(.*?)\[/INST\]|<s>(.*?)</s>", re.S)
ORDER = ["conv_id", "turn", "role", "text"]


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def role_line(role: str) -> str:
    """A role as one line without control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its (escaped) text starts and ends in it."""
    body = escape(text)
    head = "<s>" if role == "assistant" else f"[INST]{role_line(role)}\n"
    return head + body + ("</s>" if role == "assistant" else "[/INST]"), len(head), len(head) + len(body)


# Fixed value: the split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = re.compile(r"\w+|[^\w\s]", re.ASCII)


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken
    ranks = packing.merger(path)._mergeable_ranks
    return tiktoken.Encoding("chat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def _special(path: str):
    return re.compile("|".join(map(re.escape, P.specials_of(path))) or r"(?!)")


def count_tokens(formatted: str, path: str | None) -> int:
    """Tokens of formatted text: by the byte-level vocabulary at ``path`` (texts with its special strings or with code
    points unknown here go through the library), else words and marks."""
    if path is None:
        return len(WORDS.findall(formatted))
    if _special(path).search(formatted) or not formatted.isascii() and any(
            unicodedata.category(c) in ("Cn", "Co") for c in formatted):
        return len(P.library(path).encode(formatted, add_special_tokens=False).ids)
    return len(_encoder(path).encode_ordinary(formatted))


def turn_tokens(role: str, text: str, path: str | None) -> int:
    """Tokens of a turn in a window; one more than it has by itself, for what its neighbour may change at the edge."""
    if path is None:
        return len(WORDS.findall(text)) + OVERHEAD
    return count_tokens(render(role, text)[0], path) + 1


RUN = ("part int, conv_id long, turn long, role string, text string, tokens long, before long, large long, idx long")


def _run(half: int, path: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each turn; within the conversation and this partition, the tokens of shorter turns, the number of longer
    ones (above ``half``) and of all turns before it."""
    part, conv, total, large, idx, begun = TaskContext.get().partitionId(), None, 0, 0, 0, False
    for b in batches:
        sizes, before, longer, index = [], [], [], []
        for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
            if not begun or c != conv:
                conv, total, large, idx, begun = c, 0, 0, 0, True
            n = turn_tokens(role, text, path)
            sizes.append(n)
            before.append(total)
            longer.append(large)
            index.append(idx)
            total, large, idx = total + (n if n <= half else 0), large + (n > half), idx + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * b.num_rows, pa.int32()), *(b.column(c) for c in ORDER),
             *(pa.array(x, pa.int64()) for x in (sizes, before, longer, index))],
            ["part", *ORDER, "tokens", "before", "large", "idx"])


def ordered(turns: DataFrame, half: int, path: str | None, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with ``tokens``, ``before`` (tokens of turns up to ``half`` before it in its conversation), ``large`` (turns
    above that before it) and ``idx`` (its place from 0)."""
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER)
    runs = stored(rows.mapInArrow(functools.partial(_run, half, path), RUN), "turns")
    totals = runs.groupBy("conv_id", "part").agg(F.sum(F.when(F.col("tokens") <= half, F.col("tokens")).otherwise(0)).alias("t"),
                                                 F.count_if(F.col("tokens") > half).alias("l"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.sum("t").over(w).alias("tb"),
                            F.sum("l").over(w).alias("lb"), F.sum("n").over(w).alias("nb")).filter("nb > 0")
    # a partition edge cuts at most one conversation: at most one row per partition, so it may be broadcast
    both = runs.join(F.broadcast(carried), (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("part") == F.col("p")),
                     "left")
    more = lambda c, by: (F.col(c) + F.coalesce(by, F.lit(0))).alias(c)
    return both.select(*ORDER, "tokens", more("before", "tb"), more("large", "lb"), more("idx", "nb"))


FORMATTED = ("conv_id long, window long, text string, repeated int, tokens long, over boolean, "
             "loss array<struct<start:int,end:int>>")


def _format(budget: int, path: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    loss_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        out = []
        for r in b.to_pylist():
            own, first = r["own"], [r["system"]] if r["system"] else []
            held = [x for x in r["history"] or [] if not (first and x["idx"] == first[0]["idx"])]
            again = first + held
            for less in (first, []):                        # a long turn goes without history, then without system
                if sum(t["tokens"] for t in again + own) > budget:
                    again = less
            parts, loss, at = [], [], 0
            for i, t in enumerate(again + own):
                text, s, e = render(t["role"], t["text"])
                if i >= len(again) and t["role"] == "assistant":
                    loss.append({"start": at + s, "end": at + e})
                parts.append(text)
                at += len(text)
            text = "".join(parts)
            tokens = sum(t["tokens"] for t in again + own) if path is None else count_tokens(text, path)
            out.append((r["conv_id"], r["window"], text, len(again), tokens, tokens > budget, loss))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), loss_type]
        cols = list(zip(*out)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["conv_id", "window", "text", "repeated", "tokens", "over", "loss"])


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_id: str = "conv_id",
            turn: str = "turn", role: str = "role", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Formatted windows (FORMATTED) of at most ``budget`` tokens of the vocabulary file ``tokenizer`` (None: words and
    marks): ``window`` is the place of its first own turn, ``repeated`` counts the leading turns that are not its own,
    ``loss`` has the character spans under the loss mask, ``over`` marks a single turn above the budget."""
    system = budget // 8
    half = max(1, (budget - history - system) // 2)
    rows = stored(ordered(turns, half, tokenizer, conv_id, turn, role, text), "ordered")
    item = F.struct("idx", "role", "text", "tokens")
    long_turn = F.col("tokens") > half
    spans = rows.groupBy("conv_id", "large", long_turn.alias("long"),
                         F.when(long_turn, F.lit(0)).otherwise(F.floor(F.col("before") / half)).alias("span")).agg(
        F.sort_array(F.collect_list(item)).alias("own"), F.min("idx").alias("window"), F.max("idx").alias("end"))
    spans = stored(spans, "spans")
    # the span behind this one begins with the next turn; its history is what fits of this one's end
    tail = F.aggregate(F.reverse("own"), F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("on")),
                       lambda a, x: F.struct((a["sum"] + x["tokens"]).alias("sum"),
                                             (a["n"] + (a["on"] & (a["sum"] + x["tokens"] <= history)).cast("int")).alias("n"),
                                             (a["on"] & (a["sum"] + x["tokens"] <= history)).alias("on")))
    tails = spans.withColumn("fit", tail["n"]).filter("fit > 0").select(
        F.col("conv_id").alias("c"), (F.col("end") + 1).alias("s"),
        F.slice("own", F.size("own") - F.col("fit") + 1, F.col("fit")).alias("history"))
    systems = rows.filter((F.col("idx") == 0) & (F.col("role") == "system") & (F.col("tokens") <= system)).select(
        F.col("conv_id").alias("k"), item.alias("system"))
    out = spans.join(tails, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("window") == F.col("s")), "left")
    out = out.join(systems, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("window") > 0), "left")
    return out.select("conv_id", "window", "own", "history", "system").mapInArrow(
        functools.partial(_format, budget, tokenizer), FORMATTED)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_windows long")


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    return [("assistant", unescape(m[3])) if m[3] is not None else (role_of(m[1]), unescape(m[2]))
            for m in TURN.finditer(text)]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGEST.split(", ")]
    kinds = [pa.string() if "sha" in n else pa.int64() for n in names]
    conv, begun, state = None, False, None

    def row():
        return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

    for b in batches:
        out = []
        for r in b.to_pylist():
            if not begun or r["conv_id"] != conv:
                if begun:
                    out.append(row())
                conv, begun, state = r["conv_id"], True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parse(r["text"])[r["repeated"]:]:
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in r["loss"]:
                target = unescape(r["text"][span["start"]:span["end"]])
                state[2] += len(target)
                state[3].update(target.encode("utf-8", "surrogatepass"))
            state[4] += len(r["text"])
            state[5] += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), kinds)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation (DIGEST), read from its windows in order."""
    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "window")
    return rows.select("conv_id", "window", "text", "repeated", "loss").mapInArrow(_digest, DIGEST)
