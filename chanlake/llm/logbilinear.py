"""Operator 11: language-model scoring with a log-bilinear neural model.

The model predicts a token from the ``span`` tokens before it: each position has a weight vector, the weighted input
vectors are summed, and the product with every output vector plus a bias gives logits over a bounded set of outputs:
the most frequent words (and the end of a text) one by one, all others as classes of equal endings. A word of a class
then has its add-one share of the class, with one more share for words never met, so the probabilities of all tokens
sum to one. Training is noise-contrastive (noise: the outputs' frequencies) in numpy; scoring is one matrix product
a block of tokens and an exact normalisation.

Jobs: (1) count the tokens of the training documents, all of them; (2) ``rounds`` passes, each over its share of the
training documents (every document is in one): every task trains on its own from the same start, the parameters
are averaged by token counts, block by block, so only one model (bounded: outputs, buckets and dimensions are
parameters) reaches the driver; (3) score every document. Counts of the ``head`` most frequent words travel to
the tasks (bounded); all other words of a document meet their counts in a join on the word, one slim row for each
distinct word and batch. Such words are no hot keys, and a long document only gives more slim rows, summed in part before
they move.

Defined results: NULL or empty text is one end token; a NULL id counts as the empty text (crc32 0: training); repeated
rows and ids are scored (and learnt) once per row; nothing to learn from: N and V are 0 and the scores come from the
untrained model; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.llm.common import stored
from chanlake.llm.pieces import list_parts

END = b""                  # the end of a text; no word is empty
SPAN, DIM, BUCKETS = 2, 16, 2048
SHORTLIST, ENDINGS = 128, 32
HEAD = 200_000             # words whose counts travel to every task
NOISE, STEP, BATCH = 16, 0.03, 1024
CHARS = 16_000_000         # bytes of text coded at a time (one text may hold more)
FLUSH = 200_000            # distinct words a task holds before it passes them on


@dataclass
class Model:
    """Words with an output of their own, sizes of the ending classes, and the parameters."""

    words: dict[bytes, int]
    class_tokens: np.ndarray          # training tokens and distinct words of each class
    class_words: np.ndarray
    noise: np.ndarray                 # share of each output among the training tokens
    inputs: np.ndarray                # a row for the start of a text, one for each word, one for each bucket
    weights: np.ndarray               # span x dim
    outputs: np.ndarray
    bias: np.ndarray


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Tokens of the texts in a row, as numbers of distinct words, where each text ends, and these words. A-Z in
    lower case; a token is a run of anything but the six ASCII white-space characters; a text ends with END."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets, values = list_parts(lists)
    coded = values.dictionary_encode()
    index, distinct = np.asarray(coded.indices, np.int64), coded.dictionary.cast(pa.binary()).to_pylist()
    end = distinct.index(END) if END in distinct else len(distinct)    # also what leading white space leaves
    if end == len(distinct):
        distinct.append(END)
    kept = index != end
    before = np.concatenate([[0], np.cumsum(kept)])[offsets[1:]]
    return np.insert(index[kept], before, end), before + np.arange(1, len(before) + 1), distinct


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows again, about CHARS bytes of text (the column ``text``) at a time: a distinct word is then looked up
    once for many tokens."""
    held, size = [], 0
    for b in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), np.int64))
        a = 0
        while a < b.num_rows:
            e = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + CHARS - size, side="right")))
            e = min(e, b.num_rows)
            held.append(b.slice(a, e - a))
            size += int(sizes[e - 1] - (sizes[a - 1] if a else 0))
            a = e
            if size >= CHARS or a < b.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def texts_of(table: pa.Table) -> pa.Array:
    column = table.column("text")
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def bucket(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


# --- counts ----------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()),
                                           pa.array(list(found.values()), pa.int64())], ["word", "c"])

    for table in runs(batches):
        index, _, distinct = split(texts_of(table))
        for w, c in zip(distinct, np.bincount(index, minlength=len(distinct)).tolist()):
            found[w] += c
        if len(found) > FLUSH:
            yield rows()
            found.clear()
    if found:
        yield rows()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over whole texts, the end included; tasks add up before the shuffle."""
    return texts.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> tuple[int, list[tuple[bytes, int]]]:
    """(least count, words) of the most frequent words, at most ``most``: eighths of powers of two are filled from
    above, so only those sums and these words reach the driver."""
    step = F.floor(F.log2("c") * 8)
    filled, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(),
                    key=lambda r: -r["s"]):
        filled += r["n"]
        if filled > most:
            break
        least = r["c"]
    if least is None:                          # no word, or too many with the highest counts
        return 1 << 62, []
    return least, [(bytes(r["word"]), r["c"]) for r in counts.filter(F.col("c") >= least).collect()]


def start(counts: DataFrame, shortlist: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """The untrained model: ENDINGS rows of class sizes reach the driver."""
    words = {w: i for i, (w, _) in enumerate(shortlist)}
    tail = F.substring("word", F.greatest(F.length("word") - 1, F.lit(1)), F.lit(2))      # as ending() has it
    tokens, distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in counts.groupBy((F.crc32(tail) % ENDINGS).alias("k")).agg(
            F.sum("c").alias("t"), F.count(F.lit(1)).alias("w")).collect():
        tokens[r["k"]], distinct[r["k"]] = r["t"], r["w"]
    for w, c in shortlist:
        if c:
            tokens[ending(w)] -= c
            distinct[ending(w)] -= 1
    n = np.concatenate([[float(c) for _, c in shortlist], tokens])
    noise = (n + 1) / (n + 1).sum()
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return Model(words, tokens, distinct, noise, small(1 + len(words) + BUCKETS, DIM),
                 np.full((SPAN, DIM), 0.5, np.float32), small(len(noise), DIM), np.log(noise).astype(np.float32))


PARTS = ("inputs", "weights", "outputs", "bias")


# --- the model in numpy ------------------------------------------------------------

@dataclass
class Coded:
    """Tokens of several texts in a row: output numbers, input numbers of the tokens before, distinct words."""

    out: np.ndarray
    context: list[np.ndarray]         # a row for each distance, the nearest first
    ends: np.ndarray                  # after the last token of each text
    index: np.ndarray                 # of each token among the distinct words
    distinct: list[bytes]


def code(model: Model, texts: pa.Array) -> Coded:
    index, ends, distinct = split(texts)
    words, s = model.words, len(model.words)
    out = np.fromiter((words[w] if w in words else s + ending(w) for w in distinct), np.uint8, len(distinct))[index]
    inp = np.fromiter((1 + words[w] if w in words else 1 + s + bucket(w) for w in distinct), np.uint16,
                      len(distinct))[index]
    starts = np.concatenate([[0], ends[:-1]])
    context = []
    for i in range(SPAN):
        seen = np.zeros(len(index), np.uint16)
        seen[i + 1:] = inp[:max(0, len(inp) - i - 1)]
        for k in range(i + 1):                                  # the start of a text is the zeroth input
            near = starts + k
            seen[near[near < ends]] = 0
        context.append(seen)
    return Coded(out, context, ends, index, distinct)


def log_probs(model: Model, coded: Coded, block: int = 1024) -> np.ndarray:
    """Natural log of the probability of each token's output, normalised over all outputs."""
    got = np.empty(len(coded.out))
    tables = [np.ascontiguousarray(model.inputs * w) for w in model.weights]
    outputs, ones = np.ascontiguousarray(model.outputs.T), np.ones(len(model.bias), np.float32)
    longest = float(np.sqrt((model.outputs ** 2).sum(axis=1).max()))
    for a in range(0, len(got), block):
        own = coded.out[a:a + block]
        p = tables[0].take(coded.context[0][a:a + block], axis=0)
        for table, seen in zip(tables[1:], coded.context[1:]):
            p += table.take(seen[a:a + block], axis=0)
        logits = p @ outputs
        logits += model.bias
        top = 0.0
        if longest * float(np.sqrt((p ** 2).sum(axis=1).max())) + float(np.abs(model.bias).max()) > 60:
            top = logits.max(axis=1)                            # else no power of e overflows
            logits -= top[:, None]
        mine = logits[np.arange(len(own)), own].astype(np.float64)
        got[a:a + block] = mine - np.log((np.exp(logits, out=logits) @ ones).astype(np.float64))
    return got


def class_shares(model: Model) -> np.ndarray:
    """Natural log of one share in each output: a word of a class has (its count + 1) shares of it."""
    return np.concatenate([np.zeros(len(model.words)), -np.log(model.class_tokens + model.class_words + 1)])


def summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the rows of each."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order].astype(np.int64)
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return ordered[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)


class Trainer:
    """Noise-contrastive steps with Adagrad on a copy of the parameters."""

    def __init__(self, model: Model, seed: int):
        self.model = replace(model, inputs=model.inputs.copy(), weights=model.weights.copy(),
                             outputs=model.outputs.copy(), bias=model.bias.copy())
        self.rng = np.random.default_rng(seed)
        self.shift = np.log(NOISE * model.noise).astype(np.float32)
        self.cumulated = np.cumsum(model.noise)
        self.seen = {k: np.full(getattr(self.model, k).shape, 1e-2, np.float32) for k in PARTS}

    def _move(self, name: str, grad: np.ndarray):
        seen = self.seen[name]
        seen += grad * grad
        getattr(self.model, name).__iadd__(STEP * grad / np.sqrt(seen))

    def step(self, context: list[np.ndarray], out: np.ndarray):
        m = self.model
        drawn = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(m.noise) - 1)
        looked = [m.inputs.take(seen, axis=0) for seen in context]
        p = sum(x * w for x, w in zip(looked, m.weights))
        own, others = m.outputs.take(out, axis=0), m.outputs[drawn]
        true = np.einsum("td,td->t", p, own) + (m.bias - self.shift)[out]
        false = p @ others.T + (m.bias - self.shift)[drawn]
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))                  # gradients of the two log likelihoods
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        to_p = up[:, None] * own + down @ others
        outputs, bias = np.zeros_like(m.outputs), np.bincount(out, up, len(m.noise)).astype(np.float32)
        keys, sums = summed(out, up[:, None] * p)
        outputs[keys] = sums
        np.add.at(outputs, drawn, down.T @ p)
        np.add.at(bias, drawn, down.sum(axis=0))
        inputs = np.zeros_like(m.inputs)
        weights = np.empty_like(m.weights)
        for i, seen in enumerate(context):
            keys, sums = summed(seen, to_p)
            inputs[keys] += sums * m.weights[i]
            weights[i] = np.einsum("td,td->d", to_p, looked[i])
        for name, grad in (("inputs", inputs), ("weights", weights), ("outputs", outputs), ("bias", bias)):
            self._move(name, grad)

    def learn(self, coded: Coded) -> int:
        """One pass; a step takes tokens from all over the texts."""
        steps = -(-len(coded.out) // BATCH)
        for a in self.rng.permutation(steps):
            self.step([np.ascontiguousarray(seen[a::steps]) for seen in coded.context], coded.out[a::steps])
        return len(coded.out)


PIECE = 8192               # floats in a block of parameters


def flat_parameters(model: Model) -> np.ndarray:
    return np.concatenate([getattr(model, k).reshape(-1) for k in PARTS])


def with_parameters(model: Model, flat: np.ndarray) -> Model:
    found, at = {}, 0
    for k in PARTS:
        shape = getattr(model, k).shape
        n = int(np.prod(shape))
        found[k] = flat[at:at + n].reshape(shape).astype(np.float32)
        at += n
    return replace(model, **found)


# --- training on Spark ---------------------------------------------------------------

def _train(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trainer, n = Trainer(model, TaskContext.get().partitionId()), 0
    for table in runs(batches):
        n += trainer.learn(code(model, texts_of(table)))
    if n:
        flat = flat_parameters(trainer.model).astype("<f4")
        for at in range(0, len(flat), PIECE):
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([n]), pa.array([flat[at:at + PIECE].tobytes()])],
                                             ["at", "n", "piece"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of each block by tokens; one sum a block is held, whatever the number of tasks."""
    sums: dict[int, list] = {}
    for b in batches:
        for at, n, cell in zip(b.column("at").to_pylist(), b.column("n").to_pylist(), b.column("piece")):
            values = np.frombuffer(cell.as_py(), "<f4").astype(np.float64)
            one = sums.setdefault(at, [0, np.zeros(len(values))])
            one[0] += n
            one[1] += n * values
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([(s / n).astype("<f4").tobytes() for n, s in sums.values()])],
            ["at", "piece"])


def train(texts: DataFrame, model: Model, rounds: int) -> Model:
    """Local training and averaging; ``texts`` has the text and ``round_key``, a hash that deals documents to rounds."""
    spark = texts.sparkSession
    for r in range(rounds):
        share = texts.filter(F.pmod("round_key", F.lit(rounds)) == r).select("text")
        moved = share.mapInArrow(functools.partial(_train, model), "at long, n long, piece binary")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        means = moved.repartition(n, "at").mapInArrow(_average, "at long, piece binary")
        rows = sorted(means.collect(), key=lambda x: x["at"])       # one model
        if rows:
            model = with_parameters(model, np.concatenate([np.frombuffer(x["piece"], "<f4") for x in rows]))
    return model


# --- scoring -----------------------------------------------------------------------

SCORED = ("row string, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
          "word binary, n long")


def _score(model: Model, head: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document and, for words whose counts are not here, a row for each document and word."""
    part, number, shares = TaskContext.get().partitionId(), 0, class_shares(model)
    shown, fields = len(model.words), [f.split()[0] for f in SCORED.split(", ")]
    for table in runs(batches):
        some = table.to_batches()[0]
        coded = code(model, texts_of(table))
        known = np.fromiter((head.get(w, -1) for w in coded.distinct), np.int64, len(coded.distinct))
        own = np.log(np.maximum(known, 0) + 1.0)                      # zero where the join will add it
        starts = np.concatenate([[0], coded.ends[:-1]])
        score = log_probs(model, coded) + shares[coded.out]
        base = own[coded.index]
        score += np.where(coded.out < shown, 0, base)
        sums = [np.add.reduceat(x, starts) for x in (score, base, (known > 0).astype(np.int64)[coded.index])]
        rows = [f"{part}-{number + i}" for i in range(len(some))]
        number += len(some)
        lens = coded.ends - starts
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), some.column("doc_id"), some.column("held_out"), pa.array(lens), pa.array(sums[2]),
             pa.array(sums[1]), pa.array(sums[0]), pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.int64())],
            fields)
        where = np.flatnonzero((known < 0)[coded.index])
        doc = np.searchsorted(coded.ends, where, side="right")
        pair, times = np.unique(doc * len(coded.distinct) + coded.index[where], return_counts=True)
        names = pa.array(coded.distinct, pa.binary())
        for a in range(0, len(pair), 50_000):
            doc, word = np.divmod(pair[a:a + 50_000], len(coded.distinct))
            none = [pa.nulls(len(doc), t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
                                                    pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(rows).take(pa.array(doc)), *none, names.take(pa.array(word)),
                                              pa.array(times[a:a + 50_000])], fields)


def score(docs: DataFrame, train_fold: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = 4) -> DataFrame:
    """Learn from the documents where ``train_fold`` holds, score all: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (add-one unigram), score (the model), both log10."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       (~train_fold).alias("held_out"), F.xxhash64(F.col(doc_id), F.col(text)).alias("round_key"))
    learnt = rows.filter(~F.col("held_out"))
    counts = stored(count_words(learnt.select("text")), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    least, top = frequent(counts, HEAD)
    ends = counts.filter(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    shortlist = [(END, ends), *sorted((x for x in top if x[0] != END), key=lambda x: (-x[1], x[0]))[:SHORTLIST - 1]]
    model = train(learnt.select("text", "round_key"), start(counts, shortlist), rounds)
    head = dict(top) | {END: ends}
    found = stored(rows.select("doc_id", "text", "held_out").mapInArrow(functools.partial(_score, model, head), SCORED),
                   "scored")
    rest = counts.filter(F.col("c") < least)                   # the others are in head
    tail = found.filter("word is not null").select("row", "word", "n").join(rest, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = tail.groupBy("row").agg(F.sum(F.col("n") * F.log(c + 1.0)).alias("more"),
                                   F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"))
    ln10 = F.lit(float(np.log(10)))
    whole = found.filter("word is null").join(sums, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    size = F.lit(float(np.log(total["n"] + total["v"] + 1)))
    return whole.select("doc_id", "held_out", "n_tokens",
                        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                        F.lit(total["n"]).cast("long").alias("train_tokens"),
                        ((F.col("base") + more - F.col("n_tokens") * size) / ln10).alias("base_score"),
                        ((F.col("score") + more) / ln10).alias("score"))
