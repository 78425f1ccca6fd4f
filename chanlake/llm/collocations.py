"""Operator 12: phrase collocation mining by sorting suffix pointers.

Texts (A-Z in lower case) fall into pieces and these into words; a suffix is what follows a position of a piece, at
most ``longest`` words. Suffixes are routed by language and leading words, so all with the same two leading words meet
in one task (but see below). There a multikey three-way quicksort orders the pointers word by word, to that depth: the
size of each partition of equal words is the count of the phrase they spell, and partitions below ``least`` are
abandoned with everything in them.

What keeps the shuffle small and whole: (1) single words are counted first; a suffix ends before a word below
``least``, since no phrase with it can reach ``least``. Tasks learn these words from a bitmap of BITS hashed positions
(2 MB at any size; a false hit only lets a suffix run on). (2) Equal suffixes are added up before they move, and move
packed, a row for each route. (3) A pair of leading words that holds more than 1/HOT of all words is hot (at most HOT
pairs, found by counting the pairs of the at most HOT words that are that frequent themselves): its suffixes are
dealt by all their words, no partition of it is abandoned, and the partial sizes are added up afterwards. So every
count is exact.

A candidate (2 to ``longest`` words, at least ``least`` occurrences) is cut after each of its words; both parts occur
at least as often, so their counts are in the same table. The lowest-scoring cut counts. A candidate goes if a longer
one holds it and occurs at least ``share`` percent as often; it is enough to look at longer ones by one word, since
phrases in between occur at least as often as the longer.

Defined results: NULL text is empty; a NULL language is ``und`` (and counts with texts of that language); repeated rows
count each time; ties are broken as stated in ``rank``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm.common import stored
from chanlake.session import estimated_bytes

LEAST, LONGEST, SHARE = 100, 5, 100
BITS = 1 << 24
HOT = 4096
CHARS = 16_000_000         # bytes of text taken at a time (one text may hold more)
FLUSH = 400_000            # distinct words a task holds before it passes them on
ROUTE_BYTES = 16 << 20     # of the scanned files, for each route
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1                                   # between words
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2               # between pieces


# --- words and pieces ------------------------------------------------------------------

def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of the texts in a row as numbers of distinct words, the number of the piece each lies in, and the distinct
    words; A-Z in lower case."""
    texts = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    edges = np.unique(offsets[1:-1] - offsets[0])
    edges = edges[(edges > 0) & (edges < len(buf))]      # where a text begins behind another
    kind = KIND[buf]
    inside = kind == 0
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    cuts = (kind == 2).astype(np.uint8)
    cuts[edges] = 1
    piece = np.cumsum(cuts, dtype=np.int32)[starts]
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)])
    flat = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at.astype(np.int64)),
                                                                  pa.py_buffer(buf[inside])])
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices, np.int64), piece, coded.dictionary.to_pylist()


def by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, about CHARS bytes at a time."""
    def cut():
        table = pa.Table.from_batches(held).combine_chunks()
        for lang in pc.unique(table.column("lang")).to_pylist():
            own = table.filter(pc.equal(table.column("lang"), lang)).column("text").combine_chunks()
            yield lang, own.chunk(0) if isinstance(own, pa.ChunkedArray) else own

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
                yield from cut()
                held, size = [], 0
    if held:
        yield from cut()


COUNTED = "lang string, phrase binary, n long"


def _counted(lang: str, phrases: list[bytes], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()),
                                       pa.array(n, pa.int64())], ["lang", "phrase", "n"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = {}
    for lang, texts in by_lang(batches):
        ids, _, distinct = words_of(texts)
        own = found.setdefault(lang, Counter())
        for w, n in zip(distinct, np.bincount(ids, minlength=len(distinct)).tolist()):
            own[w] += n
        if sum(map(len, found.values())) > FLUSH:
            for k, c in found.items():
                yield _counted(k, list(c), list(c.values()))
            found.clear()
    for k, c in found.items():
        if c:
            yield _counted(k, list(c), list(c.values()))


def _pairs(hot: dict[str, frozenset], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours that are both frequent enough to make a hot pair."""
    for lang, texts in by_lang(batches):
        frequent = hot.get(lang)
        if not frequent:
            continue
        ids, piece, distinct = words_of(texts)
        often = np.fromiter((w in frequent for w in distinct), bool, len(distinct))[ids]
        at = np.flatnonzero(often[:-1] & often[1:] & (piece[:-1] == piece[1:])) if len(ids) else ids
        pair, n = np.unique(ids[at] * len(distinct) + ids[at + 1], return_counts=True)
        first, second = np.divmod(pair, max(1, len(distinct)))
        if len(pair):
            yield _counted(lang, [distinct[i] + b" " + distinct[j] for i, j in zip(first.tolist(), second.tolist())],
                           n.tolist())


def bit_of(lang: str, word: bytes) -> int:
    """The same position as ``F.xxhash64(lang, word)`` modulo BITS."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)) % BITS


def bitmap_of(frequent: DataFrame) -> bytes:
    """Bits of the frequent words, BITS / 8 bytes on the driver at most."""
    size = 32768
    # BITS is a power of two, so the modulus of the signed hash is that of the unsigned one
    at = F.pmod(F.xxhash64("lang", "phrase"), F.lit(BITS))
    rows = frequent.select(F.floor(at / size).alias("k"), (at % size).alias("bit")).groupBy("k").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = bytearray(BITS // 8)
    for r in rows:
        out[r["k"] * size // 8:(r["k"] + 1) * size // 8] = r["bits"]
    return bytes(out)


ROUTED = "route int, lang string, spread boolean, words binary, n int, suffixes binary, counts binary"


def mixed(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit number for each row of word hashes, the same in every task."""
    out = np.zeros(len(hashes), np.uint64)
    for column in hashes.T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def suffixes_of(ids: np.ndarray, piece: np.ndarray, often: np.ndarray, longest: int) -> np.ndarray:
    """Rows of word numbers from 1 (0: the suffix has ended) for each position with two words to come at least: a suffix
    ends with its piece, before a word that is not ``often``, or after ``longest`` words."""
    rows, going = np.zeros((len(ids), longest), np.int32), often[ids]
    for k in range(longest):
        if k:
            same = np.zeros(len(ids), bool)
            same[:-k or None] = (piece[k:] == piece[:-k]) & often[ids[k:]]
            going = going & same
        n = len(ids) - k
        rows[:n, k] = np.where(going[:n], ids[k:] + 1, 0)
    return rows[rows[:, 1] > 0] if longest > 1 else rows[:0]


def added_up(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (or nearly: equal ones always have equal keys) and how often each occurs."""
    order = np.argsort(keys, kind="stable")
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return order[first], np.diff(first, append=len(rows))


def narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, compressed."""
    most = int(values.max()) if values.size else 0
    return zstandard.compress(values.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if most < 1 << 8 * w)).tobytes(), 1)


def widened(cell: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(cell)
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def _suffixes(bits: bytes, hot: dict[str, frozenset], routes: int, longest: int,
              batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows for each route: the words its suffixes need, the suffixes as numbers of these, how often each
    occurs."""
    for lang, texts in by_lang(batches):
        ids, piece, distinct = words_of(texts)
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))
        at = (hashes % np.uint64(BITS)).astype(np.int64)
        often = (np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        if not len(ids):
            continue
        rows = suffixes_of(ids, piece, often, longest)
        numbered = np.concatenate([[np.uint64(0)], hashes])
        key = mixed(numbered[rows])
        first, n = added_up(rows, key)
        rows, key = rows[first], key[first]
        spread = np.zeros(len(rows), bool)
        if lang in hot:
            index = {w: i + 1 for i, w in enumerate(distinct)}
            pairs = [p.split(b" ") for p in hot[lang]]
            wide = [index[a] * (len(distinct) + 1) + index[b] for a, b in pairs if a in index and b in index]
            spread = np.isin(rows[:, 0].astype(np.int64) * (len(distinct) + 1) + rows[:, 1], wide)
        route = (np.where(spread, key, mixed(numbered[rows[:, :2]])) % np.uint64(routes)).astype(np.int64) * 2 + spread
        order = np.argsort(rows[:, 0].astype(np.int64) * (len(distinct) + 1) + rows[:, 1], kind="stable")
        order = order[np.argsort(route[order], kind="stable")]        # neighbours share words, which packs well
        cuts = np.flatnonzero(np.diff(route[order], prepend=-1))
        out = []
        for a, e in zip(cuts, [*cuts[1:], len(order)]):
            own = order[a:e]
            used, local = np.unique(rows[own], return_inverse=True)
            if used[0]:                                    # number 0 stays the end
                used, local = np.concatenate([[0], used]), local + 1
            words = zstandard.compress(b"\n".join([distinct[i - 1] for i in used[1:]]), 1)
            out.append((int(route[own[0]]) // 2, lang, bool(spread[own[0]]), words,
                        len(own), narrow(local.reshape(-1, longest).T), narrow(n[own])))
        if out:
            kinds = [pa.int32(), pa.string(), pa.bool_(), pa.binary(), pa.int32(), *[pa.binary()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             [f.split()[0] for f in ROUTED.split(", ")])


def quicksort(words: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of the rows of ``words`` (0: the suffix has ended) as pointers, word by word; yields
    (a row, depth, weight) for each partition of at least two equal words. Partitions that weigh less than ``least``
    are abandoned."""
    todo = [(np.arange(len(words)), 0)]
    while todo:
        rows, depth = todo.pop()
        keys, own = words[rows, depth], weights[rows]
        pivot = np.partition(keys[[0, len(keys) // 2, -1]], 1)[1]
        if (keys == pivot).all():
            equal = rows
        else:
            for side in (keys < pivot, keys > pivot):
                if side.any() and own[side].sum() >= least:
                    todo.append((rows[side], depth))
            equal, own = rows[keys == pivot], own[keys == pivot]
        total = int(own.sum())
        if pivot and total >= least:
            if depth:
                yield int(equal[0]), depth + 1, total
            if depth + 1 < words.shape[1]:
                todo.append((equal, depth + 1))


def _sort_route(least: int, longest: int, table: pa.Table) -> pa.Table:
    out: list[tuple[str, bytes, int]] = []
    groups: dict[tuple[str, bool], list[int]] = {}
    for i, k in enumerate(zip(table.column("lang").to_pylist(), table.column("spread").to_pylist())):
        groups.setdefault(k, []).append(i)
    for (lang, spread), at in groups.items():
        index: dict[bytes, int] = {}
        parts, weights = [], []
        for i in at:
            n = table.column("n")[i].as_py()
            words = zstandard.decompress(table.column("words")[i].as_py()).split(b"\n")
            numbers = np.fromiter((index.setdefault(w, len(index) + 1) for w in words), np.int32, len(words))
            parts.append(np.concatenate([[0], numbers]).astype(np.int32)[
                widened(table.column("suffixes")[i].as_py(), n * longest)].reshape(longest, n).T)
            weights.append(widened(table.column("counts")[i].as_py(), n))
        rows, weights, names = np.concatenate(parts), np.concatenate(weights), list(index)
        # of a pair that is dealt over all routes a route sees a part: nothing is abandoned
        for i, depth, total in quicksort(rows, weights, 1 if spread else least):
            out.append((lang, b" ".join([names[j - 1] for j in rows[i, :depth]]), total))
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({"lang": pa.array(cols[0], pa.string()), "phrase": pa.array(cols[1], pa.binary()),
                     "n": pa.array(cols[2], pa.int64())})


def _sets(rows) -> dict[str, frozenset]:
    out: dict[str, set] = {}
    for r in rows:
        out.setdefault(r["lang"], set()).add(bytes(r["phrase"]))
    return {k: frozenset(v) for k, v in out.items()}


def hot_pairs(texts: DataFrame, words: DataFrame, limit: int) -> dict[str, frozenset]:
    """Pairs of words that occur ``limit`` times or more, by language: only pairs of words that do so themselves are
    counted."""
    often = _sets(words.filter(F.col("f") >= limit).select("lang", "phrase").collect())
    pairs = texts.mapInArrow(functools.partial(_pairs, often), COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return _sets(pairs.filter(F.col("f") >= limit).select("lang", "phrase").collect())


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang: str = "lang",
                     text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(all phrases of 1 to ``longest`` words with at least ``least`` occurrences: lang, phrase, m words, f;
    word occurrences of each language: lang, n), both stored."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = texts.mapInArrow(_words, COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    words = stored(words, "words")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = words.filter(F.col("f") >= least)
    everything = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wide = hot_pairs(texts, words, max(least, -(-everything // HOT)))     # at most HOT words and HOT pairs reach it
    # as few as the bytes ask for: a packed row brings its own words
    least_routes = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2
    size = estimated_bytes(texts) or 0
    routes = max(1, least_routes, -(-size // ROUTE_BYTES) if size < 1 << 56 else 0)      # else: no estimate
    suffixes = texts.mapInArrow(
        functools.partial(_suffixes, bitmap_of(frequent), wide, routes, longest), ROUTED)

    def one_route(entries: pa.Table) -> pa.Table:
        return _sort_route(least, longest, entries)

    phrases = suffixes.groupBy("route").applyInArrow(one_route, COUNTED)
    phrases = phrases.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    whole = frequent.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(1).alias("m"), "f").unionByName(
        phrases.withColumn("phrase", F.col("phrase").cast("string")).select(
            "lang", "phrase", F.size(F.split("phrase", " ")).alias("m"), "f"))
    return stored(whole, "phrases"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest cut: lang, phrase, m, a, l, r, n, score."""
    known = phrases.select(F.col("lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = phrases.filter("m > 1").withColumn("w", F.split("phrase", " ")).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", "m", F.col("f").alias("a"), "k",
                       F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rest"))
    cuts = cuts.join(known.withColumnsRenamed({"part": "first", "part_f": "l"}), ["lang", "first"])
    cuts = cuts.join(known.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"])
    # one row for each language: a list as long as the corpus has languages
    cuts = cuts.join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products are exact to 38 digits
    cuts = cuts.withColumn("top", F.lit(1000).cast("decimal(19,0)") * big("a") * big("n")).withColumn(
        "under", big("l") * big("r"))
    cuts = cuts.withColumn("score", F.expr("cast(top div under as bigint)"))
    return cuts.groupBy("lang", "phrase", "m", "a", "n").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")).select(
            "lang", "phrase", "m", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that no longer candidate (dropped or not) contains and matches in ``share`` percent of its count."""
    w = F.split("phrase", " ")
    longer = candidates.filter("m > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(w, F.lit(1), F.col("m") - 1), " "),
        F.array_join(F.slice(w, F.lit(2), F.col("m") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer_a"))
    both = candidates.join(longer, ["lang", "phrase"], "left")
    return both.filter(F.col("longer_a").isNull() | (100 * F.col("longer_a") < share * F.col("a"))).drop("longer_a")


def rank(candidates: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language by score, then count (both descending), then phrase in byte order."""
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, most: int = 2000,
         lang: str = "lang", text: str = "text") -> DataFrame:
    """Ranked collocations of each language."""
    phrases, totals = frequent_phrases(docs, least, longest, lang, text)
    return rank(maximal(stored(scored(phrases, totals), "candidates"), share), most)


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m FROM (
    SELECT lang, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i
    FROM cut, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, m, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
scores AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, t.n,
         CAST((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN total t ON t.lang = c.lang),
best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM best q WHERE q.lang = b.lang AND q.m > b.m AND 100 * q.a >= 100 * b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
         score FROM kept) WHERE rank <= 2000
"""
