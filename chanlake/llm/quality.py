"""Operator 4: quality rules with cross-document line frequency (DataFrame functions only).

Per document, in one row: word, symbol, duplicate-line and repeated-window counts. Across
documents: lines are normalised (lower case, digit runs to 0, white space to one
space, trimmed) and hashed; per host the number of *distinct* documents (texts) that hold a
line is counted, so exact copies of one document count once and are left to
deduplication. A line held by more than ``max(min_docs, share * documents of the host)``
is boilerplate: it is removed, and a document of which less than ``min_left_pct`` percent of its words is
left is rejected (depleted); short clean documents that carry one such line stay.

Frequent lines are few by construction (each takes more than ``share`` of its host's
documents, so a host has at most 1/share times its mean lines per document); they are stored
as one array per host, and the planner joins them by their stored size: broadcast when
small, else a sort-merge join with skew splitting. Texts are not exploded for the second pass.

Defined results: NULL or empty text has no words and fails the base rules; a NULL host is a
host of its own; repeated rows are judged row by row (and count once as a document); an
empty table gives no rows; other columns are ignored unless kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.llm.common import SPACE, WORD, stored, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
MIN_DOCS, SHARE_PCT, MIN_LEFT_PCT = 20, 10, 30


def normalised(text: Column) -> Column:
    """Text with every line normalised; line breaks stay, so lines keep their numbers."""
    folded = F.regexp_replace(F.lower(text), r"[0-9]+", "0")
    return F.regexp_replace(folded, r"[\x20\x09\x0B-\x0D]+", " ")


def line_hashes(text: Column) -> Column:
    """Hash of each normalised line, in line order; NULL for blank lines."""
    def one(line):
        line = F.trim(line)
        return F.when(line != "", F.xxhash64(line))
    return F.transform(F.split(normalised(text), "\n"), one)


def frequent_lines(docs: DataFrame, host: str, text: str, min_docs: int, share_pct: int) -> DataFrame:
    """Rows (host, lines): the hashes of each host's frequent lines. Stored: small, and of known size."""
    slim = docs.select(F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slim = slim.select("host", F.xxhash64("text", F.length("text")).alias("doc"),
                       F.array_distinct(F.array_compact(line_hashes(F.col("text")))).alias("lines"))
    once = slim.groupBy("host", "doc").agg(F.first("lines").alias("lines"))
    # a NULL element per document counts the documents of the host in the same pass
    held = once.select("host", F.explode(F.array_append("lines", F.lit(None).cast("long"))).alias("line"))
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    counts = stored(counts.filter(F.col("line").isNull() | (F.col("docs") > min_docs)), "line-counts")
    hosts = counts.filter(F.col("line").isNull()).select(F.col("host").alias("h"), F.col("docs").alias("all_docs"))
    over = counts.filter(F.col("line").isNotNull()).join(hosts, F.col("host").eqNullSafe(F.col("h")))
    over = over.filter(F.col("docs") * 100 > F.col("all_docs") * share_pct)
    return stored(over.groupBy("host").agg(F.collect_list("line").alias("lines")), "frequent-lines")


def repeated_words(wins: Column, order: Column) -> Column:
    """Words covered by windows whose hash is found twice: ``wins`` the window hashes by position, ``order``
    the same as sorted (hash, position) structs, NULL where all are distinct."""
    def again(x, j):
        return (((j > 0) & (F.get(order, j - 1)["h"] == x["h"]))
                | ((j < F.size(order) - 1) & (F.get(order, j + 1)["h"] == x["h"])))
    at = F.sort_array(F.transform(F.filter(order, again), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, start, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return F.when(order.isNull(), F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame, doc_id: str, host: str, text: str, keep: list[str]) -> DataFrame:
    """The per-document counts, plus host, line hashes and words per line for the verdict."""
    t = F.col("_text")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(host).alias("_host"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)])
    kept = [f"_keep_{i}" for i in range(len(keep))]
    with_word = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))
    rows = rows.select("_id", "_host", "_text", *kept, words(t).alias("_words"), with_word.alias("_lines"),
                       line_hashes(t).alias("_hashes"))
    n = F.size("_words")
    rows = rows.select(
        "_id", "_host", "_text", *kept, "_hashes", n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_w"))
    wins = F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW),
                       lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("_wins", F.when(F.size("_w") >= WINDOW, wins).otherwise(F.array().cast("array<long>")))
    pairs = F.sort_array(F.transform("_wins", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_order", F.when(F.size(F.array_distinct("_wins")) < F.size("_wins"), pairs))
    rows = rows.withColumn("n_repeat_words", repeated_words(F.col("_wins"), F.col("_order"))).drop(
        "_w", "_wins", "_order")
    return rows.withColumn("row", F.monotonically_increasing_id())


def judge(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
          keep: list[str] | None = None, min_docs: int = MIN_DOCS, share_pct: int = SHARE_PCT,
          min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
          min_left_pct: int = MIN_LEFT_PCT) -> DataFrame:
    """One row per document: the counts, words_left, base_failed, kept, and ``clean_text`` without its
    frequent lines (plus the ``keep`` columns). Filter with ``kept_rows``."""
    keep = [c for c in (keep or []) if c not in (doc_id, host, text)]
    frequent = frequent_lines(docs, host, text, min_docs, share_pct)
    rows = measure(docs, doc_id, host, text, keep)
    rows = rows.join(frequent.select(F.col("host").alias("_h"), F.col("lines").alias("_frequent")),
                     F.col("_host").eqNullSafe(F.col("_h")), "left")

    def out(i):
        return F.coalesce(F.array_contains("_frequent", F.get("_hashes", i)), F.lit(False))
    hit = F.coalesce(F.arrays_overlap("_hashes", "_frequent"), F.lit(False))
    left = F.when(hit, F.array_join(F.filter(F.split("_text", "\n"), lambda _, i: ~out(i)), "\n")).otherwise(
        F.col("_text"))
    rows = rows.withColumn("clean_text", left)
    words_left = F.when(hit, F.size(words(F.col("clean_text"))).cast("long")).otherwise(F.col("n_words"))
    rows = rows.withColumn("words_left", words_left)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    depleted = F.col("words_left") * 100 < F.col("n_words") * min_left_pct
    return rows.select(
        F.col("_id").alias(doc_id), F.col("_host").alias(host),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "clean_text", "row")


def kept_rows(judged: DataFrame) -> DataFrame:
    """The kept documents. The row number in the condition keeps the optimizer from moving the filter below the
    counts, where it would work them out inside their own lambda expressions again."""
    return judged.filter(F.col("kept") & (F.col("row") >= 0))


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS u, doc_id, source, coalesce(text, '') AS text FROM documents),
toks AS (SELECT u, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda w: w <> '') AS w FROM docs),
wins AS (SELECT u, i, w[i:i + {WINDOW - 1}] AS win FROM toks, unnest(range(1, len(w) - {WINDOW - 2})) AS t(i)),
dups AS (SELECT u, i, lag(i) OVER (PARTITION BY u ORDER BY i) AS p FROM
         (SELECT u, i, count(*) OVER (PARTITION BY u, win) AS n FROM wins) WHERE n > 1),
rep AS (SELECT u, sum(least({WINDOW}, i - coalesce(p, -100))) AS n FROM dups GROUP BY u),
lines AS (SELECT u, j, string_split(text, chr(10))[j] AS line
          FROM docs, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(j)),
dupl AS (SELECT u, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY u),
norm AS (SELECT u, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
                '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line FROM lines),
texts AS (SELECT source, text, min(u) AS u FROM docs GROUP BY source, text),
host_docs AS (SELECT source, count(*) AS n FROM texts GROUP BY source),
freq AS (SELECT t.source, line FROM norm JOIN texts t USING (u) JOIN host_docs h ON h.source IS NOT DISTINCT FROM t.source
         WHERE line <> '' GROUP BY t.source, line, h.n
         HAVING count(DISTINCT u) > {MIN_DOCS} AND count(DISTINCT u) * 100 > h.n * {SHARE_PCT}),
gone AS (SELECT n.u, sum(len(string_split(n.line, ' '))) AS n FROM norm n JOIN docs d USING (u)
         JOIN freq f ON f.source IS NOT DISTINCT FROM d.source AND f.line = n.line GROUP BY n.u),
base AS (SELECT d.u, d.doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols,
         coalesce(dupl.n, 0) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(w) - coalesce(gone.n, 0) AS BIGINT) AS words_left
         FROM docs d JOIN toks USING (u) LEFT JOIN rep USING (u) LEFT JOIN dupl USING (u) LEFT JOIN gone USING (u)),
judged AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed
           FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_left, base_failed,
       NOT base_failed AND words_left * 100 >= n_words * {MIN_LEFT_PCT} AS kept
FROM judged
"""
