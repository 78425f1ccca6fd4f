"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chanlake.llm import collocations, logbilinear, trie

ODD = [None, "", " \n\t ", "One two ONE", "a\x0bb\x0cc", "Ä ä é É", "x" * 3000, "1,2.3", "b a", "\x1c\x1d \u0085", "end. "]


# --- operator 11 -----------------------------------------------------------------------

def _texts(rng, n):
    """Prose in which the word before tells much about a word."""
    follows = {w: [rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(2)] for w in
               [a + b for a in "abcdefghij" for b in "xyz"]}
    out = []
    for _ in range(n):
        w, words = rng.choice(list(follows)), []
        for _ in range(rng.randrange(5, 60)):
            words.append(w if rng.random() < 0.9 else w.upper())
            w = rng.choice(follows[w]) if rng.random() < 0.95 else rng.choice(list(follows))
        out.append(" ".join(words))
    return out


def _score(docs, **kw):
    return logbilinear.score(docs, ~logbilinear.held_out(F.col("doc_id")), **kw)


def test_counts_and_base_are_exact(spark, make_docs):
    rng = random.Random(1)
    texts = ODD + _texts(rng, 60) + [f"only{i} here" for i in range(20)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "no id", "s"), (3, texts[3], "s"), (3, "other", "s")]
    got = _score(make_docs(rows), rounds=2).collect()
    split = [(i, [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b""]) for i, t, _ in rows]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, ws in split if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out(i), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in split)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_words_outside_the_head_join(spark, make_docs, monkeypatch):
    """With room for few words, most counts come from the join; nothing changes."""
    rows = [(i, t, "s") for i, t in enumerate(_texts(random.Random(2), 80))]
    full = {r.doc_id: r for r in _score(make_docs(rows), rounds=1).collect()}
    monkeypatch.setattr(logbilinear, "HEAD", 10)
    monkeypatch.setattr(logbilinear, "SHORTLIST", 6)
    few = {r.doc_id: r for r in _score(make_docs(rows), rounds=1).collect()}
    assert full.keys() == few.keys()
    for i, r in full.items():
        assert (r.n_tokens, r.n_known) == (few[i].n_tokens, few[i].n_known)
        assert r.base_score == pytest.approx(few[i].base_score)


def test_model_beats_the_base_on_held_out_texts(spark, make_docs):
    rows = [(i, t, "s") for i, t in enumerate(_texts(random.Random(3), 1500))]
    got = [r for r in _score(make_docs(rows), rounds=3).collect() if r.held_out]
    assert len(got) > 100
    n = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / n > sum(r.base_score for r in got) / n + 0.1


def _model(words):
    rng = np.random.default_rng(0)
    small = lambda *s: rng.normal(0, 0.5, s).astype("f4")
    n = len(words) + logbilinear.ENDINGS
    return logbilinear.Model({w: i for i, w in enumerate(words)}, np.full(logbilinear.ENDINGS, 3.0),
                             np.full(logbilinear.ENDINGS, 2.0), np.full(n, 1 / n),
                             small(1 + len(words) + logbilinear.BUCKETS, logbilinear.DIM),
                             small(logbilinear.SPAN, logbilinear.DIM), small(n, logbilinear.DIM), small(n))


def test_probabilities_sum_to_one():
    """Over the words of the shortlist, the words of the classes and one unknown word in each class."""
    words = [b"", b"the", b"of"]
    m = _model(words)
    total = 0.0
    shares = np.exp(logbilinear.class_shares(m))
    coded = logbilinear.code(m, pa.array(["the some of"]))
    for out in range(len(m.noise)):
        one = logbilinear.Coded(np.full(1, out, np.uint8), [x[2:3] for x in coded.context], np.array([1]), coded.index[:1],
                                coded.distinct)
        p = math.exp(logbilinear.log_probs(m, one)[0])
        k = out - len(words)
        each = [1] if k < 0 else [m.class_tokens[k] + m.class_words[k], 1]      # counts + 1 of its words, the unknown
        total += sum(p * shares[out] * e for e in each)
    assert total == pytest.approx(1.0, abs=1e-5)


def test_scores_do_not_depend_on_neighbours_or_blocks():
    m = _model([b"", b"a", b"b"])
    texts = ["a b c a b", None, "", "b b b", "a " * 3000]
    coded = logbilinear.code(m, pa.array(texts))
    whole = np.add.reduceat(logbilinear.log_probs(m, coded, block=7), np.concatenate([[0], coded.ends[:-1]]))
    for t, want in zip(texts, whole):
        one = logbilinear.code(m, pa.array([t], pa.string()))
        assert logbilinear.log_probs(m, one).sum() == pytest.approx(want, rel=1e-4)


def test_training_in_a_quiet_corner(spark, make_docs):
    assert _score(make_docs([], parts=1)).collect() == []
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = _score(make_docs([(i, "nothing learnt", "s") for i in held])).collect()
    assert len(got) == len(held) and {(r.train_tokens, r.n_known, r.base_score) for r in got} == {(0, 0, 0.0)}


# --- operator 12 -----------------------------------------------------------------------

def _collocations(rows, least, most):
    by_lang = defaultdict(lambda: [Counter(), 0])
    for t, lang in rows:
        c = by_lang[lang if lang is not None else "und"]
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            c[1] += len(words)
            for m in range(1, 6):
                c[0].update(" ".join(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, (f, n) in by_lang.items():
        cands = {p: a for p, a in f.items() if a >= least and " " in p}
        rows = []
        for p, a in cands.items():
            w = p.split(" ")
            if any(100 * b >= 100 * a and f" {p} " in f" {q} " and q != p for q, b in cands.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k,
                                         f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w)))
            rows.append((p, a, left, right, n, score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:most])]
    return sorted(out)


def _docs12(spark, rows, parts=3):
    full = [(i, t, lang, "c", "r") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, phrase string, route string").repartition(parts)


def _rows12(rng, n):
    words = ["the", "OF", "cat", "Cat", "größe", "日本", "x1", "the,", "end.", "a\tb", "\x1c", "q\nr"]
    return [(" ".join(rng.choice(words[:rng.randrange(2, 13)]) for _ in range(rng.randrange(40))),
             rng.choice(["en", "de", None, ""])) for _ in range(n)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_collocations(spark, monkeypatch, hot):
    monkeypatch.setattr(collocations, "HOT", hot)          # 3: the frequent pairs are dealt over all routes
    rng = random.Random(hot)
    rows = _rows12(rng, 120) + [(None, "en"), ("", None), ("cat the cat the cat", "en")] * 3 + [("w " * 5000, "de")]
    got = collocations.mine(_docs12(spark, rows), least=5, most=40).collect()
    assert sorted(map(tuple, got)) == _collocations(rows, 5, 40)


def test_hot_pairs_are_found(spark):
    rows = [("is onhe. is onhe is onhe", "en")] * 30 + [("is, onhe", "en")] * 99 + [("is onhe", "de")] * 80
    texts = _docs12(spark, rows).select("lang", "text")
    words = texts.mapInArrow(collocations._words, collocations.COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    assert collocations.hot_pairs(texts, words, 90) == {"en": frozenset([b"is onhe"])}
    assert collocations.hot_pairs(texts, words, 30) == {"en": frozenset([b"is onhe", b"onhe is"]),
                                                        "de": frozenset([b"is onhe"])}


def test_bit_of_a_word_as_spark_hashes_it(spark):
    words = ["a", "größe", "日本", "", "x" * 100]
    df = spark.createDataFrame([(lang, w) for lang in ("en", "") for w in words], "lang string, w string")
    for r in df.select("lang", "w", F.pmod(F.xxhash64("lang", F.col("w").cast("binary")),
                                           F.lit(collocations.BITS)).alias("at")).collect():
        assert collocations.bit_of(r["lang"], r["w"].encode()) == r["at"]


def test_quicksort_counts_every_prefix():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 4, (400, 5)).astype(np.int32)
    cut = rng.integers(2, 6, 400)
    words[np.arange(5) >= cut[:, None]] = 0
    weights = rng.integers(1, 4, 400)
    for least in (1, 10, 60):
        want = Counter()
        for r, w in zip(words.tolist(), weights.tolist()):
            for d in range(2, 6):
                if r[d - 1]:
                    want[tuple(r[:d])] += w
        got = {tuple(words[i, :d].tolist()): t for i, d, t in collocations.quicksort(words, weights, least)}
        assert got == {k: v for k, v in want.items() if v >= least}


def test_no_documents_no_phrases(spark):
    assert collocations.mine(_docs12(spark, [], 1)).collect() == []
    assert collocations.mine(_docs12(spark, [(None, None), (" . ", "en")])).collect() == []


def test_large_numbers_stay_exact(spark):
    """Products beyond 64 bits: 1000 * a * n and l * r."""
    big = 4_000_000_000_000
    phrases = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 7)],
                                    "lang string, phrase string, m int, f long")
    totals = spark.createDataFrame([("en", 9 * big + 5)], "lang string, n long")
    row = collocations.scored(phrases, totals).first()
    assert row["score"] == 1000 * (big - 7) * (9 * big + 5) // (big * (big + 1))


# --- operator 13 -----------------------------------------------------------------------

def _nodes(rows, group=5, most=9):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - c % group, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    out = []
    for k, cs in members.items():
        below = [q for q in members if q[:len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(k))))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), kids[k],
                    sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(rng, n, deep):
    rows = []
    for c in rng.sample(range(0, 4 * n), n):
        for t in range(rng.randrange(1, deep)):
            rows.append((c, rng.choice([t, t, t, 0, None]), rng.choice(["user", "user", "assistant", None]),
                         rng.choice(["ja", "nein", "größe", "", None])))
    return rows


def _build(spark, rows, parts=4, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "conv_id long, turn long, role string, text string, conv string, part string").repartition(parts)
    return trie.build(df, taken=F.crc32(F.col("conv").cast("string")) % 9, **kw)


@pytest.mark.parametrize("band", [1, 2, 3, 1024])
def test_trie_at_any_band(spark, band, monkeypatch):
    monkeypatch.setattr(trie, "BANDS", 100)                # else the band widens with the depth
    rows = _turns(random.Random(band), 60, 9) + [(None, 1, "user", "nobody")]
    got = _build(spark, rows, band=band).collect()
    assert sorted((tuple(r) for r in got), key=str) == _nodes(rows)


def test_trie_of_copies_and_long_conversations(spark):
    """A conversation in hundreds of copies is a spine over all shards; one is long."""
    rng = random.Random(7)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 1500, 5) for t in range(3)]
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2300, 5) for t in range(9)]
    rows += [(7000, t, "user", str(t % 3)) for t in range(400)] + _turns(rng, 40, 6)
    rows += rows[:10]                                      # repeated rows are repeated turns
    got = _build(spark, rows, band=100).collect()
    assert sorted((tuple(r) for r in got), key=str) == _nodes(rows)


def test_trie_of_nothing(spark):
    assert _build(spark, [], parts=1).collect() == []
    one = _build(spark, [(3, None, None, None)]).collect()
    assert sorted((tuple(r) for r in one), key=str) == _nodes([(3, None, None, None)])


def test_findclose_and_ranks():
    rng = random.Random(11)
    for n in (1, 5, 400, 9000):
        bits, open_, todo = [], 0, n
        while todo or open_:
            if todo and (not open_ or rng.random() < (0.6 if n < 9000 else 0.52)):
                bits.append(1)
                open_, todo = open_ + 1, todo - 1
            else:
                bits.append(0)
                open_ -= 1
        bits = np.array(bits, np.uint8)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        tree = trie.Parentheses(bits)
        assert tree.findclose(tree.opens).tolist() == [close[i] for i in tree.opens.tolist()]
        leaf = (bits[:-1] == 1) & (bits[1:] == 0)
        ranks = tree.leaf_ranks()
        for a in rng.sample(range(len(bits)), min(50, len(bits))):
            assert ranks[a] == leaf[:a].sum()
    deep = np.array([1] * 20_000 + [0] * 20_000, np.uint8)
    tree = trie.Parentheses(deep)
    assert tree.findclose(np.array([0, 1, 19_999])).tolist() == [39_999, 39_998, 20_000]
