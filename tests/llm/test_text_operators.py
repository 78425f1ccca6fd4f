"""Operators 1, 4, 8 and 2 against the libraries, SQL and plain versions."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chanlake.llm import mixing, packing, pieces, quality, queries, tokencount

public = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"

ODD = [None, "", " \n\t ", "plain words here", "Don't WE'LL i'm 'S", "a  b\n\n\nc    d", "é é İstanbul ΑΣ Σ",
       "x<|endoftext|>y  <|endoftext|>", "<|startoftext|> !!<|endoftext|>!!", "日本語 テキスト 한국어", "1234 ½ ²³ ٣",
       "​﻿\u0085  \x1c\x1d", "👍🏽 ok 🇩🇪", "a" * 5000, "#" * 5000, "͸\U000e0001 z", "\t\x0b\x0c\r\n",
       "ǅ ﬁ Å Å 가", "x" + " " * 3000 + "y", "नमस्ते दुनिया", "ſt's 'ſ", "áb'LL"]


def _library(name):
    return pieces.library(public.path(name))


def test_counts_equal_the_library(spark, make_docs):
    tok = _library("word_bpe_49k.json")
    rng = random.Random(5)
    rows = [(i, t, "s") for i, t in enumerate(ODD)]
    chars = "ab cD'sTl1²é́İ#<|>\n 日"
    rows += [(100 + i, "".join(rng.choice(chars) for _ in range(rng.randrange(60))), "s") for i in range(150)]
    rows += [(1, ODD[3], "s"), (None, "null id", "s")]
    got = tokencount.count_tokens(make_docs(rows), public.path("word_bpe_49k.json"), 3).collect()
    want = sorted((str(i), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 3) for r in got)


def test_whole_tokens_are_proven(spark):
    tok, whole = _library("word_bpe_49k.json"), tokencount.proven_whole(public.path("word_bpe_49k.json"))
    assert len(whole) > 10_000 and "the" in whole
    some = sorted(whole)[::97]
    assert all(len(e.ids) == 1 for e in tok.encode_batch(some, add_special_tokens=False))


def test_ranks_merge_as_the_library(spark):
    """The vocabulary's ranks and its merge list give the same ids for every entry and for random bytes."""
    path = public.path("byte_bpe_50k.json")
    tok, ranks = _library("byte_bpe_50k.json"), packing.merger(path)
    texts = []
    for entry in list(tok.get_vocab(with_added_tokens=False))[::7]:
        try:
            texts.append(pieces.token_bytes(entry).decode())
        except (UnicodeDecodeError, KeyError):
            continue
    rng = random.Random(1)
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        if len(tok.pre_tokenizer.pre_tokenize_str(t)) == 1:
            assert ranks.encode_ordinary(t) == e.ids, t


def test_packing_covers_every_id_once(spark, make_docs):
    tok = _library("byte_bpe_50k.json")
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(900, "word " * 4000, "s")]
    got = packing.pack(make_docs(rows), public.path("byte_bpe_50k.json"), window=64).collect()
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t, _ in rows}
    at = {i: 0 for i in ids}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert all(n == 64 for s, n in used.items() if s != max(used)) and sorted(used) == list(range(len(used)))


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, "x", "s")]).filter("doc_id < 0")
    assert tokencount.count_tokens(docs, public.path("word_bpe_49k.json"), 1).count() == 0
    assert packing.pack(docs, public.path("byte_bpe_50k.json")).count() == 0
    assert quality.judge(docs).count() == 0
    assert mixing.mix(docs, F.array("source"), F.length("text"), lambda i, s: 1).count() == 0


def _quality_rows():
    rng = random.Random(3)
    vocab = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(400)]      # no digits: they are folded
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, f"{say(30)}\nShared   LINE {i} here today\n{say(25)}", "hostA") for i in range(60)]
    rows += [(100 + i, f"only boilerplate words stand in this long line number {i} "
              "and no more of them than that would do here at all\nshort one", "hostB") for i in range(40)]
    rows += [(200 + i, say(40), "hostB") for i in range(5)]
    rows += [(300, None, "hostA"), (301, "", None), (302, say(50) + "\n\n \n" + say(3), None), (303, "a b " * 40, "hostA")]
    rows += [(304, "same copy " + say(40), "hostA")] * 30
    return rows


def test_quality_equals_sql_on_a_fixture(spark, make_docs):
    rows = _quality_rows()
    got = quality.judge(make_docs(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left", "base_failed",
        "kept")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in rows])
    want = con.execute(quality.SQL).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_quality_removes_lines_and_rejects_depleted(spark, make_docs):
    out = {r.doc_id: r for r in quality.judge(make_docs(_quality_rows())).collect()}
    assert "LINE" not in out[5].clean_text and out[5].kept and out[5].words_left == 55
    assert not out[105].kept and not out[105].base_failed                       # nothing but frequent lines
    assert out[304].kept and out[202].kept                                      # exact copies count once
    assert not out[300].kept and out[301].base_failed


def test_quality_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(queries.ORACLES["op4_quality_rules"])
    df = queries.QUERIES["op4_quality_rules"](spark, SF).select(*rel.columns)
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_flow_prefers_fresh_documents():
    used = mixing.min_cost_flow({("a",): 100, ("a", "b"): 50, ("b",): 10}, {"a": 90, "b": 60}, 3)
    assert sum(used.values()) == 150 and used[("a", "b")] == 50 and used[("b",)] == 10 and used[("a",)] == 90
    assert mixing.capped_targets({"a": 10, "b": 90}, {"a": 9, "b": 1}, 100, 3) == {"a": 30.0, "b": 70.0}


def test_mixing_meets_targets(spark, make_docs):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["a", "b", "c", None])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "z")] + [(7, "again " * 5, "a")] * 3
    docs = make_docs(rows)
    size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != ""))
    run = lambda: sorted(map(tuple, mixing.mix(docs, F.array("source"), size, lambda i, s: i % 3 + 1).select(
        "doc_id", "size", "taken", "repeats", F.col("targets")[0], F.col("members")[0]).collect()), key=str)
    got = run()
    assert got == run() and len(got) == len(rows)
    total = sum(r[1] for r in got)
    assert all(r[2] == r[1] * r[3] and r[2] <= 3 * r[1] for r in got)
    for s in ("a", "b", "c", None):
        mine = [r for r in got if r[5] == s]
        assert abs(sum(r[2] for r in mine) - mine[0][4]) <= 3
    assert abs(sum(r[2] for r in got) - total) <= 12


def test_mixing_overlapping_sources(spark, make_docs):
    docs = make_docs([(i, "x " * 10, "ab"[i % 2]) for i in range(200)])
    members = F.when(F.col("doc_id") < 100, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.col("source")))
    out = mixing.mix(docs, members, F.lit(10), lambda i, s: 1).collect()
    assert sum(r.taken for r in out) == 2000 and max(r.repeats for r in out) == 1
