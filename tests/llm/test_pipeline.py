"""The corpus pipeline against plain versions, stage by stage, and its place in the entry module."""

import random

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from chanlake.llm import common, pieces
from tests.llm import brute

public = pytest.importorskip("public_tokenizers")


def _rows():
    rng = random.Random(12)
    vocab = ["v" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(600)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = say(70)
    rows = []
    for i in range(150):
        text = f"{say(rng.randrange(5, 60))}\n{say(rng.randrange(0, 60))}"
        if i % 5 == 0:
            text += "\nAll rights reserved by the site and its owners " + str(i)
        if i % 11 == 0:
            text += "\n" + passage + " " + say(4)
        rows.append([i, text, "abc"[i % 3]])
    for i in range(20):
        w = rows[i][1].split(" ")
        w[len(w) // 2] = "changed"
        rows.append([200 + i, " ".join(w), rows[i][2]])
    rows += [[300 + i, rows[40][1], "a"] for i in range(25)] + [[400, None, "a"], [401, "", None], [402, say(45), None]]
    return [tuple(r) for r in rows]


def test_stages_equal_plain_versions(spark, make_docs):
    rows = _rows()
    docs = make_docs([(i, t, s) for i, t, s in rows])
    stages = dict(corpus_pipeline.STAGES)
    host = {i: s for i, _, s in rows}

    def step(name, frame):
        return common.stored(stages[name](spark, frame, ""), "t")

    one = step("quality rules", docs)
    assert one.columns == corpus_pipeline.COLUMNS
    texts = {r.doc_id: r.text for r in one.collect()}
    assert texts == brute.quality(rows)

    two = step("n-gram Jaccard join", one)
    want = {i for i, (c, _) in brute.near(list(texts.items())).items() if i == c}
    assert {r.doc_id for r in two.collect()} == want and two.count() == len(want)

    three = step("substring dedup", two)
    cut = brute.passages([(i, texts[i]) for i in want])
    left = {r.doc_id: r for r in three.collect()}
    assert set(left) == {i for i, (n, gone, _) in cut.items() if gone < n}
    for i, r in left.items():
        assert len(brute.words(r.text)) == cut[i][0] - cut[i][1] and r.n_chars == len(r.text) and r.source == host[i]

    four = step("mixing sources", three)
    sizes = {i: len(brute.words(r.text)) for i, r in left.items()}
    taken = {}
    for r in four.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert max(taken.values()) <= 3 and set(taken) <= set(left)
    assert abs(sum(sizes[i] * k for i, k in taken.items()) - sum(sizes.values())) <= 0.05 * sum(sizes.values())

    tok = pieces.library(public.path("byte_bpe_50k.json"))
    five = stages["packing"](spark, four, "").collect()
    ids = sum(k * (len(tok.encode(left[i].text, add_special_tokens=False).ids) + 1) for i, k in taken.items())
    assert sum(r.length for r in five) == ids
    ends = np.array(sorted(r.sequence_id * 2048 + r.offset + r.length for r in five))
    assert ends[-1] == ids and len({(r.sequence_id, r.offset) for r in five}) == len(five)


def test_repeated_ids_stay_once(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    docs = make_docs([(1, text, "a"), (1, text, "a"), (2, text + " more", "a"), (None, text, "a")])
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "None"]


def test_one_id_keeps_each_of_its_texts(spark, make_docs):
    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passage, texts = say(60), [say(40), say(90)]
    docs = make_docs([(1, passage + " " + say(30), "a"), (2, texts[0], "a"), (2, texts[1] + " " + passage, "a"),
                      (2, texts[0], "a")])
    two = common.stored(corpus_pipeline.near_duplicates(spark, docs, ""), "t")
    assert sorted(r.text for r in two.collect() if r.doc_id == 2) == sorted([texts[0], texts[1] + " " + passage])
    three = corpus_pipeline.substring_dedup(spark, two, "").collect()
    assert sorted(r.text.strip() for r in three if r.doc_id == 2) == sorted(texts)


def test_empty_documents(spark, make_docs):
    docs = make_docs([(1, "x", "a")]).filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, ""), "empty")
        assert docs.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and sum(n.startswith("op") for n in names) == 13
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "substring dedup", "mixing sources", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_whole_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "doc_id" in out.columns
