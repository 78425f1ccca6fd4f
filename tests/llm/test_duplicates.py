"""Operators 5 and 7 against all-pairs versions."""

import functools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanlake.llm import components, jaccard, substring
from tests.llm import brute


def _say(rng, n, vocab=3000):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def _passage_rows(seed=1):
    rng = random.Random(seed)
    shared = [_say(rng, n) for n in (50, 51, 60, 49, 75, 200)]
    rows = []
    for i in range(120):
        w = _say(rng, rng.randrange(0, 150))
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(0, 12)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[a:]
        rows.append((i, " ".join(w)))
    rows += [(200 + i, "the " * n + " ".join(_say(rng, 5))) for i, n in enumerate((49, 50, 51, 90, 140))]
    rows += [(210 + i, "ab cd " * n + "tail") for i, n in enumerate((20, 30, 31, 70))]
    rows += [(220 + i, "x " * k + " ".join(shared[0]) + " y" * k) for i, k in enumerate((0, 1, 2, 7))]
    rows += [(300, rows[5][1]), (301, rows[5][1]), (302, None), (303, ""), (304, "\n\t "), (None, rows[5][1])]
    rows += [(305, " ".join(shared[5]) + " " + " ".join(_say(rng, 3000)))]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_equal_brute_force(spark, make_docs, seed):
    rows = _passage_rows(seed)
    got = substring.remove_passages(make_docs([(i, t, "s") for i, t in rows])).collect()
    want = brute.passages(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert (r.left_text is None) == (r.n_removed == 0)
        if r.left_text is not None:
            assert len(brute.words(r.left_text)) == r.n_words - r.n_removed


def test_hot_passage_and_slices(spark, make_docs, monkeypatch):
    """A passage in every document, in many slices, and documents of repeated ids."""
    monkeypatch.setattr(substring, "SLICE_WORDS", 200)
    rng = random.Random(8)
    hot = " ".join(_say(rng, 64))
    rows = [(i, " ".join(_say(rng, 30)) + " " + hot + " " + " ".join(_say(rng, 30))) for i in range(150)]
    got = {r.doc_id: r for r in substring.remove_passages(make_docs([(i, t, "s") for i, t in rows], 5)).collect()}
    want = brute.passages(rows)
    assert all((r.n_words, r.n_removed, r.kept_sha256) == want[i] for i, r in got.items())
    twice = rows[:3] + rows[:3]
    got = substring.remove_passages(make_docs([(i, t, "s") for i, t in twice])).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 64, 64, 64, 64]


@pytest.mark.parametrize("words", [200, 300_000])
def test_one_id_on_two_texts(spark, make_docs, monkeypatch, words):
    """Each text of an id is cut by itself, whichever of them is long, a copy, or shares a passage."""
    monkeypatch.setattr(substring, "SLICE_WORDS", words)
    rng = random.Random(9)
    shared = [" ".join(_say(rng, 60)) for _ in range(3)]
    rows = [(1, shared[0] + " " + " ".join(_say(rng, 20))), (2, " ".join(_say(rng, 70)))]
    rows += [(5, " ".join(_say(rng, 300)) + " " + shared[0]), (5, " ".join(_say(rng, 55)))]       # long, and short
    rows += [(6, rows[1][1]), (6, " ".join(_say(rng, 90)) + " " + shared[0]), (6, " ".join(_say(rng, 80)))]  # a copy
    rows += [(7, "a " + shared[1]), (7, "b c " + shared[1] + " " + shared[2]), (8, shared[2] + " d " + shared[1])]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                 for r in substring.remove_passages(make_docs([(i, t, "s") for i, t in rows], 2)).collect())
    want = []
    for i, t in rows:
        alone = [(j, u) for j, u in rows if j != i] + [(i, t)]
        want.append((i, *brute.passages(alone)[i]))
    assert got == sorted(want)


def test_own_rows_of_the_tasks_spread(spark):
    """Every task has one row of its own; 40 tasks fill many of the 64 groups, not one."""
    rng = random.Random(4)
    hot = " ".join(_say(rng, 64))
    docs = spark.createDataFrame([(i, i, hot + f" {i}") for i in range(400)], "doc_id long, text_key long, text string")
    sent = docs.repartition(40).mapInArrow(functools.partial(substring._send_phrases, 64), substring.ENTRY)
    told = docs.withColumn("phrases", F.array(*[F.lit(int(x)) for x in _phrases_of(hot)])).withColumn("copy", F.lit(False))
    windows = told.repartition(40).mapInArrow(functools.partial(substring._send_windows, 64), substring.ENTRY)
    bands = docs.select(F.col("doc_id").alias("rep"), F.lit(bytes(8)).alias("bands")).repartition(40)
    stars = bands.mapInArrow(functools.partial(jaccard._send_bands, 64), substring.ENTRY)
    for frame in (sent, windows, stars):
        groups = [r["bucket"] for r in frame.filter("own").collect()]
        assert len(groups) >= 30 and max(map(groups.count, groups)) <= 8


def _phrases_of(text):
    _, _, _, phrase = substring._phrases([0], [text.encode().split()])
    return phrase.view(np.int64)


def test_symbols_are_the_same_inside_equal_substrings():
    rng = np.random.default_rng(4)
    for _ in range(200):
        inner = rng.integers(0, 12, 50).astype(np.uint64)
        marks = []
        for _ in range(3):
            left, right = (rng.integers(0, 12, int(rng.integers(0, 60))).astype(np.uint64) for _ in range(2))
            names = substring.mixed(np.concatenate([left, inner, right]) + np.uint64(1))
            first = np.zeros(len(names), bool)
            first[0] = True
            marks.append(substring.symbol_starts(names, first)[len(left):len(left) + 50])
        both = marks[0] & marks[1] & marks[2]
        assert both[:19].any()                          # an anchor whose phrase of 32 words fits in the window


def test_empty_and_tiny(spark, make_docs):
    none = make_docs([(1, "a", "s")]).filter("doc_id < 0")
    assert substring.remove_passages(none).count() == 0
    assert jaccard.join(none).count() == 0


def _near_rows(seed=2, family=30):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        base = _say(rng, rng.randrange(5, 120))
        for _ in range(rng.randrange(1, 5)):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
            rows.append((n, " ".join(w)))
            n += 1
    base = _say(rng, 100)
    for _ in range(family):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
        rows.append((n, " ".join(w)))
        n += 1
    rows += [(900, "one two"), (901, "one two"), (902, "one  two\n"), (903, "two one"), (904, None), (905, ""),
             (906, rows[0][1]), (907, "\n".join(rows[0][1].split()))]
    return rows


@pytest.mark.parametrize("seed", [2, 3])
def test_join_equals_all_pairs(spark, make_docs, monkeypatch, seed):
    rows = _near_rows(seed)
    want = brute.near(rows)
    for tile in (512, 8):                               # whole clusters, and clusters cut into tiles
        monkeypatch.setattr(jaccard, "TILE", tile)
        got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(make_docs(
            [(i, t, "s") for i, t in rows])).collect()}
        assert got == want


def test_tile_functions(monkeypatch):
    """Dense and sparse verification agree."""
    rng = np.random.default_rng(0)
    n_members = 60
    sets = [np.unique(rng.integers(0, 80, 70)) for _ in range(n_members)]
    n = np.array([len(s) for s in sets])
    gram = np.concatenate(sets).astype(np.uint64)
    member = np.repeat(np.arange(n_members), n)
    i, j = jaccard._links_large(gram, member, n)
    want = {(a, b) for a in range(n_members) for b in range(a + 1, n_members)
            if len(set(sets[a]) & set(sets[b])) * 5 >= 4 * len(set(sets[a]) | set(sets[b]))}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_rows_without_id_and_repeated_rows(spark, make_docs):
    text = " ".join(f"t{i}" for i in range(30))
    got = jaccard.join(make_docs([(None, text, "s"), (4, text, "s"), (4, text, "s"), (9, text, "s")])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == [
        ("4", "4", 2), ("4", "4", 2), ("9", "4", 2), ("None", "None", 0)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200), (300, 290)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.v: r.c for r in components.components(df, "test").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 300: 290, 290: 290}


def test_banding_reaches_its_recall():
    bands = jaccard.banding(0.8, 0.999999, 4)
    assert 1 - (1 - 0.8 ** 4) ** bands >= 0.999999
