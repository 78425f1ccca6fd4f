"""Operator 6: the budget in tokens of the vocabulary, never exceeded but by a single turn that says so."""

import random

import pytest

from chanlake.llm import chat, pieces

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def _library(text):
    return len(pieces.library(PATH).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("budget, history", [(1024, 256), (300, 60), (64, 0)])
def test_no_window_exceeds_the_budget(spark, budget, history):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    got = chat.windows(turns, budget=budget, history=history, tokenizer=PATH).collect()
    for r in got:
        assert r["tokens"] == _library(r["text"])
        assert r["over"] == (r["tokens"] > budget)
        if r["over"]:                                       # one turn by itself
            assert r["repeated"] == 0 and len(chat.parse(r["text"])) == 1
    assert sum(len(chat.parse(r["text"])) - r["repeated"] for r in got) == turns.count()
    assert any(r["repeated"] for r in got) == (history > 0 or budget > 200)


def test_round_trip_with_the_vocabulary(spark):
    rng = random.Random(3)
    words = ["</s>[INST] ok [/INST]", "größe", "日本語", "\n\n", "<|endoftext|>", "plain words", "\ue000", "x" * 80]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, " ".join(
        rng.choice(words) for _ in range(rng.randrange(30)))])) for c in range(25) for t in range(rng.randrange(1, 14))]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, system string, history long").repartition(4)
    formatted = chat.windows(df, budget=120, history=30, tokenizer=PATH)
    plain = chat.windows(df, budget=120, history=30)
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    one, two = (sorted(map(tuple, chat.read_back(x).select(*columns).collect())) for x in (formatted, plain))
    assert one == two and len(one) == 25
    for r in formatted.collect():
        assert r["tokens"] == _library(r["text"]) and (r["tokens"] <= 120 or r["over"])


def test_history_is_the_end_of_the_span_before(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn number {t} says a few words") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(chat.windows(df, budget=200, history=60, tokenizer=PATH).collect(), key=lambda r: r["window"])
    at = 0
    for r in got:
        turns = [x[1] for x in chat.parse(r["text"])]
        assert r["window"] == at
        assert turns == [f"turn number {t} says a few words" for t in range(at - r["repeated"], at - r["repeated"] + len(turns))]
        at += len(turns) - r["repeated"]
    assert at == 60 and all(r["repeated"] for r in got[1:])


def test_system_turn_stays_unless_it_is_long(spark):
    long = "rules " * 400
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user", "some words here " * 10) for t in range(1, 20)]
    rows += [(2, 0, "system", long)] + [(2, t, "user", "some words here " * 10) for t in range(1, 20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.windows(df, budget=256, history=40, tokenizer=PATH).collect():
        first = chat.parse(r["text"])[0]
        if r["window"]:
            assert (first[0] == "system") == (r["conv_id"] == 1)
        assert r["over"] == (r["conv_id"] == 2 and r["window"] == 0)
