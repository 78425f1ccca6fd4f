"""Operator 2: the same documents whatever the file order, and flows against every allocation."""

import itertools
import random

from pyspark.sql import functions as F

from chanlake.llm import common, mixing


def _mix(docs):
    return mixing.mix(docs, members=F.array(F.col("source")), size=F.size(common.words(F.col("text"))),
                      weight_of=lambda i, source: i % 3 + 1, max_repeats=3, keep=["text"])


def test_file_order_changes_nothing(spark):
    """Ids that carry several texts, repeated rows, NULL ids; clashing columns."""
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(25)]), " ".join("w" for _ in range(rng.randrange(60))), rng.choice(["a", "b", "c", None]),
             "k", 1) for _ in range(300)]
    rows += rows[:40]
    found = []
    for seed, parts in ((1, 1), (2, 5), (3, 9)):
        some = list(rows)
        random.Random(seed).shuffle(some)
        docs = spark.createDataFrame(some, "doc_id long, text string, source string, _key string, taken int").repartition(parts)
        found.append(sorted(map(str, _mix(docs).select("doc_id", "text", "taken", "repeats").collect())))
    assert found[0] == found[1] == found[2]


def _cost(used, capacity):
    """Convex: the e-th epoch costs e a word."""
    out = 0
    for p, n in used.items():
        e, left = 0, n
        while left > 0:
            step = min(left, capacity[p])
            out, left, e = out + e * step, left - step, e + 1
    return out


def test_flow_costs_as_little_as_any_allocation():
    rng = random.Random(6)
    for _ in range(60):
        patterns = rng.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("c",)], 3)
        capacity = {p: rng.randrange(1, 4) for p in patterns}
        quota = {s: rng.randrange(0, 5) for s in sorted({s for p in patterns for s in p})}
        pairs = [(p, s) for p in patterns for s in p]
        best = None
        for give in itertools.product(range(5), repeat=len(pairs)):
            used = {p: sum(g for (q, _), g in zip(pairs, give) if q == p) for p in patterns}
            got = {s: sum(g for (_, t), g in zip(pairs, give) if t == s) for s in quota}
            if any(used[p] > 3 * capacity[p] for p in patterns) or any(got[s] > quota[s] for s in quota):
                continue
            score = (-sum(got.values()), _cost(used, capacity))
            best = score if best is None else min(best, score)
        used = mixing.min_cost_flow(capacity, quota, 3)
        assert (-sum(used.values()), _cost(used, capacity)) == best
