"""Data tests: one scan a model, counts as counted one by one."""

import random

import pytest

from chanlake.operators import quality
from chanlake.operators.quality import DataTest

TESTS = [DataTest("m", "a", "not_null"), DataTest("m", "a", "unique"), DataTest("m", "b", "unique"),
         DataTest("m", "b", "accepted_values", values=("x", "y")), DataTest("m", "l", "unique"),
         DataTest("m", "a", "rows", predicate="a > 5", name="small"), DataTest("m", "b", "not_null"),
         DataTest("m", "d", "unique")]
SCHEMA = "a long, b string, l array<string>, d double, _n long, _test string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA).repartition(4)


def plain(rows):
    def dup(values):
        values = [v for v in values if v is not None]
        return len({str(v) for v in values if values.count(v) > 1})
    a, b, lists, d = zip(*rows) if rows else ((), (), (), ())
    return [sum(x is None for x in a), dup(a), dup(b), len({x for x in b if x is not None and x not in ("x", "y")}),
            dup(lists), sum(x is not None and x > 5 for x in a), sum(x is None for x in b), dup(d)]


@pytest.mark.parametrize("seed", range(3))
def test_counts(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, "x", "y", "z", "", "w"]),
             rng.choice([None, [], ["a, b"], ["a", "b"], [None]]), rng.choice([None, 0.5, 1.0, 2.5])) for _ in range(seed * 20)]
    got = quality.run_tests({"m": frame(spark, rows)}, TESTS).collect()
    assert [(r["column"], r["test"]) for r in got] == [(t.column, t.label) for t in TESTS]
    assert [r["failures"] for r in got] == plain(rows)


def test_one_scan_and_one_shuffle_of_values(spark, workdir):
    rows = [(i % 3, "x", ["a"], 1.0) for i in range(50)]
    frame(spark, rows).write.parquet(workdir + "/m")
    report = quality.run_tests({"m": spark.read.parquet(workdir + "/m")}, TESTS)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_kinds_alone(spark):
    rows = [(1, "x", None, None), (1, None, None, None)]
    for i, t in enumerate(TESTS):
        got = quality.run_tests({"m": frame(spark, rows)}, [t]).first()
        assert got["failures"] == plain(rows)[i], t
    with pytest.raises(ValueError):
        quality.run_tests({"m": frame(spark, rows)}, [DataTest("m", "a", "no_such_test")])
