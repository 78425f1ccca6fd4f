"""Data tests (Q1-Q5) and the run-then-test gate (M3).

A test counts failures the way the declarative tests do:

* ``not_null``: rows where the column is NULL;
* ``unique``: non-NULL values that occur more than once;
* ``accepted_values``: distinct non-NULL values outside the list;
* ``rows``: rows matched by a custom predicate (a row test).

All tests of a model are counted in one scan and one shuffle: every row turns into one row of flags (for the tests
that look at rows) and one for each value a ``unique`` or ``accepted_values`` test has to tell apart, keyed by test
and value. One grouped aggregate counts both; tasks add up before the shuffle, so the flags leave a task as one row and
a hot value is combined map-side. The report is one small DataFrame: ``model, column, test, failures``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values | rows
    values: tuple = ()
    predicate: str | None = None   # SQL predicate for row tests
    name: str = field(default="")

    @property
    def label(self) -> str:
        return self.name or self.test


# --- fixed values: the declared tests ---------------------------------------
DECLARED_TESTS = (
    DataTest("cleaned_data", "group_id", "not_null"),
    DataTest("cleaned_data", "business_name", "not_null"),
    DataTest("cleaned_data", "scraped_date", "not_null"),
    DataTest("fact_business_interactions", "group_id", "not_null"),
    DataTest("fact_business_interactions", "message_id", "unique"),
    DataTest("fact_business_interactions", "extracted_link", "not_null"),
    DataTest("dim_businesses", "group_id", "not_null"),
    DataTest("dim_businesses", "group_id", "unique"),
    DataTest("dim_businesses", "business_name", "not_null"),
    DataTest("dim_businesses", "phone_number", "not_null"),
    DataTest("stg_telegram", "group_id", "not_null"),
    DataTest("stg_telegram", "group_id", "unique"),
    DataTest("stg_telegram", "phone_number", "not_null"),
    DataTest("stg_telegram", "scraped_date", "not_null"),
    DataTest("stg_telegram", "scraped_date", "accepted_values", values=("2024-01-01", "2024-01-02")),
    DataTest("standardized", "message_id", "rows", predicate="message_id IS NULL",
             name="test_message_id"),
    DataTest("standardized", "sender_id", "rows", predicate="sender_id = 'Unknown Sender'",
             name="test_sender_id"),
)
# --- end of fixed values -----------------------------------------------------


def _flag(t: DataTest) -> Column:
    """Whether a row fails a test that looks at rows."""
    if t.test == "not_null":
        return F.col(t.column).isNull()
    if t.test == "rows":
        return F.coalesce(F.expr(t.predicate), F.lit(False))
    raise ValueError(t.test)


def _value(t: DataTest) -> Column:
    """What a test of values has to tell apart, NULL for nothing: all values, or those outside the list."""
    c = F.col(t.column)
    return c if t.test == "unique" else F.when(~c.isin(*t.values), c)


def count_failures(df: DataFrame, tests: list[DataTest]) -> DataFrame:
    """One row with the failures of each test (f0, f1, ...) from one scan of the model."""
    values = {i: _value(t) for i, t in enumerate(tests) if t.test in ("unique", "accepted_values")}
    flags = {i: _flag(t) for i, t in enumerate(tests) if i not in values}
    kinds = {i: df.select(v).schema[0].dataType for i, v in values.items()}

    def row(key: int) -> Column:
        cells = [F.lit(key).alias("_test")]
        cells += [(f if key < 0 else F.lit(None).cast("boolean")).alias(f"_f{i}") for i, f in flags.items()]
        cells += [(v if i == key else F.lit(None).cast(kinds[i])).alias(f"_v{i}") for i, v in values.items()]
        return F.struct(*cells)

    rows = df.select(F.inline(F.array(*[row(k) for k in [*([-1] if flags else []), *values]])))
    for i in values:
        rows = rows.where((F.col("_test") != i) | F.col(f"_v{i}").isNotNull())
    groups = rows.groupBy("_test", *[f"_v{i}" for i in values]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(f"_f{i}").alias(f"_c{i}") for i in flags])
    failing = {i: F.coalesce(F.sum(f"_c{i}"), F.lit(0)) for i in flags}
    for i in values:
        mine = F.col("_test") == i
        failing[i] = F.count_if(mine & (F.col("_n") > 1) if tests[i].test == "unique" else mine)
    return groups.agg(*[failing[i].alias(f"f{i}") for i in range(len(tests))])


def _row(t: DataTest, failures: Column) -> Column:
    return F.struct(F.lit(t.model).alias("model"), F.lit(t.column).alias("column"),
                    F.lit(t.label).alias("test"), failures.cast("bigint").alias("failures"))


def run_tests(models: dict[str, DataFrame], tests=DECLARED_TESTS) -> DataFrame:
    """Q1-Q5: one report row per test whose model is present."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[DataTest]] = {}
    for t in tests:
        if t.model in models:
            by_model.setdefault(t.model, []).append(t)
    for model, ts in by_model.items():
        counted = count_failures(models[model], ts)
        parts.append(counted.select(F.inline(F.array(*[_row(t, F.col(f"f{i}")) for i, t in enumerate(ts)]))))
    if not parts:
        raise ValueError("no test applies to the given models")
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


class DataTestFailure(RuntimeError):
    def __init__(self, failing: list):
        self.failing = failing
        super().__init__("data tests failed: " + ", ".join(
            f"{r['model']}.{r['column']} {r['test']} ({r['failures']})" for r in failing))


def gate(report: DataFrame) -> DataFrame:
    """M3: raise with the failing tests, else return the report.
    The report has one row per test, so collecting it is bounded."""
    failing = [r.asDict() for r in report.where(F.col("failures") > 0).collect()]
    if failing:
        raise DataTestFailure(failing)
    return report
