from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import quality as q
from ledgermill.plans.constraints import declared_constraints
from ledgermill.session import stage_path
from tests.conftest import rows

TABLE = "id string, amount double, cap double, kind string"
# per constraint: a row that passes, one that fails and one that is NULL
CASES = [
    (q.NotNull("t", column="amount"), [("a", 1.0, 2.0, "x"), ("b", None, 2.0, "x")], 1),
    (q.NotNull("t", where="kind = 'x'", column="amount"),
     [("a", None, 2.0, "y"), ("b", None, 2.0, "x"), ("c", None, 2.0, None)], 1),
    (q.AcceptedValues("t", column="kind", values=("x",)),
     [("a", 1.0, 2.0, "x"), ("b", 1.0, 2.0, "y"), ("c", 1.0, 2.0, None)], 1),
    (q.ExpressionIsTrue("t", column="amount", expression="<= cap"),
     [("a", 1.0, 2.0, "x"), ("b", 3.0, 2.0, "x"), ("c", None, 2.0, "x")], 1),
    (q.AcceptedRange("t", column="amount", low=0, high=1),
     [("a", 1.0, 2.0, "x"), ("b", 1.1, 2.0, "x"), ("c", None, 2.0, "x"), ("d", -0.1, 0.0, "x")],
     2),
    (q.AcceptedRange("t", column="amount", low=0, high=1, inclusive=False),
     [("a", 0.5, 2.0, "x"), ("b", 1.0, 2.0, "x"), ("c", 0.0, 2.0, "x")], 2),
    (q.NotExceeding("t", column="amount", other="cap"),
     [("a", 2.0, 2.0, "x"), ("b", 2.1, 2.0, "x"), ("c", 1.0, None, "x")], 1),
    (q.Unique("t", columns=("id",)),
     [("a", 1.0, 2.0, "x"), ("b", 1.0, 2.0, "x"), ("b", 1.0, 2.0, "y"), ("b", 1.0, 2.0, "y"),
      (None, 1.0, 2.0, "x"), (None, 1.0, 2.0, "x")], 1),
    (q.Unique("t", columns=("id", "kind"), ignore_null=False),
     [("a", 1.0, 2.0, "x"), ("a", 1.0, 2.0, "y"), ("b", 1.0, 2.0, None), ("b", 1.0, 2.0, None)],
     1),
]


@pytest.mark.parametrize(("rule", "given", "failures"), CASES, ids=lambda v: getattr(v, "name", ""))
def test_violations_and_counts_agree(frame, rule, given, failures):
    df = frame(TABLE, *given)
    assert rule.violations(df).count() == failures
    result = q.run_constraints({"t": df}, [rule]).collect()
    assert [(r.failures, r.status) for r in result] == [(failures, "fail")]


def test_relationship_counts_rows_without_a_parent(frame):
    child = frame("parent_id string", ("a",), ("z",), ("z",), (None,))
    parent = frame("id string", ("a",), (None,))
    rule = q.Relationship("child", column="parent_id", to="parent", field="id")
    assert rows(rule.violations(child, parent)) == [("z",), ("z",)]
    result = q.run_constraints({"child": child, "parent": parent}, [rule]).first()
    assert (result.failures, result.status) == (2, "fail")


def test_severity_sets_the_status(frame):
    df = frame(TABLE, ("a", None, 2.0, "x"))
    rules = [
        q.NotNull("t", severity="warn", column="amount"),
        q.NotNull("t", column="amount"),
        q.NotNull("t", column="id"),
    ]
    results = {(r.test_name, r.severity): r.status for r in q.run_constraints({"t": df}, rules)
               .collect()}
    assert results == {
        ("not_null(amount)", "warn"): "warn",
        ("not_null(amount)", "error"): "fail",
        ("not_null(id)", "error"): "pass",
    }


def test_an_empty_table_passes(frame):
    rules = [q.NotNull("t", column="amount"), q.Unique("t", columns=("id",))]
    assert {r.status for r in q.run_constraints({"t": frame(TABLE)}, rules).collect()} == {"pass"}


def test_all_constraints_are_declared():
    kinds = Counter(type(c).__name__ for c in declared_constraints())
    assert kinds == {
        "NotNull": 90, "Unique": 25, "AcceptedValues": 22, "ExpressionIsTrue": 14,
        "Relationship": 7, "NotExceeding": 3, "AcceptedRange": 2,
    }


def test_the_suite_counts_all_rules_at_once(spark, frame):
    """Many rules against plain counting, on keys that look alike as text."""
    values = [None, "a", "b", "1:a", "-", "", "a1:"]
    given = [(values[i % 7], float(i % 5), values[(i * i) % 7], str(i % 3)) for i in range(200)]
    schema = "a string, x double, b string, kind string"
    df, parent = frame(schema, *given), frame("id string", ("a",), ("-",), ("a",), (None,))
    rules = [
        q.Unique("t", columns=("a", "b", "x"), ignore_null=False),
        q.Unique("t", columns=("a", "b"), ignore_null=True),
        q.Unique("t", where="kind = '1'", columns=("a", "b", "x")),
        q.Relationship("t", column="a", to="p", field="id"),
        q.Relationship("t", severity="warn", where="kind = '2'", column="b", to="p", field="id"),
        q.Relationship("p", column="id", to="t", field="a"),
        q.NotNull("t", column="a"),
        q.AcceptedRange("t", column="x", low=1, high=3),
        q.Unique("p", columns=("id",)),
    ]
    def repeated(keys):
        return sum(n > 1 for n in Counter(keys).values())

    known = {"a", "-"}
    expected = [
        repeated((a, b, x) for a, x, b, _ in given),
        repeated((a, b) for a, _, b, _ in given if a is not None and b is not None),
        repeated((a, b, x) for a, x, b, k in given
                 if k == "1" and a is not None and b is not None),
        sum(a is not None and a not in known for a, *_ in given),
        sum(b is not None and b not in known for _, _, b, k in given if k == "2"),
        0,
        sum(a is None for a, *_ in given),
        sum(not 1 <= x <= 3 for _, x, _, _ in given),
        1,
    ]
    found = {(r.table_name, r.test_name): r.failures
             for r in q.run_constraints({"t": df, "p": parent}, rules).collect()}
    names = [(r.table, r.name if r.where is None else f"{r.name} where {r.where}") for r in rules]
    assert [found[n] for n in names] == expected


def test_keys_of_other_types(spark, frame):
    """A parent's field is cast to the type of the column; the two zeros are one value."""
    child = frame("parent_id string, x double", ("1", 0.0), ("2", -0.0))
    parent = frame("id long", (1,), (3,))
    rules = [
        q.Relationship("c", column="parent_id", to="p", field="id"),
        q.Unique("c", columns=("x",)),
    ]
    result = q.run_constraints({"c": child, "p": parent}, rules)
    assert rows(result, "test_name", "failures") == [
        ("relationship(parent_id -> p.id)", 1), ("unique(x)", 1)]


def test_the_suite_reads_and_shuffles_once(spark, frame):
    """Each table is scanned once and all keys share one shuffle; a hot key moves as counts."""
    path, other = stage_path(spark, "suite"), stage_path(spark, "suite")
    spark.range(0, 9000, 1, 3).selectExpr(
        "cast(id as string) as id", "if(id % 3 = 0, 'hot', cast(id as string)) as ref",
        "cast(id as double) as x", "id as unused",
    ).write.parquet(path)
    spark.range(0, 6000, 1, 3).selectExpr("cast(id as string) as id").write.parquet(other)
    rules = [
        q.Unique("t", columns=("id",)), q.Unique("t", columns=("ref",)),
        q.NotNull("t", column="x"), q.AcceptedRange("t", column="x", low=0, high=10),
        q.Relationship("t", column="ref", to="p", field="id"), q.Unique("p", columns=("id",)),
    ]
    result = q.run_constraints({"t": spark.read.parquet(path), "p": spark.read.parquet(other)},
                               rules)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "unused" not in plan
    keyed = [line for line in plan.splitlines()
             if "Exchange hashpartitioning(rule" in line and "key#" in line]
    assert len(keyed) == 1
    assert rows(result, "test_name", "failures") == [
        ("accepted_range(x)", 8989), ("not_null(x)", 0), ("relationship(ref -> p.id)", 5000),
        ("unique(id)", 0), ("unique(id)", 0), ("unique(ref)", 1)]


def test_suite_joins_the_test_lines_once(testbed, monkeypatch):
    """The tables under test come from files: line items are not joined again for each."""
    from ledgermill.catalog import load_queries
    from ledgermill.catalog import quality as catalog

    seen = {}

    def noted(tables, constraints):
        seen.update(tables)
        return tables["thresholds"]

    monkeypatch.setattr(catalog.q, "run_constraints", noted)
    load_queries()["q10_suite"].run(testbed.spark, testbed.sf_dir)
    assert len(seen) == len(catalog.FRAMES)
    for name, frame in seen.items():
        files = frame.inputFiles()
        assert not any("lineitem" in file for file in files), name


def test_keys_are_packed_one_to_one(spark):
    """No two texts have the same bytes, and those of digits are half as long."""
    signs = ["", "0", "1", "a", "A", "b", "f", "x", "-", ":", "\u00ff", "\u0661", " "]
    texts = {a + b + c for a in signs for b in signs for c in signs} | {"17-4-25:1", "0017", "17"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)] + [(None,)], "key string")
    found = {r.key: r.bytes for r in df.select("key", q.packed(F.col("key")).alias("bytes")).collect()}
    assert found.pop(None) is None
    assert None not in found.values()
    assert len({bytes(b) for b in found.values()}) == len(found) == len(texts)
    assert len(found["17-4-25:1"]) == 5


def test_tables_under_test_need_no_shuffle(testbed, monkeypatch):
    """The suite holds the shuffle of its keys and none that a table was made with."""
    from ledgermill.catalog import load_queries
    from ledgermill.catalog import quality as catalog

    seen = {}

    def noted(tables, constraints):
        seen.update(tables)
        return tables["thresholds"]

    monkeypatch.setattr(catalog.q, "run_constraints", noted)
    load_queries()["q10_suite"].run(testbed.spark, testbed.sf_dir)
    shuffled = [name for name, frame in seen.items()
                if "Exchange hashpartitioning" in frame._jdf.queryExecution().executedPlan().toString()]
    assert len(seen) == len(catalog.FRAMES) and shuffled == []
