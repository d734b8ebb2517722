import datetime as dt

from pyspark.sql import functions as F

from strata.functions import digests as D
from strata.functions.digests import differing_slots, digest_differences, row_digests

SCHEMA = "id long, name string, price double, at timestamp_ntz, parts array<float>, tags struct<a:int,b:string>"
ROWS = [
    (1, "a|b", 1.25, dt.datetime(2020, 1, 2, 3, 4, 5, 600), [1.0, None], (1, "x")),
    (2, "a", -0.5, None, [], None),
    (3, None, None, dt.datetime(1969, 12, 31), None, (None, None)),
    (4, "\\N", 1e300, None, None, None),
    (4, None, 1e300, None, None, None),
    (5, "", 0.0, None, None, None),
]


def test_a_digest_tells_rows_apart(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert row_digests(df).distinct().count() == len(ROWS)


def test_values_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("a|1:b", "c"), ("a", "b|1:c"), ("a", "1:b|c"), (None, "a"), ("a", None)], "x string, y string")
    assert row_digests(df).distinct().count() == 5


def test_differences_are_those_of_multisets(spark):
    left = spark.createDataFrame(ROWS + ROWS[:2] * 3, SCHEMA)
    right = spark.createDataFrame(ROWS[1:] + ROWS[1:2] * 5, SCHEMA)
    assert digest_differences(left, left.repartition(5)).count() == 0
    found = {(r["n_left"], r["n_right"]) for r in digest_differences(left, right).collect()}
    assert found == {(4, 0), (4, 6)}


def test_empty_tables_and_odd_names(spark):
    none = spark.createDataFrame([], "`a.b` int, `row_md5` string")
    some = spark.createDataFrame([(1, "x")], "`a.b` int, `row_md5` string")
    assert digest_differences(none, none).count() == 0
    assert [tuple(r)[1:] for r in digest_differences(none, some).collect()] == [(0, 1)]
    assert row_digests(some).columns == ["row_md5"]


def test_array_elements_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([(["a,b"],), (["a", "b"],), (["a", None],), ([],), (None,)], "x array<string>")
    assert row_digests(df).distinct().count() == 5


def test_differing_slots_are_those_of_differing_rows(spark):
    left = spark.createDataFrame(ROWS + ROWS[:2] * 3, SCHEMA)
    right = spark.createDataFrame(ROWS[1:] + ROWS[1:2] * 5, SCHEMA)
    assert differing_slots(left, left.repartition(5)).count() == 0
    want = {r["slot"] for r in row_digests(left).where(F.col("row_md5").isin(
        [r["row_md5"] for r in digest_differences(left, right).collect()])).select(D._slot(F.col("row_md5")).alias("slot")).collect()}
    assert {r["slot"] for r in differing_slots(left, right).collect()} == want


def test_slots_lose_no_difference(spark, monkeypatch):
    """Many rows a slot, as many rows on either side, values exchanged between
    rows, one row for another: counts alone do not tell."""
    monkeypatch.setattr(D, "SLOTS", 4)
    left = spark.range(4000).selectExpr("id", "id % 7 as x")
    for right in (left.selectExpr("id", "if(id in (5, 6), 11 - id, x) as x"), left.selectExpr("if(id = 17, 18, id) as id", "x"),
                  left.selectExpr("id", "if(id < 3000, x + 1, x) as x"), left.where("id <> 2500"), left.where("false")):
        slots = [r["slot"] for r in differing_slots(left, right).collect()]
        assert slots
        want = sorted(map(tuple, digest_differences(left, right).collect()))
        assert sorted(map(tuple, digest_differences(left, right, slots).collect())) == want != []


def test_sums_and_not_rows_are_exchanged(spark):
    """A check of equal tables groups by slot: whatever their size, a task passes
    on at most a row per slot, and nothing is grouped by row."""
    left = spark.range(20_000).selectExpr("id", "cast(id as string) as s")
    plan = differing_slots(left, left)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(slot" in plan and "hashpartitioning(row_md5" not in plan
