import os

from pyspark.sql import functions as F

from strata.functions import keys as K
from strata.operators import integrity as INT
from strata.session import delete_path
from strata.sinks.files import write_parquet
from strata.sources import catalog as CAT
from strata.sources import crawl as CRAWL


def test_dangling_keys_counts_and_skips_null(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("b", 1), ("b", 2)], "id string, x int")
    assert [tuple(r) for r in INT.dangling_keys(facts, "k", dim, "id").collect()] == [("a", 2)]
    assert INT.dangling_keys(facts.limit(0), "k", dim, "id").count() == 0


def test_collisions_compare_what_the_key_reads(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("A", "BC"), ("x", None), ("x", ""), (None, "x"), ("p|", "q"), ("p", "|q")],
                                 "a string, b string")
    got = sorted((r["sources"], r["n_sources"]) for r in INT.key_collisions(rows, K.key_composite("a", "b"), ["a", "b"]).collect())
    assert got == [("ab|c, a|bc", 2), ("p||q, p||q", 2), ("x|, |x", 2)]


def test_collisions_show_some_and_count_all(spark):
    rows = spark.range(1, 40).select(F.expr("repeat('a', cast(id as int))").alias("a"), F.expr("repeat('a', cast(40 - id as int))").alias("b"))
    (r,) = INT.key_collisions(rows, K.key_composite("a", "b"), ["a", "b"], shown=3).collect()
    assert r["n_sources"] == 39 and len(r["sources"].split(", ")) == 3


def _states(report):
    return {r["folder"]: (r["state"], r["new"], r["changed"], r["vanished"]) for r in report}


def test_crawl_touches_only_what_differs(spark, tmp_path, monkeypatch):
    root, manifest = str(tmp_path / "zone"), str(tmp_path / "manifest")
    write_parquet(spark.range(3).coalesce(1), root + "/a")
    write_parquet(spark.range(4).withColumn("day", F.lit("x/y z")).coalesce(1), root + "/b", partition_by=("day",))
    assert _states(CRAWL.crawl(spark, "crawl_zone", root, manifest)) == {"a": ("new", 1, 0, 0), "b": ("new", 1, 0, 0)}
    touched = []
    real = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (touched.append(q), real(q, *a, **k))[1])
    assert _states(CRAWL.crawl(spark, "crawl_zone", root, manifest)) == {"a": ("same", 0, 0, 0), "b": ("same", 0, 0, 0)}
    assert not any("ALTER" in q or "CREATE TABLE" in q for q in touched)
    write_parquet(spark.range(2).withColumn("note", F.lit("n")).withColumn("day", F.lit("new")).coalesce(1), root + "/b", partition_by=("day",))
    (data,) = [f for f in os.listdir(root + "/a") if f.startswith("part-")]
    os.utime(f"{root}/a/{data}", (1, 1))
    assert _states(CRAWL.crawl(spark, "crawl_zone", root, manifest)) == {"a": ("changed", 0, 1, 0), "b": ("changed", 1, 0, 0)}
    assert not any("RECOVER" in q for q in touched)
    assert spark.table("crawl_zone.b").where("day = 'new'").select("note").distinct().collect()[0]["note"] == "n"
    assert spark.table("crawl_zone.b").count() == 6
    delete_path(spark, root + "/a")
    assert _states(CRAWL.crawl(spark, "crawl_zone", root, manifest))["a"] == ("vanished", 0, 0, 1)
    assert spark.catalog.tableExists("crawl_zone.a")
    assert spark.sql("SHOW TBLPROPERTIES crawl_zone.a").where("key = 'deprecated'").count() == 1
    assert CAT.vanished_tables(spark, "crawl_zone", deprecate=False) == ["a"]
    # a crawl that died before its manifest was complete is done again
    os.remove(f"{manifest}/3/_SUCCESS")
    assert _states(CRAWL.crawl(spark, "crawl_zone", root, manifest))["a"] == ("vanished", 0, 0, 1)
    spark.sql("DROP DATABASE crawl_zone CASCADE")


def test_crawl_of_an_empty_zone(spark, tmp_path):
    assert CRAWL.crawl(spark, "crawl_none", str(tmp_path / "none"), str(tmp_path / "m")) == []
    spark.sql("DROP DATABASE crawl_none CASCADE")
