import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import schema_ops as SO
from strata.operators.audit import audit_columns
from strata.sinks.files import write_csv_pipe, write_parquet, write_refined
from strata.sources import catalog as CAT
from strata.sources import files as SRC


def test_conform_missing_new_retyped(spark):
    reg = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()),
                        T.StructField("c", T.StringType())])
    df = spark.createDataFrame([("1", "x"), ("oops", "y")], "a string, extra string")
    out = SO.conform_to_schema(df, reg)
    assert out.columns == ["a", "b", "c", "extra"]
    assert [(r.a, r.b, r.c, r.extra) for r in out.collect()] == [(1, None, None, "x"), (None, None, None, "y")]


def test_union_count_is_sum(spark):
    a = spark.range(5).withColumn("x", F.lit(1))
    b = spark.range(3)
    assert SO.union_full_load_and_cdc(a, b).count() == 8


def test_merge_schema(spark, tmp_path):
    p = str(tmp_path / "t")
    write_parquet(spark.createDataFrame([(1,)], "a long"), p)
    write_parquet(spark.createDataFrame([(2, "z")], "a long, b string"), p)
    out = SO.merge_compatible_schemas(spark, p)
    assert sorted(out.columns) == ["a", "b"] and out.count() == 2


def test_csv_round_trip_with_pipes_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a|b "q"'), (2, None)], "id long, s string")
    p = str(tmp_path / "csv")
    write_csv_pipe(df, p, mode="overwrite")
    back = SRC.scan_csv_pipe(spark, p, schema=df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    assert open(next((tmp_path / "csv").glob("part-*"))).readline().strip() == "id|s"


def test_audit_columns_pinned(spark):
    out = audit_columns(spark.range(1), "u", "p", "s", as_of="2020-05-12 01:02:03").collect()[0]
    assert (out.create_year, out.create_month, out.create_date) == (2020, 5, 12)
    assert str(out.created_date) == "2020-05-12" and out.create_user == "u"


def test_refined_partitions_and_pruned_scan(spark, tmp_path):
    p = str(tmp_path / "refined")
    for day in ("2020-05-12 00:00:00", "2020-07-20 00:00:00", "2020-07-02 00:00:00"):
        write_refined(audit_columns(spark.range(2), "u", "p", "s", as_of=day), p)
    got = SRC.scan_partition_pruned(spark, p, 2020, 5, 7, 1, 15)
    assert sorted({r.create_date for r in got.collect()}) == [2, 12]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()


def test_catalog_register_and_select(spark, tmp_path):
    p = str(tmp_path / "zone" / "tbl_a")
    write_parquet(spark.range(3), p)
    write_parquet(spark.range(2), str(tmp_path / "zone" / "other"))
    names = CAT.register_folder_tables(spark, "test_zone", str(tmp_path / "zone"), prefix="fig_")
    assert names == ["test_zone.fig_other", "test_zone.fig_tbl_a"]
    assert CAT.select_tables(spark, "test_zone", "fig_t%") == ["fig_tbl_a"]
    assert CAT.scan_catalog_table(spark, "test_zone", "fig_tbl_a").count() == 3


def test_catalog_partitioned_table(spark, tmp_path):
    p = str(tmp_path / "part")
    write_refined(audit_columns(spark.range(4), "u", "p", "s", as_of="2021-01-02 00:00:00"), p)
    CAT.create_zone(spark, "test_zone2")
    CAT.register_table(spark, "test_zone2", "t", p, partition_by=("create_year", "create_month", "create_date"))
    assert spark.sql("select count(*) c from test_zone2.t where create_year = 2021").collect()[0].c == 4


def test_match_clusters_typed(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("bid,match_id\n1,10\nx,11\n")
    rows = SRC.scan_match_clusters(spark, str(p)).collect()
    assert [(r.bid, r.match_id) for r in rows] == [(1, 10), (None, 11)]


def test_match_columns_are_found_by_name(spark, tmp_path):
    import pytest
    p = tmp_path / "wide.csv"
    p.write_text("email,bid,match_id,score\nx@y,7,3,0.5\nz@y,n/a,4,0.1\n")
    assert sorted(map(tuple, SRC.scan_match_clusters(spark, str(p)).collect()), key=repr) == [(7, 3), (None, 4)]
    p.write_text("match_id,bid\n3,7\n")
    assert [tuple(r) for r in SRC.scan_match_clusters(spark, str(p)).collect()] == [(7, 3)]
    p.write_text("bid,cluster\n7,3\n")
    with pytest.raises(ValueError):
        SRC.scan_match_clusters(spark, str(p))


def test_csv_round_trip_of_awkward_values(spark, tmp_path):
    from strata.sinks.files import write_csv_pipe
    rows = [(1, "a\nb\r\nc", 0.1, [1.5, None]), (2, "back\\nslash \\\\ end\\", None, []), (3, 'q"u|o"te', 1e-300, None), (4, None, 2.0, [2.0]),
            (5, "tail\\\n", 3.0, [1.0])]
    df = spark.createDataFrame(rows, "id long, t string, x double, v array<double>")
    path = str(tmp_path / "csv")
    write_csv_pipe(df.coalesce(1), path)
    back = SRC.scan_csv_named(spark, path, df.schema, escaped_breaks=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert spark.read.text(path).count() == len(rows) + 1          # a line per row


def test_vanished_folders_are_named_and_marked(spark, tmp_path):
    import shutil
    zone = "vanish_zone"
    CAT.create_zone(spark, zone, str(tmp_path / "db"))
    for t in ("a", "b"):
        write_parquet(spark.range(3), str(tmp_path / t))
        CAT.register_table(spark, zone, t, str(tmp_path / t))
    shutil.rmtree(tmp_path / "b")
    assert CAT.vanished_tables(spark, zone, deprecate=False) == ["b"]
    assert CAT.vanished_tables(spark, zone) == ["b"]
    assert spark.sql(f"show tblproperties {zone}.b ('deprecated')").first()[1] == "true"


def test_crawl_csv_folders_with_inference(spark, tmp_path):
    root = tmp_path / "raw"
    write_csv_pipe(spark.createDataFrame([(1, "a", 2.5)], "id int, s string, x double"), str(root / "t_one"))
    write_csv_pipe(spark.createDataFrame([(7, "b")], "k int, v string"), str(root / "t_two"))
    names = CAT.register_folder_tables(spark, "raw_zone_t", str(root), fmt="csv",
                                       options={"inferSchema": "true"})
    assert names == ["raw_zone_t.t_one", "raw_zone_t.t_two"]
    t = CAT.scan_catalog_table(spark, "raw_zone_t", "t_one")
    assert t.schema.simpleString() == "struct<id:int,s:string,x:double>"
    assert [tuple(r) for r in t.collect()] == [(1, "a", 2.5)]


def test_evolve_table_appends_new_columns(spark, tmp_path):
    p = str(tmp_path / "ev")
    write_parquet(spark.createDataFrame([(1, "a")], "id long, s string"), p)
    CAT.create_zone(spark, "evo_zone")
    CAT.register_table(spark, "evo_zone", "t", p)
    batch = spark.createDataFrame([("2", "b", 9.5)], "id string, s string, extra double")
    added = CAT.evolve_table(spark, "evo_zone", "t", batch.schema)
    assert added == ["extra"]
    conformed = SO.conform_to_schema(batch, spark.table("evo_zone.t").schema)
    conformed.write.mode("append").parquet(p)
    spark.sql("REFRESH TABLE evo_zone.t")
    rows = sorted(tuple(r) for r in spark.table("evo_zone.t").collect())
    assert rows == [(1, "a", None), (2, "b", 9.5)]
    assert CAT.evolve_table(spark, "evo_zone", "t", batch.schema) == []


def test_checkpoint_dir_comes_from_session(spark):
    from strata.session import ensure_checkpoint_dir, scratch_path
    root = ensure_checkpoint_dir(spark)
    assert root and scratch_path(spark, "x").startswith(root + "/strata-scratch/")


def test_common_types():
    from pyspark.sql import types as T

    from strata.operators.schema_ops import common_schema, common_type
    parse = T._parse_datatype_string
    cases = {("int", "bigint"): "bigint", ("tinyint", "smallint"): "smallint", ("int", "double"): "double", ("float", "double"): "double",
             ("bigint", "decimal(10,2)"): "decimal(22,2)", ("decimal(10,2)", "decimal(8,4)"): "decimal(12,4)",
             ("decimal(38,0)", "decimal(38,10)"): "string", ("date", "timestamp"): "timestamp", ("boolean", "int"): "string",
             ("string", "bigint"): "string", ("void", "int"): "int", ("array<int>", "array<bigint>"): "array<bigint>",
             ("map<string,int>", "map<string,double>"): "map<string,double>",
             ("struct<a:int,b:string>", "struct<A:bigint,c:date>"): "struct<a:bigint,b:string,c:date>"}
    for (a, b), want in cases.items():
        assert common_type(parse(a), parse(b)).simpleString() == want, (a, b)
        if "struct" not in a:
            assert common_type(parse(b), parse(a)).simpleString() == want, (b, a)
    with pytest.raises(TypeError):
        common_type(parse("int"), parse("array<int>"))
    assert common_schema([T.StructType()]).fields == []


def test_merge_widens_and_reads_each_group_once(spark, tmp_path):
    from strata.operators import schema_ops as S
    path = str(tmp_path / "t")
    ddls = ["id int, v int, s struct<a:int>, day string", "id bigint, s struct<a:bigint,b:string>, day string",
            "id bigint, v double, s struct<a:bigint,b:string>, day string"]
    rows = [(1, 2, (3,), "a"), (2 ** 40, (2 ** 41, "x"), "b"), (5, 1.5, (7, None), "a")]
    for ddl, row in zip(ddls, rows):
        spark.createDataFrame([row] * 3, ddl).repartition(3).write.mode("append").partitionBy("day").parquet(path)
    out = S.merge_compatible_schemas(spark, path)
    assert sorted({(r.id, r.v, r.s.a, r.s.b, r.day) for r in out.collect()}, key=str) == sorted(
        [(1, 2.0, 3, None, "a"), (2 ** 40, None, 2 ** 41, "x", "b"), (5, 1.5, 7, None, "a")], key=str)
    assert out.count() == 9
    groups = S.schema_groups(spark, S.data_files(spark, [path]), {"basePath": path})
    assert len(groups) == 2 and sorted(len(f) for _, f in groups) in ([3, 6], [1, 8], [2, 7])
    plan = out.where("day = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(groups) and "PartitionFilters: [isnotnull(day" in plan


def test_a_damaged_file_is_an_error(spark, tmp_path):
    from strata.operators.schema_ops import merge_compatible_schemas
    spark.range(3).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-x.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        merge_compatible_schemas(spark, str(tmp_path / "t")).count()
