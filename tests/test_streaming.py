import json
import re
import time

import pytest

from pyspark.sql import functions as F

from strata.operators.cdc import decode_metadata, metadata_columns
from strata.plans import jobs as J
from strata.schemas import REGISTRY
from strata.sinks.files import write_parquet
from strata.streaming import incremental as INC
from strata.streaming import landing as LAND


def test_incremental_each_row_once(spark, tmp_path):
    src, dst, ck = (str(tmp_path / n) for n in ("src", "dst", "ck"))
    counts = []
    for lo, hi in ((0, 100), (100, 100), (100, 150)):
        if hi > lo:
            write_parquet(spark.range(lo, hi), src)
        INC.incremental_copy(spark, src, spark.range(1).schema, dst, ck)
        counts.append(spark.read.parquet(dst).count())
    assert counts == [100, 100, 150]
    assert spark.read.parquet(dst).distinct().count() == 150


def test_foreach_skips_empty_runs(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    seen = []
    write_parquet(spark.range(3), src)
    INC.incremental_foreach(spark, src, spark.range(1).schema, ck, lambda df, i: seen.append((i, df.count())))
    INC.incremental_foreach(spark, src, spark.range(1).schema, ck, lambda df, i: seen.append((i, df.count())))
    assert seen == [(0, 3)]


def test_a_load_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    name = INC.load_name("ck", 3)
    assert name == INC.load_name("ck/", 3) != INC.load_name("ck", 4) != INC.load_name("other", 4)
    assert INC.write_load(spark.range(3), path, name, {"top": F.max("id")}) == {"rows": 3, "top": 2}
    assert INC.write_load(spark.range(9), path, name) == {}             # complete: left as it is
    (tmp_path / "t" / f"load={name}" / "_SUCCESS").unlink()             # an attempt that did not end
    assert INC.write_load(spark.range(4), path, name) == {"rows": 4}
    assert INC.write_load(spark.range(0), path, INC.load_name("ck", 5)) == {"rows": 0}
    assert [r.id for r in spark.read.parquet(path).orderBy("id").collect()] == [0, 1, 2, 3]
    assert [p.name for p in (tmp_path / "t").iterdir()] == [f"load={name}"]


def test_landing_keeps_json_text(spark, tmp_path):
    inbox, landing, ck = (str(tmp_path / n) for n in ("inbox", "landing", "ck"))
    msgs = [json.dumps({"data": {"bid": 1}, "metadata": {"operation": "insert", "table-name": "T_BaseID"}})]
    spark.createDataFrame([(m,) for m in msgs], "value string").write.text(inbox)
    LAND.cdc_land_stream(LAND.message_file_stream(spark, inbox), landing, ck, available_now=True, routed=False).awaitTermination()
    out = spark.read.parquet(landing)
    assert out.columns == ["data", "metadata"]
    (r,) = metadata_columns(decode_metadata(out)).collect()
    assert (r.operation, r.table_name) == ("insert", "T_BaseID")


def test_cdc_to_transient_incremental(spark, tmp_path):
    landing, transient, ck = (str(tmp_path / n) for n in ("landing", "transient", "ck"))

    def batch(bids):
        rows = [(json.dumps({"bid": str(b), "email": f"e{b}"}),
                 json.dumps({"operation": "insert", "table-name": "T_BaseID"})) for b in bids]
        write_parquet(spark.createDataFrame(rows, "data string, metadata string"), landing)

    batch([1, 2])
    J.cdc_to_transient(spark, landing, transient, "insert", ck, routed=False)
    batch([3])
    J.cdc_to_transient(spark, landing, transient, "insert", ck, routed=False)
    J.cdc_to_transient(spark, landing, transient, "insert", ck, routed=False)
    got = sorted(r.bid for r in spark.read.parquet(transient + "/t_baseid").collect())
    assert got == [1, 2, 3]


def test_routed_landing_and_cdc_job_match_unrouted(spark, tmp_path):
    from strata.plans import fixtures as FX
    env = FX.fx_cdc(spark, "/root/testdata/sf0.001")
    msgs = env.select(F.concat(F.lit('{"data":'), F.col("data"), F.lit(',"metadata":'),
                               F.col("metadata"), F.lit("}")).alias("value"))
    inbox = str(tmp_path / "inbox")
    msgs.write.text(inbox)
    results = {}
    for routed in (False, True):
        land, ck, tr = (str(tmp_path / f"{n}{routed}") for n in ("land", "ck", "tr"))
        LAND.cdc_land_stream(LAND.message_file_stream(spark, inbox), land, ck + "/land",
                             available_now=True, routed=routed).awaitTermination()
        J.cdc_to_transient(spark, land, tr, "insert", ck + "/cdc", routed=routed)
        results[routed] = {t: sorted(map(tuple, spark.read.parquet(f"{tr}/{t}").drop("load").collect()))
                           for t in ("t_subscribed_offer", "t_visited_affiliate",
                                     "t_demographic_tag", "t_demographic_survey")}
    assert results[False] == results[True]
    assert sum(len(v) for v in results[True].values()) > 0
    import os
    assert os.path.isdir(str(tmp_path / "landTrue" / "operation=insert" / "table_name=T_Demographic_Tag"))


def test_old_files_are_read(spark, tmp_path):
    import os
    import time
    src, dst, ck = (str(tmp_path / n) for n in ("src", "dst", "ck"))
    write_parquet(spark.range(20).coalesce(1), src)
    INC.incremental_copy(spark, src, spark.range(1).schema, dst, ck)
    write_parquet(spark.range(20, 30).coalesce(1), str(tmp_path / "late"))
    for f in os.listdir(tmp_path / "late"):
        if f.endswith(".parquet"):
            old = time.time() - 30 * 86400
            os.utime(tmp_path / "late" / f, (old, old))
            os.rename(tmp_path / "late" / f, os.path.join(src, f))
    INC.incremental_copy(spark, src, spark.range(1).schema, dst, ck)
    assert spark.read.parquet(dst).count() == 30


def test_a_timed_landing_drains_a_backlog_in_one_batch(spark, tmp_path):
    import os
    inbox, landing, ck = (str(tmp_path / n) for n in ("inbox", "landing", "ck"))
    for i in range(6):
        msg = json.dumps({"data": {"bid": i}, "metadata": {"operation": "insert", "table-name": "T_BaseID"}})
        spark.createDataFrame([(msg,)], "value string").coalesce(1).write.mode("append").text(inbox)
    q = LAND.cdc_land_stream(LAND.message_file_stream(spark, inbox), landing, ck)
    commits = os.path.join(ck, "commits")

    def done() -> list[str]:
        return [c for c in os.listdir(commits) if c.isdigit()] if os.path.isdir(commits) else []

    # the first batch comes at once, the next one at the trigger's next time: wait for the first alone
    deadline = time.monotonic() + 120
    try:
        while not done() and q.isActive and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        q.stop()
    assert done() == ["0"]
    assert spark.read.parquet(landing).count() == 6


def _die_at(monkeypatch, when: str):
    """Die once in a micro-batch: while it is written, or right after, before
    the stream has noted it."""
    real, state = INC.write_load, {"left": 1}

    def write(df, table_path, load, metrics=None):
        if state["left"] and when == "before":
            state["left"] -= 1
            df.limit(1).write.parquet(f"{table_path}/load={load}/_temporary/0")     # what a dead attempt leaves
            raise RuntimeError("simulated driver failure")
        out = real(df, table_path, load, metrics)
        if state["left"]:
            state["left"] -= 1
            raise RuntimeError("simulated driver failure")
        return out

    monkeypatch.setattr(INC, "write_load", write)


def test_refined_replay_neither_loses_nor_doubles_rows(spark, tmp_path):
    """The sink's log knows the batch although the stream does not: it runs again
    and adds nothing, whatever the load time is by then."""
    import os
    src, dst, ck = (str(tmp_path / n) for n in ("transient", "refined", "ck"))
    write_parquet(spark.range(20), src)
    J.transient_to_refined(spark, src, dst, ck, "u", "p", "s", as_of="2024-01-02 00:00:00")
    for name in os.listdir(f"{ck}/stream/commits"):
        os.remove(f"{ck}/stream/commits/{name}")
    J.transient_to_refined(spark, src, dst, ck, "u", "p", "s", as_of="2024-01-03 00:00:00")
    out = spark.read.parquet(dst)
    assert out.count() == 20 and out.select("id").distinct().count() == 20


def test_refined_ignores_files_of_a_dead_attempt(spark, tmp_path):
    import os
    src, dst, ck = (str(tmp_path / n) for n in ("transient", "refined", "ck"))
    write_parquet(spark.range(20), src)
    J.transient_to_refined(spark, src, dst, ck, "u", "p", "s", as_of="2024-01-02 00:00:00")
    for folder in ("commits", "../../refined/_spark_metadata"):     # neither log has the batch
        for name in os.listdir(f"{ck}/stream/{folder}"):
            os.remove(f"{ck}/stream/{folder}/{name}")
    J.transient_to_refined(spark, src, dst, ck, "u", "p", "s", as_of="2024-01-03 00:00:00", zone="dead_zone")
    assert spark.read.parquet(dst).count() == 20
    assert spark.table("dead_zone.refined").count() == 20
    spark.sql("DROP DATABASE dead_zone CASCADE")


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("operations", ["insert", ("insert", "update")])
def test_change_replay_neither_loses_nor_doubles_rows(spark, tmp_path, monkeypatch, when, operations):
    landing, transient, ck = (str(tmp_path / n) for n in ("landing", "transient", "ck"))
    rows = []
    for b in range(6):
        for op in ("insert", "update"):
            rows.append((json.dumps({"bid": str(b), "email": f"e{b}"}), json.dumps({"operation": op, "table-name": "T_BaseID"})))
            rows.append((json.dumps({"bid": str(b), "tagaid": "1"}), json.dumps({"operation": op, "table-name": "T_Demographic_Tag"})))
    write_parquet(spark.createDataFrame(rows, "data string, metadata string"), landing)
    _die_at(monkeypatch, when)
    with pytest.raises(Exception):
        J.cdc_to_transient(spark, landing, transient, operations, ck, routed=False)
    J.cdc_to_transient(spark, landing, transient, operations, ck, routed=False)
    suffixes = [""] if operations == "insert" else ["", "_cdc_update"]
    for table in [t + s for t in ("t_baseid", "t_demographic_tag") for s in suffixes]:
        assert sorted(r.bid for r in spark.read.parquet(f"{transient}/{table}").collect()) == list(range(6)), table


def test_each_route_reads_only_its_own_files(spark, tmp_path):
    """The files in a route's micro-batches, and the scan in its plan."""
    from strata.operators.cdc import route_rows
    from strata.plans import fixtures as FX
    from strata.schemas import ROUTED_ENVELOPE_SCHEMA
    inbox, landing = str(tmp_path / "inbox"), str(tmp_path / "landing")
    FX.fx_cdc(spark, "/root/testdata/sf0.001").select(F.concat(
        F.lit('{"data":'), F.col("data"), F.lit(',"metadata":'), F.col("metadata"), F.lit("}")).alias("value")).write.text(inbox)
    LAND.cdc_land_stream(LAND.message_file_stream(spark, inbox), landing, str(tmp_path / "ck"), available_now=True).awaitTermination()
    for op, table in (("insert", "T_BaseID"), ("update", "T_Demographic_Tag")):
        files = []

        def look(batch, batch_id):
            files.extend(r.file for r in batch.select("file").distinct().collect())

        stream = INC.incremental_source(spark, landing, ROUTED_ENVELOPE_SCHEMA)
        named = stream.where((F.col("operation") == op) & (F.col("table_name") == table)).select(F.col("_metadata.file_path").alias("file"))
        INC.run_available_now(named.writeStream.foreachBatch(look).option("checkpointLocation", str(tmp_path / f"look-{op}")))
        assert files and all(f"operation={op}/table_name={table}/" in f for f in files)
        out = route_rows(stream, op, REGISTRY[table]).writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"noop-{op}")).trigger(availableNow=True).start()
        out.awaitTermination()
        plans = out._jsq.explainInternal(False)
        assert re.search(r"PartitionFilters: \[isnotnull\((operation|table_name)#", plans)
        assert "ReadSchema: struct<data:string>" in plans, "the metadata text is not read"


def test_counts_are_observed_in_the_write(spark, tmp_path):
    landing, transient, ck = (str(tmp_path / n) for n in ("landing", "transient", "ck"))
    meta = json.dumps({"operation": "insert", "table-name": "T_BaseID"})
    rows = [(json.dumps({"bid": "1", "email": "a"}), meta), (json.dumps({"bid": "x", "email": "b"}), meta), ("not json", meta), (None, meta)]
    write_parquet(spark.createDataFrame(rows, "data string, metadata string"), landing)
    rejects = str(tmp_path / "rejects")
    assert J.cdc_to_transient(spark, landing, transient, "insert", ck, routed=False, rejects_root=rejects) == {
        "t_baseid": {"rows": 4, "undecoded": 2, "rejected": 1}}
    assert spark.read.parquet(transient + "/t_baseid").columns == [f.name for f in REGISTRY["T_BaseID"].json_schema.fields] + ["load"]
    kept = spark.read.parquet(rejects + "/t_baseid").drop("load").collect()
    assert sorted(map(tuple, kept), key=str) == [("T_BaseID", "bid", "x"), ("T_BaseID", None, "not json"), ("T_BaseID", None, None)]
    assert J.cdc_to_transient(spark, landing, transient, "insert", ck, routed=False) == {"t_baseid": {}}


def test_byte_capped_batches_each_row_once(spark, tmp_path):
    src, dst, ck = (str(tmp_path / n) for n in ("src", "dst", "ck"))
    for lo in range(0, 50, 10):
        write_parquet(spark.range(lo, lo + 10).coalesce(1), src)
    INC.incremental_copy(spark, src, spark.range(1).schema, dst, ck, max_bytes_per_trigger=1)
    out = spark.read.parquet(dst)
    assert out.count() == 50 and out.distinct().count() == 50
    import os
    commits = os.listdir(os.path.join(ck, "commits"))
    assert len([c for c in commits if c.isdigit()]) == 5  # one file per micro-batch


def test_all_operations_in_one_decode_equal_separate_runs(spark, tmp_path):
    from strata.plans import fixtures as FX
    env = FX.fx_cdc(spark, "/root/testdata/sf0.001")
    land = str(tmp_path / "land")
    write_parquet(env, land)
    sep, one = str(tmp_path / "sep"), str(tmp_path / "one")
    for op in ("insert", "update"):
        J.cdc_to_transient(spark, land, sep, op, str(tmp_path / f"ck_{op}"), routed=False)
    J.cdc_to_transient(spark, land, one, ("insert", "update"), str(tmp_path / "ck_all"), routed=False)
    import os
    folders = sorted(f for f in os.listdir(sep) if not f.startswith((".", "_")))
    assert folders == sorted(f for f in os.listdir(one) if not f.startswith((".", "_")))
    assert len(folders) == 20
    for f in folders:
        a = sorted(map(tuple, spark.read.parquet(f"{sep}/{f}").drop("load").collect()), key=repr)
        b = sorted(map(tuple, spark.read.parquet(f"{one}/{f}").drop("load").collect()), key=repr)
        assert a == b, f
