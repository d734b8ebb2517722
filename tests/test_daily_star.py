import pytest

from strata.operators import customer as C
from strata.plans import daily_star as D
from strata.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("customer_id", "customer_email_id", "customer_name_id", "customer_address_id",
                                       "customer_phone_id", "parent_customer_id").collect()), key=repr)


def test_three_days_equal_one_run_and_a_day_again_adds_nothing(spark, tmp_path, monkeypatch):
    m, d = FX.fx_match(spark, SF).cache(), FX.fx_demographic(spark, SF).cache()
    state, out = str(tmp_path / "state"), str(tmp_path / "customer")
    real, left = D._replace_parts, {"calls": 0}

    def dies_before_the_links(df, path):
        left["calls"] += 1
        if path.endswith("links") and left["calls"] == 4:
            raise RuntimeError("simulated failure")
        real(df, path)

    monkeypatch.setattr(D, "_replace_parts", dies_before_the_links)
    for day in range(3):
        now = (d.where(f"bid % 3 = {day}"), m.where(f"coalesce(bid, 0) % 5 % 3 = {day}"),
               d.where(f"bid % 3 <= {day}"), m.where(f"coalesce(bid, 0) % 5 % 3 <= {day}"))
        if day == 1:
            with pytest.raises(RuntimeError):
                D.update_customer(*now, state, out, parts=8)
        D.update_customer(*now, state, out, parts=8)
        assert rows(spark.read.parquet(out)) == rows(C.customer(now[3], now[2])), day
    assert rows(spark.read.parquet(out)) == rows(C.customer(m, d))
    D.update_customer(*now, state, out, parts=8)
    assert rows(spark.read.parquet(out)) == rows(C.customer(m, d))


def test_only_touched_clusters_are_rewritten(spark, tmp_path):
    import glob
    import os
    d = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").selectExpr(
        "c_custkey bid", "c_name email", "c_name firstname", "c_name lastname", "c_name address1", "c_name address2", "c_name city",
        "c_name state", "c_name zippost", "c_nationkey zipplus4", "c_name phone")
    m = d.selectExpr("bid", "bid div 3 as match_id")
    state, out = str(tmp_path / "state"), str(tmp_path / "customer")
    D.update_customer(d, m, d, m, state, out, parts=16)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{state}/links/part=*/*.parquet") + glob.glob(f"{out}/part=*/*.parquet")}
    # one bid below all others joins a cluster of three: its head changes
    day_m = spark.createDataFrame([(-5, 100)], "bid long, match_id long")
    day_d = d.where("bid = 7").selectExpr("cast(-5 as bigint) bid", *[c for c in d.columns if c != "bid"])
    touched = D.update_customer(day_d, day_m, d.unionByName(day_d), m.unionByName(day_m), state, out, parts=16)
    assert touched["clusters"] == 1 and touched["bids"] == 4 and touched["parts"] <= 4
    assert rows(spark.read.parquet(out)) == rows(C.customer(m.unionByName(day_m), d.unionByName(day_d)))
    same = [f for f, t in before.items() if os.path.exists(f) and os.path.getmtime(f) == t]
    assert len([f for f in same if "/links/" in f]) >= 15 and len([f for f in same if "/customer/" in f]) >= 12


def test_empty_day(spark, tmp_path):
    m, d = FX.fx_match(spark, SF), FX.fx_demographic(spark, SF)
    state, out = str(tmp_path / "state"), str(tmp_path / "customer")
    D.update_customer(d, m, d, m, state, out, parts=4)
    assert D.update_customer(d.limit(0), m.limit(0), d, m, state, out, parts=4) == {"clusters": 0, "bids": 0, "parts": 0}
    assert rows(spark.read.parquet(out)) == rows(C.customer(m, d))
