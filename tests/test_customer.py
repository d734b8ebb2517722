from strata.functions.keys import entity_key
from strata.operators import customer as C

MATCH = "bid long, match_id long"
BASE = "bid long, email string"
DEM = ("bid long, email string, firstname string, lastname string, address1 string, "
       "address2 string, city string, state string, zippost string, zipplus4 long, phone string")


def dem(bid, email="a@b", first="F", last="L", phone="1"):
    return (bid, email, first, last, "1 Main", None, "City", "ST", "00000", 1, phone)


def frames(spark, match, base, demo):
    return (spark.createDataFrame(match, MATCH), spark.createDataFrame(base, BASE),
            spark.createDataFrame(demo, DEM))


def test_parent_link_head_and_members(spark):
    m, _, d = frames(spark, [(5, 1), (3, 1), (9, 1), (4, 2)], [], [dem(5), dem(9), dem(4)])
    got = {(r.bid, r.match_id, r.parent_bid) for r in C.parent_link(m, d).collect()}
    # bid 3 has no demographic row, so the head of cluster 1 is 5, not 3
    assert got == {(5, 1, None), (9, 1, 5), (4, 2, None)}


def test_null_match_id_is_one_cluster(spark):
    m, _, d = frames(spark, [(7, None), (8, None)], [], [dem(7), dem(8)])
    got = {(r.bid, r.parent_bid) for r in C.parent_link(m, d).collect()}
    assert got == {(7, None), (8, 7)}


def test_bid_in_two_clusters(spark):
    m, _, d = frames(spark, [(2, 1), (1, 1), (2, 9)], [], [dem(1), dem(2)])
    xref = sorted(r.bid for r in C.customer_xref(m, d).collect())
    assert xref == [1, 2, 2]
    cust = C.customer(m, d).collect()
    assert len(cust) == 3  # bid 2 has two parents: bid 1 and itself (head of cluster 9)


def test_customer_rows_per_demographic_version(spark):
    m, _, d = frames(spark, [(1, 1)], [], [dem(1, phone="1"), dem(1, phone="2"), dem(1, phone="2")])
    rows = C.customer(m, d).collect()
    assert len(rows) == 2 and len({r.customer_id for r in rows}) == 1


def test_email_dimension_uses_baseid_email(spark):
    m, b, d = frames(spark, [(1, 1), (2, 1)], [(1, "Old@X"), (1, "old@x"), (3, "n@z")],
                     [dem(1, email="new@x")])
    rows = C.customer_email(m, b).collect()
    assert sorted(r.email for r in rows) == ["Old@X", "old@x"]
    assert len({r.customer_email_id for r in rows}) == 1


def test_address_requires_baseid(spark):
    m, b, d = frames(spark, [(1, 1), (2, 1)], [(1, "a")], [dem(1), dem(2, first="Z")])
    names = {(r.firstname, r.lastname) for r in C.customer_name(m, b, d).collect()}
    assert names == {("F", "L")}


def test_customer_parent_id_is_head_key(spark):
    m, _, d = frames(spark, [(1, 1), (2, 1)], [], [dem(1), dem(2)])
    got = {r.customer_id: r.parent_customer_id for r in C.customer(m, d).collect()}
    k = {r.bid: r.k for r in spark.createDataFrame([(1,), (2,)], "bid long")
         .select("bid", entity_key("bid").alias("k")).collect()}
    assert got == {k[1]: None, k[2]: k[1]}


def test_empty_inputs(spark):
    m, b, d = frames(spark, [], [], [])
    for df in C.customer_star(m, b, d).values():
        assert df.count() == 0


def test_hot_cluster_split_matches_plain(spark):
    # one giant cluster, a NULL cluster and small ones; force the hot path
    match = [(b, 1) for b in range(10, 60)] + [(b, None) for b in range(60, 80)] + [(3, 2), (4, 2)]
    demo = [dem(b) for b in list(range(10, 80)) + [3, 4]]
    m, _, d = frames(spark, match, [], demo)
    hot = {tuple(r) for r in C.parent_link(m, d, max_hot_clusters=4, min_hot_rows=5).collect()}
    plain = {tuple(r) for r in C.parent_link(m, d).collect()}
    assert hot == plain
    assert (11, 1, 10) in hot and (61, None, 60) in hot and (4, 2, 3) in hot


def test_hot_keys_are_bounded(spark):
    from strata.operators.skew import hot_keys
    lk = spark.createDataFrame([(i, i) for i in range(100)], "k long, n long")
    assert sorted(r.k for r in hot_keys(lk, "n", max_hot_keys=3, min_hot_rows=50).collect()) == [97, 98, 99]
    assert sorted(r.k for r in hot_keys(lk, "n", max_hot_keys=30, min_hot_rows=95).collect()) == [96, 97, 98, 99]
