"""Property tests: the Spark formulations against brute-force Python versions
of the original SQL semantics on random small inputs."""
import base64
import hashlib
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import cdc as CDC
from strata.operators import customer as C
from strata.schemas import REGISTRY

DEM = ("bid long, email string, firstname string, lastname string, address1 string, "
       "address2 string, city string, state string, zippost string, zipplus4 long, phone string")


def h(text):
    return base64.b64encode(hashlib.md5(text.encode()).hexdigest().encode()).decode()


def low(x):
    return "" if x is None else x.lower()


def keys(d):
    bid, email, first, last, a1, a2, city, state, zp, z4, phone = d
    return (h(low(email)), h(low(first) + low(last)),
            h(low(a1) + low(a2) + low(city) + low(state) + (zp or "") + ("" if z4 is None else str(z4))),
            h(low(phone)))


def brute_customer(match, dem):
    inner = set()
    for mb, mid in match:
        for d in dem:
            if mb is not None and d[0] == mb:
                inner.add((mb, keys(d), mid))
    head = {}
    for bid, _, mid in inner:
        head[mid] = min(head.get(mid, bid), bid)
    return {(h(str(bid)), *k, None if head[mid] == bid else h(str(head[mid])))
            for bid, k, mid in inner}


text = st.sampled_from([None, "a", "A", "b", "ab", "Ab"])
dem_row = st.tuples(st.integers(0, 6), text, text, text, text, st.none(), text, text,
                    st.sampled_from([None, "Z1", "z1"]), st.sampled_from([None, 1, 2]), text)
match_row = st.tuples(st.one_of(st.none(), st.integers(0, 7)), st.one_of(st.none(), st.integers(0, 3)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(match_row, max_size=14), st.lists(dem_row, max_size=12), st.booleans())
def test_customer_matches_brute_force(spark, match, dem, force_hot):
    m = spark.createDataFrame(match, "bid long, match_id long")
    d = spark.createDataFrame(dem, DEM)
    kw = {"max_hot_clusters": 2, "min_hot_rows": 1} if force_hot else {}
    got = {tuple(r) for r in C.customer(m, d, **kw).collect()}
    assert got == brute_customer(match, dem)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**12, 10**12)),
                          st.one_of(st.none(), st.integers(0, 10**6)),
                          st.one_of(st.none(), st.text(max_size=8)),
                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32)),
                          st.booleans()), max_size=10))
def test_encode_decode_round_trip(spark, rows):
    """Typed values survive JSON text encoding (numbers quoted or not) and decoding."""
    spec = REGISTRY["T_Subscribed_Offer"]
    env = []
    for rid, bid, sold, rev, quote in rows:
        data = {"id": str(rid) if quote and rid is not None else rid, "bid": bid,
                "campaignid": None, "solddate": sold, "deliverystepid": None,
                "revenue": None if rev is None else (repr(float(rev)) if quote else float(rev))}
        env.append((json.dumps(data), json.dumps({"operation": "insert", "table-name": spec.name})))
    df = spark.createDataFrame(env, "data string, metadata string")
    got = [tuple(r) for r in CDC.decode_typed(CDC.decode_metadata(df), spec)
           .select("id", "bid", "solddate", "revenue").collect()]
    want = [(rid, bid, sold, None if rev is None else float(rev)) for rid, bid, sold, rev, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def brute_dimensions(match, base, dem):
    mb = {b for b, _ in match if b is not None}
    bb = {b for b, _ in base if b is not None}
    emails = {(h(low(e)), e) for b, e in base if b in mb}
    rows = [d for d in dem if d[0] in mb and d[0] in bb]
    addr = {(keys(d)[2], *d[4:10]) for d in rows}
    name = {(keys(d)[1], d[2], d[3]) for d in rows}
    phone = {(keys(d)[3], d[10]) for d in rows}
    demb = {d[0] for d in dem}
    xref = sorted((h(str(b)), b) for b, m in set(match) if b is not None and b in demb)
    return emails, addr, name, phone, xref


base_row = st.tuples(st.one_of(st.none(), st.integers(0, 7)), text)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(match_row, max_size=12), st.lists(base_row, max_size=10), st.lists(dem_row, max_size=12))
def test_dimensions_match_brute_force(spark, match, base, dem):
    m = spark.createDataFrame(match, "bid long, match_id long")
    b = spark.createDataFrame(base, "bid long, email string")
    d = spark.createDataFrame(dem, DEM)
    emails, addr, name, phone, xref = brute_dimensions(match, base, dem)
    assert {tuple(r) for r in C.customer_email(m, b).collect()} == emails
    assert {tuple(r) for r in C.customer_address(m, b, d).collect()} == addr
    assert {tuple(r) for r in C.customer_name(m, b, d).collect()} == name
    assert {tuple(r) for r in C.customer_phone(m, b, d).collect()} == phone
    assert sorted(tuple(r) for r in C.customer_xref(m, d).collect()) == xref
