from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import keys as K


def _one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_key_is_base64_of_hex_md5(spark):
    import base64
    import hashlib
    (k,) = _one(spark, [("Ab",)], "e string", K.email_key("e"))
    assert k == base64.b64encode(hashlib.md5(b"ab").hexdigest().encode()).decode()
    assert len(k) == 44


def test_null_hashes_as_empty_string(spark):
    a, b = _one(spark, [(None,), ("",)], "e string", K.email_key("e"))
    assert a == b


def test_case_variants_share_a_key(spark):
    a, b = _one(spark, [("X@Y",), ("x@y",)], "e string", K.email_key("e"))
    assert a == b


def test_composite_has_no_separator(spark):
    a, b = _one(spark, [("ab", "c"), ("a", "bc")], "f string, l string", K.name_key("f", "l"))
    assert a == b


def test_address_zip_not_lowered(spark):
    rows = [("A", None, "C", "S", "Zx", 1), ("a", None, "c", "s", "zx", 1)]
    schema = "address1 string, address2 string, city string, state string, zippost string, zipplus4 long"
    a, b = _one(spark, rows, schema, K.address_key())
    assert a != b


def test_entity_key_null_stays_null(spark):
    a, b = _one(spark, [(None,), (7,)], "bid long", K.entity_key("bid"))
    assert a is None and len(b) == 44


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=20))
def test_keys_always_44_chars(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "e string")
    out = df.select(F.length(K.email_key("e")).alias("n")).distinct().collect()
    assert [r.n for r in out] == [44]
