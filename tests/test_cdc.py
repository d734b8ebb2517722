import json

import pytest

from strata.operators import cdc as CDC
from strata.schemas import REGISTRY, table_spec


def env(spark, rows):
    """rows: (data obj|text|None, metadata obj|text|None)"""
    def enc(x):
        return x if x is None or isinstance(x, str) else json.dumps(x)
    return spark.createDataFrame([(enc(d), enc(m)) for d, m in rows], "data string, metadata string")


def md(op, table, ts="2024-01-05T10:11:12.123456Z"):
    return {"operation": op, "record-type": "data", "schema-name": "db", "table-name": table,
            "timestamp": ts}


def test_malformed_metadata_never_matches(spark):
    e = env(spark, [({"bid": 1}, "not json"), ({"bid": 1}, None), ({"bid": 1}, "")])
    assert CDC.filter_operation(CDC.decode_metadata(e), "insert").count() == 0


def test_deletes_and_control_records_dropped(spark):
    e = env(spark, [({"bid": 1}, md("delete", "T_BaseID")), ({}, {"operation": "load", "record-type": "control"}),
                    ({"bid": "2"}, md("insert", "T_BaseID"))])
    ins = CDC.filter_operation(CDC.decode_metadata(e), "insert")
    assert [r.bid for r in CDC.decode_typed(ins, REGISTRY["T_BaseID"]).collect()] == [2]


def test_string_encoded_and_malformed_numbers(spark):
    e = env(spark, [({"id": "7", "bid": 3, "revenue": "1.5", "deliverystepid": "n/a"},
                     md("insert", "T_Subscribed_Offer")),
                    ({"id": "12.5", "bid": "x"}, md("insert", "T_Subscribed_Offer"))])
    rows = CDC.decode_typed(CDC.decode_metadata(e), REGISTRY["T_Subscribed_Offer"]).orderBy("revenue").collect()
    by = {r.revenue: r for r in rows}
    assert by[1.5].id == 7 and by[1.5].bid == 3 and by[1.5].deliverystepid is None
    assert by[None].id is None and by[None].bid is None  # no truncation of 12.5


def test_booleans_and_bvphone_stays_text(spark):
    e = env(spark, [({"bid": "1", "gender": "M", "bvemail": "1", "bvaddress": "true", "bvphone": "1"},
                     md("insert", "T_Demographic"))])
    (r,) = CDC.decode_typed(CDC.decode_metadata(e), REGISTRY["T_Demographic"]).collect()
    assert r.gender is None and r.bvemail is True and r.bvaddress is True and r.bvphone == "1"


def test_malformed_data_gives_null_row(spark):
    e = env(spark, [("{broken", md("insert", "T_BaseID"))])
    (r,) = CDC.decode_typed(CDC.decode_metadata(e), REGISTRY["T_BaseID"]).collect()
    assert all(v is None for v in r)


def test_frequency_and_allowed_tables(spark):
    e = env(spark, [({}, md("insert", "T_BaseID")), ({}, md("insert", "T_BaseID")),
                    ({}, md("insert", "T_Unknown")), ({}, md("update", "T_Demographic"))])
    ins = CDC.filter_operation(CDC.decode_metadata(e), "insert")
    freq = [(r.table_name, r.cnt) for r in CDC.table_frequency(ins).collect()]
    assert freq == [("T_Unknown", 1), ("T_BaseID", 2)]
    assert [r.table_name for r in CDC.allowed_tables(ins).collect()] == ["T_BaseID"]


def test_table_name_is_case_sensitive(spark):
    e = env(spark, [({"bid": 1}, md("insert", "t_baseid"))])
    assert CDC.allowed_tables(CDC.decode_metadata(e)).count() == 0


def test_route_names():
    assert CDC.route_name("T_Demographic_Tag", "insert") == "t_demographic_tag"
    assert CDC.route_name("T_Demographic_Tag", "update") == "t_demographic_tag_cdc_update"


def test_cutover_second_precision(spark):
    e = env(spark, [({}, md("insert", "T_BaseID", "2024-01-05T10:11:11.999999Z")),
                    ({}, md("insert", "T_BaseID", "2024-01-05T10:11:12.000000Z")),
                    ({}, md("insert", "T_BaseID", "2024-01-05T10:11:12.500000Z"))])
    kept = CDC.cutover_filter(CDC.decode_metadata(e), "2024-01-05T10:11:12.750000Z")
    assert kept.count() == 2


def test_cutover_time_formats(spark):
    texts = ["2024-01-05T10:11:11Z", "2024-01-05T10:11:12Z", "2024-01-05T10:11:12.5Z", "2024-01-05T10:11:12.1234567Z",
             "2024-01-05T10:11:12.123456789Z", "2024-01-05T10:11:14Z"]
    e = env(spark, [({}, md("insert", "T_BaseID", t)) for t in texts] + [({}, md("insert", "T_BaseID", "soon"))])
    decoded = CDC.decode_metadata(e)
    for notice in ("2024-01-05T10:11:12Z", "2024-01-05T10:11:12.9Z", "2024-01-05T10:11:12.987654Z"):
        kept = CDC.metadata_columns(CDC.cutover_filter(decoded, notice))
        assert sorted(r.change_ts for r in kept.collect()) == sorted(texts[1:] + ["soon"])   # an unreadable time is kept
    for bad in ("yesterday", "2024-01-05 10:11:12", "2024-01-05T10:11:12+01:00", ""):
        with pytest.raises(ValueError):
            CDC.cutover_filter(decoded, bad)


def test_parsed_change_times(spark):
    from strata.functions.casts import parse_change_ts
    df = spark.createDataFrame([("2024-01-05T10:11:12.5Z",), ("2024-01-05T10:11:12.123456789Z",), ("2024-13-05T10:11:12Z",), (None,)], "t string")
    got = [r[0] and r[0].isoformat() for r in df.select(parse_change_ts("t")).collect()]
    assert got == ["2024-01-05T10:11:12.500000", "2024-01-05T10:11:12.123456", None, None]


def test_apply_changes_routes(spark, tmp_path):
    e = env(spark, [({"bid": "1", "email": "a"}, md("update", "T_BaseID")),
                    ({"bid": "2", "tagaid": "3"}, md("update", "T_Demographic_Tag")),
                    ({"x": 1}, md("update", "T_Unknown"))])
    out = str(tmp_path / "transient")
    written = CDC.apply_changes(e, "update", out)
    assert list(written) == ["t_baseid_cdc_update", "t_demographic_tag_cdc_update"]
    assert spark.read.parquet(written["t_baseid_cdc_update"]).collect()[0].bid == 1
    assert CDC.apply_changes(e, "insert", out) == {}


def test_custom_registry_entry(spark):
    spec = table_spec("T_X", "a, b", "a long")
    e = env(spark, [({"a": "5", "b": 6}, md("insert", "T_X"))])
    (r,) = CDC.decode_typed(CDC.decode_metadata(e), spec).collect()
    assert (r.a, r.b) == (5, "6")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_registry_types(name):
    spec = REGISTRY[name]
    assert [f.name for f in spec.typed_schema.fields] == list(spec.fields)
    assert all(c in spec.fields for c, _ in spec.casts)
