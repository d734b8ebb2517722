"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per key, and
its DuckDB oracle.  Keys follow the operator inventory of the survey."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import keys as K
from strata.functions.digests import digest_counts
from strata.operators import cdc as CDC
from strata.operators import customer as C
from strata.operators import integrity as INT
from strata.operators import schema_ops as SO
from strata.operators.audit import audit_columns
from strata.operators.bloom import prefilter
from strata.plans import fixtures as FX
from strata.plans import jobs as J
from strata.plans.daily_star import update_customer
from strata.schemas import PARTITION_KEYS, REGISTRY
from strata.session import delete_path, move_files, path_join, scratch_path, scratch_zone, set_file_age
from strata.sinks.bucketed import append_bucketed
from strata.sinks.files import write_csv_pipe, write_parquet, write_refined
from strata.sources import catalog as CAT
from strata.sources import crawl as CRAWL
from strata.sources import files as SRC
from strata.streaming import incremental as INC
from strata.streaming import landing as LAND

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def H(expr: str) -> str:
    """DuckDB spelling of base64(md5(text))."""
    return f"base64(encode(md5({expr})))"


def _with(**ctes: str) -> str:
    parts = [f"{name} as ({FX.oracle_fixture(text).strip()})" for name, text in ctes.items()]
    return "with " + ",\n".join(parts) + "\n"


_CUSTOMER_CTES = _with(fm=FX.FX_MATCH, b=FX.FX_BASEID, d=FX.FX_DEMOGRAPHIC)

_ADDR_KEY = H("coalesce(lower(d.address1), '') || coalesce(lower(d.address2), '') || "
              "coalesce(lower(d.city), '') || coalesce(lower(d.state), '') || "
              "coalesce(d.zippost, '') || coalesce(cast(d.zipplus4 as varchar), '')")
_NAME_KEY = H("coalesce(lower(d.firstname), '') || coalesce(lower(d.lastname), '')")
_EMAIL_KEY_D = H("coalesce(lower(d.email), '')")
_PHONE_KEY = H("coalesce(lower(d.phone), '')")


def _star_inputs(spark: SparkSession, sf_dir: str):
    return FX.fx_match(spark, sf_dir), FX.fx_baseid(spark, sf_dir), FX.fx_demographic(spark, sf_dir)


# --------------------------------------------------------------------------- customer star

@register("customer", _CUSTOMER_CTES + f"""
select customer_id, customer_email_id, customer_name_id, customer_address_id, customer_phone_id,
       case when parent_bid is null then null else {H('cast(parent_bid as varchar)')} end as parent_customer_id
from (
  select {H('cast(fm.bid as varchar)')} as customer_id, fm.bid as bid,
         {_EMAIL_KEY_D} as customer_email_id, {_NAME_KEY} as customer_name_id,
         {_ADDR_KEY} as customer_address_id, {_PHONE_KEY} as customer_phone_id,
         nullif(first_value(fm.bid) over (partition by fm.match_id order by fm.bid), fm.bid) as parent_bid
  from fm join d on fm.bid = d.bid
  group by 1, 2, 3, 4, 5, 6, fm.match_id
) t
group by 1, 2, 3, 4, 5, 6
""")
def q_customer(spark, sf_dir):
    m, _, d = _star_inputs(spark, sf_dir)
    return C.customer(m, d)


@register("customer_prefiltered", ORACLES["customer"])
def q_customer_prefiltered(spark, sf_dir):
    """The same, with a Bloom filter of the clustered bids before the join."""
    m, _, d = _star_inputs(spark, sf_dir)
    return C.customer(m, prefilter(d, C.distinct_bids(m), "bid", force=True))


@register("customer_daily", ORACLES["customer"])
def q_customer_daily(spark, sf_dir):
    """The same, kept up over three days of new rows and memberships."""
    m, _, d = _star_inputs(spark, sf_dir)
    root = scratch_path(spark, "daily")
    for day in range(3):
        update_customer(d.where(f"bid % 3 = {day}"), m.where(f"coalesce(bid, 0) % 4 % 3 = {day}"), d.where(f"bid % 3 <= {day}"),
                        m.where(f"coalesce(bid, 0) % 4 % 3 <= {day}"), path_join(root, "state"), path_join(root, "customer"))
    return spark.read.parquet(path_join(root, "customer")).drop("part")


@register("customer_email", _CUSTOMER_CTES + f"""
select distinct {H("coalesce(lower(b.email), '')")} as customer_email_id, b.email as email
from fm join b on fm.bid = b.bid
group by b.email
""")
def q_customer_email(spark, sf_dir):
    m, b, _ = _star_inputs(spark, sf_dir)
    return C.customer_email(m, b)


@register("customer_address", _CUSTOMER_CTES + f"""
select distinct {_ADDR_KEY} as customer_address_id,
       d.address1, d.address2, d.city, d.state, d.zippost, d.zipplus4
from fm join b on fm.bid = b.bid join d on b.bid = d.bid
group by d.address1, d.address2, d.city, d.state, d.zippost, d.zipplus4
""")
def q_customer_address(spark, sf_dir):
    return C.customer_address(*_star_inputs(spark, sf_dir))


@register("customer_name", _CUSTOMER_CTES + f"""
select distinct {_NAME_KEY} as customer_name_id, d.firstname, d.lastname
from fm join b on fm.bid = b.bid join d on b.bid = d.bid
group by d.firstname, d.lastname
""")
def q_customer_name(spark, sf_dir):
    return C.customer_name(*_star_inputs(spark, sf_dir))


@register("customer_phone", _CUSTOMER_CTES + f"""
select distinct {_PHONE_KEY} as customer_phone_id, d.phone
from fm join b on fm.bid = b.bid join d on b.bid = d.bid
group by d.phone
""")
def q_customer_phone(spark, sf_dir):
    return C.customer_phone(*_star_inputs(spark, sf_dir))


@register("customer_xref", _CUSTOMER_CTES + f"""
select {H('cast(fm.bid as varchar)')} as customer_id, fm.bid as bid
from fm join d on fm.bid = d.bid
group by fm.bid, fm.match_id
""")
def q_customer_xref(spark, sf_dir):
    m, _, d = _star_inputs(spark, sf_dir)
    return C.customer_xref(m, d)


@register("parent_link", _CUSTOMER_CTES + """
select distinct fm.bid as bid, fm.match_id as match_id,
       nullif(first_value(fm.bid) over (partition by fm.match_id order by fm.bid), fm.bid) as parent_bid
from fm join d on fm.bid = d.bid
""")
def q_parent_link(spark, sf_dir):
    m, _, d = _star_inputs(spark, sf_dir)
    return C.parent_link(m, d)


@register("customer_tables_job", _CUSTOMER_CTES + f"""
, e as (select {H("coalesce(lower(b.email), '')")} as customer_email_id from fm join b on fm.bid = b.bid group by b.email)
, p as (select distinct {_PHONE_KEY} as customer_phone_id from fm join b on fm.bid = b.bid join d on b.bid = d.bid)
, x as (select {H('cast(fm.bid as varchar)')} as customer_id from fm join d on fm.bid = d.bid group by fm.bid, fm.match_id)
select 'customer_email' as target, customer_email_id as id, 2024 as create_year from e
union all select 'customer_phone', customer_phone_id, 2024 from p
union all select 'fig_baseid_x_customer', customer_id, 2024 from x
""")
def q_customer_tables_job(spark, sf_dir):
    """The job: refined inputs by table name, clusters as CSV, outputs registered."""
    root, zone = scratch_path(spark, "star"), _zone(spark, "strata_star")
    m, b, d = _star_inputs(spark, sf_dir)
    for name, df in (("t_baseid", b), ("t_demographic", d)):
        audited = audit_columns(df, *AUDIT_ARGS, as_of=AS_OF)
        write_refined(audited, path_join(root, name))
        CAT.refresh_table(spark, zone, name, path_join(root, name), audited.schema, "fig_", PARTITION_KEYS)
    m.write.option("header", "true").csv(path_join(root, "matches"))
    J.customer_tables(spark, f"{zone}.fig_t_demographic", f"{zone}.fig_t_baseid", path_join(root, "matches"),
                      path_join(root, "out"), *AUDIT_ARGS, year=2024, as_of=AS_OF, zone=zone)
    ids = {"customer_email": "customer_email_id", "customer_phone": "customer_phone_id", "fig_baseid_x_customer": "customer_id"}
    return SRC.union_all([spark.table(f"{zone}.{t}").select(F.lit(t).alias("target"), F.col(c).alias("id"), "create_year")
                          for t, c in ids.items()])


@register("fk_email_dangling", _CUSTOMER_CTES + f"""
, f as (select {_EMAIL_KEY_D} as e, {_NAME_KEY} as n, {_ADDR_KEY} as a, {_PHONE_KEY} as p
        from (select fm.bid, nullif(first_value(fm.bid) over (partition by fm.match_id order by fm.bid), fm.bid) as parent_bid
              from (select distinct bid, match_id from fm) fm join (select distinct bid from d) x on fm.bid = x.bid) l
        join (select distinct * from d) d on l.bid = d.bid group by l.bid, l.parent_bid, 1, 2, 3, 4)
, k as (select fm.bid from fm join b on fm.bid = b.bid)
, dims as (select 'customer_email' as dimension, {H("coalesce(lower(b.email), '')")} as key from b where b.bid in (select bid from fm)
           union select 'customer_name', {_NAME_KEY} from d where d.bid in (select bid from k)
           union select 'customer_address', {_ADDR_KEY} from d where d.bid in (select bid from k)
           union select 'customer_phone', {_PHONE_KEY} from d where d.bid in (select bid from k))
, keys as (select 'customer_email_id' as foreign_key, 'customer_email' as dimension, e as key from f
           union all select 'customer_name_id', 'customer_name', n from f
           union all select 'customer_address_id', 'customer_address', a from f
           union all select 'customer_phone_id', 'customer_phone', p from f)
select foreign_key, dimension, key, count(*) as n_rows from keys
where not exists (select 1 from dims where dims.dimension = keys.dimension and dims.key = keys.key) group by all
""")
def q_fk_email_dangling(spark, sf_dir):
    """Foreign keys of the customer table that no dimension row has."""
    return INT.star_dangling(C.customer_star(*_star_inputs(spark, sf_dir)))


@register("key_collisions", f"""
with s as (select distinct {H("lower(o_orderstatus) || cast(o_custkey as varchar) || cast(o_orderkey % 100 as varchar)")} as key,
                  lower(o_orderstatus) || '|' || cast(o_custkey as varchar) || '|' || cast(o_orderkey % 100 as varchar) as source from orders),
r as (select key, source, row_number() over (partition by key order by source) as i, count(*) over (partition by key) as n from s)
select key, n as n_sources, string_agg(source, ', ' order by source) as sources from r where n > 1 and i <= 10 group by key, n
""")
def q_key_collisions(spark, sf_dir):
    """Composites without a separator that stand for unequal values."""
    rows = _orders(spark, sf_dir).select("o_orderstatus", "o_custkey", (F.col("o_orderkey") % 100).alias("place"))
    parts = ["o_orderstatus", "o_custkey", "place"]
    return INT.key_collisions(rows, K.key_composite(*parts), parts)


_STAR_TABLES = {
    "customer": ("customer_id", "customer_email_id", "customer_name_id", "customer_address_id", "customer_phone_id", "parent_customer_id"),
    "customer_email": ("customer_email_id", "email"),
    "customer_address": ("customer_address_id", *C.ADDRESS_COLUMNS),
    "customer_name": ("customer_name_id", *C.NAME_COLUMNS),
    "customer_phone": ("customer_phone_id", "phone"),
    "fig_baseid_x_customer": ("customer_id", "bid")}
_STAR_ORACLES = {t: ORACLES["customer_xref" if t.startswith("fig") else t] for t in _STAR_TABLES}


def _star_fields(columns: tuple[str, ...], kind: str) -> str:
    fields = [f"cast({c} as {kind})" for c in columns] + [f"cast(null as {kind})"] * (7 - len(columns))
    return ", ".join(f"{f} as f{i}" for i, f in enumerate(fields))


@register("customer_tables_job_rows", "\nunion all\n".join(
    f"select '{t}' as target, {_star_fields(c, 'varchar')}, 2024 as create_year, 'etl_role' as create_user from ({_STAR_ORACLES[t]}) q"
    for t, c in _STAR_TABLES.items()))
def q_customer_tables_job_rows(spark, sf_dir):
    """All columns of all six tables of the job, from bucketed refined inputs."""
    root, zone = scratch_path(spark, "star"), _zone(spark, "strata_bucketed")
    m, b, d = _star_inputs(spark, sf_dir)
    for name, df in (("t_baseid", b), ("t_demographic", d)):
        append_bucketed(audit_columns(df, *AUDIT_ARGS, as_of=AS_OF), zone, f"fig_{name}", path_join(root, name), buckets=8)
    append_bucketed(m, zone, "matches", path_join(root, "matches"), buckets=8, partition_by=())
    out = J.customer_tables(spark, f"{zone}.fig_t_demographic", f"{zone}.fig_t_baseid", f"{zone}.matches",
                            path_join(root, "out"), *AUDIT_ARGS, year=2024, as_of=AS_OF)
    return SRC.union_all([spark.read.parquet(out[t]).selectExpr(f"'{t}' as target", *_star_fields(c, "string").split(", "),
                                                               "create_year", "create_user") for t, c in _STAR_TABLES.items()])


# --------------------------------------------------------------------------- key functions

_KEY_CTES = _with(d=FX.FX_DEMOGRAPHIC)


@register("key_hash", _KEY_CTES + f"""
select bid, {H('cast(bid as varchar)')} as bid_key, {_EMAIL_KEY_D} as email_key,
       {_PHONE_KEY} as phone_key
from d
""")
def q_key_hash(spark, sf_dir):
    d = FX.fx_demographic(spark, sf_dir)
    return d.select("bid", K.entity_key("bid").alias("bid_key"),
                    K.email_key("email").alias("email_key"),
                    K.phone_key("phone").alias("phone_key"))


@register("key_composite", _KEY_CTES + f"""
select bid, {_NAME_KEY} as name_key, {_ADDR_KEY} as address_key,
       {H("coalesce(lower(d.lastname), '') || coalesce(lower(d.city), '')")} as city_key
from d
""")
def q_key_composite(spark, sf_dir):
    d = FX.fx_demographic(spark, sf_dir)
    return d.select("bid", K.name_key().alias("name_key"), K.address_key().alias("address_key"),
                    K.key_composite("lastname", "city").alias("city_key"))


# --------------------------------------------------------------------------- change capture


_CDC_CTE = _with(c=FX.FX_CDC_BASE)
_REGISTERED = ", ".join(f"'{t}'" for t in sorted(REGISTRY))
_CHANGE_TS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_WITH_BID = ", ".join(f"'{t}'" for t, fields in FX.CDC_FIELDS.items() if "bid" in fields)
_DATA_BID = f"case when tbl in ({_WITH_BID}) then cast(user_id as varchar) end"
# Fixed parameter: full-load completion notice used by the cut-over query.
CUTOVER_NOTICE = "2024-01-15T12:30:45.987654Z"


def _decoded(spark, sf_dir):
    return CDC.decode_metadata(FX.fx_cdc(spark, sf_dir))


def _flat(decoded: DataFrame, *extra: str) -> DataFrame:
    cols = {"operation": CDC.meta("operation"), "record_type": CDC.meta("record-type"),
            "schema_name": CDC.meta("schema-name"), "table_name": CDC.meta("table-name"),
            "change_ts": CDC.meta("timestamp"),
            "data_bid": F.get_json_object("data", "$.bid")}
    names = ("operation", "table_name", "change_ts") + extra
    return decoded.select(*[cols[n].alias(n) for n in names])


@register("cdc_decode_metadata", _CDC_CTE + f"""
select op as operation, 'data' as record_type, 'db' as schema_name, tbl as table_name,
       {_CHANGE_TS} as change_ts, cast(null as varchar) as transaction_id,
       cast(null as varchar) as partition_key_type
from c
""")
def q_cdc_decode_metadata(spark, sf_dir):
    return CDC.metadata_columns(_decoded(spark, sf_dir))


@register("cdc_filter_insert", _CDC_CTE + f"""
select op as operation, tbl as table_name, {_CHANGE_TS} as change_ts, {_DATA_BID} as data_bid
from c where op = 'insert'
""")
def q_cdc_filter_insert(spark, sf_dir):
    return _flat(CDC.filter_operation(_decoded(spark, sf_dir), "insert"), "data_bid")


@register("cdc_filter_update", _CDC_CTE + f"""
select op as operation, tbl as table_name, {_CHANGE_TS} as change_ts, {_DATA_BID} as data_bid
from c where op = 'update'
""")
def q_cdc_filter_update(spark, sf_dir):
    return _flat(CDC.filter_operation(_decoded(spark, sf_dir), "update"), "data_bid")


@register("cdc_table_frequency", _CDC_CTE + """
select tbl as table_name, count(*) as cnt from c where op = 'insert' group by tbl
""")
def q_cdc_table_frequency(spark, sf_dir):
    return CDC.table_frequency(CDC.filter_operation(_decoded(spark, sf_dir), "insert"))


@register("cdc_allowed_tables", _CDC_CTE + f"""
select distinct tbl as table_name from c where op = 'insert' and tbl in ({_REGISTERED})
""")
def q_cdc_allowed_tables(spark, sf_dir):
    return CDC.allowed_tables(CDC.filter_operation(_decoded(spark, sf_dir), "insert"))


@register("cdc_decode_table", _CDC_CTE + """
select cast(user_id as varchar) as bid, cast(event_id % 7 as varchar) as tagaid,
       cast(event_id % 9 as varchar) as tagvid, strftime(ts, '%Y-%m-%d') as tagdate
from c where op = 'insert' and tbl = 'T_Demographic_Tag'
""")
def q_cdc_decode_table(spark, sf_dir):
    ins = CDC.filter_operation(_decoded(spark, sf_dir), "insert")
    return CDC.decode_table(ins, REGISTRY["T_Demographic_Tag"])


def _typed_select(table: str) -> str:
    """The typed fields of a change table, for DuckDB."""
    spec, kinds = REGISTRY[table], {"long": "bigint", "double": "double", "boolean": "boolean"}
    casts = dict(spec.casts)
    return ", ".join(
        (f"try_cast(cast({e} as varchar) as {kinds[casts[f]]})" if f in casts else f"cast({e} as varchar)") + f' as "{f}"'
        for f, e in FX.CDC_FIELDS[table].items())


def _typed_oracle(table: str, op: str) -> str:
    return _CDC_CTE + f"select {_typed_select(table)} from c where op = '{op}' and tbl = '{table}'"


@register("cdc_typed_cast", _typed_oracle("T_Subscribed_Offer", "insert"))
def q_cdc_typed_cast(spark, sf_dir):
    ins = CDC.filter_operation(_decoded(spark, sf_dir), "insert")
    return CDC.decode_typed(ins, REGISTRY["T_Subscribed_Offer"])


@register("cdc_typed_cast_boolean", _typed_oracle("T_Demographic", "insert"))
def q_cdc_typed_cast_boolean(spark, sf_dir):
    ins = CDC.filter_operation(_decoded(spark, sf_dir), "insert")
    return CDC.decode_typed(ins, REGISTRY["T_Demographic"])


def _applied_oracle(*routes: tuple[str, str], tables=FX.CDC_TABLES, extra: str = "") -> str:
    return _CDC_CTE + "\nunion all by name\n".join(
        f"select '{t.lower()}{suffix}' as target, {_typed_select(t)}{extra} from c where op = '{op}' and tbl = '{t}'"
        for op, suffix in routes for t in tables)


def _read_routed(spark, written: dict[str, str]) -> DataFrame:
    frames = [spark.read.parquet(p).drop("load").withColumn("target", F.lit(p.rstrip("/").rsplit("/", 1)[-1]))
              for p in written.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


_INSERT, _UPDATE = ("insert", ""), ("update", "_cdc_update")


@register("cdc_apply_insert", _applied_oracle(_INSERT))
def q_cdc_apply_insert(spark, sf_dir):
    root = scratch_path(spark, "transient")
    written = CDC.apply_changes(FX.fx_cdc(spark, sf_dir), "insert", root)
    return _read_routed(spark, written)


@register("cdc_apply_update", _applied_oracle(_UPDATE))
def q_cdc_apply_update(spark, sf_dir):
    root = scratch_path(spark, "transient")
    written = CDC.apply_changes(FX.fx_cdc(spark, sf_dir), "update", root)
    return _read_routed(spark, written)


def _land(spark, envelope: DataFrame, root: str, routed: bool = True) -> str:
    """Messages of an envelope, landed by the stream; returns the landing."""
    inbox, landing, ck = (path_join(root, p) for p in ("inbox", "landing", "_landing_checkpoint"))
    envelope.select(F.concat(F.lit('{"data":'), F.col("data"), F.lit(',"metadata":'),
                             F.col("metadata"), F.lit("}")).alias("value")).write.mode("append").text(inbox)
    LAND.cdc_land_stream(LAND.message_file_stream(spark, inbox), landing, ck,
                         available_now=True, routed=routed).awaitTermination()
    return landing


@register("cdc_apply_all_routed", _applied_oracle(_INSERT, _UPDATE))
def q_cdc_apply_all_routed(spark, sf_dir):
    root = scratch_path(spark, "zones")
    landing = _land(spark, FX.fx_cdc(spark, sf_dir), root)
    transient, ck = path_join(root, "transient"), path_join(root, "_checkpoint")
    for _ in range(2):                # the second run finds nothing new
        J.cdc_to_transient(spark, landing, transient, ("insert", "update"), ck)
    return _read_routed(spark, {t: p for t, p in CAT.list_subfolders(spark, transient)})


def _rejected(table: str) -> list[tuple[str, str, str]]:
    """(field, value, condition) of what the cast map makes NULL, for DuckDB."""
    kinds = {"long": "bigint", "double": "double", "boolean": "boolean"}
    return [(f, f"cast({e} as varchar)", f"cast({e} as varchar) is not null and try_cast(cast({e} as varchar) as {kinds[t]}) is null")
            for f, e in FX.CDC_FIELDS[table].items() for t in [dict(REGISTRY[table].casts).get(f)] if t]


@register("cdc_counts", _CDC_CTE + "\nunion all\n".join(
    f"select '{t.lower()}{suffix}' as target, count(*) as n_rows, cast(0 as bigint) as n_undecoded, cast(coalesce(sum(0"
    + "".join(f" + case when {c} then 1 else 0 end" for _, _, c in _rejected(t)) + "), 0) as bigint) as n_rejected "
    f"from c where op = '{op}' and tbl = '{t}' having count(*) > 0"
    for op, suffix in (_INSERT, _UPDATE) for t in FX.CDC_TABLES))
def q_cdc_counts(spark, sf_dir):
    """Counts observed while two change runs write, no pass of their own."""
    root = scratch_path(spark, "zones")
    frames = []
    for part in _time_slices(FX.fx_cdc_base(spark, sf_dir), "ts", ("2024-01-16",)):
        landing = _land(spark, spark.sql(FX.FX_CDC, fx_cdc_base=part), root)
        counts = J.cdc_to_transient(spark, landing, path_join(root, "transient"), ("insert", "update"), path_join(root, "_ck"))
        frames += [(t, n["rows"], n["undecoded"], n["rejected"]) for t, n in counts.items() if n]
    out = spark.createDataFrame(frames, "target string, n_rows long, n_undecoded long, n_rejected long")
    return out.groupBy("target").agg(*[F.sum(c).alias(c) for c in out.columns[1:]])


@register("cdc_rejected_values", _CDC_CTE + "\nunion all\n".join(
    f"select '{t}' as table_name, '{f}' as field, {v} as value from c where op = 'insert' and tbl = '{t}' and {cond}"
    for t in FX.CDC_TABLES for f, v, cond in _rejected(t)))
def q_cdc_rejected_values(spark, sf_dir):
    """What typing made NULL is kept beside the tables, field and text."""
    root = scratch_path(spark, "zones")
    landing, rejects = _land(spark, FX.fx_cdc(spark, sf_dir), root), path_join(root, "rejects")
    J.cdc_to_transient(spark, landing, path_join(root, "transient"), "insert", path_join(root, "_ck"), rejects_root=rejects)
    return SRC.union_all([spark.read.parquet(path).drop("load") for _, path in CAT.list_subfolders(spark, rejects)])


@register("full_load_rerun", _CDC_CTE + f"""
select {_typed_select('T_Demographic')} from c where tbl = 'T_Demographic' and op <> 'delete'
""")
def q_full_load_rerun(spark, sf_dir):
    """The same full load twice, change inserts before and between: each row once."""
    root = scratch_path(spark, "zones")
    raw, table = path_join(root, "raw/T_Demographic"), path_join(root, "transient/t_demographic")
    landing = _land(spark, FX.fx_cdc(spark, sf_dir), root)
    write_csv_pipe(_change_rows(spark, sf_dir, "T_Demographic", "op = 'update'"), raw)
    for _ in range(2):
        J.cdc_to_transient(spark, landing, path_join(root, "transient"), "insert", path_join(root, "_ck"))
        J.raw_to_transient(spark, raw, table, escaped_breaks=True, load="full")
    return spark.read.parquet(table).drop("load")


@register("route_target", _CDC_CTE + f"""
select lower(tbl) || case when op = 'update' then '_cdc_update' else '' end as target,
       count(*) as cnt
from c where op in ('insert', 'update') and tbl in ({_REGISTERED})
group by 1
""")
def q_route_target(spark, sf_dir):
    d = CDC.registered(_decoded(spark, sf_dir))
    d = d.where(CDC.meta("operation").isin("insert", "update"))
    return (d.groupBy(CDC.route_target(CDC.meta("table-name"), CDC.meta("operation")).alias("target"))
            .agg(F.count(F.lit(1)).alias("cnt")))


@register("cdc_cutover", _CDC_CTE + f"""
select op as operation, tbl as table_name, {_CHANGE_TS} as change_ts
from c where ts >= timestamp '{CUTOVER_NOTICE[:19].replace('T', ' ')}'
""")
def q_cdc_cutover(spark, sf_dir):
    return _flat(CDC.cutover_filter(_decoded(spark, sf_dir), CUTOVER_NOTICE))


# The same times with 0, 6, 3 and 9 digits of fraction.
_MIXED_TS = """case event_id % 4 when 0 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
  when 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") when 2 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
  else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS'Z'") end"""


@register("cdc_cutover_formats", _CDC_CTE + f"""
select op as operation, tbl as table_name, {_DATA_BID} as data_bid
from c where ts >= timestamp '{CUTOVER_NOTICE[:19].replace('T', ' ')}'
""")
def q_cdc_cutover_formats(spark, sf_dir):
    decoded = CDC.decode_metadata(FX.fx_cdc(spark, sf_dir, _MIXED_TS))
    return _flat(CDC.cutover_filter(decoded, CUTOVER_NOTICE[:19] + "Z"), "data_bid").drop("change_ts")


@register("cdc_cutover_job", _CDC_CTE + "\nunion all by name\n".join(
    f"select '{t.lower()}' as target, {_typed_select(t)} from c where op = 'insert' and tbl = '{t}' "
    f"and ts >= timestamp '{CUTOVER_NOTICE[:19].replace('T', ' ')}'" for t in FX.CDC_TABLES))
def q_cdc_cutover_job(spark, sf_dir):
    root = scratch_path(spark, "zones")
    landing = _land(spark, FX.fx_cdc(spark, sf_dir), root)
    transient = path_join(root, "transient")
    J.cdc_to_transient(spark, landing, transient, "insert", path_join(root, "_checkpoint"), cutover_notice=CUTOVER_NOTICE)
    return _read_routed(spark, {t: p for t, p in CAT.list_subfolders(spark, transient)})


# --------------------------------------------------------------------------- audit, refined, pruned scans


# Fixed parameters of the audit-column queries (a pinned load time keeps them reproducible).
AS_OF = "2024-03-05 06:07:08"
AUDIT_ARGS = ("etl_role", "refine_job", "db_name")


def _audit_sql() -> str:
    user, process, source = AUDIT_ARGS
    return (f"date '2024-03-05' as created_date, timestamp '{AS_OF}' as created_timestamp, "
            f"'{user}' as create_user, '{process}' as create_process, '{source}' as first_source, "
            "cast(2024 as integer) as create_year, cast(3 as integer) as create_month, "
            "cast(5 as integer) as create_date")


def _zone(spark, name: str) -> str:
    """Create a zone database of this run below the scratch folder."""
    return CAT.create_zone(spark, scratch_zone(spark, name), scratch_path(spark, name + ".db"))


def _orders(spark, sf_dir):
    return FX.read_table(spark, sf_dir, "orders")


@register("audit_columns", f"select *, {_audit_sql()} from orders")
def q_audit_columns(spark, sf_dir):
    return audit_columns(_orders(spark, sf_dir), *AUDIT_ARGS, as_of=AS_OF)


def _time_slices(df: DataFrame, col: str, bounds: tuple[str, ...]) -> list[DataFrame]:
    """Complementary slices of a whole table by a time column (NULLs go last)."""
    c = F.col(col)
    out, lo = [], None
    for b in bounds:
        cond = c < F.lit(b).cast("timestamp_ntz")
        if lo is not None:
            cond = cond & (c >= F.lit(lo).cast("timestamp_ntz"))
        out.append(df.where(cond))
        lo = b
    out.append(df.where((c >= F.lit(lo).cast("timestamp_ntz")) | c.isNull()))
    return out


@register("transient_to_refined", f"select *, {_audit_sql()} from orders")
def q_transient_to_refined(spark, sf_dir):
    root = scratch_path(spark, "zones")
    transient, refined = path_join(root, "transient/orders"), path_join(root, "refined/orders")
    ck = path_join(root, "_checkpoints/orders")
    orders = _orders(spark, sf_dir)
    # Three scheduled runs over a growing transient folder: each row once.
    for part in _time_slices(orders, "o_orderdate", ("1997-01-01", "1999-01-01")):
        write_parquet(part, transient, mode="append")
        J.transient_to_refined(spark, transient, refined, ck, *AUDIT_ARGS, as_of=AS_OF,
                               schema=orders.schema)
    return spark.read.parquet(refined)


_HISTORY = ("T_Demographic_Survey", "T_Demographic", "T_Demographic_Tag")


@register("update_history_to_refined", _applied_oracle(_UPDATE, tables=_HISTORY, extra=f", {_audit_sql()}"))
def q_update_history_to_refined(spark, sf_dir):
    root = scratch_path(spark, "zones")
    transient, refined = path_join(root, "transient"), path_join(root, "refined")
    CDC.apply_changes(FX.fx_cdc(spark, sf_dir), "update", transient)
    written = J.update_history_to_refined(spark, transient, refined, path_join(root, "_ck"),
                                          *AUDIT_ARGS, as_of=AS_OF)
    return _read_routed(spark, written)


_PRUNE = (1996, 3, 9, 1, 15)


@register("scan_partition_pruned", f"""
select *, cast(year(o_orderdate) as integer) as create_year,
       cast(month(o_orderdate) as integer) as create_month,
       cast(day(o_orderdate) as integer) as create_date
from orders
where year(o_orderdate) = {_PRUNE[0]} and month(o_orderdate) between {_PRUNE[1]} and {_PRUNE[2]}
  and day(o_orderdate) between {_PRUNE[3]} and {_PRUNE[4]}
""")
def q_scan_partition_pruned(spark, sf_dir):
    path = scratch_path(spark, "refined/orders")
    o = _orders(spark, sf_dir)
    parted = o.withColumns({"create_year": F.year("o_orderdate"), "create_month": F.month("o_orderdate"),
                            "create_date": F.dayofmonth("o_orderdate")})
    write_parquet(parted, path, mode="overwrite", files_per_partition=1,
                  partition_by=("create_year", "create_month", "create_date"))
    return SRC.scan_partition_pruned(spark, path, *_PRUNE)


# --------------------------------------------------------------------------- scans, catalog, raw zone

@register("scan_parquet", "select * from lineitem")
def q_scan_parquet(spark, sf_dir):
    return SRC.scan_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


@register("scan_catalog_table", "select * from orders")
def q_scan_catalog_table(spark, sf_dir):
    root = scratch_path(spark, "transient")
    write_parquet(_orders(spark, sf_dir), path_join(root, "orders"), mode="overwrite")
    zone = _zone(spark, "strata_transient")
    CAT.register_table(spark, zone, "orders", path_join(root, "orders"))
    return CAT.scan_catalog_table(spark, zone, "orders")


@register("register_prefixed_tables", "select *, year(o_orderdate) as o_year from orders")
def q_register_prefixed_tables(spark, sf_dir):
    """A crawl: one prefixed table per folder; a second load brings new
    partitions and is recovered."""
    root = scratch_path(spark, "refined")
    zone, path = _zone(spark, "strata_refined"), path_join(root, "orders")
    for part in _time_slices(_orders(spark, sf_dir), "o_orderdate", ("1997-01-01",)):
        df = part.withColumn("o_year", F.year("o_orderdate").cast("long"))
        write_parquet(df, path, partition_by=("o_year",), files_per_partition=1)
        CAT.refresh_table(spark, zone, "orders", path, df.schema, "fig_", ("o_year",))
    return spark.table(f"{zone}.fig_orders")


@register("incremental_crawl", """
select 'fig_kept' as table_name, 'same' as state, count(*) as n_rows, cast(null as varchar) as deprecated from nation
union all select 'fig_gone', 'vanished', null, 'true'
union all select 'fig_fresh', 'new', count(*), null from supplier
union all select 'fig_grown', 'changed', count(o_orderpriority), null from orders where o_orderkey % 3 > 0 and o_orderstatus <> 'P'
""")
def q_incremental_crawl(spark, sf_dir):
    """Two crawls; between them a folder comes, one goes and one changes: a file
    and a column are added, a partition is added, and one goes."""
    root, manifest, zone = scratch_path(spark, "refined"), scratch_path(spark, "manifest"), _zone(spark, "strata_crawl")
    orders = _orders(spark, sf_dir).where("o_orderkey % 3 > 0")
    write_parquet(FX.read_table(spark, sf_dir, "nation"), path_join(root, "kept"))
    write_parquet(FX.read_table(spark, sf_dir, "region"), path_join(root, "gone"))
    write_parquet(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"), path_join(root, "grown"), partition_by=("o_orderstatus",))
    CRAWL.crawl(spark, zone, root, manifest, "fig_")
    delete_path(spark, path_join(root, "gone"))
    delete_path(spark, path_join(root, "grown", "o_orderstatus=P"))
    delete_path(spark, path_join(root, "grown", "o_orderstatus=O"))
    write_parquet(orders.where("o_orderstatus in ('F', 'O')").select("o_orderkey", "o_orderpriority", "o_orderstatus"),
                  path_join(root, "grown"), partition_by=("o_orderstatus",))
    write_parquet(FX.read_table(spark, sf_dir, "supplier"), path_join(root, "fresh"))
    states = {"fig_" + r["folder"]: r["state"] for r in CRAWL.crawl(spark, zone, root, manifest, "fig_")}
    counted = {"fig_kept": "count(*)", "fig_fresh": "count(*)", "fig_grown": "count(o_orderpriority)"}
    frames = [spark.table(f"{zone}.{t}").selectExpr(f"'{t}' as table_name", f"'{states[t]}' as state", f"{c} as n_rows", "cast(null as string) as deprecated")
              for t, c in counted.items()]
    gone = spark.sql(f"SHOW TBLPROPERTIES {zone}.fig_gone").where("key = 'deprecated'").select(
        F.lit("fig_gone").alias("table_name"), F.lit(states["fig_gone"]).alias("state"), F.lit(None).cast("long").alias("n_rows"), F.col("value").alias("deprecated"))
    return SRC.union_all([*frames, gone])


@register("evolve_table", """
select s_suppkey, s_name, s_nationkey, case when s_nationkey < 13 then null else s_acctbal end as s_acctbal
from supplier
""")
def q_evolve_table(spark, sf_dir):
    """A later load brings a column: the table gains it, old rows are NULL."""
    sup = FX.read_table(spark, sf_dir, "supplier")
    zone, path = _zone(spark, "strata_transient"), scratch_path(spark, "transient/supplier")
    old = sup.where(F.col("s_nationkey") < 13).select("s_suppkey", "s_name", "s_nationkey")
    new = sup.where(~(F.col("s_nationkey") < 13) | F.col("s_nationkey").isNull()).select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    for df in (old, new):
        write_parquet(df, path)
        CAT.refresh_table(spark, zone, "supplier", path, df.schema, "fig_")
    return spark.table(f"{zone}.fig_supplier")


@register("scan_csv_pipe", "select * from customer")
def q_scan_csv_pipe(spark, sf_dir):
    cust = FX.read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "raw/customer")
    write_csv_pipe(cust, path, mode="overwrite")
    return SRC.scan_csv_pipe(spark, path, schema=cust.schema)


@register("scan_match_clusters", _CUSTOMER_CTES + "select bid, match_id from fm")
def q_scan_match_clusters(spark, sf_dir):
    """A wider match file with its columns in another order."""
    path = scratch_path(spark, "matches")
    m = FX.fx_match(spark, sf_dir)
    wide = m.select(F.lit("x@y").alias("email"), "match_id", F.lit(0.5).alias("score"), "bid")
    wide.write.option("header", "true").csv(path)
    return SRC.scan_match_clusters(spark, path)


@register("scan_inferred_csv", """
select cast(c_custkey as integer) as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
from customer
""")
def q_scan_inferred_csv(spark, sf_dir):
    path = scratch_path(spark, "raw/customer")
    write_csv_pipe(FX.read_table(spark, sf_dir, "customer"), path, mode="overwrite")
    return SRC.scan_csv_pipe(spark, path, infer=True)


@register("raw_to_transient", """
select cast(p_partkey as integer) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
from part
""")
def q_raw_to_transient(spark, sf_dir):
    root = scratch_path(spark, "zones")
    raw, transient = path_join(root, "raw/part"), path_join(root, "transient/part")
    write_csv_pipe(FX.read_table(spark, sf_dir, "part"), raw, mode="overwrite")
    J.raw_to_transient(spark, raw, transient, infer=True)
    return spark.read.parquet(transient)


def _change_rows(spark, sf_dir, table: str, where: str) -> DataFrame:
    """Rows of a change table as text, as a full load would hold them."""
    columns = ", ".join(f"cast({e} as string) as `{f}`" for f, e in FX.CDC_FIELDS[table].items())
    return spark.sql(f"select {columns} from {{base}} where tbl = '{table}' and {where}", base=FX.fx_cdc_base(spark, sf_dir))


@register("raw_to_transient_typed", _CDC_CTE + f"select {_typed_select('T_Demographic')} from c where tbl = 'T_Demographic'")
def q_raw_to_transient_typed(spark, sf_dir):
    """Typed by the registry, with the header in another order and a column more."""
    root = scratch_path(spark, "zones")
    raw, transient = path_join(root, "raw/T_Demographic"), path_join(root, "transient/t_demographic")
    rows = _change_rows(spark, sf_dir, "T_Demographic", "true")
    write_csv_pipe(rows.select(F.lit("z").alias("unknown"), *reversed(rows.columns)), raw)
    J.raw_to_transient(spark, raw, transient, escaped_breaks=True)
    return spark.read.parquet(transient)


def _snapshot(spark, sf_dir, pattern: str, db: str | None = None) -> tuple[dict[str, str], dict[str, DataFrame]]:
    db = db or _zone(spark, "strata_source")
    tables = {t: FX.read_table(spark, sf_dir, t) for t in FX.TABLES}
    for t in tables:
        CAT.register_table(spark, db, t, f"{sf_dir.rstrip('/')}/{t}.parquet")
    return J.full_load_snapshot(spark, db, scratch_path(spark, "raw"), pattern=pattern), tables


@register("full_load_snapshot", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in FX.TABLES))
def q_full_load_snapshot(spark, sf_dir):
    """Every table of the database, read back as typed rows."""
    written, tables = _snapshot(spark, sf_dir, "%")
    frames = [SRC.scan_csv_named(spark, p, tables[t].schema, escaped_breaks=True).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(t).alias("table_name"), "n_rows") for t, p in written.items()]
    return SRC.union_all(frames)


@register("full_load_snapshot_values", """
select 'customer' as table_name, cast(c_custkey as varchar) as key, c_name as value, c_acctbal as number, cast(null as timestamp) as at from customer
union all select 'conversations', cast(conv_id as varchar) || ':' || cast(turn as varchar), text, null, null from conversations
""")
def q_full_load_snapshot_values(spark, sf_dir):
    """Tables chosen by a pattern, compared value by value."""
    written, tables = _snapshot(spark, sf_dir, "c%")
    assert sorted(written) == ["conversations", "customer"]
    cust, conv = (SRC.scan_csv_named(spark, written[t], tables[t].schema, escaped_breaks=True) for t in ("customer", "conversations"))
    return cust.select(F.lit("customer").alias("table_name"), F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"),
                       F.col("c_acctbal").alias("number"), F.lit(None).cast("timestamp_ntz").alias("at")).unionByName(
        conv.select(F.lit("conversations").alias("table_name"),
                    F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
                    F.col("text").alias("value"), F.lit(None).cast("double").alias("number"), F.lit(None).cast("timestamp_ntz").alias("at")))


@register("full_load_snapshot_text", "select doc_id, text, lang, source, n_chars from documents")
def q_full_load_snapshot_text(spark, sf_dir):
    """Text with line breaks survives the CSV and stays one line per row."""
    written, tables = _snapshot(spark, sf_dir, "documents")
    return SRC.scan_csv_named(spark, written["documents"], tables["documents"].schema, escaped_breaks=True)


# Columns of the source tables: i whole number, d double, s text, t time, f array of floats.
_COLUMN_KINDS = {
    "region": "r_regionkey:i r_name:s",
    "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:i c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:i s_name:s s_nationkey:i s_acctbal:d",
    "part": "p_partkey:i p_name:s p_brand:s p_type:s p_size:i p_retailprice:d",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d "
                "l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:i ts:t user_id:i event_type:s value:d props:s",
    "documents": "doc_id:i text:s lang:s source:s n_chars:i",
    "embeddings": "vec_id:i embedding:f label:i",
    "pages": "page_id:i url:s html:s",
    "benchmark": "item_id:i text:s",
    "labels": "doc_id:i quality:i toxic:i",
    "conversations": "conv_id:i turn:i role:s text:s",
}
_KIND_SQL = {"i": "cast({c} as varchar)", "d": "cast(cast(floor({c} * 1e6) as bigint) as varchar)",
             "s": "replace({c}, '\\', '\\\\')", "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
             "f": "array_to_string(list_transform(list_transform({c}, lambda x: cast(cast(floor(cast(x as double) * 1e6) as bigint) as varchar)), "
                  "lambda x: length(x) || ':' || x), ',')"}


def _digest_sql(table: str) -> str:
    texts = ["coalesce({}, '\\N')".format(_KIND_SQL[k].format(c=c)) for c, k in
             (item.split(":") for item in _COLUMN_KINDS[table].split())]
    row = " || '|' || ".join(f"length({t}) || ':' || {t}" for t in texts)
    return f"select '{table}' as table_name, md5({row}) as row_md5, count(*) as n from {table} group by all"


@register("full_load_snapshot_digests", "\nunion all\n".join(_digest_sql(t) for t in FX.TABLES))
def q_full_load_snapshot_digests(spark, sf_dir):
    """All values of all tables: a digest per row of the snapshot read back."""
    written, tables = _snapshot(spark, sf_dir, "%")
    return SRC.union_all([
        digest_counts(SRC.scan_csv_named(spark, p, tables[t].schema, escaped_breaks=True))
        .select(F.lit(t).alias("table_name"), "row_md5", "n") for t, p in written.items()])


@register("full_load_snapshot_verified", "\nunion all\n".join(
    f"select '{t}' as table_name, cast({int(t == 'nation')} as bigint) as n_missing, cast({2 * int(t == 'region')} as bigint) as n_extra"
    for t in FX.TABLES))
def q_full_load_snapshot_verified(spark, sf_dir):
    """Source and snapshot compared row by row, after a row of one table was lost
    and two of another were written twice."""
    db = _zone(spark, "strata_source")
    written, tables = _snapshot(spark, sf_dir, "%", db)
    short = scratch_path(spark, "short")
    write_csv_pipe(tables["nation"].where("n_nationkey <> 7"), short)
    write_csv_pipe(tables["region"].where("r_regionkey in (0, 3)"), written["region"])
    return J.verify_snapshot(spark, db, {**written, "nation": short})


# --------------------------------------------------------------------------- schemas

@register("merge_compatible_schemas", """
select s_suppkey, s_name, s_nationkey from supplier where s_nationkey < 13
union all by name
select * from supplier where not (s_nationkey < 13) or s_nationkey is null
""")
def q_merge_compatible_schemas(spark, sf_dir):
    sup = FX.read_table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "transient/supplier")
    old = sup.where(F.col("s_nationkey") < 13).select("s_suppkey", "s_name", "s_nationkey")
    new = sup.where(~(F.col("s_nationkey") < 13) | F.col("s_nationkey").isNull())
    write_parquet(old, path, mode="append")
    write_parquet(new, path, mode="append")
    return SO.merge_compatible_schemas(spark, path)


_EPOCHS = ("l_orderkey % 3 = 0", "l_orderkey % 3 = 1", "l_orderkey % 3 = 2")


@register("merge_type_lattice", f"""
select cast(l_orderkey as bigint) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
       cast(cast(l_quantity as integer) as double) as l_quantity, cast(cast(l_shipdate as date) as timestamp) as l_shipdate,
       cast(null as varchar) as l_note from lineitem where {_EPOCHS[0]}
union all
select l_orderkey, 'n' || cast(l_linenumber as varchar), cast(l_quantity as double), cast(l_shipdate as timestamp), null from lineitem where {_EPOCHS[1]}
union all
select l_orderkey, cast(l_linenumber as varchar), null, cast(l_shipdate as timestamp), l_returnflag from lineitem where {_EPOCHS[2]}
""")
def q_merge_type_lattice(spark, sf_dir):
    """One folder in which types changed over time: int and bigint, int and double,
    date and timestamp, number and text, a column missing and one added."""
    line, path = FX.read_table(spark, sf_dir, "lineitem"), scratch_path(spark, "transient/lineitem")
    for where, columns in zip(_EPOCHS, (
            ["cast(l_orderkey as int) l_orderkey", "cast(l_linenumber as int) l_linenumber", "cast(l_quantity as int) l_quantity",
             "cast(l_shipdate as date) l_shipdate"],
            ["cast(l_orderkey as bigint) l_orderkey", "'n' || cast(l_linenumber as string) l_linenumber",
             "cast(l_quantity as double) l_quantity", "cast(l_shipdate as timestamp_ntz) l_shipdate"],
            ["cast(l_orderkey as bigint) L_OrderKey", "cast(l_linenumber as smallint) l_linenumber",
             "cast(l_shipdate as timestamp_ntz) l_shipdate", "l_returnflag l_note"])):
        write_parquet(line.where(where).selectExpr(*columns), path)
    return SO.merge_compatible_schemas(spark, path)


@register("conform_to_schema", """
select s_suppkey, s_name, case when s_nationkey = 0 then null else s_nationkey end as s_nationkey,
       cast(null as double) as s_acctbal, upper(s_name) as s_extra
from supplier
""")
def q_conform_to_schema(spark, sf_dir):
    sup = FX.read_table(spark, sf_dir, "supplier")
    registered = sup.schema  # the registered table schema
    batch = sup.select("s_suppkey", "s_name",
                       F.when(F.col("s_nationkey") == 0, F.lit("n/a"))
                       .otherwise(F.col("s_nationkey").cast("string")).alias("s_nationkey"),
                       F.upper("s_name").alias("s_extra"))
    return SO.conform_to_schema(batch, registered)


@register("union_full_load_and_cdc", _CDC_CTE + f"""
select {_typed_select('T_Demographic')}, {_audit_sql()} from c where tbl = 'T_Demographic' and op <> 'delete'
""")
def q_union_full_load_and_cdc(spark, sf_dir):
    """Full load and change inserts of one table, typed alike in one folder, refined."""
    root = scratch_path(spark, "zones")
    raw, transient = path_join(root, "raw/T_Demographic"), path_join(root, "transient")
    write_csv_pipe(_change_rows(spark, sf_dir, "T_Demographic", "op = 'update'"), raw)
    J.raw_to_transient(spark, raw, path_join(transient, "t_demographic"), escaped_breaks=True)
    CDC.apply_changes(FX.fx_cdc(spark, sf_dir), "insert", transient)
    refined = path_join(root, "refined/t_demographic")
    J.transient_to_refined(spark, path_join(transient, "t_demographic"), refined, path_join(root, "_ck"), *AUDIT_ARGS, as_of=AS_OF)
    return spark.read.parquet(refined)


@register("union_by_registered_schema", """
select c_custkey, c_name, c_nationkey, case when c_nationkey < 13 then c_acctbal end as c_acctbal, c_mktsegment from customer
""")
def q_union_by_registered_schema(spark, sf_dir):
    cust = FX.read_table(spark, sf_dir, "customer")
    full = cust.where(F.col("c_nationkey") < 13).select(*reversed(cust.columns))
    changes = cust.where(~(F.col("c_nationkey") < 13) | F.col("c_nationkey").isNull()).drop("c_acctbal").withColumn(
        "c_custkey", F.col("c_custkey").cast("string"))
    return SO.union_full_load_and_cdc(full, changes, cust.schema)


# --------------------------------------------------------------------------- incremental / streaming

_EVENT_BOUNDS = ("2024-01-11", "2024-01-21")


@register("incremental_scan", "select * from events")
def q_incremental_scan(spark, sf_dir):
    ev = FX.read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    landing, sink, ck = (path_join(root, p) for p in ("landing", "sink", "_checkpoint"))
    for part in _time_slices(ev, "ts", _EVENT_BOUNDS):
        write_parquet(part, landing, mode="append")
        INC.incremental_copy(spark, landing, ev.schema, sink, ck)
    return spark.read.parquet(sink)


@register("incremental_late_file", "select * from events")
def q_incremental_late_file(spark, sf_dir):
    """Files dated long before the newest one are read like all others."""
    ev = FX.read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    landing, sink, ck = (path_join(root, p) for p in ("landing", "sink", "_checkpoint"))
    for days, part in zip((0, 10, 400), _time_slices(ev, "ts", _EVENT_BOUNDS)):
        write_parquet(part, path_join(root, f"arrived{days}"))
        set_file_age(spark, path_join(root, f"arrived{days}"), days)
        move_files(spark, path_join(root, f"arrived{days}"), landing)
        INC.incremental_copy(spark, landing, ev.schema, sink, ck)
    return spark.read.parquet(sink)


@register("incremental_empty_run", "select * from events")
def q_incremental_empty_run(spark, sf_dir):
    """Runs without new files do nothing, before and after the data came."""
    ev = FX.read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    landing, sink, ck = (path_join(root, p) for p in ("landing", "sink", "_checkpoint"))
    write_parquet(ev, landing)
    for _ in range(3):
        INC.run_routes(spark, {"events": lambda: INC.incremental_source(spark, landing, ev.schema)}, {"events": sink}, ck)
    return spark.read.parquet(sink).drop("load")


@register("cdc_land_stream", _CDC_CTE + f"""
select op as operation, tbl as table_name, {_CHANGE_TS} as change_ts, {_DATA_BID} as data_bid
from c
""")
def q_cdc_land_stream(spark, sf_dir):
    root = scratch_path(spark, "stream")
    # Messages arrive in three time slices; each landing run takes what is new.
    for part in _time_slices(FX.fx_cdc_base(spark, sf_dir), "ts", _EVENT_BOUNDS):
        landing = _land(spark, spark.sql(FX.FX_CDC, fx_cdc_base=part), root)
    return _flat(CDC.decode_metadata(spark.read.parquet(landing)), "data_bid")


@register("zone_sql", """
select n_name, count(distinct c_custkey) as n_customers, count(o_orderkey) as n_orders,
       max(o_totalprice) as max_price
from customer join nation on c_nationkey = n_nationkey
left join orders on o_custkey = c_custkey
group by n_name
""")
def q_zone_sql(spark, sf_dir):
    zone = _zone(spark, "strata_refined")
    for t in ("customer", "nation", "orders"):
        CAT.register_table(spark, zone, t, f"{sf_dir.rstrip('/')}/{t}.parquet")
    sql = f"""
        select n_name, count(distinct c_custkey) as n_customers, count(o_orderkey) as n_orders,
               max(o_totalprice) as max_price
        from {zone}.customer join {zone}.nation on c_nationkey = n_nationkey
        left join {zone}.orders on o_custkey = c_custkey
        group by n_name"""
    return CAT.zone_sql(spark, sql, output=scratch_path(spark, "query-results"))
