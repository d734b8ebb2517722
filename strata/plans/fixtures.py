"""Derived input tables on the synthetic test data.

Each fixture is portable SQL with ``{table}`` placeholders.  In Spark the
placeholders bind DataFrames (``spark.sql(text, customer=df, ...)``); the
DuckDB oracle substitutes view names, so both engines read exactly the same
derivation.  They give NULL and mixed-case emails, NULL zips, repeated
values and versions, clusters with members missing, a NULL cluster, bids in two
clusters or without a base id, all registered tables and an unknown one,
deletes and malformed numbers -- no row of the input tables is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Members without a demographic row or base id have shifted ids; some clusters
# are NULL, some bids sit in two clusters, some memberships are repeated.
_ABSENT = 1_000_000_000

FX_MATCH = f"""
select case when c_custkey % 4 = 0 then c_custkey + {_ABSENT} else c_custkey end as bid,
       case when c_custkey % 23 = 0 then null else cast(floor(c_custkey / 3) as bigint) end as match_id
from {{customer}}
union all
select c_custkey as bid, cast(floor(c_custkey / 5) as bigint) + {_ABSENT} as match_id
from {{customer}} where c_custkey % 9 = 0
union all
select c_custkey as bid, cast(floor(c_custkey / 3) as bigint) as match_id
from {{customer}} where c_custkey % 14 = 1
"""

FX_BASEID = f"""
select case when c_custkey % 11 = 0 then c_custkey + {_ABSENT} else c_custkey end as bid,
       case when c_custkey % 7 = 0 then null
            when c_custkey % 17 = 0 then c_mktsegment || '@old.' || n_name
            when c_custkey % 2 = 0 then c_mktsegment || '@' || n_name
            else lower(c_mktsegment) || '@' || lower(n_name) end as email
from {{customer}} join {{nation}} on c_nationkey = n_nationkey
"""

_DEMOGRAPHIC = """
select c_custkey as bid,
       case when c_custkey % 7 = 0 then null
            when c_custkey % 2 = 0 then c_mktsegment || '@' || n_name
            else lower(c_mktsegment) || '@' || lower(n_name) end as email,
       case when c_custkey % 2 = 0 then c_mktsegment else lower(c_mktsegment) end as firstname,
       n_name as lastname,
       cast(c_nationkey as string) || ' Main' as address1,
       cast(null as string) as address2,
       n_name as city, r_name as state,
       case when c_custkey % 5 = 0 then null else '0' || cast(c_nationkey as string) end as zippost,
       cast(c_nationkey as bigint) as zipplus4,
       case when c_custkey % 13 = 0 then null else cast(c_custkey % 100 as string) end as phone
from {customer} join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey
"""

# Repeated versions of a bid: some equal, some with another phone.
FX_DEMOGRAPHIC = (_DEMOGRAPHIC + "union all" + _DEMOGRAPHIC + "where c_custkey % 6 = 0\n"
                  + "union all" + _DEMOGRAPHIC.replace("c_custkey % 100 as", "c_custkey % 90 + 100 as")
                  + "where c_custkey % 10 = 0\n")

# Change events: the ten registered tables in turn, and an unknown one.
CDC_TABLES = ("T_Subscribed_Offer", "T_Visited_Affiliate", "T_Demographic_Tag", "T_Demographic_Survey", "T_BaseID",
              "T_Demographic", "T_Demographic_Survey_Attribute", "T_Demographic_Survey_Value",
              "T_Demographic_Tag_Attribute", "T_Demographic_Tag_Value")

FX_CDC_BASE = """
select event_id, user_id, event_type, value, ts,
       case when event_type in ('purchase','signup') then 'insert'
            when event_type in ('click','view') then 'update' else 'delete' end as op,
       case event_id % 11 """ + " ".join(f"when {i} then '{t}'" for i, t in enumerate(CDC_TABLES)) + """
            else 'T_Unknown' end as tbl,
       case when event_id % 97 = 0 then 'n/a' else cast(event_id % 4 as string) end as step,
       cast(cast(ts as date) as string) as day,
       case event_id % 6 when 0 then '1' when 1 then 'true' when 2 then '0' when 3 then 'false'
            when 4 then 'maybe' else null end as flag
from {events}
"""

# Payload fields per table, as expressions over fx_cdc_base that both engines read.
CDC_FIELDS = {
    "T_Subscribed_Offer": {"id": "event_id", "bid": "user_id", "campaignid": "event_id % 50", "solddate": "day",
                           "deliverystepid": "step", "revenue": "value"},
    "T_Visited_Affiliate": {"id": "event_id", "bid": "user_id", "affiliateid": "user_id % 20", "subaff2": "event_type",
                            "date": "day", "period": "event_id % 12"},
    "T_Demographic_Tag": {"bid": "user_id", "tagaid": "event_id % 7", "tagvid": "event_id % 9", "tagdate": "day"},
    "T_Demographic_Survey": {"bid": "user_id", "aid": "event_id % 7", "vid": "event_id % 9", "surveydate": "day",
                             "lastsurveydate": "cast(null as string)"},
    "T_BaseID": {"bid": "user_id", "emailcrc": "event_id * 7", "emailmd5": "event_type", "shade": "step",
                 "email": "event_type || '@x.org'"},
    "T_Demographic": {
        "bid": "user_id", "date": "day", "version": "event_id % 3", "lastmodified": "day", "lastsurveymodified": "cast(null as string)",
        "email": "event_type || '@y.org'", "firstname": "event_type", "lastname": "'O''Neil \u00e9'", "address1": "'1 Main'",
        "address2": "cast(null as string)", "city": "'a|b'", "state": "'S\"T'", "zippost": "'0' || cast(event_id % 9999 as string)",
        "gender": "flag", "phone": "'0501'", "dobyear": "1950 + event_id % 50", "dobmonth": "step", "dobday": "'n/a'",
        "bvemail": "flag", "bvphone": "flag", "bvaddress": "flag", "clientip": "'10.0.0.1'", "ispid": "user_id % 5",
        "carrierid": "cast(null as string)", "zipplus4": "event_id % 10000"},
    "T_Demographic_Survey_Attribute": {"aid": "event_id % 7", "attribute": "event_type"},
    "T_Demographic_Survey_Value": {"vid": "event_id % 9", "value": "step"},
    "T_Demographic_Tag_Attribute": {"tagaid": "event_id % 7", "attribute": "event_type", "note": "cast(null as string)", "apikey": "step"},
    "T_Demographic_Tag_Value": {"tagvid": "event_id % 9", "value": "event_type"},
}


def _payload(table: str) -> str:
    fields = ", ".join(f"'{f}', cast({e} as string)" for f, e in CDC_FIELDS[table].items())
    return f"when '{table}' then to_json(named_struct({fields}))"


# Spark only: the change-event envelope (two JSON texts) built from fx_cdc_base.
CHANGE_TS = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""
FX_CDC = ("select case tbl " + "\n".join(_payload(t) for t in CDC_TABLES) + """
         else '{{"x":1}}' end as data,
       to_json(named_struct('operation', op, 'record-type', 'data', 'schema-name', 'db',
              'table-name', tbl, 'timestamp', """ + CHANGE_TS + """)) as metadata
from {fx_cdc_base}
""")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_MATCH, customer=read_table(spark, sf_dir, "customer"))


def fx_baseid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_BASEID, customer=read_table(spark, sf_dir, "customer"),
                     nation=read_table(spark, sf_dir, "nation"))


def fx_demographic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_DEMOGRAPHIC, customer=read_table(spark, sf_dir, "customer"),
                     nation=read_table(spark, sf_dir, "nation"),
                     region=read_table(spark, sf_dir, "region"))


def fx_cdc_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX_CDC_BASE, events=read_table(spark, sf_dir, "events"))


def fx_cdc(spark: SparkSession, sf_dir: str, change_ts: str = CHANGE_TS) -> DataFrame:
    """Change-event envelope ``(data string, metadata string)``."""
    return spark.sql(FX_CDC.replace(CHANGE_TS, change_ts), fx_cdc_base=fx_cdc_base(spark, sf_dir))


def oracle_fixture(text: str) -> str:
    """Fixture SQL for DuckDB: placeholders become the pre-registered view names."""
    return text.format(**{t: t for t in TABLES})
