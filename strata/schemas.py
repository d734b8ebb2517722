"""Schema registry shared by the full-load path and the change-capture path.

One registry for both paths: a table's JSON payload is decoded with every
field as text (numbers often arrive quoted), then the cast map types it with
``try_cast`` so that malformed values become NULL instead of failing the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The names, field lists, types and suffixes below must equal
# the source system's for results to match.  Stated as text, in the order the
# source tables define them.  Fields without a cast stay string.
# ---------------------------------------------------------------------------

METADATA_FIELDS = ("operation", "partition-key-type", "record-type", "schema-name",
                   "table-name", "timestamp", "transaction-id")

AUDIT_COLUMNS = ("created_date", "created_timestamp", "create_user", "create_process",
                 "first_source", "create_year", "create_month", "create_date")
PARTITION_KEYS = ("create_year", "create_month", "create_date")
UPDATE_SUFFIX = "_cdc_update"
# Tables whose update history is refined (survey, demographic, tag).
UPDATE_HISTORY_TABLES = ("T_Demographic_Survey", "T_Demographic", "T_Demographic_Tag")

_TYPES = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
          "string": T.StringType(), "int": T.IntegerType()}


@dataclass(frozen=True)
class TableSpec:
    """Fields of a source table (JSON payload order) and their target types."""

    name: str
    fields: tuple[str, ...]
    casts: tuple[tuple[str, str], ...]

    @property
    def json_schema(self) -> T.StructType:
        """Decode schema: every field as text, typed later by the cast map."""
        return T.StructType([T.StructField(f, T.StringType(), True) for f in self.fields])

    @property
    def typed_schema(self) -> T.StructType:
        cast = dict(self.casts)
        return T.StructType([T.StructField(f, _TYPES[cast.get(f, "string")], True)
                             for f in self.fields])

    def cast_type(self, field: str) -> T.DataType | None:
        t = dict(self.casts).get(field)
        return _TYPES[t] if t else None


# The source tables -- name, fields in payload order, cast map.
_TABLES = [
    TableSpec(
        "T_BaseID",
        ("bid", "emailcrc", "emailmd5", "shade", "email"),
        (("bid", "long"), ("emailcrc", "long"), ("shade", "long")),
    ),
    TableSpec(
        "T_Demographic",
        ("bid", "date", "version", "lastmodified", "lastsurveymodified", "email", "firstname",
         "lastname", "address1", "address2", "city", "state", "zippost", "gender", "phone",
         "dobyear", "dobmonth", "dobday", "bvemail", "bvphone", "bvaddress", "clientip",
         "ispid", "carrierid", "zipplus4"),
        (("bid", "long"), ("version", "long"), ("gender", "boolean"), ("dobyear", "long"),
         ("dobmonth", "long"), ("dobday", "long"), ("bvemail", "boolean"), ("bvaddress",
         "boolean"), ("ispid", "long"), ("carrierid", "long"), ("zipplus4", "long")),
    ),
    TableSpec(
        "T_Demographic_Survey",
        ("bid", "aid", "vid", "surveydate", "lastsurveydate"),
        (("bid", "long"), ("aid", "long"), ("vid", "long")),
    ),
    TableSpec(
        "T_Demographic_Survey_Attribute",
        ("aid", "attribute"),
        (("aid", "long"),),
    ),
    TableSpec(
        "T_Demographic_Survey_Value",
        ("vid", "value"),
        (("vid", "long"),),
    ),
    TableSpec(
        "T_Demographic_Tag",
        ("bid", "tagaid", "tagvid", "tagdate"),
        (("bid", "long"), ("tagaid", "long"), ("tagvid", "long")),
    ),
    TableSpec(
        "T_Demographic_Tag_Attribute",
        ("tagaid", "attribute", "note", "apikey"),
        (("tagaid", "long"),),
    ),
    TableSpec(
        "T_Demographic_Tag_Value",
        ("tagvid", "value"),
        (("tagvid", "long"),),
    ),
    TableSpec(
        "T_Subscribed_Offer",
        ("id", "bid", "campaignid", "solddate", "deliverystepid", "revenue"),
        (("id", "long"), ("bid", "long"), ("campaignid", "long"), ("deliverystepid", "long"),
         ("revenue", "double")),
    ),
    TableSpec(
        "T_Visited_Affiliate",
        ("id", "bid", "affiliateid", "subaff2", "date", "period"),
        (("id", "long"), ("bid", "long"), ("affiliateid", "long"), ("period", "long")),
    ),
]

REGISTRY: dict[str, TableSpec] = {t.name: t for t in _TABLES}


def spec_of_folder(folder: str) -> TableSpec | None:
    """The registered table that a zone folder (``.../t_demographic`` or
    ``.../t_demographic_cdc_update``) belongs to, if any."""
    name = folder.rstrip("/").rsplit("/", 1)[-1].lower().removesuffix(UPDATE_SUFFIX)
    return next((t for t in _TABLES if t.name.lower() == name), None)


METADATA_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in METADATA_FIELDS])

ENVELOPE_SCHEMA = T.StructType([T.StructField("data", T.StringType(), True),
                                T.StructField("metadata", T.StringType(), True)])

# Optional routed landing layout: the envelope plus two partition columns.
ROUTE_COLUMNS = ("operation", "table_name")
ROUTED_ENVELOPE_SCHEMA = T.StructType(list(ENVELOPE_SCHEMA.fields) + [
    T.StructField(c, T.StringType(), True) for c in ROUTE_COLUMNS])

MATCH_SCHEMA = T.StructType([T.StructField("bid", T.LongType(), True),
                             T.StructField("match_id", T.LongType(), True)])


def table_spec(name: str, fields: str | None = None, casts: str | None = None) -> TableSpec:
    """Registry entry by name, or an ad-hoc spec from text (``"a, b"``, ``"a long"``)."""
    if fields is None:
        return REGISTRY[name]
    pairs = tuple(tuple(c.split()) for c in (casts or "").split(",") if c.strip())
    return TableSpec(name, tuple(f.strip() for f in fields.split(",")),
                     tuple((a, b) for a, b in pairs))
