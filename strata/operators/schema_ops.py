"""Schema combination and conformance.

* ``merge_compatible_schemas``: files of one folder with compatible schemas
  read as one table: footers only, no data pass; number types that differ are
  widened to the least common one.
* ``conform_to_schema``: bring a batch onto a registered schema -- missing
  columns become NULL, retyped columns go through ``try_cast``, new columns
  are kept at the end (the schema evolves by appending them).
* ``union_full_load_and_cdc``: full-load and change-insert rows of one table
  share a folder; reading both is a positional-free ``UNION ALL BY NAME``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _tightest_decimal(t: T.DataType) -> T.DecimalType | None:
    """The decimal that holds every value of an integer or decimal type."""
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}.get(type(t))
    return T.DecimalType(digits, 0) if digits else t if isinstance(t, T.DecimalType) else None


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that both ``a`` and ``b`` widen to.

    Integers widen to longer ones; an integer or decimal and a binary float to
    double; integers and decimals to a decimal with room for both (text where
    38 digits do not do); dates to timestamps; structs, arrays and maps member
    by member; NULL to anything.  Any other two scalars meet as text, as a
    catalog of mixed files would show them; a scalar and a container do not meet
    (TypeError)."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    containers = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(a, containers) or isinstance(b, containers):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    for order in (_INTEGERS, _FLOATS, _TIMES):
        if type(a) in order and type(b) in order:
            return max((a, b), key=lambda t: order.index(type(t)))
    numbers = (*_INTEGERS, *_FLOATS, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, _FLOATS) or isinstance(b, _FLOATS):
            return T.DoubleType()
        x, y = _tightest_decimal(a), _tightest_decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas by name (case-insensitively, the first spelling
    stays), in order of first appearance, each of the least common type."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.get(f.name.lower())
            fields[f.name.lower()] = (T.StructField(f.name, f.dataType) if known is None
                                      else T.StructField(known.name, common_type(known.dataType, f.dataType)))
    return T.StructType(list(fields.values()))


def schema_groups(spark: SparkSession, files: list[str], options: dict[str, str] | None = None) -> list[tuple[T.StructType, list[str]]]:
    """Files by schema: each group's files merge plainly.

    ``files`` in order of writing: schemas change now and then, so the run of
    files is halved only where merging it fails, and Spark reads the footers of
    a run in one distributed job.  Groups whose columns agree are joined."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    pending = [files] if files else []
    while pending:
        run = pending.pop()
        try:
            schema = spark.read.options(**(options or {})).option("mergeSchema", "true").parquet(*run).schema
        except Exception as e:
            if len(run) == 1 or "MERGE" not in str(e).upper():
                raise
            pending += [run[len(run) // 2:], run[:len(run) // 2]]
            continue
        groups.setdefault(schema.json(), (schema, []))[1].extend(run)
    joined: list[tuple[T.StructType, list[str]]] = []
    for schema, run in groups.values():
        for i, (other, held) in enumerate(joined):
            if _agree(schema, other):
                joined[i] = (common_schema([other, schema]), held + run)
                break
        else:
            joined.append((schema, run))
    return joined


def _agree(a: T.StructType, b: T.StructType) -> bool:
    """Whether columns of one name have one type and spelling."""
    types = {f.name.lower(): f for f in a.fields}
    return all(types[f.name.lower()].dataType == f.dataType and types[f.name.lower()].name == f.name
               for f in b.fields if f.name.lower() in types)


def data_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Data files below folders, oldest first (a listing, no content is read)."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
              .select("path", "modificationTime", "length").where("length > 0"))
    return [r["path"] for r in listed.orderBy("modificationTime", "path").collect()
            if not any(part.startswith(("_", ".")) for part in r["path"].split("/")[-1:])]


def merge_compatible_schemas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files of one folder (or several) as one table, whatever their schemas.

    Where Spark can merge the footers that is all.  Else files are grouped by
    schema, each group is read once, its columns are widened to the least common
    type (``common_type``) and missing ones are NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except Exception as e:
        if "MERGE" not in str(e).upper():
            raise
    options = {"basePath": paths[0]} if len(paths) == 1 else {}
    groups = schema_groups(spark, data_files(spark, paths), options)
    wide = common_schema([schema for schema, _ in groups])
    frames = [_widen(spark.read.options(**options).schema(schema).parquet(*files), wide) for schema, files in groups]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _widen(df: DataFrame, wide: T.StructType) -> DataFrame:
    """``df`` with the columns of ``wide``, by plain casts: widening loses nothing but
    digits beyond 2 ** 53 of long integers that meet a binary float."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in wide.fields:
        own = by_lower.get(f.name.lower())
        value = F.lit(None) if own is None else _widened(F.col(f"`{own.name}`"), own.dataType, f.dataType)
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def _widened(value: Column, own: T.DataType, wide: T.DataType) -> Column:
    """Structs are matched by field name, inside arrays too; the rest is cast."""
    if own == wide:
        return value
    if isinstance(own, T.StructType):
        by_lower = {f.name.lower(): f for f in own.fields}
        members = []
        for f in wide.fields:
            held = by_lower.get(f.name.lower())
            member = F.lit(None) if held is None else _widened(value[held.name], held.dataType, f.dataType)
            members.append(member.cast(f.dataType).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(own, T.ArrayType):
        return F.transform(value, lambda x: _widened(x, own.elementType, wide.elementType).cast(wide.elementType))
    if isinstance(own, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(
            _widened(e["key"], own.keyType, wide.keyType).cast(wide.keyType).alias("key"),
            _widened(e["value"], own.valueType, wide.valueType).cast(wide.valueType).alias("value")))
        return F.map_from_entries(pairs)
    return value.cast(wide)


def conform_to_schema(df: DataFrame, registered: T.StructType,
                      keep_new_columns: bool = True) -> DataFrame:
    """Project ``df`` onto ``registered`` (+ new columns) in a single select."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in registered.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(src).alias(f.name))
        else:
            cols.append(F.col(src).try_cast(f.dataType).alias(f.name))
    if keep_new_columns:
        known = {f.name.lower() for f in registered.fields}
        cols += [F.col(c) for c in df.columns if c.lower() not in known]
    return df.select(*cols)


def union_full_load_and_cdc(full_load: DataFrame, cdc_inserts: DataFrame,
                            registered: T.StructType | None = None) -> DataFrame:
    """Append-union (no dedup) of full-load rows and change-insert rows,
    optionally conformed to one registered schema first."""
    if registered is not None:
        full_load = conform_to_schema(full_load, registered)
        cdc_inserts = conform_to_schema(cdc_inserts, registered)
    return full_load.unionByName(cdc_inserts, allowMissingColumns=True)
