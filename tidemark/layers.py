"""Layer schemas, layer columns and the source type map."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ntz

NTZ = T.TimestampNTZType()

# Column names and types of the stored layers and of the run log.
AUDIT_FIELDS = (
    T.StructField("_LOAD_TS", NTZ),
    T.StructField("_SRC_FILE", T.StringType()),
    T.StructField("_BATCH_ID", T.StringType()),
    T.StructField("_IS_DELETED", T.BooleanType()),
    T.StructField("_DELETED_AT", NTZ),
)
AUDIT = tuple(f.name for f in AUDIT_FIELDS)

CONTROL_FIELDS = (
    T.StructField("EFF_FROM", NTZ),
    T.StructField("EFF_TO", NTZ),
    T.StructField("IS_CURRENT", T.BooleanType()),
    T.StructField("IS_DELETED", T.BooleanType()),
    T.StructField("ROW_HASH", T.LongType()),
    T.StructField("_LOAD_TS", NTZ),
    T.StructField("_BATCH_ID", T.StringType()),
)
DIM_KEY = T.StructField("DIM_KEY", T.LongType())
CONTROL = (DIM_KEY.name, *(f.name for f in CONTROL_FIELDS))

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("RUN_ID", T.StringType()),
        T.StructField("BATCH_ID", T.StringType()),
        T.StructField("SOURCE_DB", T.StringType()),
        T.StructField("SOURCE_TABLE", T.StringType()),
        T.StructField("TARGET_TABLE", T.StringType()),
        T.StructField("LOAD_TYPE", T.StringType()),
        T.StructField("ENGINE", T.StringType()),
        T.StructField("ROWS_EXTRACTED", T.LongType()),
        T.StructField("ROWS_RAW", T.LongType()),
        T.StructField("ROWS_SILVER", T.LongType()),
        T.StructField("WATERMARK_FROM", T.StringType()),
        T.StructField("WATERMARK_TO", T.StringType()),
        T.StructField("STATUS", T.StringType()),
        T.StructField("ERROR_MESSAGE", T.StringType()),
        T.StructField("FAILED_STEP", T.StringType()),
        T.StructField("DURATION_SEC", T.DecimalType(38, 2)),
        T.StructField("RUN_START_UTC", NTZ),
        T.StructField("RUN_END_UTC", NTZ),
        T.StructField("INSERTED_AT", NTZ),
    ]
)


# --- schemas ---------------------------------------------------------------

def raw_schema(business: T.StructType) -> T.StructType:
    return T.StructType([*business.fields, *AUDIT_FIELDS])


def scd2_schema(business: T.StructType, surrogate: bool = True) -> T.StructType:
    head = [DIM_KEY] if surrogate else []
    return T.StructType([*head, *business.fields, *CONTROL_FIELDS])


def business_fields(schema: T.StructType) -> list[T.StructField]:
    """Fields that are neither audit nor control columns, by explicit list."""
    reserved = {c.upper() for c in (*AUDIT, *CONTROL)}
    return [f for f in schema.fields if f.name.upper() not in reserved]


def business_columns(df: DataFrame) -> list[str]:
    return [f.name for f in business_fields(df.schema)]


# --- layer projections -----------------------------------------------------

def with_audit(
    df: DataFrame, as_of: object, batch_id: str | None = None, src_file: Column | str | None = None
) -> DataFrame:
    """Business columns plus fresh audit columns, in RAW order.

    ``src_file`` may be a column of ``df``; audit columns ``df`` has are replaced.
    """
    source = src_file if isinstance(src_file, Column) else F.lit(src_file).cast("string")
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in AUDIT],
        ntz(as_of).alias("_LOAD_TS"),
        source.alias("_SRC_FILE"),
        F.lit(batch_id).cast("string").alias("_BATCH_ID"),
        F.lit(False).alias("_IS_DELETED"),
        F.lit(None).cast(NTZ).alias("_DELETED_AT"),
    )


def is_deleted() -> Column:
    return F.coalesce(F.col("_IS_DELETED"), F.lit(False))


def live(raw: DataFrame) -> DataFrame:
    """RAW rows that are not soft-deleted."""
    return raw.where(~is_deleted())


def without_audit(raw: DataFrame) -> DataFrame:
    return raw.drop(*AUDIT)


def without_control(dim: DataFrame) -> DataFrame:
    return dim.drop(*CONTROL)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


# --- source types ----------------------------------------------------------

@dataclass(frozen=True)
class SourceColumn:
    """Column metadata as a relational source reports it."""

    name: str
    data_type: str
    column_type: str = ""
    precision: int | None = None
    scale: int | None = None
    length: int | None = None


MAX_PRECISION = 38
INTEGER_TYPES = frozenset({"tinyint", "smallint", "mediumint", "int", "integer", "bigint"})

# Source type names.
_BY_NAME: dict[str, T.DataType] = {
    **{name: T.LongType() for name in (*INTEGER_TYPES, "year")},
    **{name: T.DoubleType() for name in ("float", "double", "real")},
    **{name: NTZ for name in ("datetime", "timestamp")},
    **{
        name: T.BinaryType()
        for name in ("blob", "tinyblob", "mediumblob", "longblob", "binary", "varbinary")
    },
    "date": T.DateType(),
    # Spark has no default TIME type wide enough for a source TIME (-838h..838h).
    "time": T.StringType(),
    "json": T.VariantType(),
}


def is_wide_decimal(col: SourceColumn) -> bool:
    return (
        col.data_type.lower() in ("decimal", "numeric")
        and col.precision is not None
        and int(col.precision) > MAX_PRECISION
    )


def spark_type(col: SourceColumn) -> T.DataType:
    """Spark type of a source column; anything unknown is text."""
    kind, declared = (col.data_type or "").lower(), (col.column_type or "").lower()
    if kind == "tinyint" and "tinyint(1)" in declared:
        return T.BooleanType()
    if kind == "bigint" and "unsigned" in declared:
        return T.DecimalType(20, 0)
    if kind in ("decimal", "numeric"):
        if is_wide_decimal(col):
            return T.StringType()
        precision = MAX_PRECISION if col.precision is None else int(col.precision)
        return T.DecimalType(precision, int(col.scale or 0))
    return _BY_NAME.get(kind, T.StringType())


def target_schema(columns: Sequence[SourceColumn]) -> T.StructType:
    if not columns:
        raise ValueError("no column metadata for this table: it may not exist or not be readable")
    return T.StructType([T.StructField(c.name.upper(), spark_type(c)) for c in columns])


def _cast(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return col
    if isinstance(want, T.VariantType):
        return F.parse_json(col)
    if isinstance(want, T.BooleanType) and isinstance(have, T.StringType):
        return col.cast("long").cast("boolean")
    return col.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: by name, ordered, upper case, cast.

    Matching ignores case.  A column the input lacks becomes NULL, a column the
    schema lacks is dropped.  Casts follow ANSI rules, so a bad value fails the load.
    """
    have = {f.name.upper(): f for f in df.schema.fields}
    out = []
    for field in schema.fields:
        source = have.get(field.name.upper())
        if source is None:
            col = F.lit(None).cast(field.dataType)
        else:
            col = _cast(F.col(f"`{source.name}`"), source.dataType, field.dataType)
        out.append(col.alias(field.name))
    return df.select(*out)
