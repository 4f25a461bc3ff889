"""Type names of the source warehouse and what they become."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type name, standard SQL type code, code name, logical class, primitive.
TYPE_TABLE = (
    ("ARRAY", 12, "VARCHAR", "UNKNOWN", "array"),
    ("BIGNUMERIC", 3, "DECIMAL", "REAL", "real"),
    ("BOOL", 16, "BOOLEAN", "BOOLEAN", "bool"),
    ("BYTES", -2, "BINARY", "BYTES", "blob"),
    ("DATE", 91, "DATE", "DATE", "date"),
    ("DATETIME", 93, "TIMESTAMP", "DATETIME", "string"),
    ("FLOAT64", 8, "DOUBLE", "REAL", "real"),
    ("GEOGRAPHY", 12, "VARCHAR", "UNKNOWN", "string"),
    ("INT64", -5, "BIGINT", "INTEGER", "integer"),
    ("INTERVAL", 12, "VARCHAR", "UNKNOWN", "string"),
    ("JSON", 12, "VARCHAR", "STRING", "string"),
    ("NUMERIC", 2, "NUMERIC", "REAL", "real"),
    ("STRING", 12, "VARCHAR", "STRING", "string"),
    ("STRUCT", 12, "VARCHAR", "UNKNOWN", "object"),
    ("TIME", 92, "TIME", "TIME", "string"),
    ("TIMESTAMP", 93, "TIMESTAMP", "DATETIME", "string"),
    ("RANGE", 12, "VARCHAR", "UNKNOWN", "string"),
)

# Accepted spellings that are not type names themselves.
TYPE_ALIASES = {"INTEGER": "INT64", "FLOAT": "FLOAT64", "BOOLEAN": "BOOL"}

SPARK_TYPES = {
    "INT64": "bigint",
    "FLOAT64": "double",
    "NUMERIC": "decimal(38,9)",
    "BIGNUMERIC": "decimal(38,18)",
    "BOOL": "boolean",
    "BYTES": "binary",
    "STRING": "string",
    "DATE": "date",
    "TIME": "string",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp",
    "JSON": "string",
    "GEOGRAPHY": "string",
    "INTERVAL": "string",
}


def standard_name(type_name: str) -> str:
    """``varchar(10)``-style names without their size, aliases resolved."""
    base = type_name.split("(")[0].strip().upper()
    return TYPE_ALIASES.get(base, base)


def spark_type(type_name: str) -> str:
    base = standard_name(type_name)
    if base not in SPARK_TYPES:
        raise ValueError(f"unsupported type: {type_name}")
    return SPARK_TYPES[base]


def source_type(dtype: T.DataType) -> str:
    """The warehouse's name for a Spark type."""
    if isinstance(dtype, T.ArrayType):
        return "REPEATED " + source_type(innermost(dtype))
    if isinstance(dtype, T.StructType):
        names = [f.name for f in dtype.fields]
        return "RANGE" if names == ["start", "end"] else "STRUCT"
    if isinstance(dtype, T.DecimalType):
        return "NUMERIC" if dtype.scale <= 9 else "BIGNUMERIC"
    for kinds, name in (
        ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "INT64"),
        ((T.FloatType, T.DoubleType), "FLOAT64"),
        ((T.BooleanType,), "BOOL"),
        ((T.BinaryType,), "BYTES"),
        ((T.DateType,), "DATE"),
        ((T.TimestampNTZType,), "DATETIME"),
        ((T.TimestampType,), "TIMESTAMP"),
        ((T.VariantType,), "JSON"),
        ((T.DayTimeIntervalType, T.YearMonthIntervalType), "INTERVAL"),
    ):
        if isinstance(dtype, kinds):
            return name
    return "STRING"


def innermost(dtype: T.DataType) -> T.DataType:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype


def array_depth(dtype: T.DataType) -> int:
    depth = 0
    while isinstance(dtype, T.ArrayType):
        depth, dtype = depth + 1, dtype.elementType
    return depth


def type_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(TYPE_TABLE),
        "type_name string, sql_code int, sql_name string, logical_class string, primitive string",
    )


def map_types(fields: DataFrame, column: str = "source_type") -> DataFrame:
    """Add code, class and primitive of each field's type, whatever its case.

    Repeated and unknown types become VARCHAR / UNKNOWN. The lookup side is the
    17-row type table.
    """
    name = F.upper(F.col(column))
    return fields.join(F.broadcast(type_rows(fields.sparkSession)), name == F.col("type_name"), "left").select(
        *fields.columns,
        F.coalesce("sql_code", F.lit(12)).alias("sql_code"),
        F.coalesce("sql_name", F.lit("VARCHAR")).alias("sql_name"),
        F.coalesce("logical_class", F.lit("UNKNOWN")).alias("logical_class"),
        F.when(name.startswith("REPEATED"), F.lit("array")).otherwise(F.col("primitive")).alias("primitive"),
    )
