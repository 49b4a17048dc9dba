"""File sources and sinks: raw CSV, Parquet, published tables and views."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.reshape import day_values
from shelfcast.sources import versions
from shelfcast.schemas import CALENDAR_SCHEMA, DAY_PREFIX, ID_COLS, PRICES_SCHEMA

# The text pandas' read_csv treats as missing by default.
PANDAS_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                      "nan", "null"]

_KNOWN_TYPES = {f.name: f.dataType for f in list(CALENDAR_SCHEMA.fields) + list(PRICES_SCHEMA.fields)}
_KNOWN_TYPES.update({c: T.StringType() for c in ID_COLS})


def schema_from_header(columns: list[str]) -> T.StructType:
    """Explicit schema in header order: known columns get their type, ``d_*``
    day columns are int, anything else string (never inferred)."""
    fields = []
    for c in columns:
        if c in _KNOWN_TYPES:
            fields.append(T.StructField(c, _KNOWN_TYPES[c]))
        elif c.startswith(DAY_PREFIX) and c[len(DAY_PREFIX):].isdigit():
            fields.append(T.StructField(c, T.IntegerType()))
        else:
            fields.append(T.StructField(c, T.StringType()))
    return T.StructType(fields)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (reads only the first line)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 null_tokens: list[str] | None = None) -> DataFrame:
    """Headed CSV with an explicit schema (generated from the header when not given).

    Each file's header is checked against the schema, and a text that is no number where
    one is due raises: it must not turn into a missing price.  Spark treats only the empty
    field as null; ``null_tokens`` (for instance ``PANDAS_NULL_TOKENS``) are made null as
    pandas does, in numeric columns before they are parsed."""
    schema = schema or schema_from_header(csv_header(spark, path))
    tokens = [t for t in null_tokens or [] if t != ""]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]) if tokens else schema
    df = (spark.read.schema(as_text).option("header", True).option("enforceSchema", False)
          .option("mode", "FAILFAST").csv(path))
    if not tokens:
        return df
    kept = lambda c: F.when(~c.isin(tokens), c)
    days = [f.name for f in schema.fields if f.name.startswith(DAY_PREFIX) and isinstance(f.dataType, T.IntegerType)]
    # thousands of day columns: one expression over their array plans far faster than one each
    named = [kept(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in set(days)]
    if not days:
        return df.select(*named)
    units = F.transform(day_values(days, "string"), lambda x: kept(x).cast("int"))
    at = {d: i for i, d in enumerate(days)}
    return df.select(*named, units.alias("_units")).selectExpr(
        *[f"get(_units, {at[f.name]}) AS `{f.name}`" if f.name in at else f"`{f.name}`" for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_csv_autodetect(spark: SparkSession, csv_path: str, out_path: str) -> tuple[DataFrame, int]:
    """CSV with one header row and inferred types, truncate-and-write to
    Parquet, then report the row count of what was written."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(csv_path)
    df.write.mode("overwrite").parquet(out_path)
    written = spark.read.parquet(out_path)
    return written, written.count()


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None) -> str:
    """Overwrite one Parquet table; optional Hive-style partitions and
    within-file sort (tight min/max statistics for pruning)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Whole-table read, or a column list (pruned in the scan's ReadSchema)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def publish_table(df: DataFrame, name: str, path: str, bucket_by: str | None = None,
                  buckets: int | None = None, sort_by: list[str] | None = None, keep: int = 2) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT: an external table whose versions lie under ``path``
    (in the shared folder), optionally bucketed so that later joins and windows on the bucket
    key need no shuffle.  The table moves to the new version when that is complete; the one
    before stays for those who read it, older ones are expired."""
    spark = df.sparkSession
    versions.publish_version(df, path, bucket_by=bucket_by, buckets=buckets, sort_by=sort_by or ())
    table = versions.register_version(spark, name, path)
    versions.expire(spark, path, keep)
    return table


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE VIEW: a session view over the plan (nothing stored)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
