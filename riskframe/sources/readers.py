"""Readers with explicit schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.plans.crash_schema import RAW_SCHEMA


def read_raw_text(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    encoding: str = "UTF-8",
    schema: T.StructType = RAW_SCHEMA,
    null_text: str = "NULL",
    quote: str = "",
    malformed: str = "raise",
    header: bool = True,
) -> DataFrame:
    """Delimited text with LF line ends, every column as text; ``header`` skips each file's first line.

    An empty field stays an empty text; only ``null_text`` is null.  Quotes are
    text unless ``quote`` names a text qualifier.  A line with more or fewer
    fields than the schema fails the read, or with ``malformed='report'`` is
    kept whole in the column ``malformed_line`` with no other values.
    """
    if malformed not in ("raise", "report"):
        raise ValueError("malformed must be 'raise' or 'report'")
    if not quote:
        return _plain_text(spark, path, sep, encoding, schema, null_text, malformed, header)
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("lineSep", "\n")
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("quote", quote)
        .option("mode", "FAILFAST")
    )
    if malformed == "report":
        raise ValueError("lines with a text qualifier can only be raised")
    # The parser cannot tell an unquoted empty field from its null marker.
    raw = reader.csv(path)
    return raw.select(
        *[
            F.when(F.col(c).isNull(), F.lit("")).when(F.col(c) != null_text, F.col(c)).alias(c)
            for c in raw.columns
        ]
    )


def _plain_text(spark, path, sep, encoding, schema, null_text, malformed, header) -> DataFrame:
    """Lines cut at every separator; nothing is cut off and nothing is filled in."""
    lines = (
        spark.read.option("header", header).option("sep", "\x00").option("quote", "\x00").option("escape", "\x00")
        .option("lineSep", "\n").option("encoding", encoding).option("maxCharsPerColumn", -1)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .schema("line string").csv(path)
    )
    fields = F.split("line", f"\\Q{sep}\\E", -1)
    sound = F.size("fields") == len(schema.fields)
    if malformed == "raise":
        shown = F.concat(F.lit(f"not {len(schema.fields)} fields: "), F.col("line"))
        fields = F.when(F.size(fields) == len(schema.fields), fields).otherwise(F.raise_error(shown))
    cut = lines.where(F.col("line").isNotNull()).withColumn("fields", fields)
    value = [F.get("fields", F.lit(i)) for i in range(len(schema.fields))]
    columns = [
        F.when(sound & (v != null_text), v).cast(f.dataType).alias(f.name) for v, f in zip(value, schema.fields)
    ]
    if malformed == "report":
        columns.append(F.when(~sound, F.col("line")).alias("malformed_line"))
    return cut.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated text with a header in which ``NA`` is null."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole catalogue table."""
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    **options,
) -> DataFrame:
    """Whole table over a database connection, read in parallel slices of a column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def read_snapshot(spark: SparkSession, source: str) -> DataFrame:
    """Whole columnar snapshot by path, or a table by name; never just one page."""
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.database, t.name, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "database string, name string, kind string")


def bootstrap_live(
    spark: SparkSession, schema: T.StructType, load_id: str = "carga_id"
) -> DataFrame:
    """Empty live table: the model columns plus the load id."""
    fields = [f for f in schema.fields if f.name != load_id]
    return spark.createDataFrame(
        [], T.StructType([*fields, T.StructField(load_id, T.StringType())])
    )
