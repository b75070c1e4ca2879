"""Writers: snapshots, exports, full refresh, append, metric records."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskframe.sources.readers import table_exists


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a columnar snapshot and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", null_text: str = "NA") -> None:
    """Export with a header and without row numbers."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("lineSep", "\n")
        .option("nullValue", null_text)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def full_refresh(df: DataFrame, table: str) -> int:
    """Replace the content of an existing table, all or nothing; returns its row count.

    The rows land in a staging table made like the target (column types,
    partitioning, provider and properties), so a failure while computing,
    casting or writing leaves the target as it was; then the two tables swap
    names.  A column whose type the target's cannot hold is refused.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        raise ValueError(f"table {table} does not exist")
    target = spark.table(table)
    if sorted(target.columns) != sorted(df.columns):
        raise ValueError(f"columns differ from those of {table}")
    typed = typed_like(df, target.schema)
    tag = uuid.uuid4().hex[:8]
    staged, retired = f"{table}_staged_{tag}", f"{table}_retired_{tag}"
    try:
        spark.sql(f"CREATE TABLE {staged} LIKE {table}{_kept_properties(spark, table)}")
        typed.write.mode("append").insertInto(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    rows = spark.table(staged).count()
    spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {retired} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {retired}")
    return rows


def _kept_properties(spark: SparkSession, table: str) -> str:
    """``CREATE TABLE ... LIKE`` takes over everything but the properties."""
    own = [
        (r["key"], r["value"])
        for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        if not r["key"].startswith(("transient_", "spark.sql.", "numFiles", "totalSize"))
    ]
    quoted = ", ".join("'{}' = '{}'".format(*(x.replace("'", "\\'") for x in kv)) for kv in own)
    return f" TBLPROPERTIES ({quoted})" if own else ""


def typed_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``; a value that does not fit fails the job."""
    out = []
    for field in schema.fields:
        have = df.schema[field.name].dataType
        if have != field.dataType and not _holds(field.dataType, have):
            raise ValueError(f"{field.name}: {have.simpleString()} does not fit {field.dataType.simpleString()}")
        out.append(df[field.name].cast(field.dataType).alias(field.name))
    return df.select(*out)


def _holds(target: T.DataType, source: T.DataType) -> bool:
    """Numbers fit numbers (checked value by value), any simple value fits a text."""
    both_numbers = isinstance(target, T.NumericType) and isinstance(source, T.NumericType)
    to_text = isinstance(target, T.StringType) and not isinstance(source, (T.StructType, T.ArrayType, T.MapType))
    days = isinstance(target, T.TimestampType) and isinstance(source, (T.DateType, T.TimestampNTZType))
    return both_numbers or to_text or days or isinstance(source, T.NullType)


def full_refresh_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, **options) -> None:
    """Full refresh of a database table: emptied, then refilled in batches."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .option("batchsize", batch)
        .options(**options)
        .save()
    )


def delete_where_present(df: DataFrame, name: str) -> DataFrame:
    """What is left after deleting the rows in which a column has a value."""
    return df.where(df[name].isNull())


def append_rows(df: DataFrame, target: str) -> None:
    """Append to a table by name or to a columnar folder by path.

    A folder that holds data takes only its own columns and types.
    """
    if "/" in target:
        _same_columns(df, target)
        df.write.mode("append").parquet(target)
    else:
        columns = df.sparkSession.table(target).columns
        df.select(*columns).write.mode("append").insertInto(target)


def _same_columns(df: DataFrame, path: str) -> None:
    try:
        there = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    same_columns(df, there)


def same_columns(df: DataFrame, there: DataFrame) -> None:
    """Refuse rows whose columns or types are not those of a table."""
    if sorted(there.dtypes) != sorted(df.dtypes):
        raise ValueError(f"columns {df.dtypes} differ from those of the table: {there.dtypes}")


def _folder(spark: SparkSession, path: str):
    """A folder in whatever file system holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    at, store = _folder(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []


def move_parts(spark: SparkSession, source: str, names: list[str], target: str, prefix: str) -> None:
    """Move files of one folder into another of the same file system, each in one step, under a prefix."""
    at, store = _folder(spark, source)
    make = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        if not store.rename(make(f"{source}/{name}"), make(f"{target}/{prefix}{name}")):
            raise OSError(f"{source}/{name} could not be moved to {target}")


def append_record(spark: SparkSession, record: dict, schema: T.StructType, target: str) -> DataFrame:
    """Append one metrics record; returns it as a one-row DataFrame."""
    row = spark.createDataFrame([tuple(record[f.name] for f in schema.fields)], schema).coalesce(1)
    append_rows(row, target)
    return row
