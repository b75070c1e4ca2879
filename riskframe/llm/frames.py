"""Frame helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only when its counted bytes stay under this.
BROADCAST_BYTES = 64 << 20
#: Entries of a summed table in one row.
BLOCK = 4096
#: Tasks whose tables are added in a first step.
FAN = 512


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def counted_bytes(df: DataFrame) -> int:
    """About what the rows of ``df`` take: texts, binaries and arrays by their length, 8 bytes for any other value."""
    width = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + 8 * F.greatest(F.size(F.col(f.name)), F.lit(0))
        width = width + 8
    return int(df.agg(F.sum(width.cast("long"))).first()[0] or 0)


def small_if_counted(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (kept or cheap) with a broadcast hint if its counted bytes are at most ``most``; else left to a shuffle."""
    return F.broadcast(df) if counted_bytes(df) <= most else df


def released(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints of frames that are no longer used, and executors give memory back.

    It deletes them once the JVM has collected them, which a driver with a large heap seldom does by itself. An
    executor's heap, once grown, is given back only by a full collection; one task a core asks for it. Tasks are
    dealt over idle executors evenly, so each gets some.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def trimmed() -> None:
    """Give memory that a Python worker no longer uses back to the machine; an idle one would keep it from its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def renewed(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, for a cogroup with a frame of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def map_column(df: DataFrame, column: str, keep: list[str], made: list[tuple[str, T.DataType]],
               make: Callable[[pa.Array], list]) -> DataFrame:
    """(keep..., made...): columns made from one column, batch by batch, rows in place."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, kind) for n, kind in made])
    names = keep + [n for n, _ in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = make(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(i + 1) for i in range(len(keep))] + new, names=names)
            del new, batch
        trimmed()

    return df.select(F.col(column), *[F.col(c) for c in keep]).mapInArrow(run, schema)


def table_rows(tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's dense table as rows of blocks, for ``summed``; blocks of zeros are left out."""
    flat = tables.reshape(-1)
    some = [i for i in range(0, len(flat), BLOCK) if flat[i : i + BLOCK].any()]
    task = TaskContext.get()
    if some:
        yield pa.RecordBatch.from_arrays(
            [pa.array([i // BLOCK for i in some], pa.int32()),
             pa.array([task.partitionId() // FAN if task else 0] * len(some), pa.int32()),
             pa.array([flat[i : i + BLOCK].tobytes() for i in some], pa.binary())],
            names=["block", "part", "sums"],
        )


TABLE_SCHEMA = "block int, part int, sums binary"


def summed(parts: DataFrame, size: int, kind: type = np.float64) -> np.ndarray:
    """The sum of all tasks' tables of ``size`` entries: a fixed size, whatever the input's.

    Tables of at most ``FAN`` neighbouring tasks are added first, then their sums.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(piece, kind) for piece in rows["sums"])
        return pd.DataFrame({"block": rows["block"].iloc[:1], "part": rows["part"].iloc[:1], "sums": [total.tobytes()]})

    out = np.zeros(size, kind)
    sums = parts.groupBy("block", "part").applyInPandas(add, TABLE_SCHEMA).groupBy("block").applyInPandas(add, TABLE_SCHEMA)
    for row in sums.toLocalIterator():
        at = row["block"] * BLOCK
        out[at : at + BLOCK] = np.frombuffer(bytes(row["sums"]), kind)
    return out


def labelled_sample(labels: DataFrame, doc_id: str, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of at most ``per_class`` rows of either class, and how many there are of each.

    The rows with the smallest hashes are taken, so the sample is the same on every run.
    """
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(doc_id), F.col(label).cast("int").alias("label")
    ).distinct()
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col(doc_id))
    taken = [rows.where(F.col("label") == c).orderBy(order, doc_id).limit(per_class) for c in (0, 1)]
    return taken[0].unionByName(taken[1]), {c: counts.get(c, 0) for c in (0, 1)}


def platt(decision: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels on one decision value."""
    a, b = 1.0, 0.0
    x = np.stack([decision, np.ones_like(decision)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * decision + b, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-3 * np.array([a, 0])
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-8:
            break
    return a, b


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
