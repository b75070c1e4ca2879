"""Keyed incremental load, as one batch or as a file stream."""

from __future__ import annotations

import hashlib
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskframe.operators.columns import stamp_load
from riskframe.operators.joins import key_filters, new_rows
from riskframe.session import durable
from riskframe.sources.writers import list_names, move_parts, same_columns


LOAD_ID = "carga_id"


class Loaded(NamedTuple):
    """Rows appended, and rows of the batch left out as repeats of one of its keys."""

    added: int
    repeats: int


def new_load_id(at: datetime | None = None) -> str:
    """An id whose text order is the order of the runs."""
    return (at or datetime.now()).strftime("%Y-%m-%d %H:%M:%S.%f")


def load_increment(
    batch: DataFrame,
    live_path: str,
    key: str,
    load_id: str,
    dedupe_batch: bool = False,
    part: int | None = None,
) -> Loaded:
    """Append the rows of a batch whose key no earlier load brought.

    All rows of a new key are kept; ``dedupe_batch`` keeps one per key of the
    load and reports how many it leaves out.

    The batch is one part of its load, known by ``part`` (a micro-batch's
    number) or by its content.  A part is first written in full beside the live
    files, where readers do not look, and then its files are moved among them
    under names of their own.  Run again, a part that was not written in full
    starts anew, one that was only has its remaining files moved, and one that
    has been moved adds nothing: nothing is decided by comparing rows.
    """
    spark = batch.sparkSession
    name = hashlib.sha256(load_id.encode()).hexdigest()[:16]
    log = f"{live_path.rstrip('/')}/_loads/{name}"
    content = batch.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).alias("h")
    ).first()
    said = f"{content['n']}-{int(content['h'] or 0) % (1 << 64):016x}"
    number = f"b{said}" if part is None else f"{part:08d}"
    staged = f"{log}/{number}-{said}"
    known = [n for n in list_names(spark, log) if n.startswith(f"{number}-")]
    if known and known != [f"{number}-{said}"]:
        raise ValueError(f"part {part} of load {load_id!r} was another batch before")
    repeats = 0
    if "_SUCCESS" not in list_names(spark, staged):
        live = spark.read.parquet(live_path)
        rows = stamp_load(batch, load_id)
        same_columns(rows, live)
        own = F.col(LOAD_ID).eqNullSafe(F.lit(load_id))
        earlier = live.where(~own)
        # Rows under this id that no part of it has moved here: left by another writer that failed half way.
        foreign = live.where(own & ~F.col("_metadata.file_name").startswith(f"load-{name}-"))
        fresh = new_rows(rows, earlier, key).select(*live.columns)
        if dedupe_batch:
            every = durable(fresh)
            fresh = durable(new_rows(every, live.where(~own | F.col("_metadata.file_name").startswith(f"load-{name}-")), key,
                                     dedupe_batch=True).select(*live.columns))
            repeats = every.count() - fresh.count()
        if not foreign.isEmpty():
            fresh = fresh.exceptAll(foreign)
        # The next loads look their keys up here.
        fresh.write.mode("overwrite").options(**key_filters(key)).parquet(staged)
    left = [n for n in list_names(spark, staged) if n.startswith("part-")]
    n = spark.read.parquet(*[f"{staged}/{f}" for f in left]).count() if left else 0
    move_parts(spark, staged, left, live_path, f"load-{name}-{number}-")
    return Loaded(n, repeats)


def stream_increments(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    live_path: str,
    key: str,
    checkpoint: str,
    load_id: str | None = None,
    max_files: int | None = None,
    dedupe_batch: bool = False,
) -> StreamingQuery:
    """Run every file not seen yet through ``load_increment``, then stop.

    The run is one load with one id, by default its start time, however many
    micro-batches it takes (``max_files`` bounds the files of one); a
    micro-batch is a part of it under its own number, so one that is replayed
    after a failure adds nothing twice.  Keys are looked up among earlier loads
    only, so the rows kept do not depend on how the files fall into
    micro-batches; with ``dedupe_batch`` the first micro-batch of a key wins.
    """
    run = load_id or new_load_id()

    def load(batch: DataFrame, batch_id: int) -> None:
        load_increment(batch, live_path, key, run, dedupe_batch, part=batch_id)

    arriving = spark.readStream.schema(schema)
    if max_files:
        arriving = arriving.option("maxFilesPerTrigger", max_files)
    return (
        arriving.parquet(source_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
