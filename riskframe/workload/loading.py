"""Reading, writing, keyed increments and the stream replay."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.columns import stamp_load
from riskframe.operators import profile as prof
from riskframe.operators.joins import key_filters, new_rows
from riskframe.plans import crash_schema as cs
from riskframe.session import scratch_path
from riskframe.sources import readers, writers
from riskframe.streaming.ingest import load_increment, stream_increments
from riskframe.workload import sqltext as sq
from riskframe.workload.registry import feed, query, table

c = F.col

_FEED_SQL = f"WITH {sq.FEED} SELECT * FROM feed"


@query(
    "src1_raw_text",
    f"""WITH {sq.FEED} SELECT *, CAST(NULL AS VARCHAR) AS malformed_line FROM feed
    UNION ALL SELECT CASE WHEN o_orderkey % 3 = 0 THEN '"' || o_comment END,
      {", ".join(f"CASE WHEN o_orderkey % 3 = 0 THEN '' END AS {n}" for n in cs.RAW_SCHEMA.names[1:])},
      CASE o_orderkey % 3 WHEN 1 THEN 'short;' || o_orderkey
        WHEN 2 THEN o_orderkey || repeat(';x', {len(cs.RAW_SCHEMA.names)}) END FROM
      (SELECT *, CAST(o_orderkey AS VARCHAR) || ' said' AS o_comment FROM orders)""",
)
def src1(spark, sf_dir):
    """The feed, and a line with a lone quote, a short or a long line for every order."""
    path = scratch_path(spark, "raw")
    names = cs.RAW_SCHEMA.names
    blank = [F.coalesce(c(n), F.lit("NULL")) for n in names]
    feed_lines = feed(spark, sf_dir).select(F.concat_ws(";", *blank).alias("value"))
    key = c("o_orderkey").cast("string")
    lines = table(spark, sf_dir, "orders").select(
        F.when(c("o_orderkey") % 3 == 0, F.concat(F.lit('"'), key, F.lit(" said"), F.lit(";" * (len(names) - 1))))
        .when(c("o_orderkey") % 3 == 1, F.concat(F.lit("short;"), key))
        .otherwise(F.concat(key, F.lit(";x" * len(names))))
        .alias("value")
    )
    feed_lines.unionByName(lines).write.text(path)
    return readers.read_raw_text(spark, path, header=False, malformed="report")


@query("src2_read_table", "SELECT * FROM orders")
def src2(spark, sf_dir):
    name = f"orders_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "orders")
    rows.write.option("path", scratch_path(spark, name)).saveAsTable(name)
    found = readers.read_table(spark, name)
    # The files stay in the shared folder; only the catalogue entry goes.
    spark.sql(f"DROP TABLE {name}")
    return found


@query(
    "src3_read_csv",
    """SELECT * REPLACE (CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS o_totalprice)
    FROM orders""",
)
def src3(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "orders").withColumn(
        "o_totalprice", F.when(c("o_totalprice") > 1000, c("o_totalprice"))
    )
    writers.write_csv(rows, path)
    return readers.read_csv(spark, path, rows.schema)


@query("src4_read_snapshot", _FEED_SQL)
def src4(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    feed(spark, sf_dir).write.parquet(path)
    return readers.read_snapshot(spark, path)


@query(
    "snk1_materialize",
    f"WITH {sq.FEED} SELECT * FROM feed WHERE Trecho IN ({sq._ROAD_LIST})",
)
def snk1(spark, sf_dir):
    road = feed(spark, sf_dir).where(c("Trecho").isin(*cs.ROADS))
    return writers.materialize(road, scratch_path(spark, "road"))


@query("snk2_write_csv", "SELECT * FROM customer")
def snk2(spark, sf_dir):
    path = scratch_path(spark, "export")
    rows = table(spark, sf_dir, "customer")
    writers.write_csv(rows, path)
    return readers.read_csv(spark, path, rows.schema)


@query(
    "snk3_full_refresh",
    """SELECT *, 'c_mktsegment' AS partitioned_by, 'yes' AS kept FROM customer""",
)
def snk3(spark, sf_dir):
    """A partitioned, typed target with a property is refilled and stays what it was."""
    name = f"refresh_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "customer")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    old = rows.limit(10).write.partitionBy("c_mktsegment")
    old.option("path", scratch_path(spark, name)).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('kept' = 'yes')")
    writers.full_refresh(rows, name)
    target = spark.table(name)
    assert {f.name: f.dataType.simpleString() for f in target.schema.fields} == types
    partitioned = ",".join(f.name for f in spark.catalog.listColumns(name) if f.isPartition)
    kept = spark.sql(f"SHOW TBLPROPERTIES {name} ('kept')").first()["value"]
    # Read back into the shared folder so the working table can go.
    out = target.withColumns({"partitioned_by": F.lit(partitioned), "kept": F.lit(kept)})
    held = writers.materialize(out, scratch_path(spark, name))
    spark.sql(f"DROP TABLE {name}")
    return held


@query(
    "snk4_append",
    """SELECT *, 'first' AS carga_id FROM customer
    UNION ALL SELECT *, 'second' FROM customer WHERE c_custkey % 2 = 0""",
)
def snk4(spark, sf_dir):
    path = scratch_path(spark, "append")
    rows = table(spark, sf_dir, "customer")
    writers.append_rows(stamp_load(rows, "first"), path)
    writers.append_rows(stamp_load(rows.where(c("c_custkey") % 2 == 0), "second"), path)
    return readers.read_snapshot(spark, path)


_MONTHLY = """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS carga_id,
  count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1"""


@query(
    "snk5_append_record",
    f"""WITH m AS ({_MONTHLY}), r AS (SELECT * FROM m WHERE carga_id IN
      ((SELECT min(carga_id) FROM m), (SELECT max(carga_id) FROM m))) SELECT * FROM r""",
)
def snk5(spark, sf_dir):
    """The first and the last month of the orders, appended as two records and read back."""
    path = scratch_path(spark, "records")
    schema = T.StructType.fromDDL("carga_id string, n long, mean double")
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM").alias("carga_id")
    monthly = table(spark, sf_dir, "orders").groupBy(month).agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean")
    )
    ends = monthly.agg(
        F.min(F.struct("carga_id", "n", "mean")).alias("a"), F.max(F.struct("carga_id", "n", "mean")).alias("b")
    ).first()
    for record in (ends["a"], ends["b"]):
        writers.append_record(spark, record.asDict(), schema, path)
    return readers.read_snapshot(spark, path)


@query(
    "src6_table_exists",
    "SELECT 0 AS before, 1 AS after, 1 AS listed, count(*) AS n FROM supplier",
)
def src6(spark, sf_dir):
    """Whether a table is there before and after it is saved."""
    name = f"seen_{uuid.uuid4().hex}"
    before = readers.table_exists(spark, name)
    table(spark, sf_dir, "supplier").write.option("path", scratch_path(spark, name)).saveAsTable(name)
    after = readers.table_exists(spark, name)
    listed = readers.list_tables(spark).where(c("name") == name).count()
    out = readers.read_table(spark, name).agg(F.count("*").alias("n")).select(
        F.lit(int(before)).alias("before"), F.lit(int(after)).alias("after"), F.lit(listed).alias("listed"), "n"
    )
    held = writers.materialize(out, scratch_path(spark, "exists"))
    spark.sql(f"DROP TABLE {name}")
    return held


@query(
    "src7_structure",
    """SELECT 'l_returnflag' AS name, l_returnflag AS level, count(*) AS n,
      (SELECT count(*) FROM lineitem) AS rows, (SELECT count(*) FROM (DESCRIBE lineitem)) AS columns
    FROM lineitem GROUP BY l_returnflag
    UNION ALL SELECT 'l_linestatus', l_linestatus, count(*),
      (SELECT count(*) FROM lineitem), (SELECT count(*) FROM (DESCRIBE lineitem))
    FROM lineitem GROUP BY l_linestatus""",
)
def src7(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    levels = prof.column_levels(rows, ["l_returnflag", "l_linestatus"])
    return levels.join(F.broadcast(prof.dimensions(rows)))


@query("src8_bootstrap_live", "SELECT *, 'base' AS carga_id FROM customer")
def src8(spark, sf_dir):
    """An empty live table made from a schema, then its first load."""
    path = scratch_path(spark, "bootstrap")
    rows = table(spark, sf_dir, "customer")
    live = readers.bootstrap_live(spark, rows.schema)
    assert live.isEmpty()
    live.write.parquet(path)
    writers.append_rows(stamp_load(rows, "base"), path)
    return readers.read_snapshot(spark, path)


def _batch(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("Chave"), c("c_name").alias("name")
    )


@query(
    "jn1_new_rows",
    """SELECT c_custkey AS "Chave", c_name AS name FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def jn1(spark, sf_dir):
    live = table(spark, sf_dir, "events").select(c("user_id").alias("Chave"))
    return new_rows(_batch(spark, sf_dir), live, "Chave")


@query(
    "jn1_new_rows_small_batch",
    """SELECT c_custkey AS "Chave", c_name AS name FROM customer
    WHERE c_nationkey = 7 AND c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT user_id FROM events)""",
)
def jn1_small(spark, sf_dir):
    """A batch of few keys is looked up through the filters of a live table written with them."""
    path = scratch_path(spark, "live")
    seen = table(spark, sf_dir, "events").select(c("user_id").alias("Chave"), "event_type")
    seen.write.options(**key_filters("Chave")).parquet(path)
    customers = table(spark, sf_dir, "customer").where((c("c_nationkey") == 7) & (c("c_custkey") % 3 == 0))
    batch = customers.select(c("c_custkey").alias("Chave"), c("c_name").alias("name"))
    return new_rows(batch, readers.read_snapshot(spark, path), "Chave")


_LOADED = """SELECT c_custkey AS "Chave", c_name AS name,
  CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 'base' ELSE '{load}' END AS carga_id
FROM customer"""


def _live(spark, sf_dir):
    """Live table holding the customers that already appear in the events."""
    path = scratch_path(spark, "live")
    seen = table(spark, sf_dir, "events").select(c("user_id").alias("Chave")).distinct()
    stamp_load(_batch(spark, sf_dir).join(seen, "Chave", "left_semi"), "base").write.parquet(path)
    return path


# Keys that come twice in a batch with different content; all their rows are kept.
_REPEATED = f"""{_LOADED} UNION ALL SELECT c_custkey, c_name || ' bis', '{{load}}' FROM customer
WHERE c_custkey % 10 = 0 AND c_custkey NOT IN (SELECT user_id FROM events)"""


def _repeated_batch(spark, sf_dir):
    batch = _batch(spark, sf_dir)
    again = batch.where(c("Chave") % 10 == 0)
    return batch.unionByName(again.withColumn("name", F.concat("name", F.lit(" bis"))))


@query("str1_batch_increment", _REPEATED.format(load="load-1"))
def str1_batch(spark, sf_dir):
    live = _live(spark, sf_dir)
    for _ in range(2):  # run again under its id, a load adds nothing
        load_increment(_repeated_batch(spark, sf_dir), live, "Chave", "load-1")
    return readers.read_snapshot(spark, live)


@query("str1_stream_increment", _REPEATED.format(load="2026-02-12 08:00:00"))
def str1_stream(spark, sf_dir):
    live = _live(spark, sf_dir)
    arrivals = scratch_path(spark, "arrivals")
    batch = _repeated_batch(spark, sf_dir)
    batch.repartition(3).write.parquet(arrivals)
    for replay, run in enumerate(("2026-02-12 08:00:00", "2026-02-13 08:00:00")):
        # Several micro-batches are one load.  The second run starts from a
        # fresh checkpoint and must change nothing.
        stream_increments(
            spark, arrivals, batch.schema, live, "Chave", scratch_path(spark, f"state{replay}"),
            load_id=run, max_files=1,
        ).awaitTermination()
    return readers.read_snapshot(spark, live)


@query(
    "str1_stream_equal_rows",
    """WITH b AS (SELECT c_custkey AS "Chave", c_name AS name FROM customer, range(3)
      WHERE c_custkey NOT IN (SELECT user_id FROM events))
    SELECT *, 'load' AS carga_id FROM b, (VALUES ('one by one'), ('together')) AS f(files)""",
)
def str1_equal(spark, sf_dir):
    """Three equal rows of every new customer, each in another file: all are loaded, however the files arrive, and once."""
    batch = _batch(spark, sf_dir)
    arrivals = scratch_path(spark, "arrivals")
    for _ in range(3):
        batch.coalesce(1).write.mode("append").parquet(arrivals)
    seen = table(spark, sf_dir, "events").select(c("user_id").alias("Chave")).distinct()
    known = stamp_load(batch.join(seen, "Chave", "left_semi"), "base")
    tables = []
    for files, most in (("one by one", 1), ("together", None)):
        live = scratch_path(spark, "live")
        known.write.parquet(live)
        for replay in range(2):  # under the same id, from the start
            stream_increments(
                spark, arrivals, batch.schema, live, "Chave", scratch_path(spark, f"state{replay}"),
                load_id="load", max_files=most,
            ).awaitTermination()
        tables.append(readers.read_snapshot(spark, live).where(c("carga_id") == "load").withColumn("files", F.lit(files)))
    return tables[0].unionByName(tables[1])
