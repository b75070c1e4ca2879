"""Sources, sinks, keyed increments, streaming replay and monitoring."""

import math
from datetime import datetime

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import profile as prof
from riskframe.plans import cleaning as plan
from riskframe.plans import crash_schema as cs
from riskframe.plans.modelling import run_study
from riskframe.plans.monitoring import latest_baseline, monitor
from riskframe.session import durable, scratch_path, shared_dir
from riskframe.sources import readers, writers
from riskframe.spec import FeatureSpec
from riskframe.streaming.ingest import load_increment, new_load_id, stream_increments
from riskframe.workload.registry import feed, planted

c = F.col


def test_raw_text_keeps_blank_and_null_apart(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "d")])
    (tmp_path / "raw.txt").write_bytes("a;b;d\n1;;NULL\n x ;é;\tz\n".encode("latin-1"))
    got = readers.read_raw_text(spark, str(tmp_path), encoding="ISO-8859-1", schema=schema)
    assert sorted(map(tuple, got.collect()), key=str) == [(" x ", "é", "\tz"), ("1", "", None)]


def test_csv_round_trip_with_missing(spark):
    path = scratch_path(spark, "csv")
    rows = spark.createDataFrame([(1, "a", None), (2, None, 0.5)], "k int, s string, v double")
    writers.write_csv(rows, path)
    back = readers.read_csv(spark, path, rows.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a", None), (2, None, 0.5)]


def test_catalogue_listing(spark):
    spark.sql("DROP TABLE IF EXISTS seen")
    assert not readers.table_exists(spark, "seen")
    spark.range(3).write.saveAsTable("seen")
    assert readers.table_exists(spark, "seen")
    assert "seen" in [r.name for r in readers.list_tables(spark).collect()]
    columns = prof.list_columns(readers.read_table(spark, "seen")).collect()
    assert [tuple(r)[:3] for r in columns] == [(1, "id", "bigint")]
    assert readers.read_snapshot(spark, "seen").count() == 3
    spark.sql("DROP TABLE seen")


def test_bootstrap_live(spark):
    live = readers.bootstrap_live(spark, cs.BASELINE_SCHEMA)
    assert live.count() == 0 and live.columns[-1] == "carga_id"
    twice = readers.bootstrap_live(spark, live.schema)
    assert twice.columns == live.columns


def test_full_refresh_replaces_everything_or_nothing(spark):
    spark.sql("DROP TABLE IF EXISTS target")
    with pytest.raises(ValueError, match="does not exist"):
        writers.full_refresh(spark.range(3), "target")
    spark.range(5).write.saveAsTable("target")
    assert writers.full_refresh(spark.range(10, 13), "target") == 3
    assert sorted(r.id for r in spark.table("target").collect()) == [10, 11, 12]
    failing = spark.range(100).select(
        F.when(c("id") < 99, c("id")).otherwise(F.raise_error(F.lit("broken row"))).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="broken row"):
        writers.full_refresh(failing, "target")
    assert sorted(r.id for r in spark.table("target").collect()) == [10, 11, 12]
    with pytest.raises(ValueError, match="columns differ"):
        writers.full_refresh(spark.range(3).withColumnRenamed("id", "other"), "target")
    names = [t.name for t in spark.catalog.listTables()]
    assert not [n for n in names if n.startswith("target_")]
    writers.append_rows(spark.range(1), "target")
    assert spark.table("target").count() == 4
    spark.sql("DROP TABLE target")


def test_delete_where_present(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert [r.k for r in writers.delete_where_present(rows, "v").collect()] == [2]


def test_increment_appends_only_new_keys(spark):
    live = scratch_path(spark, "live")
    base = spark.createDataFrame([("a", 1, "base")], "Chave string, v int, carga_id string")
    base.write.parquet(live)
    batch = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2), ("d", 4)], "Chave string, v int")
    assert load_increment(batch, live, "Chave", "l1") == (3, 0)
    assert load_increment(batch, live, "Chave", "l1") == (0, 0)
    assert load_increment(batch, live, "Chave", "l2") == (0, 0)
    rows = sorted(map(tuple, spark.read.parquet(live).collect()))
    assert rows == [("a", 1, "base"), ("b", 2, "l1"), ("b", 2, "l1"), ("d", 4, "l1")]


def test_increment_keeps_rows_that_share_a_key_unless_told_otherwise(spark):
    schema = "Chave string, v int, carga_id string"
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "Chave string, v int")
    for dedupe, want in ((False, (3, 0)), (True, (2, 1))):
        live = scratch_path(spark, "live")
        spark.createDataFrame([], schema).write.parquet(live)
        assert load_increment(batch, live, "Chave", "l1", dedupe_batch=dedupe) == want
        assert spark.read.parquet(live).count() == want[0]


def test_latest_of_eleven_runs_is_taken(spark):
    live = scratch_path(spark, "live")
    spark.createDataFrame([], "Chave string, y int, l_returnflag string, carga_id string").write.parquet(live)
    for day in range(1, 12):
        rows = [(f"{day}-{i}", i % 2, "ANR"[i % 3]) for i in range(6)]
        batch = spark.createDataFrame(rows, "Chave string, y int, l_returnflag string")
        load_increment(batch, live, "Chave", new_load_id(datetime(2026, 1, day, 8)))
    run = monitor(spark.read.parquet(live), _baseline(spark, 0.1), SPEC)
    assert run.record["carga_id"] == "2026-01-11 08:00:00.000000"


def test_half_written_increment_is_completed(spark):
    live = scratch_path(spark, "live")
    schema = "Chave string, v int, carga_id string"
    # A load that died after some of its rows had been appended.
    spark.createDataFrame([("a", 1, "base"), ("b", 2, "l1")], schema).write.parquet(live)
    batch = spark.createDataFrame([("b", 2), ("d", 4)], "Chave string, v int")
    assert load_increment(batch, live, "Chave", "l1").added == 1
    assert spark.read.parquet(live).groupBy("Chave").count().where("count > 1").count() == 0


def test_a_small_batch_reads_a_fraction_of_the_live_table(spark):
    from riskframe.operators import joins

    live = scratch_path(spark, "live")
    rows = spark.range(40_000).select(F.md5(c("id").cast("string")).alias("Chave"), c("id").alias("v"))
    # Random keys: every file spans the whole range, so only the Bloom filters tell them apart.
    rows.repartition(20).write.options(**joins.key_filters("Chave")).parquet(live)
    batch = spark.range(39_999, 40_200).select(F.md5(c("id").cast("string")).alias("Chave"))

    def rows_read(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaves = (plan.executedPlan() if "Adaptive" in plan.nodeName() else plan).collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))

    table = spark.read.parquet(live)
    keys = joins.pushed_keys(batch, "Chave")
    assert len(keys) == 201
    assert rows_read(table.where(joins._any_of(c("Chave"), keys)).select("Chave")) <= 3 * 2_000
    assert joins.new_rows(batch, table, "Chave").count() == 200
    some = spark.createDataFrame([(None,), ("x",)], "Chave string")
    assert [r[0] for r in joins.new_rows(some, table, "Chave").collect()] in ([None, "x"], ["x", None])
    assert joins.new_rows(batch.limit(0), table, "Chave").count() == 0


def test_a_failure_between_writing_and_moving_is_mended(spark, monkeypatch):
    from riskframe.streaming import ingest

    live = scratch_path(spark, "live")
    spark.createDataFrame([("a", 1, "base")], "Chave string, v int, carga_id string").write.parquet(live)
    batch = spark.createDataFrame([(f"k{i}", i) for i in range(40)] * 2, "Chave string, v int").repartition(4)

    def fails(*args):
        # The first file is moved, then the driver dies.
        writers.move_parts(args[0], args[1], args[2][:1], *args[3:])
        raise OSError("lost")

    monkeypatch.setattr(ingest, "move_parts", fails)
    with pytest.raises(OSError, match="lost"):
        load_increment(batch, live, "Chave", "l1")
    monkeypatch.undo()
    half = spark.read.parquet(live).count()
    assert 1 < half < 81
    assert load_increment(batch, live, "Chave", "l1").added == 81 - half
    assert load_increment(batch, live, "Chave", "l1").added == 0
    assert spark.read.parquet(live).groupBy("Chave").count().where("count <> 2").count() == 1


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("Chave", T.StringType()), T.StructField("v", T.IntegerType())])
    live, arrivals, state = (str(tmp_path / n) for n in ("live", "arrivals", "state"))
    readers.bootstrap_live(spark, schema).write.parquet(live)
    for _ in range(2):
        spark.createDataFrame([("a", 1), ("b", 1)], schema).coalesce(1).write.mode("append").parquet(arrivals)

    def run():
        stream_increments(spark, arrivals, schema, live, "Chave", state, load_id="l", max_files=1).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(live).collect()))

    once = run()
    assert once == [("a", 1, "l")] * 2 + [("b", 1, "l")] * 2
    # The micro-batch was written, its number was not: the stream runs it again.
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    assert run() == once
    with pytest.raises(ValueError, match="another batch"):
        load_increment(spark.createDataFrame([("c", 1)], schema), live, "Chave", "l", part=0)


def test_stream_takes_late_files_once(spark):
    live, arrivals, state = (scratch_path(spark, n) for n in ("live", "arrivals", "state"))
    schema = T.StructType([T.StructField("Chave", T.StringType()), T.StructField("v", T.IntegerType())])
    readers.bootstrap_live(spark, schema).write.parquet(live)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(arrivals)
        stream_increments(spark, arrivals, schema, live, "Chave", state, max_files=1).awaitTermination()
        return spark.read.parquet(live).count()

    assert arrive([("a", 1), ("b", 1)]) == 2
    assert arrive([("b", 2), ("d", 2)]) == 3
    assert arrive([("a", 3)]) == 3
    loads = {r.carga_id for r in spark.read.parquet(live).collect()}
    assert len(loads) == 2


def test_stream_run_is_one_load_however_many_micro_batches(spark):
    live, arrivals, state = (scratch_path(spark, n) for n in ("live", "arrivals", "state"))
    schema = T.StructType([T.StructField("Chave", T.StringType()), T.StructField("v", T.IntegerType())])
    readers.bootstrap_live(spark, schema).write.parquet(live)
    for v in range(4):
        spark.createDataFrame([("same", v)], schema).coalesce(1).write.mode("append").parquet(arrivals)
    stream = stream_increments(spark, arrivals, schema, live, "Chave", state, load_id="run", max_files=1)
    stream.awaitTermination()
    assert len(stream.recentProgress) >= 4
    assert sorted(map(tuple, spark.read.parquet(live).collect())) == [("same", v, "run") for v in range(4)]


def test_append_record_and_latest(spark):
    log = scratch_path(spark, "log")
    record = {
        "data_treinamento": datetime(2026, 1, 1), "auc_treino": 0.7, "auc_teste": 0.7,
        "ks_treino": 0.3, "ks_teste": 0.4, "cutoff": 0.03,
    }
    writers.append_record(spark, record, cs.BASELINE_SCHEMA, log)
    newer = record | {"data_treinamento": datetime(2026, 2, 1), "cutoff": 0.05}
    writers.append_record(spark, newer, cs.BASELINE_SCHEMA, log)
    assert latest_baseline(spark.read.parquet(log)).first().cutoff == 0.05
    assert latest_baseline(spark.read.parquet(log).where("false")).count() == 0


SPEC = FeatureSpec(target="y", levels={"l_returnflag": ("A", "N", "R")})


def _baseline(spark, cutoff):
    row = (datetime(2026, 1, 1), 0.7, 0.7, 0.3, 0.4, cutoff)
    return spark.createDataFrame([row], cs.BASELINE_SCHEMA)


def test_monitor_counts_unscored_and_unlisted(spark):
    live = planted(spark, SF001).withColumn("carga_id", F.lit("2026-01-01 00:00:00"))
    live = live.withColumn(
        "l_returnflag", F.when(c("l_linenumber") == 1, "?").otherwise(c("l_returnflag"))
    )
    log = scratch_path(spark, "monitoring")
    run = monitor(live, _baseline(spark, 0.1), SPEC, log)
    assert run.n_unscored == live.where("l_linenumber = 1").count() > 0
    assert [tuple(r) for r in run.unlisted.collect()] == [("l_returnflag", "?", run.n_unscored)]
    assert run.record["n_linhas_base_viva"] == live.count()
    assert 0.5 < run.record["auc_viva"] < 1 and run.baseline["auc_treino"] == 0.7
    assert tuple(spark.read.parquet(log).first())[0] == "2026-01-01 00:00:00"


def test_monitor_empty_metric(spark):
    live = planted(spark, SF001).withColumn("carga_id", F.lit("x"))
    zero = monitor(live, _baseline(spark, None), SPEC)
    assert zero.record["sensibilidade_viva"] == 0 and zero.record["cutoff_usado"] == 0
    null = monitor(live, _baseline(spark, None), SPEC, empty_metric="null")
    assert null.record["sensibilidade_viva"] is None and null.record["cutoff_usado"] is None
    with pytest.raises(ValueError):
        monitor(live, _baseline(spark, 0.1).where("false"), SPEC)


def test_study_on_the_crash_feed(spark):
    model = plan.model_table(durable(plan.feature_table(feed(spark, SF001))))
    n = model.count()
    study = run_study(model, cs.CRASH_SPEC.without("Km_cat"))
    rows = {r["sample"]: r for r in study.comparison.collect()}
    assert set(rows) == {"logit/train", "logit/test", "chaid/train", "chaid/test"}
    train, test = rows["logit/train"], rows["logit/test"]
    assert train.tp + train.fp + train.fn + train.tn + train.unscored == math.floor(0.8 * n)
    assert test.tp + test.fp + test.fn + test.tn + test.unscored == n - math.floor(0.8 * n)
    assert all(0 <= r.accuracy <= 1 for r in rows.values())
    assert {r.metric for r in study.cutoffs.collect()} == {"abs_d_sens_spec", "accuracy", "f1", "youden"}


def test_shared_folder_setting_is_respected(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
