"""The pipeline stage by stage, and every registered query with SQL."""

import os

import corpus_pipeline
import numpy as np
import pytest
from helpers import components, cosines_by_hand, documents, labels, shingles
from pyspark.sql import functions as F
from test_texts import lines_left

from riskframe.llm import toxicity, workload
from riskframe.llm.frames import platt, released
from tools.check import compare, connect

SF001 = "/root/testdata/sf0.001"


class Query:
    def __init__(self, name):
        self.run, self.sql = workload.QUERIES[name], workload.ORACLE_SQL.get(name)


@pytest.fixture(scope="module")
def connection():
    return connect(SF001)


@pytest.mark.parametrize("name", list(workload.ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, Query(name), SF001) is None


@pytest.mark.parametrize("name", sorted(set(workload.QUERIES) - set(workload.ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    got = workload.QUERIES[name](spark, SF001)
    table, key = ("pages", "page_id") if name.startswith("op7") else ("documents", "doc_id")
    want = spark.read.parquet(f"{SF001}/{table}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in want.select(key).collect())


def test_stages_in_order_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "byte_bpe"]


def test_executors_give_memory_back_before_each_stage(spark, monkeypatch):
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("given-back", "released")
    released(spark)
    context.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("given-back") for s in tracker.getJobInfo(j).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) == context.defaultParallelism
    said = []
    monkeypatch.setattr(corpus_pipeline, "released", lambda _: said.append("released"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001)
        said.append(name)
    assert said == [x for name, _ in corpus_pipeline.STAGES for x in ("released", name)]


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    extra = ["score", "evidence", "n_lines", "n_deleted", "component_id", "item_id", "class", "__x"]
    docs = docs.select("*", *[F.lit(c).alias(c) for c in extra])
    _, toxic = corpus_pipeline.STAGES[0]
    kept = toxic(spark, docs, SF001)
    assert kept.columns == docs.columns
    assert kept.count() > 0.8 * docs.count()

    _, lines = corpus_pipeline.STAGES[1]
    before = [(r["doc_id"], r["text"]) for r in kept.collect()]
    kept = lines(spark, kept, SF001)
    assert kept.columns == docs.columns
    after = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert after == lines_left(before, 50)
    assert {r["n_chars"] - len(r["text"]) for r in kept.collect()} == {0}

    _, near = corpus_pipeline.STAGES[2]
    left = near(spark, kept, SF001)
    assert left.columns == docs.columns
    sets = {i: shingles(t, 5) for i, t in after.items()}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = components(ids, links)
    assert {r["doc_id"] for r in left.collect()} == {i for i in sets if root.get(i, i) == i}

    _, clean = corpus_pipeline.STAGES[3]
    now = {r["doc_id"]: r["text"] for r in left.collect()}
    last = clean(spark, left, SF001)
    assert last.columns == docs.columns
    items = [shingles(t, 5) for t in bench]
    want = {i for i, t in now.items() if not any(s and len(s & shingles(t, 5)) >= 0.8 * len(s) for s in items)}
    assert {r["doc_id"] for r in last.collect()} == want


def toxic_scores_by_hand(rows, marks):
    """Calibrated score of every row from all cosines; all labels are examples."""
    mean = sum(marks.values()) / len(marks)

    def share(cosines):
        near = sorted(cosines.items(), key=lambda p: -round(p[1], 9))[: toxicity.NEIGHBOURS]
        votes = [(1 / (1.02 - min(c, 1)), marks[j]) for j, c in near]
        return sum(v * y for v, y in votes) / sum(v for v, _ in votes) if votes else None

    found = cosines_by_hand(rows, list(marks))
    place = {i: n for n, (i, _) in enumerate(rows)}
    own = {i: share({j: c for j, c in found[place[i]].items() if j != i}) for i in marks}
    some = [i for i in marks if own[i] is not None]
    y = np.array([marks[i] for i in some])
    slope, offset = platt(np.array([own[i] for i in some]) - 0.5, y, np.ones(len(y)))
    none = [marks[i] for i in marks if own[i] is None]
    nothing = (sum(none) + mean) / (len(none) + 1)
    shares = [share(c) for c in found]
    return [nothing if s is None else 1 / (1 + np.exp(-(slope * (s - 0.5) + offset))) for s in shares]


def test_toxicity_stage_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows, marks = [], {}
    for i in range(120):
        words = [f"w{n}" for n in rng.integers(0, 300, rng.integers(8, 40))] + [f"own{i}"]
        marks[i] = int(i % 4 == 0)
        rows.append((i, " ".join(words + ["vile", "scum", "vermin"] * 4 * marks[i])))
    # Copies and near copies of toxic and of clean examples, and texts without evidence.
    rows += [(200 + i, rows[i][1]) for i in range(16)] + [(300 + i, rows[i][1] + " more") for i in range(16)]
    rows += [(400, "unheard of"), (401, ""), (402, None), (None, rows[1][1])]
    folder = str(tmp_path)
    labels(spark, list(marks.items()), "toxic").write.parquet(os.path.join(folder, "labels.parquet"))
    docs = documents(spark, rows)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()]
    by_hand = toxic_scores_by_hand(rows, marks)
    assert min(abs(s - corpus_pipeline.TOXIC) for s in by_hand) > 1e-6
    want = [r for r, s in zip(rows, by_hand, strict=True) if s < corpus_pipeline.TOXIC]
    assert sorted(kept, key=str) == sorted(want, key=str)
    gone = {i for i, _ in rows} - {i for i, _ in kept}
    assert {200, 204, 208, 300, 304} <= gone
    assert not gone & {201, 202, 301, 302, 400, 401, 402, None}


def test_pipeline_on_unusual_rows_and_an_empty_table(spark, tmp_path):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    rows = spark.createDataFrame([(1, None), (None, None), (2, ""), (None, "x"), (3, "word " * 60_000), (3, "word " * 60_000)], "doc_id long, text string")
    for name, docs in (("odd", rows), ("none", rows.limit(0))):
        folder = str(tmp_path / name)
        for table, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(os.path.join(folder, f"{table}.parquet"))
        got = corpus_pipeline.run(spark, folder)
        assert got.count() == (6 if name == "odd" else 0)
