import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import cosines_by_hand, documents, labels

from riskframe.llm import quality, toxicity

SF01 = "/root/testdata/sf0.01"


def crc(i, parts):
    return zlib.crc32(("" if i is None else str(i)).encode()) % parts


def corpus(n=400):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 80)))
        bad = i % 4 == 0
        if bad:
            text[:: 5] = ["vile"] * len(text[:: 5])
        rows.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    return rows, marks


@pytest.mark.parametrize(
    ("classify", "label", "folds", "held", "cut"),
    [(quality.classify, "quality", 5, 0, 0.3), (toxicity.classify, "toxic", 3, 1, 0.7)],
)
class TestBoth:
    def test_held_out_accuracy_folds_and_thresholds(self, spark, classify, label, folds, held, cut):
        rows, marks = corpus()
        got = classify(documents(spark, rows), labels(spark, marks, label)).collect()
        want = dict(marks)
        assert len(got) == len(rows)
        assert all(r["held_out"] == (crc(r["doc_id"], folds) == held) for r in got)
        assert all(r["predicted"] == int(r["score"] >= cut) and 0 <= r["score"] <= 1 for r in got)
        out = [r for r in got if r["held_out"]]
        assert np.mean([(r["score"] >= 0.5) == want[r["doc_id"]] for r in out]) > 0.97

    def test_labels_of_the_held_out_fold_are_not_read(self, spark, classify, label, folds, held, cut):
        rows, marks = corpus(200)
        flipped = [(i, 1 - y if crc(i, folds) == held else y) for i, y in marks]
        a, b = (
            {r["doc_id"]: r["score"] for r in classify(documents(spark, rows), labels(spark, m, label)).collect()}
            for m in (marks, flipped)
        )
        assert a == b

    def test_unusual_input(self, spark, classify, label, folds, held, cut):
        rows, marks = corpus(100)
        rows += [(1000, None), (1001, ""), (None, "vile w1"), (3, rows[3][1]), (1002, "vile " * 300_000)]
        marks += [(None, 1), (7, None), (8, 5)]
        docs = documents(spark, rows, ["label", "score", "evidence", "lang"])
        got = classify(docs, labels(spark, marks, label).withColumnRenamed("x", "y")).collect()
        assert len(got) == len(rows)
        assert all(r["score"] is not None for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (1000, 1001)}) == 1
        assert classify(docs.limit(0), labels(spark, marks, label)).count() == 0
        for few in ([], [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)]):
            scores = {r["score"] for r in classify(docs, labels(spark, few, label)).collect()}
            assert len(scores) == 1


def test_neighbours_equal_brute_force():
    rng = np.random.default_rng(1)
    x = rng.random((300, 20)) * (rng.random((300, 20)) < 0.3)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    n = toxicity.EXAMPLES_IN_BLOCK
    blocks = [x[i : i + n].T.copy() for i in range(0, len(x), n)]
    index = toxicity.Index(np.arange(1, 21, dtype=np.uint64), np.ones(20), blocks, np.stack([b.max(axis=1) for b in blocks]),
                           np.zeros(300, int), np.arange(300), 1.0, 0.0, 0.5)
    q = x[rng.permutation(300)[:100]]
    best, which = index.nearest(q, 7)
    want = -np.sort(-(q @ x.T), axis=1)[:, :7]
    assert np.allclose(best, want)
    found = which >= 0
    assert np.allclose(np.take_along_axis(q @ x.T, np.maximum(which, 0), axis=1)[found], best[found])
    assert (best[~found] <= 1e-9).all()


@pytest.mark.parametrize("common", [8, 1024])
def test_query_neighbours_equal_brute_force_over_all_words(spark, monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "ASK_BITS", 3)
    monkeypatch.setattr(toxicity, "EXAMPLES_IN_BLOCK", 8)
    rng = np.random.default_rng(8)
    # No word tells the classes apart; many words have one or two texts.
    rows = [(i, " ".join([f"w{int(w)}" for w in rng.zipf(1.3, rng.integers(3, 60)) if w < 10_000] + ["the", f"Own{i}", f"pair{i // 2}!"]))
            for i in range(160)]
    rows += [(160 + i, rows[i][1] + " zebra") for i in range(12)] + [(172, ""), (173, None), (174, "nowhere else")]
    marks = [(i, i % 3 == 0) for i in range(160)]
    examples = [i for i in range(160) if crc(i, 3) != 1]
    got = {r["doc_id"]: r for r in toxicity.classify(documents(spark, rows), labels(spark, [(i, int(y)) for i, y in marks], "toxic")).collect()}
    assert len(got) == len(rows)
    for (i, _), want in zip(rows, cosines_by_hand(rows, examples), strict=True):
        found = got[i]["evidence"]
        best = sorted(want.values(), reverse=True)[:3]
        assert np.allclose([e["cosine"] for e in found], best)
        assert all(np.isclose(want[e["doc_id"]], e["cosine"]) and e["label"] == int(e["doc_id"] % 3 == 0) for e in found)
    assert not got[174]["evidence"]


def test_a_few_telling_words_in_long_texts_are_found(spark):
    rng = np.random.default_rng(21)
    bad = ["vile", "scum", "vermin", "idiot", "moron", "loser"]
    rows, marks = [], []
    for i in range(600):
        words = [f"w{int(n)}" for n in rng.zipf(1.2, 150) if n < 100_000]
        toxic = i % 5 == 0
        rows.append((i, " ".join(words + [str(w) for w in rng.choice(bad, 3, replace=False)] * toxic)))
        marks.append((i, int(toxic)))
    got = toxicity.classify(documents(spark, rows), labels(spark, marks, "toxic")).where("held_out").collect()
    assert np.mean([r["predicted"] for r in got if r["doc_id"] % 5 == 0]) > 0.8
    assert np.mean([r["predicted"] for r in got if r["doc_id"] % 5]) < 0.02


def test_factors_of_telling_words():
    # Word 0: in all of class 1 only; word 1: in every text; word 2: in one text; word 3: in class 0 alone.
    y = np.array([0] * 60 + [1] * 30)
    pairs = [(i, 0) for i in range(60, 90)] + [(i, 1) for i in range(90)] + [(70, 2)] + [(i, 3) for i in range(60)]
    row, term = np.array(pairs).T
    got = toxicity.telling(row, term, y, 4)
    assert got[1] == got[2] == 1
    assert np.isclose(got[0], 1 + np.log(30.5 / 31) - np.log(0.5 / 61))
    assert np.isclose(got[3], 1 + np.log(60.5 / 61) - np.log(0.5 / 31))


def test_dual_descent_reaches_the_hinge_loss_optimum():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(100, 140, 12)) for _ in range(120)]
    y = np.array([int(105 in r or 110 in r) for r in rows])
    ratio, cost = np.ones(1 << quality.BITS), np.full(120, 1.0)
    w, b = quality.descend(rows, y, ratio, cost, 200)
    x = np.zeros((120, 40))
    for i, r in enumerate(rows):
        x[i, r - 100] = 1 / np.sqrt(len(r))
    sign = 2 * y - 1

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])).sum()

    found = np.append(w[100:140], b)
    base = loss(found)
    assert all(loss(found + 0.02 * d / np.linalg.norm(d)) > base - 1e-3 for d in rng.normal(size=(200, 41)))


def test_shapes_tell_repeated_words():
    clean, loop = pa.array(["a b c d e f g h"]), pa.array(["a a a a b b b b"])
    (_, _, x), (_, _, y) = next(quality.indicators(clean)), next(quality.indicators(loop))
    assert set(x[x < quality.SHAPES]) != set(y[y < quality.SHAPES])
