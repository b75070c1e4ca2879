import random

import numpy as np
import pytest
from helpers import components, documents, shingles, spaced

from riskframe.llm import decontaminate, graph, kdtree, partenum
from pyspark.sql import functions as F


def near_copies(seed=4, families=12, size=14):
    """Families of documents edited a little or a lot, with exact copies and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    rows, n = [], 0
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 9, 14, 22, 40, 80, 160]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, " ".join(text)))
            n += 1
    rng.shuffle(rows)
    return rows


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        sets[i] = shingles(t, size)
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = components(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


@pytest.mark.parametrize(("size", "percent", "block"), [(4, 85, 512), (5, 80, 3), (2, 60, 4)])
def test_components_equal_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "PIVOTS", 2)
    rows = near_copies()
    got = partenum.near_duplicates(documents(spark, rows), size, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, size, percent)
    assert len(got) == len(rows)


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95, 100])
def test_similar_sets_always_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = partenum.Bands(percent)
    for _ in range(250):
        n = int(rng.integers(1, 400))
        a = rng.integers(1, 1 << 63, n).astype(np.uint64)
        room = int(n * (100 - percent) / (100 + percent) * 2)
        lost, new = sorted(rng.integers(0, room + 1, 2))
        b = np.concatenate([a[: n - lost], rng.integers(1, 1 << 63, new - lost).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both) or (len(a) == len(b) == both):
            continue
        s, r = partenum.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
        assert len(np.intersect1d(s[r == 0], s[r == 1]))


def test_unusual_texts_link_with_nothing(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (None, "a"), (7, "x " * 200_000), (8, "x " * 200_001),
            (9, "p q r s"), (9, "p q r s")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in partenum.near_duplicates(documents(spark, rows, ["class", "coarse", "n_shingles"]), 4, 85).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 7), 9: (1, 9)}
    assert partenum.near_duplicates(documents(spark, rows).limit(0), 4, 85).count() == 0


def test_sketches_rule_out_no_similar_pair():
    rng = np.random.default_rng(6)
    for _ in range(300):
        percent = int(rng.choice([50, 70, 80, 85, 95]))
        n = int(rng.integers(1, 3000))
        a = rng.integers(1, 1 << 63, n).astype(np.uint64)
        lost = int(rng.integers(0, n // 2 + 1))
        b = np.concatenate([a[: n - lost], rng.integers(1, 1 << 63, int(rng.integers(0, lost + 2))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        s, t = partenum.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        # Sizes differ, so do widths; the narrower one decides.
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert partenum._wider(s, len(a), t, len(b), percent)
        elif both * 4 < len(a) and percent >= 80 and len(a) > 20:
            assert not partenum._wider(s, len(a), t, len(b), percent)


@pytest.mark.parametrize("n", [600, 683, 1024, 1300, 2048])
def test_sketches_rule_out_pairs_of_unlike_sets(n):
    rng = np.random.default_rng(n)
    # A third of all shingles in common. With one bit for two shingles, 4 of these 3,160 pairs passed at 1,024.
    shared = rng.integers(1, 1 << 63, n // 3).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(1, 1 << 63, n - n // 3).astype(np.uint64)])) for _ in range(80)]
    sketch = partenum.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    passed = [(i, j) for i in range(80) for j in range(i) if partenum._wider(sketch[i], len(sets[i]), sketch[j], len(sets[j]), 80)]
    assert not passed


@pytest.mark.parametrize("few", [2, 16])
def test_trees_join_every_pair_that_passes(monkeypatch, few):
    monkeypatch.setattr(partenum, "FEW", few)
    rng = np.random.default_rng(few)
    sets, families = [], 12
    for f in range(families):
        whole = rng.integers(1, 1 << 63, int(rng.choice([40, 90, 1500]))).astype(np.uint64)
        for _ in range(6):
            sets.append(np.unique(np.concatenate([whole[: int(len(whole) * rng.uniform(0.9, 1))],
                                                  rng.integers(1, 1 << 63, 3).astype(np.uint64)])))
    sizes = np.array([len(x) for x in sets])
    sketch = partenum.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]))
    groups = [np.sort(rng.choice(len(sets), int(m), replace=False)) for m in rng.integers(2, 40, 60)]
    bounds = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
    edges = partenum.passing(np.concatenate(groups), bounds, sketch, sizes, 80)
    root = components(range(len(sets)), [tuple(e) for e in edges.tolist()])
    for g in groups:
        for i in g.tolist():
            for j in g.tolist():
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                    assert root[i] == root[j]
    assert len({root[i] for i in range(len(sets))}) >= families
    assert len(edges) < len(sets)


def test_groups_of_one_signature_come_once():
    s = np.array([5, 5, 9, 9, 7, 7, 7, 3], np.uint64)
    m = np.array([1, 2, 2, 1, 4, 4, 6, 8], np.uint64)
    members, bounds = partenum.shared(s, m)
    assert [members[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] in ([[1, 2], [4, 6]], [[4, 6], [1, 2]])
    assert partenum.shared(s[:0], m[:0])[1].tolist() == [0]


def test_a_hot_group_sends_no_pairs(spark):
    """Many near copies: every signature's pairs are joined into trees."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        text[i % 120] = f"new{i}"
        rows.append((i, " ".join(text)))
    got = partenum.near_duplicates(documents(spark, rows), 4, 85).collect()
    assert {r["component_id"] for r in got} == {0}


def test_rows_that_repeat_an_id_keep_their_own_links(spark):
    own = " ".join(f"t{i}" for i in range(60))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, own), (3, own + " more"), (3, own + " more")]
    docs = documents(spark, rows).withColumn("said", F.sha2("text", 256))
    got = partenum.near_duplicates(docs, 4, 85, keep=("said",)).join(docs.select("said", "text").distinct(), "said").collect()
    assert sorted((r["doc_id"], r["text"] == own, r["component_id"]) for r in got) == [
        (1, False, 1), (2, False, 1), (2, True, 2), (3, False, 2), (3, False, 2)]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 5), (5, 101), (200, 200), (300, 299), (299, 300)]
    got = {r[0]: r[1] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 10 for i in range(10, 61)} | {5: 5, 100: 5, 101: 5, 299: 299, 300: 299}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def contaminated(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 12, 13, 20, 40, 90, 300])))) for i in range(40)]
    docs = []
    for d in range(120):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 4, 50, 900, 4000]))]
        if d % 2:
            item = rng.choice(items)[1].split()
            lose = rng.choice([0, 0, 1, len(item) // 20, len(item) // 6])
            part = item[lose:]
            if d % 8 == 1 and len(part) > 12:  # in two places
                h = len(part) // 2
                text = part[:h] + text + part[h:]
            else:
                at = rng.randrange(len(text) + 1)
                text = text[:at] + part + text[at:]
        docs.append((d, " ".join(text)))
    return docs, items


@pytest.mark.parametrize("slice_shingles", [1 << 20, 300])
def test_contained_items_equal_brute_force(spark, slice_shingles):
    docs, items = contaminated()
    got = decontaminate.contained_items(documents(spark, docs), documents(spark, items).withColumnRenamed("doc_id", "item_id"),
                                        slice_shingles=slice_shingles).collect()
    want = set()
    for d, t in docs:
        own = shingles(t, 5)
        for i, s in items:
            part = shingles(s, 5)
            if part and len(own & part) >= 0.8 * len(part):
                want.add((d, i, len(part), len(own & part)))
    assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got} == want
    assert len(got) == len(want) > 20


def test_contained_items_unusual_input(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "a b c"), (4, "x " * 100_000 + "a b c d e f g"), (None, "a b c"), (3, "A b c")],
                     ["item_id", "shingles"])
    items = documents(spark, [(1, "a b c"), (2, None), (3, ""), (4, "A B C D E F G"), (None, "a b c")]).withColumnRenamed("doc_id", "item_id")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contained_items(docs, items).collect())
    assert got == [(3, 1), (3, 1), (4, 4)]
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0


def exact(vectors, k, divisor):
    out = []
    sound = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in vectors
             if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    for q, x in sound:
        if q % divisor == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in sound if i != q and len(x) == len(y))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard_rows", "block"), [(1 << 14, 1 << 12), (40, 5)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(60)]  # ties
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] + [0.0] * 5), (404, [float("inf")] * 6),
             (None, [9.0] * 6), (410, [3.0, 3.0]), (420, [1e12] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("x", F.lit(1))
    got = kdtree.top_k(df, F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows, query_block=block).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == exact(rows, 5, 10)
    assert kdtree.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_boxes_bound_their_vectors_and_leaves_are_skipped():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 5)) * 900
    x = (centres[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 5)) * 9).astype(np.int64)
    tree = kdtree.Tree(np.arange(2000), x)
    assert sum(b - a for a, b in tree.leaves) == 2000
    for (a, b), low, high in zip(tree.leaves, tree.low, tree.high, strict=True):
        assert (tree.vectors[a:b] >= low).all() and (tree.vectors[a:b] <= high).all()
    q = x[:50]
    bounds = np.maximum(q, 0) @ tree.high.T + np.minimum(q, 0) @ tree.low.T
    kth = -np.sort(-(q @ x.T), axis=1)[:, 5]
    assert (bounds < kth[:, None]).mean() > 0.5
