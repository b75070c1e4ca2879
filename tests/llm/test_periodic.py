import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import documents

from riskframe.llm import periodic, workload


def runs_by_hand(words):
    """Every lag scanned; a stretch whose words have a smaller period is none of this one."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, x in enumerate(same):
            if x and start is None:
                start = i
            if not x and start is not None:
                length = i - start + q
                part = words[start : start + length]
                smaller = any(part[d:] == part[:-d] for d in range(1, q))
                if length >= max(6, 4 * q) and not smaller:
                    found.append((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(seed, n):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        kind = rng.random()
        alphabet = "ab" if kind < 0.4 else "abcdefghij"
        piece = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 16, 17, 31, 33, 64, 65, 100]))]
        if kind < 0.8:
            piece = (piece * 6)[: int(len(piece) * rng.uniform(2.5, 6))]
        out += piece
    return out


def test_runs_equal_brute_force_over_many_texts_at_once():
    texts = [repetitive(s, random.Random(s).choice([5, 40, 200, 500])) for s in range(50)] + [[], ["a"], ["a"] * 6, list("abab") * 30]
    rng = random.Random(5)
    texts += [[rng.choice("ab") for _ in range(60)] for _ in range(200)]
    letters = {c: i for i, c in enumerate("abcdefghij")}
    ids = np.array([letters[c] for t in texts for c in t], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = periodic.runs_of(ids, bounds)
    for i, t in enumerate(texts):
        assert [tuple(r) for r in got[got[:, 0] == i, 1:].tolist()] == runs_by_hand(t)
    assert (got[:, 3] > periodic.DIRECT).sum() > 30


def test_long_periods_come_from_seeds_alone():
    rng = np.random.default_rng(1)
    for period in (9, 16, 17, 1000, 4096, 4097):
        word = rng.integers(0, 5000, period)
        ids = np.concatenate([rng.integers(0, 5000, 777), np.tile(word, 4), rng.integers(5000, 6000, 99)])
        got = periodic.runs_of(ids, np.array([0, len(ids)]))
        assert [tuple(r) for r in got.tolist()] == [(0, 777, 4 * period, period)]


def planted_by_hand(doc_id, text):
    w = text.encode().split()
    w = [x.decode() for x in w]
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def test_planted_documents_have_their_runs(spark):
    rng = random.Random(3)
    rows = [(i, " \x0b".join(f"w{rng.randrange(50)} " for _ in range(rng.choice([0, 1, 7, 60, 300])))) for i in range(300)]
    got = {r["doc_id"]: r for r in periodic.find_runs(workload.planted(documents(spark, rows))).collect()}
    some = 0
    for i, text in rows:
        w = planted_by_hand(i, text)
        runs = runs_by_hand(w)
        r = got[i]
        assert r["n_words"] == len(w) and [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == collapsed_by_hand(w, runs)
        some += bool(runs)
    assert some > 5


def test_unusual_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a a a a a a"), (4, "A a A a A a A a b"), (4, "A a A a A a A a b"), (5, "x " * 300_000),
            (6, "x\u00a0x " * 6)]
    docs = documents(spark, rows, ["runs", "n_words", "__text"])
    got = periodic.find_runs(docs).collect()
    assert len(got) == len(rows)
    by_text = {r["text"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in got}
    assert by_text[None] == by_text[""] == by_text[" \n"] == ([], "")
    assert by_text["a a a a a a"] == ([(0, 6, 1)], "a")
    assert by_text["A a A a A a A a b"] == ([(0, 8, 2)], "A a b")
    assert by_text["x " * 300_000] == ([(0, 300_000, 1)], "x")
    assert by_text[rows[-1][1]] == ([(0, 6, 1)], "x\u00a0x")
    assert periodic.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs, min_exponent=3)


def test_the_query_takes_the_greatest_exact_exponent(spark, tmp_path):
    rows = [(11, "a a a a a a b c b c b c b c b c b c"), (12, "p q p q p q p q p x y x y x y x y x"), (13, "no run"), (14, None)]
    assert not any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in workload.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert tuple(got[11])[1:6] == (2, 0, 6, 1, 6000)
    assert tuple(got[12])[1:6] == (2, 0, 9, 2, 4500)
    assert tuple(got[13])[1:6] == (0, None, None, None, None)
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[14]["runs_sha256"], got[14]["collapsed_sha256"]) == (empty, empty)
    assert got[12]["runs_sha256"] == hashlib.sha256(b"0,9,2\n9,9,2\n").hexdigest()
