"""Line de-duplication, licence scans, URL filter, language model: against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import LOWER, documents, spaced
from pyspark.sql import functions as F

from riskframe.llm import licenses, linedup, maxent, urls
from riskframe.llm.license_rules import BASE, RULES, Rule, gates, needed_words

# --- lines ---------------------------------------------------------------------------


def lines_left(rows, min_words, shortest=True):
    """Every window of lines with enough words that an earlier place holds as well goes.

    ``shortest``: only windows that lose the words they need with their first or last line;
    they cover the same lines, but not all blank lines between these.
    """
    texts = {}
    for i, t in rows:
        if i is not None and t is not None:
            numbered = [(k, x.strip(" \t\n\x0b\x0c\r")) for k, x in enumerate(t.split("\n"))]
            texts[i] = [(k, x) for k, x in numbered if x]
    first, gone = {}, {i: set() for i in texts}
    for i in sorted(texts):
        own = texts[i]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                said = tuple(x for _, x in own[a:b])
                sizes = [len(spaced(x)) for x in said]
                if sum(sizes) >= min_words and (not shortest or sum(sizes) - max(sizes[0], sizes[-1]) < min_words):
                    if said in first:
                        gone[i].update(range(own[a][0], own[b - 1][0] + 1))
                    else:
                        first[said] = (i, a)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) if t is not None else None
            for i, t in rows}


def line_corpus(seed=2):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(12)]
    passage = [" ".join(f"p{k}{j}" for j in range(4)) for k in range(5)]
    rows = []
    for i in range(60):
        own = [rng.choice([*pool, "", " ", f"only {i} {rng.random()}"]) for _ in range(rng.randint(0, 14))]
        if i % 3 == 0:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage[rng.randint(0, 2) :]
        rows.append((i, "\n".join(own)))
    return rows


@pytest.mark.parametrize("min_words", [1, 5, 12])
def test_lines_equal_brute_force(spark, min_words):
    rows = line_corpus()
    got = linedup.dedup_lines(documents(spark, rows), min_words).collect()
    assert {r["doc_id"]: r["text"] for r in got} == lines_left(rows, min_words)
    visible = lambda left: {i: [x for x in t.split("\n") if x.strip()] for i, t in left.items()}
    assert visible({r["doc_id"]: r["text"] for r in got}) == visible(lines_left(rows, min_words, shortest=False))


def test_lines_unusual_input(spark):
    line = "one two three four"
    rows = [(1, None), (2, ""), (3, f"{line}\n\n{line} \r\nrest"), (None, line), (4, f"x\n{line}"), (4, f"x\n{line}"), (5, "\n" * 50_000)]
    docs = documents(spark, rows, ["n_lines", "doc", "__gone"])
    got = [(r["doc_id"], r["text"], r["n_deleted"], r["doc"]) for r in linedup.dedup_lines(docs.drop("__gone"), 4).collect()]
    want = [(1, None, 0, "doc"), (2, "", 0, "doc"), (3, f"{line}\n\nrest", 1, "doc"), (None, line, 0, "doc"),
            (4, "x", 1, "doc"), (4, "x", 1, "doc"), (5, "\n" * 50_000, 0, "doc")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert linedup.dedup_lines(documents(spark, rows).limit(0), 4).count() == 0


# --- licences ------------------------------------------------------------------------


def scanned(text, rules):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    norm = " " + " ".join(words) + " "

    def places(pattern):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", norm):
            start = norm[: m.start()].count(" ") - 1
            yield start, start + m.group().count(" ")

    base = sorted((a, label) for label, phrase in BASE for a, _ in places(phrase))
    found = [(a, b, r.priority, i, r.label) for i, r in enumerate(rules) if r.keyword in norm for a, b in places(r.pattern)]
    kept = [d for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1]
        and (e[2] > d[2] or e[2] == d[2] and (e[1] - e[0] > d[1] - d[0] or e[:2] == d[:2] and e[3] < d[3]))
        for e in found)]
    sure = [licenses.CONFIDENCE[d[2]] for d in kept] + [licenses.CONFIDENCE[2]] * bool(base)
    base_labels = sorted({x for _, x in base})
    return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(base_labels),
            ",".join(sorted({*base_labels, *(d[4] for d in kept)})), max(sure, default=0.0))


LICENSED = [
    None, "", "!!", "nothing here", "MIT License", "mit license mit license, MIT-licence; Mité license",
    "Licensed under the Apache License, Version 2.0 (the License)", "GNU General Public License, version 3.",
    "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "cc by-nc-sa 4.0 and CC BY 4.0; cc0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "SPDX-License-Identifier: GPL-2.0-or-later", "the gnu lesser general public license v2.1 or the GNU Affero General Public License",
    "public domain dedication and license; released into the public domain. " * 30, "x " * 50_000 + "bsd 3-clause license",
    "licence license licenses " * 200, "Apache License 2 apache licence 1.1 apache licensed",
]


def test_scans_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(None, "MIT license"), (4, "MIT License"), (4, "gpl")]
    docs = documents(spark, rows, ["body", "labels", "number"])
    got = sorted((tuple(r)[1:] for r in licenses.scan(docs).collect()), key=str)
    assert got == sorted((scanned(t, RULES) for _, t in rows), key=str)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_rules_are_many_and_pass_the_gate():
    assert len(RULES) > 200
    for rule in RULES:
        assert needed_words(rule) & set(gates()), rule
    # Words that a rule needs do stand in texts it matches.
    for rule in (r for r in RULES if not re.search(r"[|?\\.\[(]", r.pattern)):
        assert all(w in rule.pattern or w in rule.keyword for w in needed_words(rule)), rule


def test_containment_suppresses_by_priority_then_length(spark):
    rules = [Rule("a", 1, "x y", "x y"), Rule("b", 1, "x y z", "x y z"), Rule("c", 2, "y z", "y z"), Rule("d", 1, "x y", "x y"),
             Rule("e", 1, "z w", "z w")]
    docs = documents(spark, [(1, "license x y z w")])
    (row,) = licenses.scan(docs, rules).collect()
    assert row["labels"] == "b,c,e" == scanned("license x y z w", rules)[5]


# --- urls ----------------------------------------------------------------------------

URLS = [None, "", "nothing", "http://Example.NET/en/1", "https://a.b.example.net/de/2?q=/en/", "http://net", "http://net/", "ftp://x.org/fr/#a",
        "http://org/fr/", "http://x.example.com/de/1", "http://x.example.com/DE/1", "http://notexample.net/en/", "http://e.com://z", "://",
        "http://q.com?x/de/", "http://Über.example.net/en/ü"]
URLS += [f"http://h{i % 7}.example.com/{'de' if i % 2 else 'es'}/{i}" for i in range(40)]
URLS += [f"https://good{i % 5}.org/{'fr' if i % 3 else 'it'}/{i}" for i in range(40)]


def judged(all_urls, url):
    def cut(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        return rest, host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()

    def ruled(u):
        _, host, path = cut(u)
        fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.host + r.path)) if fit else None

    def pieces(rest):
        p = "\x02" * 4 + rest + "\x03"
        return [p[i : i + 5] for i in range(len(p) - 4)]

    grams = {v: Counter() for v in ("allow", "block")}
    for u in all_urls:
        r = ruled(u)
        if r and cut(u)[0]:
            for piece in pieces(cut(u)[0]):
                for k in range(6):
                    grams[r.verdict][k, piece[5 - k :]] += 1
                    if k:
                        grams[r.verdict]["context", piece[5 - k : 4]] += 1

    def chance(v, piece):
        p = 1 / urls.ALPHABET
        for k in range(5):
            p = (grams[v][k + 1, piece[4 - k :]] + urls.SMOOTH * p) / (grams[v]["context", piece[4 - k : 4]] + urls.SMOOTH)
        return p

    def mean(rest):
        return np.mean([math.log(chance("allow", x)) - math.log(chance("block", x)) for x in pieces(rest)]) if rest else 0.0

    known = {v: [mean(cut(u)[0]) for u in all_urls if (r := ruled(u)) and r.verdict == v and cut(u)[0]] for v in grams}
    a, b = np.mean(known["allow"]), np.mean(known["block"])
    spread = (sum((x - a) ** 2 for x in known["allow"]) + sum((x - b) ** 2 for x in known["block"])) / sum(map(len, known.values()))
    r = ruled(url)
    score = 1 / (1 + math.exp(-max(min((a - b) / max(spread, 1e-9) * (mean(cut(url)[0]) - (a + b) / 2), 30), -30)))
    return cut(url)[1], cut(url)[2], r and r.host + r.path, r.verdict if r else ("allow" if score >= 0.5 else "block"), score


def test_urls_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(URLS)] + [(None, URLS[3], "h", "x"), (1, "", "h", "x")],
                                  "page_id long, url string, host string, rest string")
    got = urls.judge(pages).collect()
    assert len(got) == len(URLS) + 2
    want = {u: judged([*URLS, URLS[3], ""], u) for u in URLS}
    for r in got:
        if r["page_id"] is not None:
            w = want[URLS[r["page_id"]]]
            assert tuple(r)[1:5] == w[:4] and r["score"] == pytest.approx(w[4], rel=1e-6)
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(pages.where("url IS NULL OR url = 'nothing'")).collect()} == {"allow"}


# --- language model --------------------------------------------------------------------


def prose(n=250, seed=7):
    rng = random.Random(seed)
    tongues = [[f"{t}{i}" + rng.choice(["", "", ".", ","]) for i in range(120)] for t in ("en", "dé", "fr")]
    rows = []
    for i in range(n):
        own = rng.choice(tongues)
        rows.append((i, " ".join(own[int(rng.paretovariate(0.7)) % 120] for _ in range(rng.randint(0, 90)))))
    return rows


def based(rows):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    count = Counter(w for t in train for w in [*spaced(t), None])
    total, distinct = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        own = [*spaced(t), None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        out.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(own), sum(count[w] > 0 for w in own), total, base))
    return out


@pytest.mark.parametrize("head", [maxent.HEAD, 20])
def test_base_scores_equal_brute_force_and_the_model_does_better(spark, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)
    rows = [*prose(), (1000, None), (1001, ""), (None, "en1 en2"), (3, "unheard of"), (1002, "en1 " * 100_000)]
    docs = documents(spark, rows, ["row", "score", "tail"])
    got = maxent.score(docs.repartition(3)).collect()
    key = lambda r: (str(r[0]), r[2])
    for r, w in zip(sorted((tuple(r) for r in got), key=key), sorted(based(rows), key=key), strict=True):
        assert r[:5] == w[:5]
        assert r[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert math.isfinite(r[6]) and r[6] < 0
    held = [r for r in got if r["held_out"] and (r["doc_id"] or 0) < 1000]
    assert len(held) > 10 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_without_training_documents_or_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, "a b") for i in held[:3]]
    got = maxent.score(documents(spark, rows)).collect()
    assert all((r["n_known"], r["train_tokens"]) == (0, 0) and r["base_score"] == pytest.approx(0, abs=1e-9) for r in got)
    assert maxent.score(documents(spark, rows).limit(0)).count() == 0


def test_class_probabilities_add_up_and_training_helps():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 60, 40).astype(np.uint64) & ~np.uint64(3)
    keys = np.unique(keys)
    classes = np.append(np.arange(len(keys)) % 4, maxent.END_CLASS)
    number = np.append(np.arange(len(keys)), -1)
    vocab = maxent.Vocabulary(keys, np.ones(len(keys), np.int64), number, classes, 40, 40, np.ones(maxent.CLASSES))
    table = np.zeros((maxent.ROWS, maxent.CLASSES), np.float32)
    stream = np.tile(keys[:8], 200)
    rows, at = maxent.features(vocab, stream, np.array([0, len(stream)]))
    y = maxent.target(vocab, stream, at)
    assert np.allclose(np.exp(maxent.log_softmax(table, rows[:50])).sum(axis=1), 1)

    class Batch:
        def column(self, _):
            return None

    def loss(t):
        return -maxent.log_softmax(t, rows)[np.arange(len(y)), y].mean()

    original = maxent.keyed
    maxent.keyed = lambda column: [(0, stream, np.array([0, len(stream)]))]
    try:
        change, uses = maxent.learn(table, [Batch()] * 5, vocab)
    finally:
        maxent.keyed = original
    assert loss(table + change / np.maximum(uses, 1)[:, None]) < 0.3 * loss(table)
