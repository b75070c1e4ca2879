import random
from collections import Counter

import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from riskframe.llm import tokencounts, workload

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def by_library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def check(rows):
    for r, text in rows:
        assert (r["n_bytes"], r["n_tokens"]) == (len((text or "").encode()), by_library(text))
        assert r["over_limit"] == (r["n_tokens"] > 512)


def test_query_counts_as_the_library_does(spark):
    sf_dir = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = workload.op13_token_counts(spark, sf_dir).collect()
    assert len(got) == len(text) and got[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    check([(r, text[r["doc_id"]]) for r in got])


def test_random_characters_special_tokens_and_cuts(spark, monkeypatch):
    monkeypatch.setattr(tokencounts, "PIECE", 40)
    rng = random.Random(8)
    alphabet = ["a", "Zé", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "7", "'s", "!?", "<|endoftext|>", "<|endoftext|", "漢",
                " " * 9, "\n" * 8 + " ", "՘", "꟒", "\U00010940", " ", "٣"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 150))) for _ in range(600)]
    s = tokencounts.splitter(FILE, public_tokenizers.PATTERN)
    odd = __import__("re").compile(tokencounts.disagreements(FILE, public_tokenizers.PATTERN)[1])
    for t in texts:
        if not odd.search(t):
            n, between = s.parts(t)
            pieces = [p for b in between for found in s.pieces(b) for p in found]
            assert n + sum(map(s.length, pieces)) == by_library(t)
    monkeypatch.undo()
    got = tokencounts.count_tokens(documents(spark, list(enumerate(texts))), FILE, public_tokenizers.PATTERN).collect()
    check([(r, texts[r["doc_id"]]) for r in got])


def test_unusual_rows(spark):
    rows = [(1, "Hello"), (1, "Hello"), (2, None), (3, ""), (None, "x y"), (4, "word " * 200_000), (5, "a" * 300_000), (6, " " * 300_000)]
    docs = documents(spark, rows, ["n_tokens", "over_limit", "__text"])
    got = tokencounts.count_tokens(docs, FILE, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "text", "__text", "n_bytes", "n_tokens", "over_limit"]
    found = got.collect()
    assert len(found) == len(rows)
    check([(r, r["text"]) for r in found])
    assert tokencounts.count_tokens(docs.limit(0), FILE, public_tokenizers.PATTERN).count() == 0


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokencounts, "CACHE", 3)
    s = tokencounts.splitter(FILE, public_tokenizers.PATTERN)
    import numpy as np

    held = tokencounts.Lengths(s, "the a", np.array([3, 5]), np.array([1, 1]))
    words = [f" word{i % 7}{'x' * (i % 3)}" for i in range(200)] + ["the", " a"]
    assert [held[w] for w in words] == s.encoded(words)
    assert len(held) <= 5


def test_summaries_keep_frequent_items(spark, monkeypatch):
    monkeypatch.setattr(tokencounts, "SUMMARY", 8)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.7 else f"w{rng.randrange(5000)}" for _ in range(300))
             for _ in range(60)]
    top = tokencounts.frequent(documents(spark, list(enumerate(texts))).repartition(5), "text", FILE, public_tokenizers.PATTERN, 4)
    pieces = Counter(p for t in texts for p in tokencounts.splitter(FILE, public_tokenizers.PATTERN).pattern.findall(t))
    assert {k for k, _ in top} == {k for k, _ in pieces.most_common(4)} == {" the", " of", " and", " w"}
    assert all(n <= pieces[k] for k, n in top)
    with pytest.raises(ValueError):
        tokencounts.splitter(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)
