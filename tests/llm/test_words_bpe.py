import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from helpers import documents, shingles, spaced

from riskframe.llm import bpe, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["Ab aB\tc\x0bab", None, "", "  \n ", "äÖ x y ÄÖ", "one " * 5000, "a" * 3_000_000, "ab ab"]


def test_equal_words_and_only_equal_words_share_a_hash():
    seen = {}
    for t in words.tokens(pa.array(TEXTS)):
        for row in range(t.rows):
            own = t.hashes[t.bounds[row] : t.bounds[row + 1]].tolist()
            want = spaced(TEXTS[t.first + row])
            assert len(own) == len(want)
            for h, w in zip(own, want, strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("size", [1, 4, 5])
def test_shingles_match_plain_python(size):
    for t in words.tokens(pa.array(TEXTS)):
        made, bounds = words.shingles(t, size)
        for row in range(t.rows):
            own = np.unique(made[bounds[row] : bounds[row + 1]])
            assert len(own) == len(shingles(TEXTS[t.first + row], size))


def test_slices_of_a_column_are_read_from_their_offset():
    column = pa.array(["x y", "a b c", None, "d"]).slice(1, 3)
    (t,) = words.tokens(column)
    assert t.bounds.tolist() == [0, 3, 3, 4]


def plain():
    ranks = bpe.codec(RANKS, public_tokenizers.PATTERN).encoding._mergeable_ranks
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_texts_encode_as_in_one_piece(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "LONG_SPACE", 7)
    monkeypatch.setattr(bpe, "_LONG_RUN", __import__("re").compile(f"[{bpe._SPACE}]{{7,}}"))
    codec, whole = bpe.codec(RANKS, public_tokenizers.PATTERN), plain()
    rng = random.Random(3)
    alphabet = ["a", "Zé", " ", "  ", "\n", "\t", " ", " ", "7", "'s", "!?", "<|endoftext|>", "漢", " " * 9, "\n" * 8 + " ", "\x1c"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200)))
        ids = codec.encode(text)
        assert ids == whole.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_very_long_runs_of_white_space():
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    for text in ("a" + " " * 300_000 + "b", "\n" * 200_000):
        assert codec.decode(codec.encode(text)) == text.encode()


def test_round_trip_handles_nulls_clashes_and_empty_tables(spark):
    docs = documents(spark, [(1, "Hello, wörld"), (2, None), (3, ""), (None, "x"), (1, "Hello, wörld")], ["n_tokens", "ids"])
    rows = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, ids_column="token_ids").collect()
    assert len(rows) == 5
    by_text = {r["text"]: r for r in rows}
    ids = plain().encode_ordinary("Hello, wörld")
    assert by_text["Hello, wörld"]["token_ids"] == ids and by_text["Hello, wörld"]["n_tokens"] == len(ids)
    assert by_text["Hello, wörld"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert by_text["Hello, wörld"]["decoded_sha256"] == hashlib.sha256("Hello, wörld".encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    for text in (None, ""):
        assert (by_text[text]["n_tokens"], by_text[text]["ids_sha256"], by_text[text]["decoded_sha256"]) == (0, empty, empty)
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    there = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(there, RANKS, public_tokenizers.PATTERN).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
