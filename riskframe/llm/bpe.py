"""Byte-level BPE with the tiktoken library: text to ids, ids to bytes.

Contract for unusual input: a null text is encoded as the empty text, which has
no ids; nulls in other columns pass through; empty tables stay empty; columns
whose names clash with an output are replaced by it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Longer texts are cut at safe boundaries into pieces of about this many characters.
PIECE = 1 << 16
#: Runs of white space from this length on are encoded by themselves.
LONG_SPACE = 1 << 12
# White space as Unicode defines it and as the pattern's \s sees it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")
_LONG_RUN = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


class Codec:
    """One rank file and one split pattern, without special tokens."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.single = tiktoken.Encoding("one", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        # In a run of white space before a visible character, the pattern takes all but the last
        # character as one match; at the end of a text it takes the whole run.
        for run in _LONG_RUN.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            self._pieces(text[at : run.start()], ids)
            ids += self.single.encode_ordinary(text[run.start() : stop])
            at = stop
        self._pieces(text[at:], ids)
        return ids

    def _pieces(self, text: str, ids: list[int]) -> None:
        """No match of the pattern crosses from a visible character to white space."""
        at = 0
        while len(text) - at > PIECE:
            cut = _BOUNDARY.search(text, at + PIECE)
            if cut is None:
                break
            ids += self.encoding.encode_ordinary(text[at : cut.start()])
            at = cut.start()
        ids += self.encoding.encode_ordinary(text[at:])

    def decode(self, ids) -> bytes:
        """The bytes of the ids; they need not be valid UTF-8 when ids were cut."""
        return self.encoding.decode_bytes(ids)


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> Codec:
    """One per Python worker."""
    return Codec(rank_file, pattern)


def _mapped(df: DataFrame, column: str, outputs: list[T.StructField], make) -> DataFrame:
    """``df`` with columns made from one column, batch by batch; rows stay where they are."""
    names = [f.name for f in outputs]
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + outputs)

    def run(batches):
        for batch in batches:
            made = make(batch.column(batch.schema.get_field_index(column)))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept] + made
            yield pa.RecordBatch.from_arrays(arrays, names=kept + names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` and an array of token ids for each text."""

    def make(column):
        c = codec(rank_file, pattern)
        return [pa.array([c.encode(t) for t in column.to_pylist()], pa.list_(pa.int32()))]

    return _mapped(df, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` and the raw bytes of each array of ids; a null array is empty bytes."""

    def make(column):
        c = codec(rank_file, pattern)
        return [pa.array([c.decode(x or []) for x in column.to_pylist()], pa.binary())]

    return _mapped(df, ids, [T.StructField(out, T.BinaryType())], make)


def round_trip(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids_column: str | None = None) -> DataFrame:
    """``df`` with token count and digests of ids and decoded bytes, and the ids if a column for them is named."""

    def make(column):
        c = codec(rank_file, pattern)
        counts, coded, decoded, kept = [], [], [], []
        for value in column:
            ids = c.encode(value.as_py())
            counts.append(len(ids))
            coded.append(hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest())
            decoded.append(hashlib.sha256(c.decode(ids)).hexdigest())
            if ids_column:
                kept.append(array("i", ids))
        made = [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
        return made + ([pa.array(kept, pa.list_(pa.int32()))] if ids_column else [])

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if ids_column:
        fields.append(T.StructField(ids_column, T.ArrayType(T.IntegerType())))
    return _mapped(df, text, fields, make)
