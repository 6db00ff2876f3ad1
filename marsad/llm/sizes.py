"""Sizes of texts in tokens of a public byte-level BPE vocabulary, read from a file that is named, never copied."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from marsad.llm import forms

#: The vocabulary file; callers may name another one of the same kind.
TOKENIZER = os.environ.get("MARSAD_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")

# Fixed value: how byte-level BPE vocabularies of this family cut text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter(dict):
    """Piece of text -> number of tokens. Merges never cross pieces, so sizes add up exactly; memory is bounded."""

    def __init__(self, path: str, limit: int = 150_000):
        import regex
        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pieces = regex.compile(PATTERN).findall
        self.limit = limit

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = len(self.encode(piece))
        if len(piece) < 40:
            self[piece] = n
        return n

    def size(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_sizes(df: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` columns and n_tokens of each row; null and empty texts have 0 tokens."""
    path = path or TOKENIZER
    fields = [df.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in forms.slices(batches):
            n = pa.array([c.size(x) if x else 0 for x in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], n], names=[*keep, "n_tokens"])

    return df.select(*keep, text).mapInArrow(run, schema)
