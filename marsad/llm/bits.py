"""Filters of fixed size over distributed keys: a table of bits that is never larger than stated."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of a piece of the table; pieces travel apart and meet on the driver, whose share is the table itself.
PIECE = 1 << 12
#: The largest table: 2 ** 27 bits are 16 MB.
MOST_BITS = 27
_SPREAD = np.uint64(0x9FB21C651E98DF25)


def size_for(n: int, least: int = 12, most: int = MOST_BITS) -> int:
    """log2 of the bits for n keys at about 16 bits a key, within fixed bounds; beyond them the filter only lets more through."""
    return max(least + 3, min(most, int(max(n, 1) * 16 - 1).bit_length()))


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where unsigned 64-bit keys fall in a table of 2 ** bits bits."""
    k = keys * _SPREAD
    return ((k ^ (k >> np.uint64(31))) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)


def held(table: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = places(keys, bits)
    return ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """The bits of all keys of a one-column table of longs, as packed bytes.

    Each task marks its own keys, pieces are joined by their number, and only the table of
    2 ** (bits - 3) bytes reaches the driver. Null keys are not allowed.
    """
    per = PIECE * 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0, np.int64)]
        for b in batches:
            seen.append(np.unique(places(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)))
            if len(seen) > 50:
                seen = [np.unique(np.concatenate(seen))]
        at = np.unique(np.concatenate(seen))
        starts = np.flatnonzero(np.concatenate([[True], at[1:] // per != at[:-1] // per])) if len(at) else np.zeros(0, int)
        data = [(p % per).astype(np.uint16).tobytes() for p in np.split(at, starts[1:])] if len(at) else []
        yield pa.RecordBatch.from_arrays([pa.array(at[starts] // per, pa.int64()), pa.array(data, pa.binary())], names=["piece", "at"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                maps.setdefault(p, np.zeros(per, np.uint8))[np.frombuffer(x, np.uint16)] = 1
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int64()), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())], names=["piece", "map"])

    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in keys.mapInArrow(mark, "piece long, at binary").repartition("piece").mapInArrow(join, "piece long, map binary").toLocalIterator():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(r.map, np.uint8)
    return out
