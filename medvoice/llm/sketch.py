"""Saturating counters of hashes, built in parts by all tasks and merged by range.

A sketch has ``depth`` places per hash among ``2**bits`` counters that stop at two, so
it is a pair of bit arrays: seen once, seen twice. Places may share one range (a pair of
Bloom filters) or have a range per row (count-min). Counts are never underestimated, so
whatever occurs twice is always reported; a crowded sketch reports more than that, and
only costs later steps work. The size is a parameter and does not grow with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from medvoice.llm.arrays import mix

SEGMENT_BITS = 20
# Places a task holds before it hands them on.
HELD = 6_000_000
SCHEMA = "segment int, once binary, twice binary"


def places(hashes: np.ndarray, row: int, bits: int, shared: bool) -> np.ndarray:
    """Counter numbers of some hashes in one row."""
    at = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (1 << 64) - 1)) >> np.uint64(64 - bits)
    return at.astype(np.int64) + (0 if shared else row << bits)


def pack(sorted_places: np.ndarray) -> bytes:
    """Ascending numbers as gaps of one byte, where 255 means "255 more"."""
    gaps = np.diff(sorted_places, prepend=0)
    full = gaps // 255
    out = np.full(len(gaps) + int(full.sum()), 255, dtype=np.uint8)
    out[np.cumsum(full + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, dtype=np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw < 255]


def _parts(held: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
    every = np.sort(np.concatenate(held))
    new = np.concatenate(([True], every[1:] != every[:-1]))
    once = every[new]
    twice = np.unique(every[~new])
    cuts = np.unique(once >> SEGMENT_BITS)
    for s in cuts:
        low, high = s << SEGMENT_BITS, (s + 1) << SEGMENT_BITS
        a = once[np.searchsorted(once, low) : np.searchsorted(once, high)] - low
        b = twice[np.searchsorted(twice, low) : np.searchsorted(twice, high)] - low
        yield int(s), pack(a), pack(b)


class Sketch:
    """The merged "seen twice" bits; a plain object that is broadcast to the tasks."""

    def __init__(self, bits: int, depth: int, shared: bool):
        self.bits, self.depth, self.shared = bits, depth, shared
        self.twice = np.zeros(((1 if shared else depth) << bits) // 8, dtype=np.uint8)

    def __getstate__(self) -> dict:
        # Broadcast compressed: most bits are 0 unless the sketch is crowded.
        return {**self.__dict__, "twice": zlib.compress(self.twice.tobytes(), 1)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = {**state, "twice": np.frombuffer(zlib.decompress(state["twice"]), dtype=np.uint8)}

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """True for every hash that was added twice or more, and for some others."""
        out = np.ones(len(hashes), dtype=bool)
        for row in range(self.depth):
            at = places(hashes, row, self.bits, self.shared)
            out &= (self.twice[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return out


def build(
    df: DataFrame,
    hashes: Callable[[Iterable[pa.RecordBatch]], Iterable[np.ndarray]],
    bits: int,
    depth: int,
    shared: bool = False,
) -> Sketch:
    """Sketch of all hashes that ``hashes`` makes of the table's batches.

    Tasks send the places they saw as gaps, about a byte each; the parts of one
    range meet in one task, which keeps two bit arrays of fixed size per range.
    """
    if bits < SEGMENT_BITS:
        raise ValueError(f"at least {SEGMENT_BITS} bits")

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            rows = list(zip(*_parts(held)))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
                names=["segment", "once", "twice"],
            )

        for some in hashes(batches):
            for row in range(depth if len(some) else 0):
                held.append(places(some, row, bits, shared))
                size += len(some)
            if size > HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def merged(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for frame in frames:
            for s, once, twice in zip(frame["segment"], frame["once"], frame["twice"]):
                if s not in state:
                    state[s] = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
                have, double = state[s]
                at = unpack(once)
                double[at[have[at]]] = True
                have[at] = True
                double[unpack(twice)] = True
        for s, (_, double) in state.items():
            if double.any():
                yield pd.DataFrame({"segment": [s], "twice": [np.packbits(double).tobytes()]})

    sketch = Sketch(bits, depth, shared)
    tasks = max(1, len(sketch.twice) >> (SEGMENT_BITS - 3))
    parts = (
        df.mapInArrow(seen, SCHEMA)
        .repartition(min(128, tasks), "segment")
        .mapInPandas(merged, "segment int, twice binary")
    )
    wide = 1 << (SEGMENT_BITS - 3)
    for row in parts.collect():
        sketch.twice[row["segment"] * wide : (row["segment"] + 1) * wide] = np.frombuffer(row["twice"], dtype=np.uint8)
    return sketch
